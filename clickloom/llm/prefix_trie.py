"""The trie of conversation prefixes, with figures of every node's subtree.

Prefixes are known by running sums (exclusive or) of two 64-bit hashes of (place, turn), so that a very long conversation is cut
into blocks and no task walks it whole. The smallest member owns a node: a conversation owns one stretch of its own path, and a
node is (conv_id, depth). Nodes are dealt to shards by blocks of neighbouring owners and of depth. Within a shard, time-forward
processing passes subtree totals to parents (``forward``); what hangs below a node of another shard is a bundle, and the totals
of bundles are found across shards by doubling, in as many rounds as the logarithm of the height of the tree of bundles.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.common import joined, partitions, ranked, ship_code, sql_crc32, table, written
from clickloom.llm.forward import BUNDLES, bundle_sums, subtree_totals

MOST_HEAD = 8
#: Turns of one conversation in a block, members of a node in a chunk, and nodes in a shard (about).
BLOCK = 4096
CHUNK = 1024
SHARD_NODES = 250_000
OWNERS = 64
LEVELS = 2048
KEY = ["depth", "key_a", "key_b"]


def _block(at: Column, size: int) -> Column:
    return F.floor(at / F.lit(size)).cast("long")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_HEAD + 1)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, n_bytes, length) of every rebuilt turn, and (conv_id, length) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    placed = written(ranked(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], "turns").drop("turn"), "placed")
    convs = placed.groupBy("conv_id").agg(F.first("width").alias("width")).withColumn("h", head_length(F.col("conv_id"))).withColumn(
        "leader", F.col("conv_id") - F.col("conv_id") % 5)
    widths = convs.select(F.col("conv_id").alias("leader"), F.col("width").alias("leader_width"))
    convs = written(convs.join(widths, "leader", "left").withColumn(
        "head", F.least("h", F.coalesce("leader_width", F.lit(0)))).withColumn(
        "length", F.col("head") + F.greatest(F.col("width") - F.col("h"), F.lit(0))).drop("leader_width"), "conversations")
    parts = convs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), _block(F.col("width") - 1, BLOCK))))
    own = placed.where(F.col("rank") >= head_length(F.col("conv_id"))).withColumn("part", _block(F.col("rank"), BLOCK)).join(
        parts.select("conv_id", "part", "h", "head", "length"), ["conv_id", "part"]).select(
        "conv_id", (F.col("rank") - F.col("h") + F.col("head") + 1).alias("depth"), "digest", "n_bytes", "length")
    heads = placed.where(F.col("rank") < MOST_HEAD).select(F.col("conv_id").alias("leader"), "rank", "digest", "n_bytes")
    taken = convs.where("head > 0").join(heads, "leader").where("rank < head").select(
        "conv_id", (F.col("rank") + 1).alias("depth"), "digest", "n_bytes", "length")
    return written(own.unionByName(taken), "rebuilt"), convs.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the keys of the prefix that ends there (key_a, key_b) and of the one before (parent_a, parent_b)."""
    terms = turns.select("conv_id", "depth", "n_bytes", "length", _block(F.col("depth") - 1, BLOCK).alias("block"),
                         *[F.xxhash64(F.lit(seed), "depth", "digest").alias(f"term_{name}") for seed, name in ((1, "a"), (2, "b"))])
    sums = [F.bit_xor(f"term_{name}").alias(f"sum_{name}") for name in "ab"]
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = terms.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(*sums).select(
        "conv_id", "block", *[F.bit_xor(f"sum_{name}").over(earlier).alias(f"before_{name}") for name in "ab"])
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    out = terms.withColumns({f"run_{name}": F.bit_xor(f"term_{name}").over(here) for name in "ab"}).join(
        offsets, ["conv_id", "block"], "left")
    for name in "ab":
        key = F.col(f"run_{name}").bitwiseXOR(F.coalesce(f"before_{name}", F.lit(0).cast("long")))
        out = out.withColumn(f"key_{name}", key).withColumn(f"parent_{name}", F.col(f"key_{name}").bitwiseXOR(F.col(f"term_{name}")))
    return out.select("conv_id", "depth", "key_a", "key_b", "parent_a", "parent_b", "n_bytes", (F.col("depth") == F.col("length")).alias("last"))


def _streamed_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each key over its chunks, which come in order; a batch of chunks is held at a time."""
    key, state = None, None

    def batch_of(found):
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])],
                                          names=[*KEY, "ends_sha256"])

    for batch in batches:
        out = []
        for *now, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
            if now != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = now, sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield batch_of(out)
    yield batch_of([] if key is None else [(*key, state.hexdigest())])


def ends(ending: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) for the conversations (KEY, conv_id) that end at a node. Any number may: their ids are joined in
    chunks of ``CHUNK``, and the chunks of a node with several run through its hash one after another."""
    chunks = ranked(ending, KEY, [F.col("conv_id")], "ends").groupBy(*KEY, "width", _block(F.col("rank"), CHUNK).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    chunks = written(chunks, "end-chunks")
    small = chunks.where(F.col("width") <= CHUNK).select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))
    large = chunks.where(F.col("width") > CHUNK).select(*KEY, "chunk", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    return small.unionByName(large.mapInArrow(_streamed_hash, "depth long, key_a long, key_b long, ends_sha256 string"))


def _nodes(conversations: DataFrame) -> DataFrame:
    turns, convs = rebuilt(conversations)
    rows = written(prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in KEY], "conv_id", "n_convs", F.lit(None).cast("long").alias("parent_a"),
        F.lit(None).cast("long").alias("parent_b"), zero.alias("n_bytes"))
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent_a").alias("parent_a"),
                                   F.min("parent_b").alias("parent_b"), F.min("n_bytes").alias("n_bytes")).unionByName(root)
    nodes = written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("key_a"),
                                                F.col("parent_b").alias("key_b")).agg(F.count("*").alias("n_children"))
    ending = rows.where("last").select(*KEY, "conv_id").unionByName(
        convs.where("length = 0").select(*[zero.alias(c) for c in KEY], "conv_id"))
    full = nodes.join(children, KEY, "left").join(ends(ending), KEY, "left").select(
        "conv_id", "depth", (F.col("depth") - 1).alias("parent_depth"), "parent_a", "parent_b", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    owners = nodes.select(F.col("depth").alias("parent_depth"), F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"),
                          F.col("conv_id").alias("parent_conv_id"))
    return joined(written(full, "nodes"), owners, ["parent_depth", "parent_a", "parent_b"], "left").drop("parent_depth", "parent_a", "parent_b")


def _shard(conv_id: Column, depth: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(_block(conv_id, OWNERS), _block(depth, LEVELS)), F.lit(shards).cast("long"))


def _across(bundles: DataFrame, portals: DataFrame) -> DataFrame:
    """Bundles with the totals of all that hangs below them, by doubling: after r rounds a bundle has what is less than 2^r below."""
    above = portals.select(F.col("conv_id").alias("bundle_conv"), F.col("depth").alias("bundle_depth"),
                           F.struct("shard", "bundle_conv", "bundle_depth").alias("jump"))
    table_ = written(bundles.withColumn("id", F.struct("shard", "bundle_conv", "bundle_depth")).join(
        above, ["bundle_conv", "bundle_depth"], "left").select("id", "jump", "leaves", "saved"), "bundles")
    while not table_.where("jump IS NOT NULL").isEmpty():
        passed = table_.where("jump IS NOT NULL").groupBy("jump").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jumps = table_.select(F.col("id").alias("jump"), F.col("jump").alias("next")).where("next IS NOT NULL")
        step = table_.join(passed.withColumnRenamed("jump", "id"), "id", "left").select(
            "id", "jump", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        table_ = written(joined(written(step, "bundles"), jumps, ["jump"], "left").select("id", F.col("next").alias("jump"), "leaves", "saved"), "bundles")
    return table_.select("id.*", "leaves", "saved")


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation and are left out. Turns are ordered by ``turn`` (null first), those with the
    same ``turn`` by the hash of role and text; repeated rows are turns of their own. A null role or text is empty. ``c % 5`` has
    the sign of ``c``. Other columns are not read; an empty table gives no rows, not even the root.
    """
    spark = conversations.sparkSession
    ship_code(spark)
    nodes = written(_nodes(conversations), "owned")
    shards = max(partitions(spark), nodes.count() // SHARD_NODES)
    above = F.col("shard") == _shard(F.col("parent_conv_id"), F.col("depth") - 1, shards)  # a hash passes over nulls: the root has a number too
    nodes = nodes.withColumn("shard", _shard(F.col("conv_id"), F.col("depth"), shards)).withColumn(
        "up", F.col("parent_conv_id").isNotNull() & above).withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    doors = nodes.where("NOT up AND parent_conv_id IS NOT NULL").select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).distinct().withColumn("portal", F.lit(True))
    flagged = nodes.drop("ends_sha256", "n_convs").join(doors, ["conv_id", "depth"], "left").withColumn("portal", F.coalesce("portal", F.lit(False)))
    found = written(flagged.repartition("shard").sortWithinPartitions("shard", "depth", "parent_conv_id", "conv_id").mapInArrow(
        bundle_sums, BUNDLES), "bundle-sums")
    totals = _across(found.where("kind = 'sum'").select("shard", "bundle_conv", "bundle_depth", "leaves", "saved"),
                     found.where("kind = 'portal'").select("conv_id", "depth", "shard", "bundle_conv", "bundle_depth"))
    more = totals.groupBy(F.col("bundle_conv").alias("conv_id"), F.col("bundle_depth").alias("depth")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    ready = nodes.join(more, ["conv_id", "depth"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).withColumn(
        "saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))).drop("more_leaves", "more_saved")
    out = ready.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "conv_id").mapInArrow(subtree_totals, ready.schema)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), "ends_sha256")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP12_SQL = f"""
WITH RECURSIVE {sql_crc32('SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL', 'crcs')},
plain AS (SELECT conv_id, turn, text, sha256(octet_length(encode(role)) || ':' || role || text) AS digest
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS rank FROM plain),
convs AS (SELECT id AS conv_id, crc % 9 AS h, id - id % 5 AS leader,
  least(crc % 9, (SELECT count(*) FROM own WHERE own.conv_id = id - id % 5)) AS head FROM crcs),
rebuilt AS (
  SELECT c.conv_id, rank + 1 AS depth, digest, text FROM convs c JOIN own ON own.conv_id = leader AND rank < h
  UNION ALL
  SELECT c.conv_id, rank - h + head + 1, digest, text FROM convs c JOIN own ON own.conv_id = c.conv_id AND rank >= h),
paths AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS n_bytes,
    string_agg(',' || digest, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(n_bytes) AS saved,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, path),
children AS (SELECT left(path, 65 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
totals AS (SELECT left(path, 65 * k) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN totals USING (path) LEFT JOIN counted p ON c.depth > 0 AND p.path = left(c.path, 65 * (c.depth - 1))
"""
