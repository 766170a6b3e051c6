"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

1. Targets. Sources (by code point, null last) weigh 1, 2, 3, repeating, and share all words; no target exceeds ``MOST_PASSES``
   times its source's words, and the excess is shared again by weight (one ordered pass: water filling).
2. Blocks. A hash of each row puts it into one of its source's blocks, in random order. A source is taken whole as often as
   its target holds it, and then in block order up to the rest: whole blocks, then rows of the next block. A row that no longer
   fits is passed by, and a next run goes on over the later rows that do, until none does; then single rows bring it nearest. Sources of any size only need sums by block; rows never meet by source.
3. Quotas. Every (pass, block) is a unit. A tree over the output shards splits the units: a node's left half gets as many units as
   its shards hold, drawn without replacement from all sources, which is a multivariate hypergeometric draw of the quotas.
   Quotas are exact: shards add up to every source's units.
4. Draw. A source's units are permuted, and each shard takes the next run of them as long as its quota: the draws are disjoint.
   Rows are sorted by a hash within their shard. All random choices are hashes of values and ``seed``; reruns agree.

Nulls: a null text has no words, a null source is a source, a null doc_id is a value. Rows without words are taken as their block
is. Equal rows (same id, source and text) share a hash and are taken alike.
Documents are drawn whole: no document that is left out would fit into what a source lacks of its target, unless a row's copies
do not fit together. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import table, unit_hash, word_count, written
from clickloom.session import broadcast_if_small

MOST_PASSES = 3
WEIGHTS = 3
BLOCK_WORDS = 1 << 14
MOST_BLOCKS = 1 << 20
SHARD_WORDS = 1 << 25
FILLERS = 3
_SPAN = 1 << 62
_STEP = 1_000_000_007  # a prime above any number of units, so that multiplying by it permutes them


def narrow(docs: DataFrame, seed: int = 0) -> DataFrame:
    """What the plan needs of each row, stored once: row, doc_id, source, size, u."""
    return written(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"), _place(seed).alias("u"),
    ), "mix-rows")


def _place(seed: int) -> Column:
    return unit_hash("doc_id", "source", "text", seed=seed)


def _block(u: Column, blocks: Column) -> Column:
    return F.least(F.floor(u / F.lit(float(_SPAN)) * blocks), blocks - 1).cast("long")


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, weight, target. As many rows as there are sources."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1).withColumn(
        "weight", (F.col("rank") % WEIGHTS + 1).cast("long"))
    cap, everything = MOST_PASSES * F.col("source_size"), Window.partitionBy()
    by_level = Window.orderBy(cap / F.col("weight"), "rank")
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        / F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levelled = ranked.withColumn("level", level).withColumn("free", cap > F.col("level") * F.col("weight"))
    final = F.max(F.when(F.col("free"), F.col("level"))).over(everything)  # the first free source's; later ones are lower
    return levelled.withColumn("target", F.coalesce(F.least(cap.cast("double"), final * F.col("weight")), cap.cast("double"))).select(
        "source", "rank", "source_size", "weight", "target")


def plan(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """How to take each source: passes (whole), blocks, last (block of the first run), runs, fillers (hashes), units."""
    size = F.col("source_size")
    wanted = targets(rows).withColumns({
        "blocks": F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCKS), F.ceil(size / block_words))).cast("long"),
        "passes": F.when(size > 0, F.least(F.lit(MOST_PASSES), F.floor(F.col("target") / size))).otherwise(0).cast("long"),
    }).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * size))
    wanted = broadcast_if_small(wanted)
    partial = wanted.where((size > 0) & (F.col("passes") < MOST_PASSES))
    units = written(_with_source(rows, partial).groupBy("rank", "u").agg(F.first("size").alias("size"), F.sum("size").alias("total")), "mix-units")
    edge = broadcast_if_small(partial.select(
        "rank", "blocks", "passes", F.col("rest").alias("gap"), F.lit(-1).cast("long").alias("start"), F.lit(None).cast("long").alias("last"),
        F.array().cast("array<struct<lo:bigint,block:bigint,upto:bigint,most:double>>").alias("runs"),
        F.array().cast("array<bigint>").alias("fillers")))
    while not edge.where("start IS NOT NULL").isEmpty():
        edge = _run(units, edge)

    for _ in range(FILLERS):
        gain = F.floor(F.col("gap") - F.abs(F.col("total") - F.col("gap"))).cast("long")  # how much nearer a row brings the source
        over = (F.col("total") > F.col("gap")).cast("long")
        free = units.join(edge, "rank").where((gain > 0) & ~_partial())
        packed = ((2 * gain + over).cast("decimal(18,0)") * F.lit(_SPAN).cast("decimal(19,0)") + F.col("u")).cast("decimal(38,0)")
        best = free.groupBy("rank").agg(F.max(packed).alias("best"))
        found = best.select("rank", (F.col("best") % F.lit(_SPAN).cast("decimal(38,0)")).cast("long").alias("u1"),
                            F.expr(f"best div {_SPAN}BD").cast("long").alias("code"))
        gain1, gap = F.floor(F.col("code") / 2), F.col("gap")
        edge = broadcast_if_small(edge.join(found, "rank", "left").withColumns({
            "fillers": F.when(F.col("u1").isNotNull(), F.array_append("fillers", F.col("u1"))).otherwise(F.col("fillers")),
            "gap": F.when(F.col("code").isNull(), gap).when(F.col("code") % 2 == 1, gain1 - gap).otherwise(gap - gain1),
        }).drop("u1", "code"))

    whole = wanted.join(edge.select("rank", "last", "runs", "fillers"), "rank", "left")
    return broadcast_if_small(whole.withColumns({
        "last": F.coalesce("last", F.lit(-1)), "fillers": F.coalesce("fillers", F.array().cast("array<bigint>")),
    }).withColumn("units", F.col("passes") * F.col("blocks") + F.when(F.col("passes") < MOST_PASSES, F.col("last") + 1).otherwise(0)))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    named = sources.withColumnRenamed("source", "_mix_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")


def _run(units: DataFrame, edge: DataFrame) -> DataFrame:
    """Take, in order of the hash after ``start``, all rows of at most ``gap`` words up to the first that no longer fits.

    The next run starts at the first later row that fits what is left; a source without one has no start. Rows that a run passes by
    are longer than its gap, so that they fit no later one.
    """
    block = _block(F.col("u"), F.col("blocks"))
    open_ = (F.col("u") > F.col("start")) & (F.col("size") <= F.col("gap"))

    sums = units.join(edge, "rank").where(open_).groupBy("rank", block.alias("block")).agg(F.sum("total").alias("words"), F.first("gap").alias("gap"))
    upto = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)  # at most MOST_BLOCKS short rows
    over = F.col("end") > F.col("gap")
    ends = sums.withColumn("end", F.sum("words").over(upto)).groupBy("rank").agg(
        F.max("end").alias("all_words"), F.min(F.when(over, F.col("block"))).alias("cut"),
        F.min_by(F.col("end") - F.col("words"), F.when(over, F.col("block"))).alias("base"))
    edge = broadcast_if_small(edge.join(ends, "rank", "left"))

    running = F.sum("total").over(Window.partitionBy("rank").orderBy("u"))  # rows of one block
    fits = units.join(edge, "rank").where(open_ & (block == F.col("cut"))).withColumn("run", F.col("base") + running).where(F.col("run") <= F.col("gap"))
    edge = edge.join(fits.groupBy("rank").agg(F.max("u").alias("upto"), F.max("run").alias("taken")), "rank", "left")
    found = F.col("start").isNotNull() & F.col("all_words").isNotNull()
    cut = F.coalesce("cut", F.col("blocks"))
    run = F.struct(F.col("start").alias("lo"), cut.alias("block"), F.coalesce("upto", F.lit(-1).cast("long")).alias("upto"), F.col("gap").alias("most"))
    left = F.col("gap") - F.when(F.col("cut").isNull(), F.col("all_words")).otherwise(F.coalesce("taken", "base"))
    edge = broadcast_if_small(edge.select(
        "rank", "blocks", "passes", F.when(found, left).otherwise(F.col("gap")).alias("gap"),
        F.coalesce("last", F.when(found, F.least(cut, F.col("blocks") - 1)).otherwise(F.lit(0))).alias("last"),
        F.when(found, F.array_append("runs", run)).otherwise(F.col("runs")).alias("runs"), "fillers",
        F.when(found & F.col("cut").isNotNull(), F.struct(F.col("cut").alias("block"), F.coalesce("upto", F.lit(-1).cast("long")).alias("upto"))).alias("at")))

    later = (block > F.col("at.block")) | (block == F.col("at.block")) & (F.col("u") > F.col("at.upto"))
    starts = units.join(edge, "rank").where(later & (F.col("total") > 0) & (F.col("total") <= F.col("gap"))).groupBy("rank").agg(
        (F.min("u") - 1).alias("start"))
    return broadcast_if_small(edge.drop("at").join(starts, "rank", "left"))


def _partial() -> Column:
    """Whether the last, partial pass takes a row."""
    u, block = F.col("u"), _block(F.col("u"), F.col("blocks"))
    in_run = F.exists("runs", lambda x: (u > x["lo"]) & (F.col("size") <= x["most"]) & (
        (block < x["block"]) | (block == x["block"]) & (u <= x["upto"])))
    return (F.col("passes") < MOST_PASSES) & (F.coalesce(in_run, F.lit(False)) | F.array_contains("fillers", u))


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` from ``total`` are among the ``good``: the inverse of the distribution at ``u`` (0 to 1).

    The weights run upwards by the ratio of neighbours, over twelve standard deviations on both sides of the mean: what lies
    beyond is below the precision of a double.
    """
    mean = drawn * good / total
    spread = 12 * F.sqrt(mean * (1 - good / total) * (total - drawn) / F.greatest(total - 1, F.lit(1))) + 12
    least = F.greatest(F.lit(0), drawn + good - total, F.floor(mean - spread)).cast("long")
    most = F.least(drawn, good, F.ceil(mean + spread)).cast("long")
    span = F.sequence(least, most)

    def ratio(k: Column) -> Column:
        return (good - k) * (drawn - k) / ((k + 1) * F.greatest(total - good - drawn + k + 1, F.lit(1)))

    whole = F.aggregate(span, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), lambda a, k: F.struct(
        (a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum")))["sum"]
    found = F.aggregate(
        span, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), least.alias("at"), (whole * u).alias("goal")), lambda a, k: F.struct(
            (a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum"),
            F.when(a["sum"] + a["w"] < a["goal"], F.least(k + 1, most)).otherwise(a["at"]).alias("at"), a["goal"].alias("goal")))["at"]
    return F.when((good <= 0) | (drawn <= 0), F.lit(0)).when(drawn >= total, good).otherwise(found).cast("long")


def quotas(sources: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """shard, rank, quota: the splitting tree, one level at a time; a node is one row with all sources' quotas."""
    node = sources.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", "units"))).alias("s")).select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.transform("s", lambda x: x["rank"]).alias("ranks"),
        F.transform("s", lambda x: x["units"]).alias("q")).withColumn("all", F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x))

    def held(lo: Column, hi: Column) -> Column:  # units of the shards lo to hi - 1
        return F.floor(F.col("all") * hi / shards) - F.floor(F.col("all") * lo / shards)

    levels = 0
    while 1 << levels < shards:
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        start = F.struct(held(F.col("lo"), mid).cast("long").alias("left"), held(F.col("lo"), F.col("hi")).cast("long").alias("total"),
                         F.array().cast("array<bigint>").alias("drawn"))

        def draw(a: Column, x: Column) -> Column:
            u = unit_hash(F.lit(levels), F.col("lo"), F.size(a["drawn"]), seed=seed + 1) / F.lit(float(_SPAN))
            taken = hypergeometric(a["total"], x, a["left"], u)
            return F.struct((a["left"] - taken).alias("left"), (a["total"] - x).alias("total"), F.array_append(a["drawn"], taken).alias("drawn"))

        halves = node.withColumn("mid", mid).withColumn("first", F.aggregate("q", start, draw)["drawn"])
        parts = F.when(F.col("hi") - F.col("lo") > 1, F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("first").alias("q")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), F.zip_with("q", "first", lambda a, b: a - b).alias("q")),
        )).otherwise(F.array(F.struct("lo", "hi", "q")))
        node = halves.select("ranks", "all", F.explode(parts).alias("part")).select("ranks", "all", "part.*")
        levels += 1
    return node.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("ranks", "q")).alias("x")).select(
        "shard", F.col("x.ranks").alias("rank"), F.col("x.q").alias("quota"))


def unit_shards(sources: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """rank, slot, shard: which shard holds each place of a source's permuted units."""
    split = written(quotas(sources, shards, seed), "mix-quotas")
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begun = split.withColumn("from", F.coalesce(F.sum("quota").over(before), F.lit(0))).where("quota > 0")
    return begun.select("rank", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("quota") - 1)).alias("slot"), "shard")


def draw(rows: DataFrame, sources: DataFrame, shards: int, seed: int = 0, keep: bool = False) -> DataFrame:
    """One row per drawn copy, with its shard and its place there; ``keep`` also leaves rows that are not drawn (shard null)."""
    placed = _with_source(rows, sources)
    block = _block(F.col("u"), F.col("blocks"))
    whole = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda p: F.when(
        p < F.col("passes"), p * F.col("blocks") + block).when(
            _partial(), p * F.col("blocks") + F.when(block <= F.col("last"), block).otherwise(block % (F.col("last") + 1))))
    units = F.filter(whole, lambda x: x.isNotNull())
    shift = unit_hash("rank", seed=seed + 2) % F.col("units")
    exploded = placed.withColumn("_mix_unit", (F.explode_outer if keep else F.explode)(units)).withColumn(
        "slot", (F.col("_mix_unit") * _STEP + shift) % F.col("units"))
    shard = unit_shards(sources, shards, seed)
    drawn = exploded.join(shard, ["rank", "slot"], "left" if keep else "inner")
    return drawn.withColumn("place", unit_hash("u", "_mix_unit", seed=seed + 3))


def shard_count(sources: DataFrame, shard_words: int = SHARD_WORDS) -> int:
    words = sources.agg(F.sum("target")).first()[0] or 0
    return max(1, -(-int(words) // shard_words))


def mix_report(docs: DataFrame, seed: int = 0, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words of its drawn copies), shards (where they went)."""
    rows = narrow(docs.select("doc_id", "source", "text"), seed)
    sources = plan(rows, block_words)
    drawn = draw(rows, sources, shard_count(sources, shard_words), seed, keep=True)
    return drawn.groupBy("row", "doc_id", "size", "source_size", "target").agg(
        F.count("shard").alias("copies"), F.array_sort(F.collect_list("shard")).alias("shards")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "shards")


def mix(docs: DataFrame, seed: int = 0, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixed documents themselves (their own columns), copies repeated, in the order of shards and places."""
    rows = narrow(docs.select("doc_id", "source", "text"), seed)
    sources = plan(rows, block_words)
    whole = docs.select("source", _place(seed).alias("u"), word_count(F.col("text")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    drawn = draw(whole, sources, shard_count(sources, shard_words), seed).select("shard", "place", "_doc")
    return drawn.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select("_doc.*")


def op10_mixing(spark, sf_dir) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
