"""A Merkle manifest of a table: one tree for each language, one over their roots, and a proof for every row.

Leaves are hashes of rows. In a tree every two consecutive nodes become the hash of their joined digests (a last one alone: of
its own) until one remains. The tree is built ``STEP`` halvings at a time: a stored node row holds its digest, the siblings on
the way to its ancestor ``STEP`` halvings up, and the key of that ancestor, its parent row. The top node of a language is the
child of the tree over all languages (``TOP``). Proofs are one recursive query: every leaf climbs from row to parent row,
appends the siblings and folds its (possibly tampered) digest with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import ranked, sql_crc32, table, written

STEP = 10
FAN = 1 << STEP
TOP = ""
#: Climbing rows that meet at one copy of a stored node; nodes above more leaves are stored in several copies.
MEET = 2048


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text: no two lists of fields share a text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, changed) for every row. ``changed`` is the digest with n_chars one higher where 7 divides
    crc32(doc_id), else null; null doc_ids are never tampered with, and a null n_chars stays null.

    ``tree`` is ``-`` for a null language and ``=`` before any other, so that its byte order has null first.
    """
    def digest(n_chars: Column) -> Column:
        return F.unhex(F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars),
                                       field(F.col("text"))), 256))

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
                       digest(F.col("n_chars")).alias("hash"),
                       F.when(hit & F.col("n_chars").isNotNull(), digest(F.col("n_chars") + 1)).alias("changed"))


def _halved(digests: Column, top: Column) -> Column:
    """The next level of a block. The last node of a whole tree is not hashed again."""
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) + 1) / 2).cast("int") - 1), lambda i: F.sha2(
        F.concat(F.get(digests, 2 * i), F.coalesce(F.get(digests, 2 * i + 1), F.lit(""))), 256))
    return F.when(top & (F.size(digests) == 1), digests).otherwise(pairs)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of at most ``FAN`` neighbours (columns tree, width, pos, hash and those of ``_NODE``), one row each.

    ``rows`` has every node with its ``path``, the siblings up to the block's own digest ``up_hash``.
    """
    blocks = nodes.groupBy("tree", "width", F.shiftright("pos", STEP).alias("up_pos")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash", "leaves", "doc_id", "changed"))).alias("kids"), F.sum("leaves").alias("up_leaves"))
    blocks = blocks.withColumn("level_0", F.transform("kids", lambda kid: F.lower(F.hex(kid["hash"]))))
    top = F.col("width") <= FAN
    for j in range(STEP):
        blocks = blocks.withColumn(f"level_{j + 1}", _halved(F.col(f"level_{j}"), top))

    def step(i: Column, j: int) -> Column:
        at = F.floor(i / (1 << j)).cast("int")
        return F.struct(F.unhex(F.get(F.col(f"level_{j}"), at.bitwiseXOR(F.lit(1)))).alias("hash"), (at % 2 == 1).alias("left"),
                        (~top | (F.size(f"level_{j}") > 1)).alias("live"))

    rows = F.transform("kids", lambda kid, i: F.struct(
        *[kid[c].alias(c) for c in ("pos", "hash", "leaves", "doc_id", "changed")],
        F.filter(F.array(*[step(i, j) for j in range(STEP)]), lambda s: s["live"]).alias("path")))
    return blocks.select("tree", "width", "up_pos", "up_leaves", F.unhex(F.get(f"level_{STEP}", F.lit(0))).alias("up_hash"),
                         rows.alias("rows"))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Stored blocks of every ``STEP`` levels of the trees of ``nodes``: one pass each, until the widest tree has its root."""
    stored = []
    while True:
        blocks = written(_blocks(nodes), "merkle-blocks")
        stored.append(blocks)
        nodes = blocks.where(F.col("width") > FAN).select(
            "tree", F.ceil(F.col("width") / FAN).alias("width"), F.col("up_pos").alias("pos"), F.col("up_hash").alias("hash"),
            F.col("up_leaves").alias("leaves"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"))
        if nodes.isEmpty():
            return stored


def _copies(leaves: Column) -> Column:
    return F.ceil(leaves / MEET).cast("long")


def _linked(blocks: DataFrame, level: int, places: DataFrame) -> DataFrame:
    """Node rows of a level with their parents: in the same tree, or (with ``places`` of the trees' roots) in the top tree."""
    last = F.col("width") <= FAN
    linked = blocks.withColumn("end", F.when(last, F.col("tree"))).join(places, "end", "left")
    return linked.select(
        "tree", F.explode("rows").alias("r"), F.when(last, F.col("top_tree")).otherwise(F.col("tree")).alias("up_tree"),
        F.when(last, F.lit(0)).otherwise(F.lit(level + 1)).alias("up_level"),
        F.when(last, F.col("top_pos")).otherwise(F.col("up_pos")).alias("up_pos"), "up_hash", _copies(F.col("up_leaves")).alias("up_copies"),
    ).select("r.*", "tree", F.lit(level).alias("level"), "up_tree", "up_level", "up_pos", "up_hash", "up_copies")


def build(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node rows of the leaves, and of all stored levels above in as many copies as are to meet there.

    A row has tree, level, pos, its path to the parent row (up_tree, up_level, up_pos) and that row's digest. The row of the root of
    all has no parent; its digest is the up_hash of rows whose up_tree is null.
    """
    nothing = F.lit(None).cast("string")
    low = _levels(placed)
    tops = reduce(DataFrame.unionByName, [b.where(F.col("width") <= FAN).select(
        "tree", F.col("up_hash").alias("hash"), F.col("up_leaves").alias("leaves")) for b in low])
    roots = written(ranked(tops.withColumn("whole", F.lit(TOP)), ["whole"], [F.col("tree")], "merkle-roots"), "merkle-tops")
    high = _levels(roots.select(F.col("whole").alias("tree"), "width", F.col("rank").alias("pos"), "hash", "leaves",
                                F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed")))
    places = roots.select(F.col("tree").alias("end"), F.lit(TOP).alias("top_tree"), F.col("rank").alias("top_pos"))
    nowhere = places.select("end", nothing.alias("top_tree"), F.lit(None).cast("long").alias("top_pos")).limit(0)
    above = [_linked(b, k + 1, places) for k, b in enumerate(low[1:])] + [_linked(b, k, nowhere) for k, b in enumerate(high)]
    nodes = reduce(DataFrame.unionByName, above).drop("doc_id", "changed", "hash").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("leaves")) - 1))).drop("leaves")
    return _linked(low[0], 0, places), written(nodes, "merkle-nodes")


#: Climb from row to parent row; a leaf's own row is the first. ``siblings`` are joined raw digests, in order; the way into the
#: top tree yields the subroot, the way out of it the root.
_FOLD = """unhex(aggregate({path}, lower(hex({start})), (h, p) -> sha2(CASE WHEN p.hash IS NULL THEN h
      WHEN p.left THEN concat(lower(hex(p.hash)), h) ELSE concat(h, lower(hex(p.hash))) END, 256)))"""
_SIBLINGS = "aggregate({path}, CAST({start} AS BINARY), (a, p) -> concat(a, coalesce(p.hash, X'')))"
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, hash AS leaf, {_FOLD.format(path='path', start='coalesce(changed, hash)')} AS folded,
    {_SIBLINGS.format(path='path', start="X''")} AS siblings, CASE WHEN up_tree = '{TOP}' THEN up_hash END AS subroot,
    CASE WHEN up_tree IS NULL THEN up_hash END AS root, up_tree, up_level, up_pos, xxhash64(tree, pos) AS seed, up_copies
  FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.leaf, {_FOLD.format(path='n.path', start='c.folded')}, {_SIBLINGS.format(path='n.path', start='c.siblings')},
    CASE WHEN n.tree <> '{TOP}' AND n.up_tree = '{TOP}' THEN n.up_hash ELSE c.subroot END,
    CASE WHEN n.up_tree IS NULL THEN n.up_hash END, n.up_tree, n.up_level, n.up_pos, c.seed, n.up_copies
  FROM climb c JOIN {{nodes}} n
    ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND pmod(c.seed, c.up_copies) = n.part
)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root,
  sha2(lower(hex(siblings)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = root AS verified
FROM climb WHERE root IS NOT NULL
"""


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    Rows of a language are ordered by doc_id (null first), then by digest, so that repeated doc_ids have one defined tree; equal
    rows are leaves of their own. A null, empty or very long text is a field like any other; other columns are not hashed; an
    empty table gives no rows. Rows above a node meet at one of its copies, at most some ``MEET`` at each, so that the way to
    the root has no hot key.
    """
    spark = docs.sparkSession
    placed = ranked(leaves(docs), ["tree"], [F.col("doc_id"), F.col("hash")], "merkle-leaves")
    starts, nodes = build(placed.withColumn("leaves", F.lit(1).cast("long")).withColumnRenamed("rank", "pos"))
    limit = "spark.sql.cteRecursionRowLimit"  # bounds runaway queries; every climb ends at the root
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return written(spark.sql(CLIMB, leaves=starts, nodes=nodes), "merkle-proofs")
    finally:
        spark.conf.set(limit, before)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_sql_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


OP11_SQL = f"""
WITH RECURSIVE {sql_crc32('SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL', 'crcs')},
hit AS (SELECT id AS doc_id, crc % 7 = 0 AS hit FROM crcs),
hashed AS (SELECT d.doc_id, lang, {_sql_leaf('n_chars')} AS leaf,
  CASE WHEN hit AND n_chars IS NOT NULL THEN {_sql_leaf('n_chars + 1')} ELSE {_sql_leaf('n_chars')} END AS tampered
  FROM documents d LEFT JOIN hit USING (doc_id)),
places AS (SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
levels AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM places
  UNION ALL
  SELECT a.tree, a.level + 1, a.pos // 2, sha256(a.h || coalesce(b.h, '')), (a.n + 1) // 2
  FROM levels a LEFT JOIN levels b ON a.tree = b.tree AND b.pos = a.pos + 1 WHERE a.pos % 2 = 0 AND a.n > 1),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT a.level + 1, a.pos // 2, sha256(a.h || coalesce(b.h, '')), (a.n + 1) // 2
  FROM tops a LEFT JOIN tops b ON b.pos = a.pos + 1 WHERE a.pos % 2 = 0 AND a.n > 1),
climb AS (
  SELECT doc_id, leaf, tree, pos AS start, pos, 0 AS level, tampered AS f, '' AS sibs, (SELECT max(n) FROM levels l WHERE l.tree = places.tree AND level = 0) AS n FROM places
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.start, c.pos // 2, c.level + 1,
    sha256(CASE WHEN s.h IS NULL THEN c.f WHEN c.pos % 2 = 1 THEN s.h || c.f ELSE c.f || s.h END), c.sibs || coalesce(s.h, ''), (c.n + 1) // 2
  FROM climb c LEFT JOIN levels s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
above AS (
  SELECT c.doc_id, c.leaf, s.h AS subroot, r.pos, 0 AS level, c.f, c.sibs, (SELECT count(*) FROM subroots) AS n, c.tree, c.start
  FROM climb c JOIN subroots s USING (tree) JOIN subroots r USING (tree) WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.pos // 2, c.level + 1,
    sha256(CASE WHEN s.h IS NULL THEN c.f WHEN c.pos % 2 = 1 THEN s.h || c.f ELSE c.f || s.h END), c.sibs || coalesce(s.h, ''), (c.n + 1) // 2, c.tree, c.start
  FROM above c LEFT JOIN tops s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(sibs) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM above, (SELECT h FROM tops WHERE n = 1) t WHERE above.n = 1
"""
