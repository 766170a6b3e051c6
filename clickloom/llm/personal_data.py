"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are what four fixed patterns find (e-mail and IP addresses, card numbers that pass their check digit, phone numbers).
Other tokens with a digit are candidates. Every seed and candidate is an instance in a graph with two lexical patterns at each of
its places: its shape (digits and letters by class) and the word before its own. Scores run over the graph for ``ROUNDS`` rounds:

* a shape's confidence for a kind is the score of its instances of that kind over that of all that are known to be something
  (instances of which nothing is known do not count);
* a word's confidence is the score of what follows it over all its places in the corpus, so that common words have none;
* an instance that is no seed takes the confidence of its best pattern. Patterns count from ``SUPPORT`` different positive
  instances and a confidence of ``CONFIDENT`` on; tokens of under ``LEAST_DIGITS`` digits are known to be none of the kinds.

Candidates at places of such a pattern are found. Scores are whole millionths, so that sums do not depend on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import joined, table, written

#: The fixed patterns of the contract. Possessive quantifiers and the look-behinds change no match: they keep long runs of
#: one class from being tried at every place (``\\G`` is the end of the match before, where a new one may start).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
NAMES = tuple(name for name, _ in KINDS)
_IN = "[0-9A-Za-z._%+@:/-]"
CANDIDATE = rf"(?<!{_IN})[A-Za-z._%+@:/-]*+[0-9][0-9A-Za-z]*+(?:[._%+@:/-]++[0-9A-Za-z]++)*+"
ROUNDS = 3
SUPPORT = 3
CONFIDENT = 800_000
SURE = 1_000_000
LEAST_DIGITS = 7
#: Code points before a place in which the word before is looked for; longer words are no context.
CONTEXT = 60
BLOCK = 512


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:  # i: place from the right
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(name: str, match: Column) -> Column:
    n = F.length(_digits(match))
    return {
        "email": F.lit(True),
        "ip": match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"),
        "card": F.when(n.between(16, 19), _passes_luhn(_digits(match))).otherwise(False),
        "phone": n.between(8, 15),
    }[name]


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each, in blocks, so that no long array is copied for each of its items."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    empty, zero = F.array().cast("array<bigint>"), F.lit(0).cast("long")
    inner = F.transform(blocks, lambda block: F.aggregate(
        block, F.struct(zero.alias("sum"), empty.alias("out")), lambda a, x: F.struct(
            (a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out"))))
    outer = F.aggregate(inner, F.struct(zero.alias("sum"), F.array().cast("array<array<bigint>>").alias("out")), lambda a, x: F.struct(
        (a["sum"] + x["sum"]).alias("sum"),
        F.concat(a["out"], F.array(F.transform(x["out"], lambda v: v + a["sum"]))).alias("out")))
    return F.when(F.size(lengths) > 0, F.flatten(outer["out"])).otherwise(empty)


def _scan(step: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Columns ``<name>_parts`` (what stands between matches), ``<name>_all`` and ``<name>_at``: matches and their starts."""
    step = step.withColumn(f"{name}_all", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    step = step.withColumn(f"{name}_parts", F.when(F.size(f"{name}_all") > 0, F.split(text, pattern, -1)).otherwise(F.array(text)))
    lengths = F.transform(f"{name}_all", lambda m, i: (F.length(m) + F.length(F.get(F.col(f"{name}_parts"), i))).cast("long"))
    step = step.withColumn(f"{name}_before", _starts(lengths))
    return step.withColumn(f"{name}_at", F.zip_with(f"{name}_before", F.slice(f"{name}_parts", 1, F.size(f"{name}_all")),
                                                    lambda s, part: s + F.length(part)))


def _places(name: str, keep) -> Column:
    """The matches that ``keep`` accepts: match, start, end, and what stands before as far as a context may reach.

    Starts are zipped in, not looked up: the optimizer would copy a column that one lambda alone reads into that lambda.
    """
    rows = F.transform(F.zip_with(f"{name}_all", f"{name}_at", lambda m, s: F.struct(m.alias("match"), s.alias("start"))),
                       lambda r, i: F.struct(r["match"].alias("match"), r["start"].alias("start"), i.alias("i")))
    return F.transform(F.filter(rows, lambda r: keep(r["match"])), lambda r: F.struct(
        r["match"].alias("match"), r["start"].alias("start"), (r["start"] + F.length(r["match"])).alias("end"),
        _context(name, r["i"]).alias("before")))


def _context(name: str, i: Column) -> Column:
    """Up to ``CONTEXT`` code points before a match: the part before it and, where that is short, the match before that."""
    part = F.get(F.col(f"{name}_parts"), i)
    earlier = F.when(i > 0, F.concat(F.lit("\n"), F.right(F.get(F.col(f"{name}_all"), i - 1), F.lit(CONTEXT)))).otherwise(F.lit("\n"))
    return F.right(F.concat(F.when(F.length(part) < CONTEXT, earlier).otherwise(F.lit("")), part), F.lit(CONTEXT))


def _masked(text: str, name: str) -> Column:
    """``text`` with blanks in place of the valid matches of a kind."""
    pieces = F.transform(f"{name}_parts", lambda part, i: F.concat(part, F.coalesce(
        F.when(_valid(name, F.get(F.col(f"{name}_all"), i)), F.repeat(F.lit(" "), F.length(F.get(F.col(f"{name}_all"), i)))),
        F.get(F.col(f"{name}_all"), i), F.lit(""))))
    return F.when(F.size(f"{name}_spans") > 0, F.array_join(pieces, "")).otherwise(F.col(text))


def _shape(token: Column) -> Column:
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[0-9]", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
    return F.xxhash64(F.lit("shape"), classes)


def _word_before(before: Column) -> Column:
    """A hash of the last whole word before the word that holds the place; null where there is none within reach."""
    word = F.regexp_extract(before, r"[ \t-\r]([^ \t-\r]++)[ \t-\r]++[^ \t-\r]*+$", 1)
    return F.when(word != "", F.xxhash64(F.lit("word"), F.lower(word)))


def _unmasked() -> Column:
    """The tokens that stand in both masked texts too: in ``merged``, sorted, each is followed by its two equals."""
    def same(t: Column, i: Column) -> Column:
        other = F.get(F.col("merged"), i)
        return F.coalesce((other["text"] == 1) & (other["start"] == t["start"]) & (other["end"] == t["end"]), F.lit(False))

    found = F.filter("merged", lambda t, i: (t["text"] == 0) & same(t, i + 1) & same(t, i + 2))
    return F.transform(found, lambda t: F.struct(t["match"].alias("match"), t["start"].alias("start"), t["end"].alias("end"),
                                                 t["before"].alias("before")))


def _instances(spans: str, kind: Column) -> Column:
    return F.transform(spans, lambda place: F.struct(place["start"].alias("start"), place["end"].alias("end"), F.md5(place["match"]).alias("instance"),
                    _shape(place["match"]).alias("shape"), _word_before(place["before"]).alias("word"), kind.alias("seed"),
                    (F.length(_digits(place["match"])) < LEAST_DIGITS).alias("plain")))


def places(docs: DataFrame) -> DataFrame:
    """For every row: ``row`` (a number), doc_id, ``seeds`` by kind and the ``others``, with shape and word before each."""
    step = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    for name, pattern in KINDS:
        step = _scan(step, "text", name, pattern)
        step = step.withColumn(f"{name}_spans", _places(name, lambda m, name=name: _valid(name, m)))
    step = _scan(step, "text", "token", CANDIDATE).withColumn("token_spans", _places("token", lambda m: ~m.rlike(EMAIL) & ~F.exists(
        F.regexp_extract_all(m, F.lit(IP), F.lit(0)), lambda x: _valid("ip", x))))
    wide = (F.size("card_spans") > 0) | (F.size("phone_spans") > 0)  # only these may reach over several tokens
    for name in ("card", "phone"):
        step = _scan(step.withColumn(f"{name}_mask", F.when(wide, _masked("text", name)).otherwise(F.lit(""))), f"{name}_mask",
                     f"{name}_token", CANDIDATE)
    step = step.withColumn("merged", F.when(wide, F.sort_array(F.concat(
        F.transform("token_spans", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(0).alias("text"),
                                                      t["match"].alias("match"), t["before"].alias("before"))),
        *[F.zip_with(f"{name}_token_all", f"{name}_token_at", lambda m, s: F.struct(
            s.alias("start"), (s + F.length(m)).alias("end"), F.lit(1).alias("text"), F.lit(None).cast("string").alias("match"),
            F.lit(None).cast("string").alias("before"))) for name in ("card", "phone")]))))
    step = step.withColumn("token_spans", F.when(wide, _unmasked()).otherwise(F.col("token_spans")))
    seeds = F.concat(*[_instances(f"{name}_spans", F.lit(k)) for k, name in enumerate(NAMES)])
    return step.select("row", "doc_id", seeds.alias("seeds"),
                       _instances("token_spans", F.lit(None).cast("int")).alias("others"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(pattern, places) for every word of the corpus."""
    words = F.transform(F.split(F.lower(F.coalesce("text", F.lit(""))), "[ \t-\r]+"), lambda w: F.xxhash64(F.lit("word"), w))
    return docs.select(F.explode(words).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("places"))


def _scores(graph: DataFrame, counts: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that count, from edges with the scores of their instances."""
    sums = []
    for k in range(len(NAMES)):
        mine = F.coalesce(F.when(F.col("kind") == k, F.col("score")), F.lit(0))
        other = F.when(F.col("plain") & F.col("kind").isNull(), SURE).otherwise(F.coalesce(F.when(F.col("kind") != k, F.col("score")), F.lit(0)))
        sums += [F.sum(mine).alias(f"mine_{k}"), F.sum(other).alias(f"other_{k}"), F.sum(mine * F.col("places")).alias(f"here_{k}"),
                 F.count_if(mine > 0).alias(f"support_{k}")]
    by_pattern = graph.groupBy("pattern", "is_word").agg(*sums).where(reduce(
        lambda a, b: a | b, [F.col(f"support_{k}") >= SUPPORT for k in range(len(NAMES))]))
    known = by_pattern.join(counts, "pattern", "left")

    def confidence(k: int) -> Column:
        whole = F.when(F.col("is_word"), F.coalesce("places", F.lit(0)) * SURE).otherwise(F.col(f"mine_{k}") + F.col(f"other_{k}"))
        part = F.when(F.col("is_word"), F.col(f"here_{k}")).otherwise(F.col(f"mine_{k}"))
        return F.when((F.col(f"support_{k}") >= SUPPORT) & (whole > 0), F.least(F.floor(
            part.cast("decimal(38,0)") * SURE / whole).cast("long"), F.lit(SURE).cast("long"))).otherwise(F.lit(0).cast("long"))

    best = F.array_max(F.array(*[F.struct(confidence(k).alias("confidence"), F.lit(-k).alias("k")) for k in range(len(NAMES))]))
    return known.select("pattern", best.alias("b")).select(
        "pattern", (-F.col("b.k")).alias("kind"), F.col("b.confidence").alias("confidence")).where(F.col("confidence") >= CONFIDENT)


def _best(rows: DataFrame, by: list[str]) -> DataFrame:
    """The kind of the highest confidence (the first of equals) for each of ``by``."""
    best = F.max(F.struct("confidence", (-F.col("kind")).alias("k")))
    return rows.groupBy(*by).agg(best.alias("b")).select(*by, (-F.col("b.k")).alias("kind"), F.col("b.confidence").alias("score"))


def patterns(found: DataFrame, counts: DataFrame) -> DataFrame:
    """The patterns that count after ``ROUNDS`` rounds over the graph of patterns and instances.

    Both sides may be hot (a number in very many texts, the word before very many numbers): edges are counted before anything
    is joined, and joins split hot keys.
    """
    seen = found.select(F.explode(F.concat("seeds", "others")).alias("o")).select("o.*")
    edges = seen.select("instance", "seed", "plain", F.explode(F.filter(F.array(
        F.struct(F.col("shape").alias("pattern"), F.lit(False).alias("is_word")),
        F.struct(F.col("word").alias("pattern"), F.lit(True).alias("is_word"))), lambda p: p["pattern"].isNotNull())).alias("p"))
    edges = written(edges.groupBy("p.pattern", "p.is_word", "instance").agg(
        F.count("*").alias("places"), F.min("seed").alias("seed"), F.min("plain").alias("plain")), "pattern-edges")
    instances = written(edges.groupBy("instance").agg(F.min("seed").alias("seed"), F.min("plain").alias("plain")), "instances")
    edges = edges.drop("seed", "plain")
    seeded = F.when(F.col("seed").isNotNull(), F.lit(SURE).cast("long"))
    scores = instances.select("instance", "plain", F.col("seed").alias("kind"), seeded.alias("score"))
    for _ in range(ROUNDS):
        graph = joined(edges, written(scores, "instance-scores"), ["instance"])
        kept = written(_scores(graph, counts), "patterns")
        told = _best(joined(edges, kept, ["pattern"]), ["instance"]).select("instance", F.col("kind").alias("told"), "score")
        scores = instances.join(told, "instance", "left").select(
            "instance", "plain", F.coalesce("seed", F.when(~F.col("plain"), F.col("told"))).alias("kind"),
            F.coalesce(seeded, F.when(~F.col("plain"), F.col("score"))).alias("score"))
    return kept


def _joined_spans(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) for every row of ``docs``.

    The counts and ``base_sha256`` are of the fixed patterns alone; ``spans`` has these and the ``n_found`` tokens that patterns of
    the graph found, under the kind of their best pattern. A found token shares no character with a seed. A null or empty text
    has none; texts are read whole, one row at a time, so repeated rows and doc_ids, nulls and other columns do not matter. An
    empty table gives no rows.
    """
    rows = written(places(docs), "personal-places")
    kept = patterns(rows, written(word_counts(docs), "word-counts"))
    unknown = rows.select("row", F.explode(F.filter("others", lambda o: ~o["plain"])).alias("o")).select(
        "row", "o.start", "o.end", F.explode(F.array_compact(F.array("o.shape", "o.word"))).alias("pattern"))
    more = _best(joined(written(unknown, "unknown-places"), kept, ["pattern"]), ["row", "start", "end"])
    more = more.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("found"))
    out = rows.join(more, "row", "left")
    base = F.transform("seeds", lambda s: F.struct(s["seed"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def number(k: int) -> Column:
        return F.size(F.filter("seeds", lambda s: s["seed"] == k)).cast("long").alias(f"n_{NAMES[k]}")

    return out.select(
        "doc_id", *map(number, range(len(NAMES))), F.sha2(_joined_spans(base), 256).alias("base_sha256"),
        _joined_spans(F.concat(base, F.coalesce("found", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))).alias("spans"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_found"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
