"""Line-first cleaning and quality rules, in DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing lines are removed; a document that loses more
than ``MOST_LOST`` of its words is rejected, as is one that fails the base rules on its whole text. A line fails when

* punctuation: more than one symbol of ``SYMBOLS`` for four words, or at most two words without a mark at the end, or over
  two fifths of its characters are capitals (in a line of three words or more);
* navigation: bars, angle signs and the like between words (the same count of symbols), or most words repeat the word before;
* boilerplate: it has at most ``SHORT`` words and a phrase of ``PHRASES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.common import table

SYMBOLS = "#*$%&|<>"
ENDS = ".!?:;,\"')]}”’…»"
PHRASES = ("javascript", "cookie", "lorem ipsum", "privacy policy", "terms of use", "terms of service", "all rights reserved",
           "click here", "sign up", "log in")
SHORT = 20
MOST_LOST = 0.3
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \t-\r]+"), "")


def _count(text: Column, kinds: str) -> Column:
    """Characters of a class of a regular expression."""
    return F.length(F.regexp_replace(text, f"[^{kinds}]+", ""))


def line_fails(line: Column, words: Column, symbols: Column) -> Column:
    """Whether a line with these words and so many symbols is to be removed. Lines without a word stay (they carry nothing)."""
    n = F.size(words)
    repeats = F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
    ending = F.right(F.element_at(words, -1), F.lit(1))
    lower = F.lower(line)
    phrase = F.lit(False)
    for text in PHRASES:
        phrase = phrase | F.contains(lower, F.lit(text))
    return (n > 0) & (
        (4 * symbols > n)
        | ((n <= 2) & ~F.contains(F.lit(ENDS), ending))
        | ((n >= 3) & (5 * _count(line, "A-Z") > 2 * F.length(line)))
        | (2 * repeats > n)
        | ((n <= SHORT) & phrase))


def _paired(hashes: Column, apart: int) -> Column:
    """Hashes of each item with the one so far behind it; the last items, which have none, go."""
    behind = F.slice(hashes, apart + 1, F.greatest(F.size(hashes) - apart, F.lit(0)))
    both = F.zip_with(hashes, behind, lambda x, y: F.xxhash64(x, y))
    return F.slice(both, 1, F.greatest(F.size(hashes) - apart, F.lit(0)))


def judge(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus the base figures, ``cleaned`` text, ``n_lost_words``, ``base_failed`` and ``kept``.

    A null text has no words and fails the base rules, as does an empty one. Lines are parted by \\n alone. Windows of words are
    compared by 64-bit hashes of their words' hashes. Rows are judged alone, so ties, copies, nulls in other columns and extra
    columns do not matter; a column with the name of a figure is replaced; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda line: F.struct(
        line.alias("line"), _words(line).alias("words"), _count(line, SYMBOLS).alias("symbols")))
    step = docs.withColumn("_q_text", text).withColumn("_q_lines", lines)
    step = step.withColumn("_q_words", F.flatten(F.transform("_q_lines", lambda x: x["words"])))
    step = step.withColumn("_q_windows", F.transform("_q_words", lambda w: F.xxhash64(w)))
    for apart in (1, 2, 4):  # a window of eight words: pairs, pairs of pairs, and pairs of those
        step = step.withColumn("_q_windows", _paired(F.col("_q_windows"), apart))
    again = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    placed = F.when(again, F.sort_array(F.transform("_q_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    step = step.withColumn("_q_placed", placed)
    p = F.col("_q_placed")
    found = F.filter(p, lambda s, j: (s["x"] == F.get(p, j - 1)["x"]) | (s["x"] == F.get(p, j + 1)["x"]))
    starts = F.array_sort(F.transform(found, lambda s: s["i"]))
    step = step.withColumn("_q_starts", starts)
    covered = F.aggregate(
        "_q_starts", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")))
    step = step.withColumn("_q_judged", F.transform("_q_lines", lambda x: F.struct(
        x["line"].alias("line"), F.size(x["words"]).alias("n"), x["symbols"].alias("symbols"),
        line_fails(x["line"], x["words"], x["symbols"]).alias("fails"))))
    worded = F.transform(F.filter("_q_judged", lambda x: x["n"] > 0), lambda x: x["line"])
    step = step.withColumn("_q_worded", worded).withColumn(
        "n_lost_words", F.aggregate("_q_judged", F.lit(0), lambda a, x: a + F.when(x["fails"], x["n"]).otherwise(0)).cast("long"))
    n_words = F.size("_q_words").cast("long")
    out = step.withColumns({
        "n_words": n_words,
        "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
        "n_symbols": F.aggregate("_q_judged", F.lit(0), lambda a, x: a + x["symbols"]).cast("long"),
        "n_dup_lines": (F.size("_q_worded") - F.size(F.array_distinct("_q_worded"))).cast("long"),
        "n_repeat_words": F.coalesce(covered["total"], F.lit(0)).cast("long"),
        "cleaned": F.array_join(F.transform(F.filter("_q_judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"),
    })
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_lost_words") <= MOST_LOST * F.col("n_words")))
    return out.drop(*[c for c in out.columns if c.startswith("_q_")])


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines removed and ``n_chars`` to match.

    The row number keeps the optimizer from copying the whole judgement into the filter, where it would run again.
    """
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_rest"))
    judged = judge(rows).withColumn("_row", F.monotonically_increasing_id()).where(F.col("kept") & (F.col("_row") >= 0))
    changed = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return judged.select(*[changed[c].alias(c) if c in changed else F.col(f"_rest.`{c}`") for c in docs.columns])


def op8_quality_rules(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words",
        F.sha2("cleaned", 256).alias("cleaned_sha256"))


_SQL_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in PHRASES)
_WORD = r"[^\x20\x09-\x0D]+"
_QUOTED_ENDS = ENDS.replace("'", "''")
OP8_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range({WINDOW}) AS r(k) GROUP BY doc_id),
split AS (SELECT doc_id, generate_subscripts(ls, 1) AS k, unnest(ls) AS line FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d)),
lines AS (SELECT doc_id, k, line, regexp_extract_all(line, '{_WORD}') AS w, len(regexp_extract_all(line, '{_WORD}')) AS n FROM split),
judged AS (SELECT *, n > 0 AND (
    4 * (length(line) - length(translate(line, '{SYMBOLS}', ''))) > n
    OR (n <= 2 AND NOT contains('{_QUOTED_ENDS}', right(w[n], 1)))
    OR (n >= 3 AND 5 * (length(line) - length(regexp_replace(line, '[A-Z]', '', 'g'))) > 2 * length(line))
    OR 2 * len(list_filter(range(2, n + 1), lambda i: w[i] = w[i - 1])) > n
    OR (n <= {SHORT} AND ({_SQL_PHRASES}))) AS fails FROM lines),
by_doc AS (SELECT doc_id, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS n_lost_words,
    count(line) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
    coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT fails), '') AS cleaned FROM judged GROUP BY doc_id),
base AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(translate(t, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_lost_words, sha256(cleaned) AS cleaned_sha256 FROM d JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)),
verdict AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_lost_words <= {MOST_LOST} * n_words AS kept FROM verdict
"""
