"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, u string, spans int, shard string"


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(("an", "el", "ti", "ro", "ma", "shé", "ver", "lo")) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(made[i:i + line]).capitalize() + "." for i in range(0, words, line))


def edited(text: str, seed: int, changes: int = 1) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


PASSAGE = prose(99, 90)


def documents() -> list[tuple]:
    base = prose(1, 200)
    texts = [
        (1, base), (2, base), (3, edited(base, 5)), (4, edited(base, 6)), (5, prose(2, 150)), (6, prose(3, 60) + "\n" + PASSAGE + "\n" + prose(4, 50)),
        (7, prose(5, 70) + "\n" + PASSAGE + "\n" + prose(6, 30)), (8, None), (9, ""), (10, " \t\n"), (11, "word"), (12, "three small words"),
        (13, prose(7, 6000)), (13, prose(8, 40)), (None, prose(9, 50)), (14, prose(10, 45)), (14, prose(10, 45)), (15, base + "\n" + "Menu | Home | About\n" * 2),
        (16, "Nous avons été là. " * 20), (17, "$$$ buy ### now *** " * 15), (18, "日本語 のテキスト です。 " * 12),
    ]
    sources = ("a", "a", "b", None, "c", "a", "A")
    rows = [(i, t, "en", sources[k % 7], len(t or ""), k, "x", "y", k, "z") for k, (i, t) in enumerate(texts)]
    return rows + [rows[4], rows[-3]]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
