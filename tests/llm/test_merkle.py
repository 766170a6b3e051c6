"""The Merkle manifest against a plain model of trees and proofs."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from clickloom.llm import merkle
from fixtures import frame, prose, rows_of

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more: int = 0) -> str:
    n = row["n_chars"]
    return digest(*map(coded, (row["doc_id"], row["source"], row["lang"], None if n is None else n + more, row["text"])))


def proven(digests: list[str]):
    """The root and, for each digest, its levels of (sibling, whether it stands before)."""
    proofs, level = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), 2):
            run = level[at:at + 2]
            for mine, (_, members) in enumerate(run):
                for i in members:
                    proofs[i].append([(d, k < mine) for k, (d, _) in enumerate(run) if k != mine])
            above.append((digest(*[d for d, _ in run]), [i for _, m in run for i in m]))
        level = above
    return level[0][0], proofs


def expected(rows) -> list[tuple]:
    by_lang: dict = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = proven([leaf(r) for r in by_lang[lang]])
    if not langs:
        return []
    root, tops = proven([trees[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        for row, proof in zip(by_lang[lang], trees[lang][1]):
            levels = proof + top
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            folded = leaf(row, 1 if hit else 0)
            for level in levels:
                folded = digest(*[d for d, before in level if before], folded, *[d for d, before in level if not before])
            siblings = digest(*[d for level in levels for d, _ in level])
            out.append((row["doc_id"], leaf(row), trees[lang][0], root, siblings, folded, folded == root))
    return sorted(out, key=repr)


def awkward(spark, n: int, langs: int):
    rng = random.Random(n)
    names = [None, "", *(f"l{k}" for k in range(langs - 2))][:langs]
    rows = [(rng.choice((None, i, i // 2)), rng.choice((None, "", "ü 1:a", prose(i, 9))), names[0 if i % 3 == 0 else i % langs],
             rng.choice((None, "-", "s")), rng.choice((None, i)), 1, "k", "u", 2, "s") for i in range(n)]
    return frame(spark, rows + rows[:3])


def check(df):
    wanted = expected(df.collect())
    got = rows_of(merkle.manifest(df).select(*COLUMNS))
    assert got == wanted
    return got


def test_awkward_rows_and_an_empty_table(spark):
    check(frame(spark))
    check(frame(spark, []))
    check(frame(spark, [(7, "one", "en", None, 3, 1, "k", "u", 2, "s")]))


@pytest.mark.parametrize("step, n, langs", [(1, 19, 3), (2, 90, 21)])
def test_trees_of_several_stored_levels(spark, monkeypatch, step, n, langs):
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "FAN", 1 << step)
    monkeypatch.setattr(merkle, "MEET", 4)
    check(awkward(spark, n, langs))


def test_only_tampered_rows_fail(spark):
    rows = [(i, f"t{i}", "en" if i % 2 else "de", "s", i, 1, "k", "u", 2, "s") for i in range(60)]
    got = check(frame(spark, rows))
    assert {r[0] for r in got if not r[6]} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}


def test_sql_gives_the_same_rows(spark):
    documents = awkward(spark, 70, 5).toArrow()  # noqa: F841
    got = duckdb.sql(merkle.OP11_SQL).select(", ".join(COLUMNS)).fetchall()
    assert sorted(got, key=repr) == expected(awkward(spark, 70, 5).collect())
