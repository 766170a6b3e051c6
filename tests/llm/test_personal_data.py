"""Personal data against a plain model of spans and of the graph, and what the graph adds, by hand."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from fixtures import frame, prose

from clickloom.llm import personal_data as pd_
from clickloom.llm.common import table

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
KINDS = list(BASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in match.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def scanned(text: str, pattern: str):
    """(match, start, what stands before) of all matches."""
    out, end, last = [], 0, None
    for m in re.finditer(pattern, text):
        part = text[end:m.start()]
        before = part if len(part) >= pd_.CONTEXT else "\n" + ("" if last is None else last[-pd_.CONTEXT:]) + part
        out.append((m.group(), m.start(), before[-pd_.CONTEXT:]))
        end, last = m.end(), m.group()
    return out


def features(match: str, before: str):
    shape = re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", re.sub("[0-9]", "9", match)))
    word = re.search(r"[ \t-\r]([^ \t-\r]+)[ \t-\r]+[^ \t-\r]*$", before)
    return [("shape", shape)] + ([("word", word.group(1).lower())] if word else [])


def model(texts: list[str]):
    """For each text: the base spans and the found ones, (kind number, start, end)."""
    seeds, others, words = [], [], defaultdict(int)
    for text in texts:
        for w in re.split(r"[ \t-\r]+", text.lower()):
            words[w] += 1
        mine = [(k, m, s, b) for k, kind in enumerate(KINDS) for m, s, b in scanned(text, BASE[kind]) if valid(kind, m)]
        wide = [(s, s + len(m)) for k, m, s, _ in mine if KINDS[k] in ("card", "phone")]
        seeds.append(mine)
        others.append([(m, s, b) for m, s, b in scanned(text, pd_.CANDIDATE) if not re.search(BASE["email"], m)
                       and not any(valid("ip", x.group()) for x in re.finditer(BASE["ip"], m))
                       and not any(s < e and a < s + len(m) for a, e in wide)])
    edges, seed_of, plain = defaultdict(int), {}, {}
    for mine, rest in zip(seeds, others):
        for k, m, b in [(k, m, b) for k, m, _, b in mine] + [(None, m, b) for m, _, b in rest]:
            few = len(re.sub("[^0-9]", "", m)) < pd_.LEAST_DIGITS
            plain[m] = few
            if k is not None:
                seed_of[m] = min(k, seed_of.get(m, 9))
            for p in features(m, b):
                edges[p, m] += 1
    scores, kept = {m: (k, pd_.SURE) for m, k in seed_of.items()}, {}
    for _ in range(pd_.ROUNDS):
        sums = defaultdict(lambda: [[0, 0, 0, 0] for _ in KINDS])
        for (p, m), n in edges.items():
            kind, score = scores.get(m, (None, 0))
            for k, s in enumerate(sums[p]):
                mine = score if kind == k else 0
                s[0] += mine
                s[1] += pd_.SURE if kind is None and plain[m] else (score if kind is not None and kind != k else 0)
                s[2] += mine * n
                s[3] += mine > 0
        kept = {}
        for p, by_kind in sums.items():
            found = []
            for k, (mine, other, here, support) in enumerate(by_kind):
                part, whole = (here, words[p[1]] * pd_.SURE) if p[0] == "word" else (mine, mine + other)
                if support >= pd_.SUPPORT and whole:
                    found.append((min(part * pd_.SURE // whole, pd_.SURE), -k))
            if found and max(found)[0] >= pd_.CONFIDENT:
                kept[p] = max(found)
        told = {}
        for p, m in edges:
            if p in kept:
                told[m] = max(told.get(m, kept[p]), kept[p])
        scores = {m: (-k, c) for m, (c, k) in told.items() if not plain[m]} | {m: (k, pd_.SURE) for m, k in seed_of.items()}
    out = []
    for mine, rest in zip(seeds, others):
        more = []
        for m, s, b in rest:
            best = max((kept[p] for p in features(m, b) if p in kept), default=None)
            if best and len(re.sub("[^0-9]", "", m)) >= pd_.LEAST_DIGITS:
                more.append((-best[1], s, s + len(m)))
        out.append(([(k, s, s + len(m)) for k, m, s, _ in mine], more))
    return out


def told(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def check(df):
    rows = df.select("doc_id", "text").collect()
    wanted = []
    for row, (base, more) in zip(rows, model([r.text or "" for r in rows])):
        counts = [sum(k == j for k, _, _ in base) for j in range(4)]
        wanted.append((row.doc_id, *counts, hashlib.sha256(told(base).encode()).hexdigest(), told(base + more), len(more)))
    got = [tuple(r) for r in pd_.find(df).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    return {r[0]: r for r in got}


def card(prefix: str) -> str:
    return next(prefix + str(d) for d in range(10) if luhn(prefix + str(d)))


def numbers(n: int) -> list[str]:
    return [f"{41 * i + 1234567 * (i + 3):015d}"[:15] for i in range(n)]


PLANTED = (
    [f"Write to a{i}.b+c@mail{i}.example.com or x{i}@y.z.org@q.io, {prose(i, 9)}" for i in range(4)]
    + [f"Please phone +1 (555) 010-{1000 + i} today, {prose(20 + i, 9)}" for i in range(9)]
    + ["Please phone 555-010-2000 today", "they sold the 555-010-2001 and the 30 others", "éphone 555-010-2002 x", "phone 12"]
    + [f"{prose(40 + i, 5)} {card(numbers(9)[i])} {prose(50 + i, 5)}" for i in range(4)]
    + [f"pay {numbers(9)[5]}{(int(card(numbers(9)[5])[-1]) + 1) % 10} now", f"4 4 {card('4' * 15)}", "1 2 3 4-5-6 7", "+1 234 5678 9012 3456 7890 1"]
    + ["1.2.3.4.5.6.7.8.9 256.1.1.1 0000255.1.01.1 a@1.2.3.4 é9.9.9.9é", "日本 203.0.113.9\n\n203.0.113.300 x203.0.113.7y", "no.reply@@a.b@c.d e@f"]
    + [f"token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" id {i}" for i in range(3)])


def planted(spark):
    return frame(spark, [(i, t, "en", "s", 0, 1, "k", "u", 2, "s") for i, t in enumerate(PLANTED)])


def test_planted_texts(spark):
    got = check(planted(spark))
    assert sum(r[7] for r in got.values()) >= 2
    assert "phone:13:25" in got[13][6], got[13]  # by the word before it
    assert got[14][6] == got[16][6] == ""
    assert got[21][6] == "card:4:20", got[21]  # by its shape
    assert all(got[i][6] == "" for i in range(len(PLANTED) - 3, len(PLANTED)))


def test_the_graph_finds_what_seeds_alone_do_not(spark, monkeypatch):
    monkeypatch.setattr(pd_, "SUPPORT", 10**6)
    assert sum(r.n_found for r in pd_.find(planted(spark)).collect()) == 0


def test_awkward_rows(spark):
    check(frame(spark))
    assert pd_.find(frame(spark, [])).count() == 0


def test_very_long_texts(spark):
    """By hand: the plain patterns would try every place of a long run."""
    texts = [("a" * 300_000, (0, 0, 0, 0)), ("1" * 300_000, (0, 0, 0, 0)), ("1.2.3.4 " * 3000, (0, 3000, 0, 0)),
             ("x@y" + ".z" * 40_000, (1, 0, 0, 0)), ("+1" + " " * 100_000, (0, 0, 0, 0)), ("@" * 50_000, (0, 0, 0, 0)),
             ("1-" * 50_000 + "é1.1", (0, 0, 0, 0)), ("_" * 200_000 + "a@b.c", (1, 0, 0, 0)), ("x +12 345 678\n" * 2000, (0, 0, 0, 2000))]
    got = pd_.find(frame(spark, [(i, t, "en", "s", 0, 1, "k", "u", 2, "s") for i, (t, _) in enumerate(texts)])).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got} == {i: n for i, (_, n) in enumerate(texts)}
    assert next(r for r in got if r.doc_id == 8).spans.endswith("phone:27988:27999")


def test_registered_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    wanted = {r.doc_id: told(a + b) for r, (a, b) in zip(rows, model([r.text or "" for r in rows]))}
    assert {r.doc_id: r.spans for r in pd_.op13_personal_data(spark, sf_dir).collect()} == wanted


@pytest.mark.parametrize("spans", [0, 1, 511, 512, 513, 1500])
def test_starts_are_sums_before(spark, spans):
    df = spark.range(1).selectExpr(f"slice(sequence(1L, 2000L), 1, {spans}) AS v")
    assert df.select(pd_._starts(df["v"])).first()[0] == [i * (i + 1) // 2 for i in range(spans)]
