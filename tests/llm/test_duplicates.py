"""Near copies, repeated passages and near vectors, against brute force."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import PASSAGE, documents, edited, frame, prose, rows_of
from pyspark.sql import functions as F

from clickloom.llm import embedding_dedup, near_dedup, suffix_dedup
from clickloom.llm.common import table
from clickloom.llm.embedding_dedup import COSINE, Spanning, audited_beam, count_links, forest, link_vectors, near_pairs
from clickloom.llm.graph import components
from clickloom.llm.near_dedup import drop_near_copies, near_groups, word_idf
from clickloom.llm.small_world import Graph
from clickloom.llm.suffix_dedup import remove_repeats, repeated_spans, report
from clickloom.llm.suffix_sort import closest_matches, common, deep_shallow


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


# --- components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots(140, links)
    assert got == {k: want[k] for k in {x for a, b in links if a != b for x in (a, b)}}


# --- near copies


def weighted(text, idf):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    span = min(5, len(words))
    out = Counter()
    for i in range(len(words) - span + 1 if words else 0):
        out[tuple(words[i:i + span])] += sum(idf(w) for w in words[i:i + span]) / span
    return out


def brute_groups(rows):
    """Group ids by all pairs; word frequencies by word (the operator's are by hash bucket, which is the same on small tables)."""
    words = Counter()
    for _, text, *_ in rows:
        words.update(set((text or "").split()))
    vectors = [weighted(text or "", lambda w: 1 + math.log((1 + len(rows)) / (1 + words[w]))) for _, text, *_ in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            shared = sum(min(vectors[i][k], vectors[j][k]) for k in vectors[i] if k in vectors[j])
            total = sum(vectors[i].values()) + sum(vectors[j].values()) - shared
            if total and shared / total >= 0.8:
                links.append((i, j))
    found = roots(len(rows), links)
    least = defaultdict(list)
    for k, root in enumerate(found):
        least[root].append(rows[k][0])
    return [min((i for i in least[root] if i is not None), default=None) for root in found]


def test_groups_equal_brute_force(spark):
    rows = documents()
    got = near_groups(frame(spark)).collect()
    assert sorted(map(repr, ((r.doc_id, r.group_id) for r in got))) == sorted(map(repr, zip((r[0] for r in rows), brute_groups(rows))))
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].kept and not by_id[2].kept and by_id[3].group_id == by_id[4].group_id == by_id[15].group_id == 1
    assert by_id[8].kept and by_id[9].kept and by_id[10].kept and by_id[None].kept


def test_large_group_around_a_hub(spark):
    """Copies that are alike only through the original, and a bucket with several components in blocks."""
    base = prose(30, 120)
    rows = [(k, edited(base, k) if k else base, "", "", 0, 0, "", "", 0, "") for k in range(120)]
    got = near_groups(frame(spark, rows)).collect()
    want = brute_groups(rows)
    assert {r.doc_id: r.group_id for r in got} == dict(zip(range(120), want)) and len(set(want)) < 20


def test_blocks_miss_no_pair_across_components(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    base = prose(31, 100)
    rows = [(k, edited(base, k, 1 + k % 3), "", "", 0, 0, "", "", 0, "") for k in range(40)]
    assert {r.doc_id: r.group_id for r in near_groups(frame(spark, rows)).collect()} == dict(zip(range(40), brute_groups(rows)))


@pytest.mark.parametrize("leaders, block", [((), 3), ((1, 2), 4), ((4, 16, 64), 500)])
def test_rounds_of_leaders_change_no_group(spark, monkeypatch, leaders, block):
    """Copies about as alike as the threshold asks for, beside others in the same buckets, with any number of rounds."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "LEADERS", leaders)
    base, other = prose(32, 90), prose(33, 90)
    rows = [(k, edited(base if k % 4 else other, k, 1 + k % 2), "", "", 0, 0, "", "", 0, "") for k in range(60)]
    assert {r.doc_id: r.group_id for r in near_groups(frame(spark, rows)).collect()} == dict(zip(range(60), brute_groups(rows)))


def test_near_groups_take_few_rounds(spark, monkeypatch):
    """A bucket that a few blocks hold goes to them at once: components are found after its leader and at the end, not after every round.
    A bucket of two texts has no pair left after its leader, so nothing of it is sketched."""
    rounds, sketched = [], []
    monkeypatch.setattr(near_dedup, "components", lambda links: rounds.append(1) or components(links))
    monkeypatch.setattr(near_dedup, "sketch", lambda texts, idf, own=near_dedup.sketch: sketched.append(texts.count()) or own(texts, idf))
    base, other = prose(35, 90), prose(36, 90)
    rows = [(k, edited(base, k, 1 + k % 2), "", "", 0, 0, "", "", 0, "") for k in range(24)]
    assert {r.doc_id: r.group_id for r in near_groups(frame(spark, rows)).collect()} == dict(zip(range(24), brute_groups(rows)))
    assert len(rounds) == 2 and len(sketched) == 1 and 2 < sketched[0] <= 24

    two = [(k, edited(other, k, 5 * k), "", "", 0, 0, "", "", 0, "") for k in range(2)]  # about half alike: they share buckets and no group
    assert [r.group_id for r in near_groups(frame(spark, two)).orderBy("doc_id").collect()] == [0, 1]
    assert len(rounds) == 3 and len(sketched) == 1


def test_blocks_of_few_bytes_change_no_group(spark, monkeypatch):
    """Every text is longer than a block may be, so that each is a part of its own."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 200)
    monkeypatch.setattr(near_dedup, "LEADERS", ())
    base = prose(34, 90)
    rows = [(k, edited(base, k, 1 + k % 2), "", "", 0, 0, "", "", 0, "") for k in range(30)]
    assert {r.doc_id: r.group_id for r in near_groups(frame(spark, rows)).collect()} == dict(zip(range(30), brute_groups(rows)))


def test_sketches_miss_less_than_bands():
    n, alike, least = near_dedup.SKETCH, near_dedup.SIMILARITY, math.ceil(near_dedup.SKETCH_SHARE * near_dedup.SKETCH)
    missed = sum(math.comb(n, k) * alike**k * (1 - alike)**(n - k) for k in range(least))
    assert missed < 0.001 * (1 - alike**near_dedup.ROWS)**near_dedup.BANDS


def test_table_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    got = {r.doc_id: r.group_id for r in near_dedup.op3_near_dedup(spark, sf_dir).collect()}
    assert got == dict(zip((r[0] for r in rows), brute_groups(rows)))


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    out = drop_near_copies(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(map(repr, (r.doc_id for r in kept))) == sorted(map(repr, [1, 5, 6, 7, 8, 9, 10, 11, 12, 13, 13, None, 14, 16, 17, 18]))
    assert rows_of(drop_near_copies(frame(spark, []))) == [] and rows_of(near_groups(frame(spark, []))) == []


def test_samples_agree_as_often_as_texts_are_alike():
    import pyarrow as pa
    from clickloom.llm.near_dedup import IDF_BITS, elements, signatures, similarity
    from clickloom.llm.words import string_parts
    idf = np.ones(1 << IDF_BITS, np.float32)
    base = prose(40, 400)
    texts = [base] + [edited(base, k, 12) for k in range(60)]
    found = elements(*string_parts(pa.array(texts)), idf)
    samples = signatures(*found, len(texts))
    agree = (samples[1:] == samples[0]).mean()
    alone = [tuple(x[found[0] == k] for x in found) for k in range(len(texts))]
    exact = np.mean([similarity((alone[0][0] * 0, *alone[0][1:]), (alone[k][0] * 0, *alone[k][1:]), 1)[0] for k in range(1, len(texts))])
    assert abs(agree - exact) < 0.03


def test_idf_counts_all_documents(spark):
    docs = frame(spark, [(k, "common " + ("rare" if k == 0 else "x"), "", "", 0, 0, "", "", 0, "") for k in range(10)])
    idf = word_idf(docs)
    assert {round(float(x), 4) for x in np.unique(idf)} == {1.0, round(1 + math.log(1.1), 4), round(1 + math.log(11 / 2), 4), round(1 + math.log(11), 4)}


# --- repeated passages


def test_deep_shallow_sorts():
    rng = random.Random(3)
    for _ in range(100):
        n = rng.randint(1, 30)
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, rng.choice((3, 30, 80))))) for _ in range(n)]
        groups = [rng.randint(0, 3) for _ in range(n)]
        ends = np.cumsum([len(s) for s in strings])
        order = deep_shallow(np.frombuffer(b"".join(strings), np.uint8), ends - [len(s) for s in strings], ends, np.array(groups), 0, 16)
        assert [(groups[k], strings[k]) for k in order] == sorted(zip(groups, strings))


def test_closest_matches_hold_every_longest_one():
    rng = random.Random(5)
    for _ in range(100):
        n = rng.randint(2, 20)
        left, right = ([bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 8))) for _ in range(n)] for _ in range(2))
        rank = [0] * n
        for place, k in enumerate(sorted(range(n), key=lambda k: right[k])):
            rank[k] = place
        best = {}
        for a, b, l, r in closest_matches(left, right, sorted(range(n), key=lambda k: left[k]), rank):
            for x in (a, b):
                for k in range(l + 1):
                    best[x, k] = max(best.get((x, k), -1), r)
        for x in range(n):
            for k in range(9):
                want = max((common(right[x], right[y]) for y in range(n) if y != x and common(left[x], left[y]) >= k), default=-1)
                assert best.get((x, k), -1) == want


def brute_report(rows, length):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[p:p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, body in texts:
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            if seen[body[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(body, gone) if not g)
        spans = sum(1 for k in range(len(body)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_report_equals_brute_force(spark):
    assert rows_of(report(frame(spark))) == brute_report(documents(), 400)
    assert rows_of(report(frame(spark, []))) == []


def test_table_report_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = rows_of(suffix_dedup.op6_suffix_dedup(spark, sf_dir))
    assert got == brute_report(rows, 400) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("most", [2, 256])
def test_short_lengths_and_hot_minimizers(spark, monkeypatch, most):
    """Many overlapping and periodic repeats; with ``most`` 2, most of them by single windows."""
    monkeypatch.setattr(suffix_dedup, "MOST_CLASSES", most)
    rng = random.Random(8)
    parts = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 60))) for _ in range(25)] + ["ab" * 40, "é" * 30]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8))), "", "", 0, 0, "", "", 0, "") for k in range(60)]
    docs = frame(spark, rows)
    keyed, spans = repeated_spans(docs.select("doc_id", "text"), 40, 12)
    found = {r.doc_id: r.spans for r in keyed.join(spans, ["t1", "t2"], "left").collect()}
    want = {r[0]: r for r in brute_report(rows, 40)}
    for k, text, *_ in rows:
        gone = {p for s in found[k] or [] for p in range(s.a, s.b)}
        assert len(gone) == want[k][2]


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 3000)
    assert rows_of(report(frame(spark))) == brute_report(documents(), 400)


def test_a_hot_minimizer_is_not_dealt_to_one_task(spark, monkeypatch):
    """A line that repeats within many texts: most passages have one minimizer, and one class."""
    kept, shares = suffix_dedup.written, {}

    def watched(df, purpose):
        out = kept(df, purpose)
        sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
        shares[purpose] = max(sizes, default=0) / max(1, sum(sizes))
        return out

    monkeypatch.setattr(suffix_dedup, "written", watched)
    line = prose(11, 6, line=6) + "\n"
    rows = [(k, prose(100 + k, 40) + line * 60 + prose(900 + k, 40), "", "", 0, 0, "", "", 0, "") for k in range(160)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # as on large tables
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keyed, spans = repeated_spans(frame(spark, rows).repartition(16).select("doc_id", "text"), 100, 32)
        found = keyed.join(spans, ["t1", "t2"], "left").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    gone = {r.doc_id: len({p for s in r.spans or [] for p in range(s.a, s.b)}) for r in found}
    assert gone == {r[0]: r[2] for r in brute_report(rows, 100)}
    assert shares["passage-members"] < 0.5, shares


def test_passages_of_a_long_text_take_little_memory():
    text = np.random.default_rng(5).integers(97, 123, 3 << 20, dtype=np.uint8).tobytes().decode()
    short = [text[k:k + 2000] for k in range(0, 1 << 20, 2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(short) + 1)), pa.array(range(len(short) + 1)), pa.array([*short, text])], ["t1", "t2", "text"])
    tracemalloc.start()
    windows = sum(sum(found.column(5).to_pylist()) for found in suffix_dedup.passage_batches(iter([batch]), 200, 64, suffix_dedup.RUN_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows == sum(max(0, len(x) - 199) for x in [*short, text])
    assert peak < 40 << 20, peak


def test_passages_go_from_documents(spark):
    docs = frame(spark)
    out = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert set(remove_repeats(docs).columns) == set(docs.columns)
    middle = PASSAGE[50:400]
    assert middle in {r[0]: r[1] for r in documents()}[6] and middle not in out[6].text and prose(3, 60)[:100] in out[6].text
    assert 2 not in out and out[8].text is None and out[6].u == "y" and all(r.n_chars == len(r.text) for r in out.values() if r.text)


# --- vectors


def vectors(n=1500, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[100:220] = x[100] + 0.05 * rng.normal(size=(120, dim))
    x[300:340] = x[300]
    for k in range(400, 450):
        x[k + 50] = x[k] + 0.1 * rng.normal(size=dim)
    return x


def brute_links(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= COSINE
    np.fill_diagonal(near, False)
    return near.sum(1), roots(len(x), np.argwhere(np.triu(near)).tolist())


def test_vectors_equal_brute_force(spark):
    x = vectors()
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    got = {r.vec_id: r for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), shards=3).collect()}
    links, components_ = brute_links(x)
    assert sum(min(got[k].n_links, links[k]) for k in got) >= 0.99 * links.sum()
    assert sum(got[k].component_id == components_[k] for k in got) >= 0.99 * len(x)
    assert all(got[k].n_links <= links[k] and got[k].kept == (got[k].component_id == k) for k in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]),
            (10, [1e300, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 5.0]), (11, [0.0, 1.0]), (12, [-0.0, 1.0])]
    frame_ = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, h1 string")
    got = sorted(map(repr, map(tuple, link_vectors(frame_).collect())))
    want = [(i, 0, i, i is not None) for i in (3, 4, 5, 6, 7, 8, 9)] + [(1, 3, 1, True)] * 2 + [(2, 3, 1, False), (10, 3, 1, False)] + [
        (None, 2, 11, False), (11, 2, 11, True), (12, 2, 11, False)]
    assert got == sorted(map(repr, want))
    assert link_vectors(frame_.limit(0)).collect() == []


def test_graph_survives_storage_and_audit_widens():
    x = vectors(800)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph.load(Graph(unit, np.random.default_rng(2).integers(0, 2**62, len(x)).astype(np.uint64)).dump())
    assert 1 <= audited_beam(graph, unit, unit, COSINE, beam=1) <= len(x)
    q, n = graph.within(unit, COSINE, 32)
    assert len(set(zip(q.tolist(), n.tolist()))) == len(q)
    assert len(q) >= 0.98 * (unit @ unit.T >= COSINE).sum()


def test_forest_spans_the_same_components():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 80, 70), rng.integers(0, 80, 70)
    u, v = forest(a, b)
    assert roots(80, list(zip(a, b))) == roots(80, list(zip(u, v))) and len(u) < 80


def test_lost_small_groups_fail_the_audit_of_a_shard_with_a_large_one():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24))
    x[:500] = x[0] + 0.02 * rng.normal(size=(500, 24))
    x[501::2] = x[500::2] + 0.02 * rng.normal(size=(500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x, rng.integers(0, 2**62, len(x)).astype(np.uint64))
    lost = np.isin(graph.order, np.arange(501, 1500, 2))
    for links in graph.links:
        links[lost[np.maximum(links, 0)]] = -1  # no link leads to one of each pair
    own = np.arange(len(x))
    assert audited_beam(graph, x, x, COSINE, own=own) == len(x)
    found = {pair for q, n in near_pairs(graph, x, x, COSINE, own) for pair in zip(q.tolist(), n.tolist())}
    assert {(k, k + 1) for k in range(500, 1500, 2)} | {(k + 1, k) for k in range(500, 1500, 2)} <= found
    assert len(found) == (x @ x.T >= COSINE).sum()


def test_pairs_of_a_large_group_are_not_held():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 16))
    x[:3000] = x[0] + 0.01 * rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, ids = Graph(x, rng.integers(0, 2**62, len(x)).astype(np.uint64)), np.arange(len(x))
    links, spanning = np.zeros(len(x), np.int64), Spanning()
    tracemalloc.start()
    count_links(ids, np.ones(len(x), np.int64), x, graph, ids, x, links, spanning)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links[:3000].tolist() == [2999] * 3000
    assert peak < links.sum() * 12  # nine million pairs as two whole numbers each are 144 MB, and joining them holds them twice
    a, b = spanning.edges()
    assert roots(len(x), zip(a.tolist(), b.tolist()))[:3000] == [0] * 3000


def test_shards_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_FIGURES", 24 * 100)
    built, build = [], embedding_dedup.build
    monkeypatch.setattr(embedding_dedup, "build", lambda classes, folder: (built.append(classes), build(classes, folder))[1])
    x = vectors()
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(2000 + k, [1.0, float(k)]) for k in range(3)]
    got = {r.vec_id: r for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    shards = {(r.dim, r.shard): r["count"] for r in built[0].groupBy("dim", "shard").count().collect()}
    assert len([k for k in shards if k[0] == 24]) == 15 and max(shards.values()) < 150 and {d for d, _ in shards} == {2, 24}
    links, _ = brute_links(x)
    assert sum(min(got[k].n_links, links[k]) for k in range(len(x))) >= 0.99 * links.sum()
