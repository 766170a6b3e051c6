"""Mixing against its targets worked out in plain Python."""

from collections import Counter, defaultdict

import pytest
from fixtures import documents, frame, prose, rows_of
from pyspark.sql import functions as F

from clickloom.llm.common import table
from clickloom.llm.mixing import MOST_PASSES, draw, hypergeometric, mix, mix_report, narrow, plan, quotas


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 3 * sizes[s] <= level * weight[s]}
        if not full:
            target.update({s: level * weight[s] for s in free})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= full
    return target


def check(report, rows):
    sizes = defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    got = report.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.taken <= MOST_PASSES * r["size"] and r.taken == len(r.shards) * r["size"]
    for source, goal in want.items():
        own = [r for r in got if r.source_size == sizes[source] and abs(r.target - goal) < 1e-6 * max(1, goal)]
        assert own or not sizes[source]
    return got, want


def test_targets_and_reruns(spark):
    rows = documents()
    first, _ = check(mix_report(frame(spark)), rows)
    again, _ = check(mix_report(frame(spark).repartition(5)), rows)
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_sources_come_near_their_targets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    report = mix_report(docs, shard_words=5_000, block_words=512).join(docs.select("doc_id", "source"), "doc_id")
    for r in report.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("size").alias("size")).collect():
        assert abs(r.taken - r.target) <= max(0.02 * r.target, r["size"] / 2)


@pytest.mark.parametrize("seed", range(2))
def test_a_very_long_document_leaves_no_gap(spark, seed):
    sizes = {"a": [20_000 + k for k in range(8)] + [100 + k % 150 for k in range(900)], "b": [400 + k % 200 for k in range(600)]}
    rows = [(k, "w " * n, s) for s, own in sizes.items() for k, n in enumerate(own)]
    report = mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed, block_words=512).collect()
    for own in sizes.values():
        got = [r for r in report if r.source_size == sum(own)]
        assert len(got) == len(own)
        assert abs(sum(r.taken for r in got) - got[0].target) < min(own)


def test_quotas_are_exact_and_random(spark):
    sources = spark.createDataFrame([(0, 40), (1, 7), (2, 0), (3, 953)], "rank int, units long")
    seen = []
    for seed in range(3):
        rows = quotas(sources, 5, seed).collect()
        by_rank, by_shard = Counter(), Counter()
        for r in rows:
            assert r.quota >= 0
            by_rank[r["rank"]] += r.quota
            by_shard[r.shard] += r.quota
        assert by_rank == {0: 40, 1: 7, 2: 0, 3: 953} and set(by_shard.values()) == {200}
        seen.append(sorted(map(tuple, rows)))
    assert seen[0] != seen[1]


def test_hypergeometric_has_its_distribution(spark):
    draws = spark.range(4000).select(hypergeometric(F.lit(50), F.lit(12), F.lit(20), (F.col("id") + 0.5) / 4000).alias("k"))
    mean, var = draws.agg(F.avg("k"), F.var_pop("k")).first()
    assert abs(mean - 4.8) < 0.01 and abs(var - 20 * 0.24 * 0.76 * 30 / 49) < 0.02


def test_shards_draw_disjoint_runs(spark):
    rows = narrow(spark.createDataFrame([(k, prose(k, 20), f"s{k % 4}") for k in range(200)], "doc_id long, text string, source string"))
    sources = plan(rows, 64)
    drawn = draw(rows, sources, 7).collect()
    quota = {(r["rank"], r.shard): r.quota for r in quotas(sources, 7).collect()}
    units = defaultdict(set)
    for r in drawn:
        units[r["rank"], r.slot].add(r.shard)
    assert all(len(s) == 1 for s in units.values())
    used = Counter((rank, next(iter(s))) for (rank, _), s in units.items())
    assert all(n <= quota[k] for k, n in used.items())


def test_mix_repeats_whole_documents(spark):
    docs = frame(spark)
    out = mix(docs)
    assert out.columns == docs.columns
    taken = Counter(tuple(r) for r in out.collect())
    known = Counter(tuple(r) for r in docs.collect())
    assert set(taken) <= set(known) and all(n <= MOST_PASSES * known[k] for k, n in taken.items())
    assert rows_of(mix(frame(spark, []))) == [] and rows_of(mix_report(frame(spark, []))) == []


@pytest.mark.parametrize("build", [mix, mix_report])
def test_no_python_on_the_way(spark, build):
    plan_text = build(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan_text for word in ("Python", "Arrow", "Pandas", "Cartesian"))
