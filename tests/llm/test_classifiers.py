"""The two classifiers: held-out accuracy, the counterfactual penalty, and odd inputs."""

import zlib

import numpy as np
import pytest
from fixtures import documents, frame
from pyspark.sql import functions as F

from clickloom.llm import quality_classifier, toxicity
from clickloom.llm.common import table
from clickloom.llm.labelled import held_out, sample_of_labelled

BIG = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name,query,label,least", [("op5", quality_classifier.op5_quality_classifier, "quality", 0.98),
                                                    ("op2", toxicity.op2_toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, name, query, label, least):
    labels = table(spark, BIG, "labels")
    scored = query(spark, BIG)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and scored.count() == table(spark, BIG, "documents").count()
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", label, "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    ones = [r for r in rows if r[label] == 1]
    assert np.mean([r.predicted for r in ones]) >= 0.85


def test_folds(spark):
    got = {r.doc_id: r.h for r in spark.createDataFrame([(k,) for k in [*range(200), None]], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(got[k] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(200)) and got[None]


def test_samples_leave_out_the_fold_and_disputed_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (5, 0), (7, 1), (None, 1), (13, 1)], "doc_id long, quality int")
    got = sample_of_labelled(frame(spark), labels, "quality", 100).collect()
    free = {k for k in (5, 7, 13) if zlib.crc32(str(k).encode()) % 5}
    texts = [t for i, t, *_ in documents() if i in free]
    assert sorted(r.text for r in got) == sorted(texts)
    assert sample_of_labelled(frame(spark), labels, "quality", 0).count() == 0


def test_swaps_are_penalised():
    """A group's name that only stands in bad sentences keeps little weight of its own."""
    bad = [f"those muslims are vile number{k}" for k in range(60)]
    good = [f"those people are kind number{k}" for k in range(60, 120)] + [f"the christians sing number{k}" for k in range(120, 150)]
    indices, labels = [toxicity.buckets_of(t) for t in bad + good], np.array([1] * 60 + [0] * 90)

    def score(w, text):
        return w[toxicity.buckets_of(text)].sum() + w[-1]

    def gap(w):
        return abs(score(w, "the muslims sing") - score(w, "the christians sing"))
    free, held = toxicity.fit(indices, labels, strength=0.0), toxicity.fit(indices, labels)
    assert gap(held) < 0.2 * gap(free) and score(held, "the muslims sing") < 0
    assert np.mean([(score(held, t) > 0) == (k < 60) for k, t in enumerate(bad + good)]) == 1


def test_odd_texts_get_scores(spark):
    docs, labels = frame(spark), spark.createDataFrame([(1, 1, 0), (5, 1, 1), (17, 0, 1), (13, 1, 0)], "doc_id long, quality int, toxic int")
    for module in (quality_classifier, toxicity):
        got = module.score(docs, module.learn(docs, labels)).collect()
        assert len(got) == len(documents()) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (8, 9)}) == 1
        none = module.score(docs, module.learn(docs, labels.limit(0))).collect()
        assert len({round(r.score, 9) for r in none}) == 1
        assert module.score(docs.limit(0), module.learn(docs.limit(0), labels)).collect() == []


def test_pairs_are_ranked():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(300, 12)))
    y = (x[:, 0] + 0.1 * rng.normal(size=300) < 1).astype(int)
    model = quality_classifier.fit(x, y)
    got = quality_classifier.scores(x, model)
    assert np.mean((got >= quality_classifier.CUT) == (y == 1)) > 0.9
    assert abs((got < quality_classifier.CUT).mean() - (y == 0).mean()) < 0.01
