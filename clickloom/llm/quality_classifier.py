"""Quality by Bradley-Terry ranking of documents.

A document's strength is a weighted sum of figures of its text. Preference pairs (a document labelled good before one labelled
bad) are won with the logistic probability of the strengths' difference, so the weights come from a logistic loss on feature
differences. The threshold is a quantile of the sample's strengths: the share that is labelled bad lies below it. Scores are
the strengths on a logistic scale that puts the threshold at ``CUT``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import ship_code, table
from clickloom.llm.labelled import held_out, sample_of_labelled
from clickloom.llm.words import Prefix, first_of_row, mix, runs, word_spans

#: Bounds on the labelled documents and the preference pairs that the model is fitted on.
SAMPLE = 20_000
PAIRS = 100_000
CUT = 0.3

NAMES = ("symbols", "capitals", "digits", "shouts", "repeats", "loose_lines", "again", "long_words", "log_words", "word_length", "commas", "distinct")

_KIND = {"symbols": b"#*$%&|<>{}[]@~^_=+\\/", "digits": b"0123456789", "shouts": b"!", "commas": b",.;:"}
_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in _KIND.items()}
_CAPITAL = np.isin(np.arange(256), list(range(65, 91)))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_END = np.isin(np.arange(256), list(b".!?:;\"')]"))


def figures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of figures (as in ``NAMES``) per text. An empty text has zeros."""
    rows = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    at = first_of_row(row, rows)
    n = np.maximum(np.diff(at), 1)

    def per_row(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[places[1:]] - sums[places[:-1]]

    hashes = Prefix(data).spans(start, end)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    # distinct words and repeated runs of four words, by sorting (row, hash) keys
    order = np.lexsort((hashes, row))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    four = hashes.copy()
    for k in (1, 2, 3):
        four[:-k] = mix(four[:-k] + hashes[k:] * np.uint64(2 * k + 1)) if len(four) > k else four[:-k]
    whole = np.zeros(len(row), bool)
    whole[:-3] = row[:-3] == row[3:] if len(row) > 3 else False
    inside = np.flatnonzero(whole)
    by = inside[np.lexsort((four[inside], row[inside]))]
    again = np.zeros(len(row), bool)
    again[by[1:]] = (four[by[1:]] == four[by[:-1]]) & (row[by[1:]] == row[by[:-1]])

    last_of_line = np.zeros(len(row), bool)
    if len(row):
        gap_break = np.concatenate([[0], np.cumsum(data == 10)])
        last_of_line[:-1] = (gap_break[start[1:]] > gap_break[end[:-1]]) | (row[1:] != row[:-1])
        last_of_line[-1] = True
    loose = last_of_line & ~_END[data[end - 1]] if len(row) else last_of_line
    lines = np.maximum(per_row(last_of_line, at), 1)
    letters = np.maximum(per_row(_LETTER[data], offsets), 1)
    solid = per_row(end - start, at)
    return np.stack([
        per_row(_IS["symbols"][data], offsets) / n, per_row(_CAPITAL[data], offsets) / letters, per_row(_IS["digits"][data], offsets) / n,
        per_row(_IS["shouts"][data], offsets) / n, per_row(same, at) / n, per_row(loose, at) / lines, per_row(again, at) / n,
        per_row(end - start > 30, at) / n, np.log1p(np.diff(at)), solid / n, per_row(_IS["commas"][data], offsets) / n,
        per_row(first, first_of_row(row[order], rows)) / n ** 0.8,
    ], axis=1)


def _squash(x: np.ndarray) -> np.ndarray:
    """Bounded figures and their square roots: small shares of symbols or repeats already tell."""
    bounded = np.minimum(np.abs(x), 20)
    return np.concatenate([bounded, np.sqrt(bounded)], axis=1)


def fit(x: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, rounds: int = 60) -> dict:
    """Weights on standardised figures by Newton steps on the pairs' logistic loss, and the threshold.

    Without labels of both kinds all documents score alike: above the cut if they are good, below if bad.
    """
    labels = labels > 0
    x = _squash(x)
    if not labels.any() or labels.all():
        return {"mean": 0.0, "scale": 1.0, "w": np.zeros(x.shape[1]), "cut": -1.0 if labels.all() else 1.0}
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = (x - mean) / scale
    rng = np.random.default_rng(7)
    good, bad = rng.permutation(np.flatnonzero(labels)), rng.permutation(np.flatnonzero(~labels))
    count = min(pairs, 20 * max(len(good), len(bad)))
    better, worse = good[np.arange(count) % len(good)], bad[rng.integers(0, len(bad), count)]
    diff = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))  # the chance of the wrong order
        grad = -(diff * p[:, None]).mean(0) + 1e-3 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / count + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    strength = np.sort(x @ w)
    share = (~labels).mean()
    k = int(np.clip(round(share * len(strength)), 1, len(strength) - 1))
    return {"mean": mean, "scale": scale, "w": w, "cut": float((strength[k - 1] + strength[k]) / 2)}


def scores(x: np.ndarray, model: dict) -> np.ndarray:
    strength = ((_squash(x) - model["mean"]) / model["scale"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(strength - model["cut"] + np.log(CUT / (1 - CUT)), -40, 40)))


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict:
    """Fit on a bounded sample of labelled documents outside the held-out fold; only their figures come to the driver."""
    ship_code(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(0)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(figures(data, offsets)), pa.list_(pa.float64())), batch.column(1).slice(first, last - first).cast(pa.int64())],
                    ["figures", "label"])

    rows = sample_of_labelled(docs, labels, "quality", most).mapInArrow(gather, "figures array<double>, label long").toPandas()
    x = np.stack(rows["figures"].to_numpy()) if len(rows) else np.zeros((0, len(NAMES)))
    order = np.lexsort((rows["label"].to_numpy(), *x.T)) if len(rows) else np.zeros(0, int)  # rows arrive in any order
    return fit(x[order], rows["label"].to_numpy()[order])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= CUT) for every document; null and empty texts have zero figures."""
    ship_code(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(2)):
                value = scores(figures(data, offsets), model)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                    pa.array(value), pa.array((value >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        apply, "doc_id long, held_out boolean, score double, predicted int")


def op5_quality_classifier(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
