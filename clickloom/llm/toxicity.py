"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the presence of words and of word beginnings. Labelled sentences that name a group get a counterfactual
copy in which each identity term is swapped for another of its kind; the squared change of the score between the two is
penalised beside the logistic loss. Group names then cannot carry weight that their neutral mentions would bear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import ship_code, table
from clickloom.llm.labelled import held_out, sample_of_labelled
from clickloom.llm.words import Prefix, mix, runs

#: Bound on the labelled documents that the model is fitted on.
SAMPLE = 12_000
BUCKET_BITS = 20
BEGINNINGS = (4, 5, 6, 8)
FEATURES = 20_000
LEAST_DOCS = 5
STRENGTH = 5.0

IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("wives", "husbands"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("immigrants", "refugees", "foreigners", "locals", "citizens"), ("old", "young"), ("disabled", "deaf", "blind"))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Prefix]:
    lower = _LOWER[data]
    capital = np.flatnonzero((lower[:-1] == 0xC3) & (lower[1:] >= 0x80) & (lower[1:] <= 0x9E) & (lower[1:] != 0x97)) + 1
    lower[capital] += 32
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = _WORD[lower]
    begin, end = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    touch = inner[solid[inner] & solid[inner + 1]]
    begin[touch], end[touch - 1] = True, True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, Prefix(lower)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and word beginning of the rows, with repeats."""
    starts, ends, rows, prefix = _spans(data, offsets)
    found = [(rows, prefix.spans(starts, ends))]
    for n in BEGINNINGS:
        longer = ends - starts > n
        found.append((rows[longer], mix(prefix.spans(starts[longer], starts[longer] + n) + np.uint64(n))))
    return (np.concatenate([r for r, _ in found]),
            np.concatenate([h >> np.uint64(64 - BUCKET_BITS) for _, h in found]).astype(np.int64))


def buckets_of(text: str) -> np.ndarray:
    """The distinct buckets of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.unique(features(data, np.array([0, len(data)]))[1])


def swaps(terms=IDENTITY_TERMS) -> dict[bytes, list[list[int]]]:
    """For each identity term, its buckets and those of the next term of its kind."""
    return {term: (buckets_of(term).tolist(), buckets_of(kind[(k + 1) % len(kind)]).tolist()) for kind in terms for k, term in enumerate(kind)}


def fit(indices: list[np.ndarray], labels: np.ndarray, terms=IDENTITY_TERMS, strength: float = STRENGTH, rounds: int = 300) -> np.ndarray:
    """Weights by bucket, the bias last. ``indices`` are the documents' distinct buckets.

    The loss is the mean logistic loss, a ridge, and ``strength`` times the mean squared score change under swaps. Without labels of
    both kinds the weights are zero and the bias is the log odds of what there is.
    """
    size = 1 << BUCKET_BITS
    weights = np.zeros(size + 1)
    positive = labels > 0
    rate = (positive.sum() + 1) / (len(labels) + 2)
    weights[-1] = np.log(rate / (1 - rate))
    if not len(labels) or positive.all() or not positive.any():
        return weights
    rows = np.repeat(np.arange(len(indices)), [len(x) for x in indices])
    flat = np.concatenate(indices)
    hits = np.bincount(flat, minlength=size)
    good = np.bincount(flat[positive[rows]], minlength=size)
    a, b = good + 0.5, hits - good + 0.5
    c, d = positive.sum() - good + 0.5, (~positive).sum() - (hits - good) + 0.5
    z = np.abs(np.log(a * d / (b * c))) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    z[hits < LEAST_DOCS] = 0
    chosen = np.sort(np.argsort(-z, kind="stable")[:FEATURES])
    chosen = chosen[z[chosen] > 2]
    swapped = swaps(terms)
    named = np.array(sorted({k for old, new in swapped.values() for k in (*old, *new)}), np.int64)
    chosen = np.union1d(chosen, named)
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))
    keep = column[flat] >= 0
    rows, cols = rows[keep], column[flat[keep]]

    # counterfactual differences: minus what the swap takes away, plus what it brings, per document that names a group
    diff_rows, diff_cols, diff_signs, pairs = [], [], [], 0
    by_bucket = {old[0]: (old, new) for old, new in swapped.values()}
    lookup = np.zeros(size, bool)
    lookup[list(by_bucket)] = True
    for buckets in indices:
        mentions = buckets[lookup[buckets]]
        if len(mentions):
            for k in mentions.tolist():
                for sign, side in zip((-1.0, 1.0), by_bucket[k]):
                    diff_rows += [pairs] * len(side)
                    diff_cols += column[side].tolist()
                    diff_signs += [sign] * len(side)
            pairs += 1
    diff_rows, diff_cols, diff_signs = np.array(diff_rows, int), np.array(diff_cols, int), np.array(diff_signs, float)

    n, w, bias = len(labels), np.zeros(len(chosen)), weights[-1]
    y = positive.astype(float)
    speed_w, speed_b = np.full(len(chosen), 1e-8), 1e-8
    for _ in range(rounds):
        score = np.bincount(rows, w[cols], minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y) / n
        grad = np.bincount(cols, error[rows], minlength=len(w)) + 2e-5 * w
        if pairs:
            change = np.bincount(diff_rows, diff_signs * w[diff_cols], minlength=pairs)
            grad += 2 * strength / pairs * np.bincount(diff_cols, diff_signs * change[diff_rows], minlength=len(w))
        speed_w, speed_b = speed_w + grad ** 2, speed_b + error.sum() ** 2
        w, bias = w - 0.3 * grad / np.sqrt(speed_w), bias - 0.3 * error.sum() / np.sqrt(speed_b)
    weights[chosen], weights[-1] = w, bias
    return weights


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """Fit on a bounded sample of labelled documents outside the held-out fold; only their buckets come to the driver."""
    ship_code(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(0)):
                rows, buckets = features(data, offsets)
                keys = np.unique(rows << BUCKET_BITS | buckets)
                cut = np.searchsorted(keys >> BUCKET_BITS, np.arange(last - first + 1))
                own = (keys & ((1 << BUCKET_BITS) - 1)).astype("<i4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([own[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                    batch.column(1).slice(first, last - first).cast(pa.int64())], ["buckets", "label"])

    sample = sample_of_labelled(docs, labels, "toxic", most).mapInArrow(gather, "buckets binary, label long").toPandas()
    order = sample.assign(k=pd.util.hash_array(sample["buckets"].to_numpy(object))).sort_values(["k", "label"])
    return fit([np.frombuffer(x, "<i4") for x in order["buckets"]], order["label"].to_numpy())


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every document. Null and empty texts get the score of the bias alone."""
    ship_code(docs.sparkSession)
    packed = weights.astype(np.float32).tobytes()  # 4 MB, whatever the corpus

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(packed, np.float32)
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(2)):
                rows, buckets = features(data, offsets)
                keep = w[buckets] != 0
                keys = np.unique(rows[keep] << BUCKET_BITS | buckets[keep])
                total = np.bincount(keys >> BUCKET_BITS, w[keys & ((1 << BUCKET_BITS) - 1)], minlength=last - first) + float(w[-1])
                value = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                    pa.array(value), pa.array((value >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        apply, "doc_id long, held_out boolean, score double, predicted int")


def op2_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
