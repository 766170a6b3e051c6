"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

Elements are shingles of ``SHINGLE`` words; an element's weight is its count in the text times the mean inverse document
frequency of its words. (The frequency of a whole shingle would measure how often it was copied: in large groups of copies it
would take the weight from just what they share.) Word frequencies are counted over all documents by hash bucket, a table of
fixed size. A text's signature has ``BANDS * ROWS`` consistent samples; two texts agree in a sample with the probability
of their weighted Jaccard similarity.

Texts with an equal band share a bucket. Copies of a text count once. Within a bucket every text is compared with the bucket's
leader, the text that shares most buckets (the original in a group of copies): as many pairs as texts. Compared means: the share
of equal samples is at least ``LEAST_SHARE`` (a pair at the threshold misses that once in many millions) and then the exact
weighted Jaccard similarity of the whole texts is at least ``SIMILARITY``. Two texts alone in a bucket are done with that. Where the texts
of a bucket of more than ``LARGE`` blocks are then in more than one component, those outside its largest component are compared with more
leaders, the best standing texts of that component (``LEADERS``: their numbers in the rounds to come): in a group of texts about as alike
as the threshold asks for, a leader reaches a half, and few stay outside. What is then still in more than one component is compared in all
pairs of which one text is outside the largest component, in blocks and by longer sketches of ``SKETCH`` samples of a byte, each pair in
the first bucket of more than two texts that it shares. This lists no pairs: only the texts that have a pair with a share of equal samples of at least ``SKETCH_SHARE`` go on, with their whole texts, to blocks
that verify such pairs and hand on a spanning forest of the links. So no pair of a bucket is left out, and none is verified that a component
already covers or that a sketch rules out. A pair of similarity 0.8 shares a bucket with probability 1 - (1 - 0.8^4)^14 > 0.999,
and its sketch, where it needs one, misses with probability 4e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm.common import ship_code, table, written
from clickloom.llm.graph import components
from clickloom.llm.words import Prefix, mix, runs, word_spans

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
LEAST_SHARE = 0.5
IDF_BITS = 18
SKETCH, SKETCH_SHARE = 512, 0.70
BLOCK, BLOCK_BYTES = 500, 1 << 22
LEADERS = (3, 9)
LARGE = 8
FOUND = "bucket long, band int, id binary, root binary, largest binary, weight double, bytes long, bands array<long>, sketch binary"
_RUN = 1 << 19
_TABLE = 1 << 16


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2 at the middles of equal parts, by bisection."""
    goal = (np.arange(_TABLE) + 0.5) / _TABLE
    low, high = np.zeros(_TABLE), np.full(_TABLE, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < goal
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


_GAMMA = _gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_BETA = ((np.arange(_TABLE) + 0.5) / _TABLE).astype(np.float32)
_ODD = np.random.default_rng(11).integers(1, 2**62, max(SKETCH, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word."""
    start, end, row = word_spans(data, offsets)
    return row, Prefix(data).spans(start, end)


def elements(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, weight) of the rows' distinct shingles, grouped by row. A shorter text is one shingle of its words."""
    row, words = word_table(data, offsets)
    own = idf[words >> np.uint64(64 - IDF_BITS)]
    n = len(row)
    first = np.searchsorted(row, np.arange(len(offsets)))  # where each row's words begin
    count = np.diff(first)
    # every position starts a shingle if SHINGLE words of its row follow; of a short text only the first word does
    left = first[1:][row] - np.arange(n)
    starts = np.flatnonzero((left >= SHINGLE) | (np.arange(n) == first[:-1][row]))
    width = np.minimum(left[starts], SHINGLE)
    shingle, weight = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.float64)
    for k in range(SHINGLE):
        inside = width > k
        at = starts[inside] + k
        shingle[inside] = (shingle[inside] + words[at]) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        weight[inside] += own[at]
    shingle, weight, rows = mix(shingle), weight / width, row[starts]
    del count
    order = np.lexsort((shingle, rows)) if len(offsets) < 3 else np.argsort(mix(shingle + rows.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), kind="stable")
    rows, shingle, weight = rows[order], shingle[order], weight[order]
    new = np.ones(len(rows), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    weight = np.add.reduceat(weight, at) if len(at) else weight
    by_row = np.argsort(rows[at], kind="stable")
    return rows[at][by_row], shingle[at][by_row], weight[by_row]


def signatures(rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray, count: int, samples: int = BANDS * ROWS) -> np.ndarray:
    """Samples (32 bits each) of every row, one row of the result each; rows without elements get zeros."""
    out = np.zeros((count, samples), np.int32)
    if not len(rows):
        return out
    at = np.flatnonzero(np.diff(rows, prepend=-1))
    log_weight = np.log(weights).astype(np.float32)
    length = np.diff(np.append(at, len(rows)))
    for k in range(samples):
        g = shingles * _ODD[k]
        g ^= g >> np.uint64(32)
        r = _GAMMA[(g & np.uint64(0xFFFF)).astype(np.int64)]
        beta = _BETA[((g >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        t = np.floor(log_weight / r + beta)
        a = _LOG_GAMMA[(g >> np.uint64(48)).astype(np.int64)] - r * (t - beta) - r
        least = np.minimum.reduceat(a, at)
        hit = np.flatnonzero(a == np.repeat(least, length))
        place = hit[np.searchsorted(hit, at)]
        sample = mix(shingles[place] + t[place].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[rows[at], k] = (sample >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def similarity(first: tuple, second: tuple, count: int) -> np.ndarray:
    """Weighted Jaccard similarity of the i-th rows of two sets of elements (row, shingle, weight)."""
    rows = np.concatenate([first[0], second[0]])
    keys = np.concatenate([first[1], second[1]])
    side = np.concatenate([np.zeros(len(first[0]), bool), np.ones(len(second[0]), bool)])
    weight = np.concatenate([first[2], second[2]])
    order = np.lexsort((side, keys, rows))
    rows, keys, weight = rows[order], keys[order], weight[order]
    same = np.flatnonzero((keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1]))
    shared = np.bincount(rows[same], np.minimum(weight[same], weight[same + 1]), minlength=count)
    total = np.bincount(rows, weight, minlength=count) - shared
    return np.divide(shared, total, out=np.zeros(count), where=total > 0)


def word_idf(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies by hash bucket of words, over all documents (2^IDF_BITS figures, whatever the corpus)."""
    size = 1 << IDF_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(size, np.int64), 0
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(0), _RUN):
                row, words = word_table(data, offsets)
                keys = np.unique(row.astype(np.int64) << IDF_BITS | (words >> np.uint64(64 - IDF_BITS)).astype(np.int64))
                seen += np.bincount(keys & (size - 1), minlength=size)
                total += last - first
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], total))], ["bucket", "n"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    buckets, n = (found.column(c).to_numpy() for c in ("bucket", "n"))
    counts = np.zeros(size)
    counts[buckets[buckets >= 0]] = n[buckets >= 0]
    return (1 + np.log((1 + float(n[buckets < 0].sum())) / (1 + counts))).astype(np.float32)


def sign(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(id, weight, samples) for texts (columns id, text) that have a word."""
    packed = idf.tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = np.frombuffer(packed, np.float32)
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(1), _RUN):
                rows, shingles, weights = elements(data, offsets, idf)
                total = np.bincount(rows, weights, minlength=last - first)
                some = np.flatnonzero(total > 0)
                samples = signatures(rows, shingles, weights, last - first)[some]
                flat = pa.array(samples.reshape(-1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).take(pa.array(some)), pa.array(total[some]),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * (BANDS * ROWS)), flat)],
                    ["id", "weight", "samples"])

    return texts.mapInArrow(work, "id binary, weight double, samples array<int>")


def sketch(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(id, bands, weight, bytes, sketch) for texts (columns id, text, bands): a byte for each of SKETCH samples."""
    packed = idf.tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = np.frombuffer(packed, np.float32)
        for batch in batches:
            for first, last, data, offsets in runs(batch.column(1), _RUN):
                rows, shingles, weights = elements(data, offsets, idf)
                total = np.bincount(rows, weights, minlength=last - first)
                samples = signatures(rows, shingles, weights, last - first, SKETCH).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first), pa.array(total),
                    pa.array(np.diff(offsets).astype(np.int64)), pa.array([x.tobytes() for x in samples], pa.binary())],
                    ["id", "bands", "weight", "bytes", "sketch"])

    return texts.select("id", "text", "bands").mapInArrow(work, "id binary, bands array<long>, weight double, bytes long, sketch binary")


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (a, b) whose whole texts are at least SIMILARITY alike."""
    packed = idf.tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = np.frombuffer(packed, np.float32)
        for batch in batches:
            keep = []
            right = batch.column(3)
            for first, last, data, offsets in runs(batch.column(2), _RUN):
                one = elements(data, offsets, idf)
                parts = []
                for lo, _, other, bounds in runs(right.slice(first, last - first), _RUN):
                    rows, shingles, weights = elements(other, bounds, idf)
                    parts.append((rows + lo, shingles, weights))
                two = tuple(np.concatenate(x) for x in zip(*parts))
                keep.append(first + np.flatnonzero(similarity(one, two, last - first) >= SIMILARITY))
            at = pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    few = written(texts.join(wanted, "id", "left_semi"), "near-texts")
    joined = pairs.join(few.select(F.col("id").alias("a"), F.col("text").alias("left")), "a").join(
        few.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return joined.select("a", "b", "left", "right").mapInArrow(work, "a binary, b binary")


def _alike(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs whose signatures and total weights leave a similarity of SIMILARITY possible."""
    one = signed.select(F.col("id").alias("a"), F.col("weight").alias("wa"), F.col("samples").alias("sa"))
    two = signed.select(F.col("id").alias("b"), F.col("weight").alias("wb"), F.col("samples").alias("sb"))
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return pairs.join(one, "a").join(two, "b").where(
        (F.least("wa", "wb") >= 0.999 * SIMILARITY * F.greatest("wa", "wb")) & (equal >= LEAST_SHARE * BANDS * ROWS)).select("a", "b")


def _in_blocks(members: DataFrame, columns: list[str], judge, schema: str) -> DataFrame:
    """``judge`` over every block of a bucket's members: (bucket, band, id, root, largest, outer, inner, bands, weight, sketch, ``columns``).

    The members outside the bucket's largest component make ``outer`` parts, those inside it ``inner``. A member outside goes to
    the blocks of its part with every part, one inside to those of its part with every part outside: two members inside are
    never compared, and while few are outside, each of the many inside is sent on but once. ``judge`` gets the rows of whole
    blocks and yields what it finds.
    """
    inside = F.col("root") == F.col("largest")
    own = F.pmod(F.xxhash64("id"), F.when(inside, F.col("inner")).otherwise(F.col("outer"))).cast("int") + F.when(inside, F.col("outer")).otherwise(F.lit(0))
    others = F.sequence(F.lit(0), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)
    placed = members.withColumn("own", own).withColumn("other", F.explode(others))
    key = ("bucket", "i", "j")
    blocks = placed.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "band", "id", "root",
                           "weight", "bands", "sketch", *columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in key]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
            last = int(change[-1]) + 1 if len(change) else 0  # the last group may go on in the next batch
            if pending and any(pending[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in key):
                yield from judge(pa.Table.from_batches(pending))
                pending = []
            if last:
                pending.append(batch.slice(0, last))
                yield from judge(pa.Table.from_batches(pending))
                pending = []
            pending.append(batch.slice(last))
        if pending:
            yield from judge(pa.Table.from_batches(pending))

    return blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(work, schema)


def _candidates(rows: pa.Table) -> Iterator[tuple[int, int, np.ndarray, int, np.ndarray]]:
    """(first row of its block, last row + 1, the block's roots, row, later rows that may be alike) for the rows of whole blocks.

    A pair is met in the first of its common buckets only. Writing one root over another in the block's roots spares their pairs.
    """
    codes: dict[bytes, int] = {}
    root = np.array([codes.setdefault(r, len(codes)) for r in rows.column("root").to_pylist()])
    weight, own, band = (rows.column(c).to_numpy() for c in ("weight", "own", "band"))
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(root), SKETCH)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(root), BANDS)
    key = np.stack([rows.column(c).to_numpy() for c in ("bucket", "i", "j")])
    cut = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
    for lo, hi in zip(np.append(0, cut).tolist(), np.append(cut, len(root)).tolist()):
        r = root[lo:hi]
        if hi - lo < 2 or (r == r[0]).all():
            continue
        s, w, o, c = sketches[lo:hi], weight[lo:hi], own[lo:hi], bands[lo:hi, :band[lo]]
        for k in range(hi - lo - 1):
            ok = (r[k + 1:] != r[k]) & (np.minimum(w[k], w[k + 1:]) >= 0.999 * SIMILARITY * np.maximum(w[k], w[k + 1:]))
            if key[1, lo] != key[2, lo]:
                ok &= o[k + 1:] != o[k]
            near = k + 1 + np.flatnonzero(ok)
            near = near[~((c[near] == c[k]) & (c[k] != 0)).any(axis=1)]
            near = near[(s[near, :64] == s[k, :64]).sum(1) >= LEAST_SHARE * 64]
            near = near[(s[near] == s[k]).sum(1) >= SKETCH_SHARE * SKETCH]
            if len(near):
                yield lo, hi, r, lo + k, lo + near


def _with_candidates(members: DataFrame) -> DataFrame:
    """The members (``FOUND``) with another of a different root in their bucket that may be alike, each once."""
    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        found = np.zeros(rows.num_rows, bool)
        for _, _, _, k, near in _candidates(rows):
            found[k] = True
            found[near] = True
        yield from rows.select(names).filter(pa.array(found)).to_batches()

    def parts(size):
        return F.ceil(size / BLOCK).cast("int")

    names = [c.split()[0] for c in FOUND.split(", ")]
    sized = members.withColumn("outer", parts(F.col("size") - F.col("most"))).withColumn("inner", parts(F.col("most")))
    return _in_blocks(sized, ["largest", "bytes"], judge, FOUND).dropDuplicates(["bucket", "id"])


def _forest(members: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links (a, b) between members of different roots, verified on whole texts (columns id, text) within blocks.

    A block hands on a link only where it joins what the block's other links do not, so less than it has members. A block has
    texts of about twice BLOCK_BYTES, or two longer texts.
    """
    packed = idf.tobytes()

    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        idf = np.frombuffer(packed, np.float32)
        texts, ids = rows.column("text").combine_chunks(), rows.column("id")
        at, found, a, b = -1, [], [], []
        for lo, hi, root, k, near in _candidates(rows):
            if at != lo:
                at, found = lo, []
                for _, _, data, offsets in runs(texts.slice(lo, hi - lo), _RUN):
                    line, shingles, weights = elements(data, offsets, idf)
                    ends = np.searchsorted(line, np.arange(len(offsets)))
                    found += [(shingles[x:y], weights[x:y]) for x, y in zip(ends[:-1], ends[1:])]
            for first in range(0, len(near), 64):
                some = near[first:first + 64]
                others = [found[m - lo] for m in some]
                mine, n = found[k - lo], len(some)
                one = np.repeat(np.arange(n), len(mine[0])), np.tile(mine[0], n), np.tile(mine[1], n)
                two = np.repeat(np.arange(n), [len(x) for x, _ in others]), *(np.concatenate(x) for x in zip(*others))
                for m in some[similarity(one, two, n) >= SIMILARITY].tolist():
                    if root[m - lo] != root[k - lo]:
                        root[root == root[m - lo]] = root[k - lo]
                        a.append(ids[k].as_py())
                        b.append(ids[m].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    inside = F.col("root") == F.col("largest")

    def parts(own):
        rows, size = F.count_if(own), F.coalesce(F.sum(F.when(own, F.col("bytes"))), F.lit(0))
        return F.greatest(F.ceil(rows / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")

    sized = members.groupBy("bucket").agg(parts(~inside).alias("outer"), parts(inside).alias("inner"))
    return _in_blocks(members.join(sized, "bucket").join(texts, "id"), ["text"], judge, "a binary, b binary")


def near_links(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links (a, b) among distinct texts (id, text) whose components are those of all pairs of a bucket that are alike."""
    signed = written(sign(texts, idf), "near-signatures")
    bands = F.array(*[F.xxhash64(F.lit(k), *[F.col("samples")[k * ROWS + i] for i in range(ROWS)]) for k in range(BANDS)])
    banded = signed.select("id", F.posexplode(bands).alias("band", "bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(banded.join(sizes, "bucket"), "near-buckets")
    mates = shared.select("id").distinct()  # all that follows reads only texts that share a bucket
    texts, signed = written(texts.join(mates, "id", "left_semi"), "near-texts"), written(signed.join(mates, "id", "left_semi"), "near-signatures")

    ranked = shared.select("bucket", "id", F.sum("size").over(Window.partitionBy("id")).alias("standing"))  # a text has BANDS rows at most
    leader = ranked.groupBy("bucket").agg(F.max(F.struct(_rank().alias("rank"), "id")).alias("top")).select("bucket", F.col("top.id").alias("b"))
    # dealt by the text, not by its leader, whose bucket may be large
    to_leader = shared.join(leader, "bucket").where("id <> b").select(F.col("id").alias("a"), "b").repartition("a").dropDuplicates(["a", "b"])
    links = written(verify(written(_alike(to_leader, signed), "near-pairs"), texts, idf), "near-links")
    if links.isEmpty():
        roots = links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    else:
        roots = written(components(links), "near-roots")
    parted = _parted(shared, roots)

    compared = to_leader.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for leaders in LEADERS:
        large = parted.where(F.col("size") > LARGE * BLOCK)
        if large.isEmpty():
            break
        standing = shared.groupBy("id").agg(F.sum("size").alias("standing"))
        stood = large.where("root = largest").join(standing, "id").withColumn("rank", _rank())
        best = Window.partitionBy("bucket").orderBy(F.desc("rank"), "id")
        few = stood.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= leaders).select("bucket", F.col("id").alias("leader"))
        more = large.where("root <> largest").join(few, "bucket").select(
            F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
        more = written(more.join(compared, ["a", "b"], "left_anti"), "near-pairs")
        compared = compared.unionByName(more)
        links = verify(written(_alike(more, signed), "near-pairs"), texts, idf)
        roots = written(components(_stars(roots).unionByName(links)), "near-roots")
        parted = _parted(shared, roots)
    if parted.isEmpty():
        return _stars(roots)
    # a row a text: its buckets that have several components, by band
    keys = parted.groupBy("id").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("band") == k, F.col("bucket"))), F.lit(0)) for k in range(BANDS)]).alias("bands"))
    sketches = written(sketch(texts.join(keys, "id"), idf), "near-sketches")
    found = written(_with_candidates(parted.join(sketches, "id")), "near-across")
    return _stars(roots).unionByName(written(_forest(found, texts, idf), "near-links"))


def _rank():
    return F.col("standing") * 65536 + F.pmod(F.xxhash64("id"), F.lit(65536))


def _stars(roots: DataFrame) -> DataFrame:
    """Links (a, b) with the components of ``roots``: what comes later joins components that are known."""
    return roots.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))


def _parted(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, band, size, id, root, largest, most) of the buckets of more than two texts with several components: the largest and how many
    members it has there. (The one pair of a bucket of two has been compared: one of them led it.)"""
    rooted = shared.where("size > 2").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    counts = rooted.groupBy("bucket", "size", "root").agg(F.count("*").alias("n")).groupBy("bucket", "size").agg(F.max(F.struct("n", "root")).alias("top"))
    mixed = counts.where("top.n < size").select("bucket", F.col("top.root").alias("largest"), F.col("top.n").alias("most"))
    return written(rooted.join(mixed, "bucket").select("bucket", "band", "size", "id", "root", "largest", "most"), "near-members")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows have doc_id, id (of the text) and worded; classes of texts with a word have id, least (doc_id),
    group_id, chosen (the one class of its group that stays), again (several rows of this text have the least id)."""
    ship_code(docs.sparkSession)
    keyed = docs.select("doc_id", _text_id().alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    narrow = written(keyed.select("doc_id", "id", F.col("text").rlike("[^ \t-\r]").alias("worded")), "near-ids")
    idf = word_idf(docs)
    # one row for each text: the row of its smallest doc_id, or, where ids repeat, any of the equal rows
    least = narrow.where("worded").groupBy("id").agg(F.min("doc_id").alias("least"))
    repeats = narrow.where("worded").groupBy("id", "doc_id").count().where("count > 1").select("id").distinct()
    least = written(least.join(repeats.withColumn("again", F.lit(True)), "id", "left").withColumn("again", F.coalesce("again", F.lit(False))), "near-least")
    once = keyed.join(least, "id").where(F.col("doc_id").eqNullSafe(F.col("least"))).select("id", "text", "again")
    texts = written(once.where("NOT again").unionByName(once.where("again").dropDuplicates(["id"])).drop("again"), "near-distinct")
    roots = components(near_links(texts, idf))
    grouped = least.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "id")).alias("first"))
    return narrow, written(grouped.join(first, "root").select(
        "id", "least", "again", F.col("first.least").alias("group_id"), (F.col("id") == F.col("first.id")).alias("chosen")), "near-classes")


def _text_id():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, group_id (smallest doc_id of its group), kept (it is that document).

    Copies of a text form one group, as do texts that links join. Null texts and texts without a word are alone (their own id).
    Rows of equal id and text are kept or dropped together here; ``drop_near_copies`` leaves one of them. A null id is kept only
    in a group without ids. An empty table gives no rows; other columns are ignored.
    """
    rows, classes = _classes(docs)
    joined = rows.join(classes, "id", "left")
    kept = ~F.col("worded") | (F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("least")))
    return joined.select("doc_id", F.when(F.col("worded"), F.col("group_id")).otherwise(F.col("doc_id")).alias("group_id"),
                         F.coalesce(kept, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) without near copies: of each group the one with the smallest doc_id stays, once."""
    _, classes = _classes(docs)
    stays = classes.where("chosen").select(F.col("id").alias("_near_id"), F.col("least").alias("_near_least"), F.col("again").alias("_near_again"))
    keyed = docs.withColumn("_near_id", _text_id())
    worded = F.coalesce(F.col("text").rlike("[^ \t-\r]"), F.lit(False))
    first = keyed.where(worded).join(stays, "_near_id").where(F.col("doc_id").eqNullSafe(F.col("_near_least")))
    parts = first.where("NOT _near_again"), first.where("_near_again").dropDuplicates(["_near_id"]), keyed.where(~worded)
    columns = [f"`{c}`" for c in docs.columns]
    return parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns))


def op3_near_dedup(spark, sf_dir) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
