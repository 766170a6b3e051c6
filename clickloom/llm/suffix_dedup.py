"""Removal of repeated byte passages by suffix sorting.

Every string of ``LENGTH`` bytes that starts at two places of the corpus is found, and each byte under such a string goes.

* Every window of LENGTH bytes is filed under its minimizer, the smallest hash among its grams of ``GRAM`` bytes. Windows that
  follow each other and share the place of their minimizer form one passage, so a text yields about one passage for 140 bytes. Equal
  windows have equal minimizers at equal places; passages whose minimizer occurs once hold no repeat and end there.
* Equal passages form one class. A class with two members repeats in whole and is not looked at again on its own.
* Where one minimizer has several classes, their bytes are fetched once per class and sorted around the minimizer: the sides to
  the right and, reversed, to the left, by deep-shallow sorting. From both orders follow, for every class, all longest matches
  with others that meet at the minimizer, and from them the windows that repeat.
* A minimizer with over ``MOST_CLASSES`` classes (a passage that very many texts share among different neighbours) would be one
  large task. Its windows are compared one by one over the whole cluster, by two 64-bit hashes of all their bytes.
* A minimizer or a class with very many passages (a line that repeats within many texts) goes to the joins in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import partitions, ship_code, table, written
from clickloom.llm.suffix_sort import closest_matches, deep_shallow
from clickloom.llm.words import Prefix, mix, runs, string_parts

LENGTH = 400
GRAM = 128
MOST_CLASSES = 256
#: A minimizer or a class with more rows than this, and over a thousandth of all, goes to the joins in pieces.
HOT_ROWS = 512
#: Low bits of an ordered gram that hold its place in a run; the same for all runs, so that equal windows choose alike.
PLACE_BITS = 22
#: Bytes whose passages are found at once, and texts that are cut at once; a worker's memory follows from these.
RUN_BYTES = 1 << 17
CUT_ROWS = 1024

PASSAGE = "anchor long, content long, t1 long, t2 long, start long, windows int, lead int"


def passages(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """All passages of the rows: row, start (in the row), windows, lead (bytes before the minimizer), anchor and content hashes."""
    n, span = len(data), length - gram + 1
    empty = {k: np.zeros(0, np.int64) for k in ("row", "start", "windows", "lead", "anchor", "content")}
    if n < length:
        return empty
    if n >= 1 << PLACE_BITS:
        raise ValueError("a run is too long for the places of its minimizers")
    prefix = Prefix(data)
    at = np.arange(n - gram + 1)
    hashes = prefix.spans(at, at + gram)
    bits = np.uint64(PLACE_BITS)
    keyed = hashes >> bits << bits | at.astype(np.uint64)
    short = -len(keyed) % span
    blocks = np.append(keyed, np.full(short, np.iinfo(np.uint64).max)).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    count = n - length + 1
    least = np.minimum(ahead[:count], behind[span - 1:span - 1 + count])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    fits = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(fits, offsets[long], 1)
    np.add.at(fits, offsets[long + 1] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(fits)[:count] > 0)
    if not len(window):
        return empty
    own = place[window]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)]))
    windows = np.diff(np.append(first, len(window)))
    start, middle = window[first], own[first]
    row = np.searchsorted(offsets, start, "right") - 1
    return {"row": row, "start": start - offsets[row], "windows": windows, "lead": middle - start, "anchor": hashes[middle].view(np.int64),
            "content": prefix.spans(start, start + windows - 1 + length).view(np.int64)}


def passage_batches(batches: Iterator[pa.RecordBatch], length: int, gram: int, run: int) -> Iterator[pa.RecordBatch]:
    """Passages of the texts in batches of (t1, t2, text), a run of texts or a part of a long one at a time."""
    for batch in batches:
        t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for first, last, data, offsets in runs(batch.column(2), run):
            step = max(run, len(data) if last - first > 1 else 0)
            for base in range(0, max(1, len(data)), step):  # a text beyond a run is read in parts that overlap by a window
                part = data[base:base + step + length - 1]
                bounds = offsets if last - first > 1 else np.array([0, len(part)])
                found = passages(part, bounds, length, gram)
                row = first + found["row"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(found["anchor"]), pa.array(found["content"]), pa.array(t1[row]), pa.array(t2[row]), pa.array(found["start"] + base),
                    pa.array(found["windows"].astype(np.int32)), pa.array(found["lead"].astype(np.int32))], PASSAGE.replace(" long", "").replace(" int", "").split(", "))


def find_passages(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Passages of all texts (columns t1, t2, text)."""
    run = RUN_BYTES
    return keyed.select("t1", "t2", "text").mapInArrow(lambda batches: passage_batches(batches, length, gram, run), PASSAGE)


def _fetch(classes: DataFrame, keyed: DataFrame, least: DataFrame, length: int) -> DataFrame:
    """The classes (with the place of one member: t1, t2, start, and the classes of its minimizer) and their bytes."""
    places = classes.groupBy("t1", "t2").agg(F.collect_list(F.struct("anchor", "content", "start", "windows", "lead", "classes")).alias("places"))
    asked = places.join(least, ["t1", "t2"])
    read = keyed.join(asked, ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("least"))).select("text", "places")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_parts(batch.column(0))
            places = batch.column(1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
            flat = places.flatten()
            start, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
            begin = offsets[row] + start
            for lo in range(0, len(row), 4096):
                part = slice(lo, lo + 4096)
                body = [data[a:b].tobytes() for a, b in zip(begin[part].tolist(), (begin[part] + windows[part] + length - 1).tolist())]
                own = flat.slice(lo, 4096)
                yield pa.RecordBatch.from_arrays(
                    [own.field("anchor"), own.field("content"), own.field("windows"), own.field("lead"), pa.array(body, pa.binary()), own.field("classes")],
                    ["anchor", "content", "windows", "lead", "body", "classes"])

    return read.mapInArrow(work, "anchor long, content long, windows int, lead int, body binary, classes long")


def _repeats(lead: np.ndarray, windows: np.ndarray, bodies: list[bytes], anchors: np.ndarray, length: int, gram: int) -> list[list[tuple[int, int]]]:
    """For every class, the runs (first, last window) that repeat in another class of its anchor. Classes stand by anchor."""
    buffer = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies])
    begin = np.cumsum(sizes) - sizes
    right_order = deep_shallow(buffer, begin + lead, begin + sizes, anchors, gram)
    total = len(buffer)
    mirrored = np.ascontiguousarray(buffer[::-1])
    left_order = deep_shallow(mirrored, total - begin - lead, total - begin, anchors)
    cut = np.append(np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])), len(anchors))
    found: list[list[tuple[int, int]]] = [[] for _ in bodies]
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if hi - lo < 2:
            continue
        left = [bodies[k][:lead[k]][::-1] for k in range(lo, hi)]
        right = [bodies[k][lead[k]:] for k in range(lo, hi)]
        rank = [0] * (hi - lo)
        for place, k in enumerate(right_order[lo:hi].tolist()):
            rank[k - lo] = place
        for a, b, l, r in closest_matches(left, right, [k - lo for k in left_order[lo:hi].tolist()], rank):
            if l + r >= length:
                for k in (lo + a, lo + b):
                    first, last = int(lead[k]) - l, min(int(windows[k]) - 1, int(lead[k]) + r - length)
                    if first <= last:
                        found[k].append((max(0, first), last))
    return found


def _by_sorting(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, content, first, last: the runs of windows that repeat, by deep-shallow sorting within each task."""
    def close(rows: pa.Table) -> pa.RecordBatch:
        anchors, contents = rows.column("anchor").to_numpy(), rows.column("content").to_numpy()
        once = np.flatnonzero(np.append(True, (anchors[1:] != anchors[:-1]) | (contents[1:] != contents[:-1])))
        body = rows.column("body").to_pylist()
        found = _repeats(rows.column("lead").to_numpy()[once].astype(np.int64), rows.column("windows").to_numpy()[once], [body[k] for k in once.tolist()],
                         anchors[once], length, gram)
        size = [len(x) for x in found]
        flat = [x for one in found for x in one]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(anchors[once], size)), pa.array(np.repeat(contents[once], size)), pa.array([x[0] for x in flat], pa.int32()),
            pa.array([x[1] for x in flat], pa.int32())], ["anchor", "content", "first", "last"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                anchors = batch.column(0).to_numpy()
                change = np.flatnonzero(anchors[1:] != anchors[:-1])
                if pending and pending[-1].column(0)[-1].as_py() != anchors[0]:
                    yield close(pa.Table.from_batches(pending))
                    pending = []
                last = int(change[-1]) + 1 if len(change) else 0  # the last anchor may go on in the next batch
                if last:
                    yield close(pa.Table.from_batches([*pending, batch.slice(0, last)]))
                    pending = []
                pending.append(batch.slice(last))
        if pending:
            yield close(pa.Table.from_batches(pending))

    ordered = bodies.repartition("anchor").sortWithinPartitions("anchor", "content")
    return ordered.mapInArrow(work, "anchor long, content long, first int, last int")


def _dealt(rows: np.ndarray, key: np.ndarray, buckets: int, names: list[str]) -> pa.RecordBatch:
    """Columns of numbers as one row per bucket of the key, with the numbers in lists: a shuffle of few rows."""
    bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[:, order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    cut = pa.array(np.append(at, len(bucket)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[at]), *[pa.ListArray.from_arrays(cut, pa.array(column)) for column in rows]], ["bucket", *names])


def _gathered(batches: Iterator[pa.RecordBatch], columns: int) -> np.ndarray:
    """All numbers of a task's rows, as made by ``_dealt``."""
    parts = [np.stack([batch.column(k + 1).flatten().to_numpy() for k in range(columns)]) for batch in batches if batch.num_rows]
    return np.concatenate(parts, axis=1) if parts else np.zeros((columns, 0), np.int64)


def _by_windows(bodies: DataFrame, length: int) -> DataFrame:
    """As ``_by_sorting``, for anchors with very many classes: every window by itself, by two hashes of its bytes.

    Windows are dealt to tasks by hash, those that repeat then by class, where they join to runs.
    """
    buckets = partitions(bodies.sparkSession)
    window, place = ["h1", "h2", "anchor", "content", "nth"], ["anchor", "content", "nth"]

    def schema(names: list[str]) -> str:
        return ", ".join(["bucket long", *[f"{n} array<long>" for n in names]])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, content = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            windows = batch.column(2).to_numpy().astype(np.int64)
            data, offsets = string_parts(batch.column(4))
            for lo in range(0, batch.num_rows, 2048):
                hi = min(lo + 2048, batch.num_rows)
                part = data[offsets[lo]:offsets[hi]]
                row = np.repeat(np.arange(lo, hi), windows[lo:hi])
                nth = np.arange(len(row)) - np.repeat(np.cumsum(windows[lo:hi]) - windows[lo:hi], windows[lo:hi])
                at = offsets[row] - offsets[lo] + nth
                one = Prefix(part).spans(at, at + length).view(np.int64)
                two = mix(Prefix(part ^ 0x5A).spans(at, at + length)).view(np.int64)
                yield _dealt(np.stack([one, two, anchor[row], content[row], nth]), one, buckets, window)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _gathered(batches, len(window))
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        same = (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])
        again = np.append(False, same) | np.append(same, False) if rows.shape[1] else np.zeros(0, bool)
        yield _dealt(rows[2:, again], rows[3, again], buckets, place)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _gathered(batches, len(place))
        anchor, content, nth = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
        first = np.ones(len(nth), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]) | (nth[1:] > nth[:-1] + 1)
        at = np.flatnonzero(first)
        end = np.append(at[1:] - 1, len(nth) - 1)[:len(at)]
        yield pa.RecordBatch.from_arrays([
            pa.array(anchor[at]), pa.array(content[at]), pa.array(nth[at], pa.int32()), pa.array(nth[end], pa.int32())], ["anchor", "content", "first", "last"])

    spread = bodies.dropDuplicates(["anchor", "content"]).mapInArrow(hashed, schema(window)).repartition(buckets, "bucket")
    found = spread.mapInArrow(repeated, schema(place)).repartition(buckets, "bucket")
    return found.mapInArrow(joined, "anchor long, content long, first int, last int")


def _in_pieces(big: DataFrame, small: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """``big`` join ``small``, which has one row a key and in ``rows`` the number of that key's rows in ``big``. Both are stored.

    A key with over a thousandth of the rows is dealt to tasks in pieces of about that many, and its row of ``small`` is copied
    for each of them: some two thousand copies at most.
    """
    bound = max(HOT_ROWS, big.count() // 1000)
    pieces = F.when(F.col(rows) > bound, F.floor(F.col(rows) / bound) + 1).otherwise(1).cast("long")
    hot = small.where(F.col(rows) > bound).select(*keys, pieces.alias("pieces"))
    dealt = big.join(F.broadcast(hot), keys, "left").withColumn(
        "piece", F.pmod(F.monotonically_increasing_id(), F.coalesce("pieces", F.lit(1)))).drop("pieces")
    return dealt.join(small.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))), [*keys, "piece"]).drop("piece")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, nulls: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents with t1, t2 and text, spans by text): spans is (t1, t2, spans array<struct<a, b>>), bytes [a, b) of repeated strings.

    Null texts become empty unless ``nulls`` leaves them.
    """
    ship_code(docs.sparkSession)
    keyed = (docs if nulls else docs.withColumn("text", F.coalesce("text", F.lit("")))).withColumns(
        {"t1": F.xxhash64(F.lit(1), "text"), "t2": F.xxhash64(F.lit(2), "text")})
    found = written(find_passages(keyed, length, gram), "passages")
    again = written(found.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1"), "repeated-anchors")
    members = written(_in_pieces(found, again, ["anchor"], "rows").drop("rows"), "passage-members")
    classes = written(members.groupBy("anchor", "content").agg(
        F.count("*").alias("members"), F.min(F.struct("t1", "t2", "start")).alias("at"), F.max("windows").alias("windows"), F.max("lead").alias("lead"),
    ).select("anchor", "content", "members", "windows", "lead", "at.*"), "passage-classes")
    several = written(classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1"), "mixed-anchors")
    mixed = _in_pieces(classes, several, ["anchor"], "classes")
    least = keyed.where(F.length("text") > 0).groupBy("t1", "t2").agg(F.min("doc_id").alias("least"))
    bodies = written(_fetch(mixed, keyed, least, length), "passage-bodies")
    parts = _by_sorting(bodies.where(F.col("classes") <= MOST_CLASSES).drop("classes"), length, gram).unionByName(
        _by_windows(bodies.where(F.col("classes") > MOST_CLASSES).drop("classes"), length))
    alone = classes.where("members = 1").select("anchor", "content")
    partly = written(parts.join(alone, ["anchor", "content"], "left_semi").groupBy("anchor", "content").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")), "passage-runs").withColumn("members", F.lit(1).cast("long"))
    whole = classes.where("members > 1").select("anchor", "content", F.array(F.struct(
        F.lit(0).alias("first"), (F.col("windows") - 1).alias("last"))).alias("runs"), "members")
    flagged = _in_pieces(members, whole.unionByName(partly), ["anchor", "content"], "members")
    spans = flagged.select("t1", "t2", "start", F.explode("runs").alias("run")).select(
        "t1", "t2", F.struct((F.col("start") + F.col("run.first")).alias("a"), (F.col("start") + F.col("run.last") + length).alias("b")).alias("span"))
    return keyed, spans.groupBy("t1", "t2").agg(F.collect_set("span").alias("spans"))


def _merged(pairs: np.ndarray) -> np.ndarray:
    """Union of [a, b) spans, as sorted disjoint rows."""
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
    return np.stack([pairs[first, 0], reach[np.append(first[1:] - 1, len(pairs) - 1)]], axis=1)


def _cut(batch: pa.RecordBatch, text: int, spans: int) -> Iterator[tuple[bytes, np.ndarray, bytes]]:
    """(bytes, removed spans, remaining bytes) of every row."""
    data, offsets = string_parts(batch.column(text))
    lists = batch.column(spans)
    flat = lists.flatten()
    both = np.stack([flat.field("a").to_numpy(), flat.field("b").to_numpy()], axis=1) if len(flat) else np.zeros((0, 2), np.int64)
    bound = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    for k in range(batch.num_rows):
        body = data[offsets[k]:offsets[k + 1]].tobytes()
        gone = _merged(both[bound[k]:bound[k + 1]])
        edges = [0, *gone.reshape(-1).tolist(), len(body)]
        yield body, gone, b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document.

    Null texts are empty; documents that repeat lose all that the others hold (each copy is another place); texts under
    ``length`` bytes stay. Rows with equal ids are told apart by their texts; an empty table gives no rows; other columns are ignored.
    """
    keyed, spans = repeated_spans(docs.select("doc_id", "text"), length)
    joined = keyed.join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(body), len(body) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()) for body, gone, kept in _cut(batch, 1, 2)]
            n, removed, spans, digest = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents without their repeated passages (``n_chars`` follows); bytes of a character that was cut in two go too.

    Documents of which nothing is left, but which had text, are dropped.
    """
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest")
    keyed, spans = repeated_spans(docs.select("doc_id", "text", rest), length, gram, nulls=True)
    row = keyed.join(spans, ["t1", "t2"], "left").select("text", "spans", "_rest")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, CUT_ROWS):
                batch = whole.slice(lo, CUT_ROWS)
                kept = [body.decode("utf-8", "ignore") for _, _, body in _cut(batch, 0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), batch.column(2)], ["text", "_rest"])

    cut = row.where("spans IS NOT NULL").mapInArrow(work, row.select("text", "_rest").schema).where(F.col("text").rlike("[^ \t-\r]"))
    cut = cut.withColumn("_chars", F.length("text").cast("long"))
    whole = row.where("spans IS NULL").select("text", "_rest", F.lit(None).cast("long").alias("_chars")).unionByName(cut)
    changed = {"text": F.col("text"), "n_chars": F.coalesce("_chars", F.col("_rest.n_chars") if "n_chars" in others else F.lit(None))}
    return whole.select(*[changed[c].alias(c) if c in changed else F.col(f"_rest.`{c}`") for c in docs.columns])


def op6_suffix_dedup(spark, sf_dir) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
