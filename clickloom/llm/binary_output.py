"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank by frequency over all documents (the most frequent becomes 0), so that common ids need one
byte. Each rank takes one to four bytes in a data area; its length less one takes two bits in a control area, four ranks to
a control byte. Decoding looks all control bytes up in a table of lengths, sums them to offsets and gathers the bytes: numpy
on whole frames, no loop over ids.

Layout of a shard file: frames, each ``frame header (4 little-endian int64: documents, ids, control bytes, data bytes)``,
then document ids (int64; the smallest int64 for null), ids per document (int64), control bytes, data bytes. ``ranks.bin``
holds the id of every rank (uint32). Shards are cut by ranges of doc_id; documents stand in ascending doc_id order, nulls first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.taskcontext import TaskContext

from clickloom.llm.common import shared_folder, ship_code, table, written
from clickloom.llm.tokens import default_path, tokens

NULL_ID = np.iinfo(np.int64).min
_CODES = np.arange(256, dtype=np.uint8)
#: Lengths of the four numbers that a control byte describes.
LENGTHS = np.stack([((_CODES >> s) & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.int64)
_HEADER = 32
#: Shards whose counts meet in one task, and at most in the driver (a vocabulary's counts each).
GATHERED = 64


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4")
    lengths = 1 + (numbers > 0xFF).astype(np.int64) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-len(numbers) % 4 + len(numbers), np.uint8)
    codes[:len(numbers)] = lengths - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    body = numbers.view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), body[np.arange(4) < lengths[:, None]].tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers that ``encode_numbers`` coded."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths)
    body = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    starts = ends - lengths
    out = body[starts]
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        out[longer] |= body[starts[longer] + k] << np.uint32(8 * k)
    return out


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def _put(store: fs.FileSystem, path: str, write) -> None:
    """Write under a name of this attempt, then rename: a lost or repeated task leaves whole files only."""
    context = TaskContext.get()
    attempt = f"{path}.{context.taskAttemptId() if context else 0}"
    with store.open_output_stream(attempt) as out:
        write(out)
    store.move(attempt, path)


def _frames(stream) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, bytes]]:
    while head := stream.read(_HEADER):
        documents, _, control, data = np.frombuffer(head, "<i8")
        ids, counts = (np.frombuffer(stream.read(8 * int(documents)), "<i8") for _ in range(2))
        yield ids, counts, stream.read(int(control)), stream.read(int(data))


def _frame(doc_ids: np.ndarray, counts: np.ndarray, control: bytes, data: bytes) -> bytes:
    head = np.array([len(doc_ids), counts.sum(), len(control), len(data)], "<i8")
    return b"".join([head.tobytes(), doc_ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), control, data])


def corpus_counts(shards: DataFrame, vocabulary: int) -> np.ndarray:
    """Sum of the shards' counts by id: a tree of sums, GATHERED shards to a task, until the driver can take the rest."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_buffer(), np.int64)
        yield pa.RecordBatch.from_pydict({"counts": [total.tobytes()]}, schema=pa.schema([("counts", pa.binary())]))

    level, n = shards.select("counts"), shards.count()
    while n > GATHERED:
        n = -(-n // GATHERED)
        level = written(level.repartition(n).mapInArrow(add, "counts binary"), "token-counts")
    return sum((np.frombuffer(row["counts"], np.int64) for row in level.collect()), np.zeros(vocabulary, np.int64))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write all documents' ids to ``folder``; one row per shard: shard, path, n_docs, n_tokens.

    The texts are sorted by ranges of doc_id and encoded once, into plain shard files with counts of their ids. The counts,
    summed over all shards, give the ranks (as many as the vocabulary has ids). One task per shard then rewrites it in the
    coded form and drops the plain file, so that the two never exist in full together. A repeated task finds the coded file.
    """
    spark = docs.sparkSession
    ship_code(spark)
    store, root = _open(folder)
    store.create_dir(root)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(tokenizer)
        shard = TaskContext.get().partitionId()
        files, base = _open(folder)
        path, counts, total = f"{base}/shard-{shard:06d}", np.zeros(coder.size, np.int64), [0, 0]
        kind = np.uint16 if coder.size <= 1 << 16 else np.uint32
        batch = next(batches, None)
        if batch is None:
            return

        def write(out) -> None:
            nonlocal batch
            while batch is not None:
                keys = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                for first, last, ids, bounds in coder.encode(batch.column(1)):
                    counts[:] += np.bincount(ids, minlength=coder.size)
                    total[0] += last - first
                    total[1] += len(ids)
                    body = pa.compress(ids.astype(kind).tobytes(), codec="zstd", asbytes=True)
                    out.write(_frame(keys[first:last], np.diff(bounds), b"", body))
                batch = next(batches, None)

        _put(files, f"{path}.plain", write)
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "path": [path], "n_docs": [total[0]], "n_tokens": [total[1]], "counts": [counts.tobytes()]}, schema=plain_schema)

    plain_schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                              ("counts", pa.binary())])
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = texts.repartitionByRange(F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text")
    shards = written(ordered.mapInArrow(
        plain, "shard int, path string, n_docs long, n_tokens long, counts binary"), "token-shards")

    vocabulary = tokens(tokenizer).size
    counts = corpus_counts(shards, vocabulary)
    ranks = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)].astype("<u4")
    with store.open_output_stream(f"{root}/ranks.bin") as out:
        out.write(ranks.tobytes())

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _open(folder)
        with files.open_input_stream(f"{base}/ranks.bin") as stream:
            by_rank = np.frombuffer(stream.read(), "<u4")
        rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank))
        kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        for frame in batches:
            for path in frame["path"]:
                old, new = files.get_file_info([f"{path}.plain", f"{path}.ids"])
                if new.type == fs.FileType.NotFound:
                    with files.open_input_stream(f"{path}.plain") as stream:
                        def write(out) -> None:
                            for doc_ids, counts, _, body in _frames(stream):
                                raw = pa.decompress(body, int(counts.sum()) * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
                                out.write(_frame(doc_ids, counts, *encode_numbers(rank_of[np.frombuffer(raw, kind)])))
                        _put(files, f"{path}.ids", write)
                try:
                    if old.type != fs.FileType.NotFound:
                        files.delete_file(f"{path}.plain")
                except FileNotFoundError:  # another attempt of this task was first
                    continue
            yield frame[["shard", "path", "n_docs", "n_tokens"]]

    names = shards.select("shard", "path", "n_docs", "n_tokens")
    one_each = names.repartition(max(1, names.count()), "shard")
    return written(one_each.mapInPandas(coded, "shard int, path string, n_docs long, n_tokens long"), "token-files")


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """Documents of the files, in order: doc_id, start, n_tokens, ids (array), ids_crc32."""
    ship_code(files.sparkSession)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one short row per shard
    placed = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        with store.open_input_stream(f"{root}/ranks.bin") as stream:
            by_rank = np.frombuffer(stream.read(), "<u4")
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{path}.ids") as stream:
                    for doc_ids, counts, control, data in _frames(stream):
                        ids = by_rank[decode_numbers(control, data, int(counts.sum()))]
                        ends = np.cumsum(counts)
                        starts = ends - counts
                        crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(base + starts), pa.array(counts), pa.array(crc, pa.int64()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        base += int(ends[-1]) if len(ends) else 0

    spread = placed.select("path", "base").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the documents' ids to files and describe each document as read back from them.

    Null texts count as empty (one id, the end id); documents with equal doc_id follow each other by text; a null doc_id comes
    first; an empty table gives no rows; other columns are ignored.
    """
    folder = folder or shared_folder(docs.sparkSession, "token-ids")
    return read_tokens(write_tokens(docs, folder, tokenizer or default_path()), folder)


def op1_binary_output(spark, sf_dir) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
