"""Near-duplicate embeddings by navigable small-world graphs per shard.

Vectors of each length are dealt to shards by hash, at most about ``SHARD_FIGURES`` figures to one; each shard builds a graph and stores it in the shared folder. Every vector then queries
every shard: a beam search gets near, and goes on through all neighbours in range. Before a block of queries is answered, a recall
audit compares the beam with the whole shard on a sample of queries and of the shard's own vectors, query by query; the beam is doubled
until the audit passes, and a shard that never passes is compared whole. Every pair is verified by cosine in double precision. Equal vectors are one node with a count. A task hands on,
not its pairs, but each vector's number of links and a spanning forest of them; components of the forests are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from clickloom.llm.common import shared_folder, ship_code, table, written
from clickloom.llm.graph import components
from clickloom.llm.small_world import Graph
from clickloom.session import broadcast_if_small

COSINE = 0.95
#: At least so many shards, and more as the table grows: building a shard of so many figures (131,072 vectors of 64) takes a task about 0.5 GB.
SHARDS = 4
SHARD_FIGURES = 1 << 23
BEAM = 32
AUDITED = 48
#: Of the queries, and of the shard's own vectors, so many are compared with the whole shard to find those to audit.
POOL = 192
#: Up to so many neighbours are few.
FEW = 16
FOLD = 1 << 18
RECALL = 0.99
#: Single precision may put a pair below the threshold by this much; pairs are verified in double precision.
SLACK = 1e-4


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    vectors = vectors / scale
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def build(classes: DataFrame, folder: str) -> DataFrame:
    """One graph file per dimension and shard: (dim, shard, path)."""
    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("cid").combine_chunks()
        cid = rows.column("cid").to_numpy()
        vectors = _matrix(rows.column("embedding").combine_chunks())
        keys = (cid.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        graph = Graph(_unit(vectors), keys ^ (keys >> np.uint64(29)))
        dim, shard = rows.column("dim")[0].as_py(), rows.column("shard")[0].as_py()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        path = f"{root}/graph-{dim}-{shard}"
        attempt = f"{path}.{TaskContext.get().taskAttemptId()}"
        with store.open_output_stream(attempt) as out:
            for part in (cid.astype("<i8"), rows.column("copies").to_numpy().astype("<i8"), vectors):
                data = part.tobytes()
                out.write(np.array([len(data)], "<i8").tobytes() + data)
            out.write(graph.dump())
        store.move(attempt, path)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [path]})

    return written(classes.groupBy("dim", "shard").applyInArrow(work, "dim int, shard int, path string"), "graphs")


def _load(store: fs.FileSystem, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    with store.open_input_stream(path) as stream:
        cid, copies, flat = (stream.read(int(np.frombuffer(stream.read(8), "<i8")[0])) for _ in range(3))
        graph = Graph.load(stream.read())
    cid = np.frombuffer(cid, "<i8")
    return cid, np.frombuffer(copies, "<i8"), _unit(np.frombuffer(flat, np.float64).reshape(len(cid), -1)), graph


def _planted(shard: np.ndarray, count: int, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """Vectors at the cosine from some of the shard's, in random directions."""
    base = shard[rng.integers(0, len(shard), count)]
    away = rng.normal(size=base.shape)
    away -= np.einsum("pd,pd->p", away, base)[:, None] * base
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    return _unit(cosine * base + np.sqrt(1 - cosine * cosine) * away)


def _counts(pieces: Iterator[tuple[np.ndarray, np.ndarray]], own: np.ndarray) -> np.ndarray:
    """How many nodes each query meets, without itself."""
    counts = np.zeros(len(own), np.int64)
    for q, n in pieces:
        counts += np.bincount(q[n != own[q]], minlength=len(own))
    return counts


def audited_beam(graph: Graph, shard: np.ndarray, queries: np.ndarray, least: float, beam: int = BEAM, own: np.ndarray | None = None) -> int:
    """The beam width at which sampled queries find RECALL of what the whole shard holds for them; the shard's size if none does.

    Recall is the mean over queries of each one's share, its hit on itself (``own``: its place in the shard, or -1) left out. Queries of
    at most FEW neighbours and those of more must pass apart. The sample is drawn from the queries and from the shard's own vectors;
    planted vectors near the threshold make sure that it has queries of few neighbours.
    """
    if not len(shard) or not len(queries):
        return len(shard)
    rng = np.random.default_rng(5)
    asked, kept = rng.permutation(len(queries))[:POOL], rng.permutation(len(shard))[:POOL]
    planted = _planted(shard, AUDITED, 1 - 0.8 * (1 - least), rng)
    sample = np.concatenate([queries[asked], shard[kept], planted])
    own = np.concatenate([np.full(len(asked), -1) if own is None else own[asked], kept, np.full(len(planted), -1)])
    held = _counts(graph.scan(sample, least + 1e-6), own)
    many = np.flatnonzero(held > FEW)
    audited = np.concatenate([np.flatnonzero((held > 0) & (held <= FEW)), many[rng.permutation(len(many))[:AUDITED]]])
    sample, own, held = sample[audited], own[audited], held[audited]
    while beam < len(shard):
        recall = np.minimum(1, _counts(graph.pieces(sample, least, beam), own) / held)
        if all(recall[group].mean() >= RECALL for group in (held <= FEW, held > FEW) if group.any()):
            return beam
        beam *= 2
        if 8 * beam > len(shard):  # comparing with all is then no dearer
            break
    return len(shard)


def near_pairs(graph: Graph, shard: np.ndarray, queries: np.ndarray, least: float, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) pairs a piece at a time: by the graph where its audit passes, else by comparing all, in blocks."""
    beam = audited_beam(graph, shard, queries, least, own=own)
    return graph.pieces(queries, least, beam) if beam < len(shard) else graph.scan(queries, least)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components: each pass joins nodes to their smallest neighbour's root."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


class Spanning:
    """A forest of all links added so far. What is added since the last fold stays below FOLD links, or the forest's own size."""

    def __init__(self):
        self.held, self.fresh, self.waiting = np.zeros((2, 0), np.int64), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.fresh.append(np.stack(forest(a, b)))
        self.waiting += self.fresh[-1].shape[1]
        if self.waiting > max(FOLD, self.held.shape[1]):
            self.edges()

    def edges(self) -> np.ndarray:
        joined = np.concatenate([self.held, *self.fresh], axis=1)
        self.held, self.fresh, self.waiting = np.stack(forest(joined[0], joined[1])), [], 0
        return self.held


def count_links(ids: np.ndarray, copies: np.ndarray, shard: np.ndarray, graph: Graph, cid: np.ndarray, queries: np.ndarray, links: np.ndarray,
                spanning: Spanning) -> None:
    """Add the queries' links with one shard to ``links`` and ``spanning``; each piece of pairs is verified and dropped before the next."""
    at = np.minimum(np.searchsorted(ids, cid), len(ids) - 1)
    for q, n in near_pairs(graph, shard, queries, COSINE - SLACK, np.where(ids[at] == cid, at, -1)):
        for lo in range(0, len(q), 1 << 16):
            a, b = q[lo:lo + (1 << 16)], n[lo:lo + (1 << 16)]
            true = (np.einsum("pd,pd->p", queries[a], shard[b]) >= COSINE) & (cid[a] != ids[b])
            a, b = a[true], b[true]
            np.add.at(links, a, copies[b])
            spanning.add(cid[a], ids[b])


def search(classes: DataFrame, graphs: DataFrame) -> DataFrame:
    """(a, b, links): rows with b null give a's number of linked vectors in other classes; the others are forest links."""
    by_dim: dict[int, list[str]] = {}
    for row in graphs.orderBy("dim", "shard").collect():  # one short row per shard
        by_dim.setdefault(row["dim"], []).append(row["path"])
    base = classes.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(base)
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)  # a task's share of the vectors
        dims = rows.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = rows.filter(pa.array(dims == dim)).combine_chunks()
            cid = own.column("cid").to_numpy()
            queries = _unit(_matrix(own.column("embedding").combine_chunks()))
            links, spanning = np.zeros(len(cid), np.int64), Spanning()
            for path in by_dim.get(dim, []):
                count_links(*_load(store, path), cid, queries, links, spanning)
            a, b = spanning.edges()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([cid, a])), pa.array(np.concatenate([np.zeros_like(cid), b]), mask=np.arange(len(cid) + len(a)) < len(cid)),
                pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]))], ["a", "b", "links"])

    return written(classes.select("cid", "dim", "embedding").mapInArrow(work, "a long, b long, links long"), "embedding-links")


def shard_counts(classes: DataFrame, shards: int | None = None) -> DataFrame:
    """dim, shards: into how many shards the vectors of each length are dealt (``shards``, or by their count and length)."""
    full = F.ceil(F.count("*") * F.col("dim") / F.lit(SHARD_FIGURES))
    return classes.groupBy("dim").agg((F.lit(shards) if shards else F.greatest(F.lit(SHARDS), full)).cast("int").alias("shards"))


def link_vectors(vectors: DataFrame, shards: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Null, empty, zero and non-finite vectors link with nothing and stand alone, as do vectors of different lengths from each other. Equal
    vectors are linked, also rows that repeat whole. A null vec_id is never the smallest of a component that has others; an empty
    table gives no rows; other columns are ignored.
    """
    ship_code(vectors.sparkSession)
    cells = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # minus zero becomes zero
    good = F.coalesce(
        F.size("embedding") > 0, F.lit(False)) & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) \
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    keyed = vectors.select("vec_id", F.when(good, cells).alias("embedding")).withColumns(
        {"h1": F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(1), "embedding")), "h2": F.xxhash64(F.lit(2), "embedding")})
    rows = written(keyed, "vectors")
    classes = written(rows.where("embedding IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"),
    ).withColumns({"cid": F.monotonically_increasing_id(), "dim": F.size("embedding")}), "vector-classes")
    dealt = classes.join(broadcast_if_small(shard_counts(classes, shards)), "dim").withColumn(
        "shard", F.pmod(F.xxhash64("h1", "h2"), F.col("shards")).cast("int"))
    found = search(classes, build(dealt.select("dim", "shard", "cid", "copies", "embedding"), shared_folder(vectors.sparkSession, "small-worlds")))
    roots = components(found.where("b IS NOT NULL"))
    counts = found.where("b IS NULL").select(F.col("a").alias("cid"), "links")
    labelled = classes.select("cid", "h1", "h2", "copies", "least").join(counts, "cid").join(
        roots.withColumnRenamed("id", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classed = labelled.join(least, "root").select("h1", "h2", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "h1", "h2").join(classed, ["h1", "h2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op4_embedding_dedup(spark, sf_dir) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
