"""Time-forward processing of a tree that is dealt to shards: sorted nodes, messages between them in spilling priority queues.

Spark sorts a shard's nodes by level; a task streams them and holds only the messages to levels still to come. A queue with too
many messages writes sorted runs to an unnamed scratch file of its task, which ends with the task, and merges them when read.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 4
READ = 4096


class SpillingQueue:
    """Messages (level, address, x, y) of whole numbers in order of level and address; at most ``most`` of them in memory."""

    def __init__(self, most: int = 1 << 18):
        self.most, self.heap, self.heads, self.runs = most, [], [], []

    def push(self, message: tuple[int, int, int, int]) -> None:
        if len(self.heap) >= self.most:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        if len(self.runs) >= 64:  # so many open runs become one
            run = heapq.merge(*[self._rest(k) for k in range(len(self.runs))], sorted(self.heap))
            self.runs, self.heads = [self._store(run)], []
        else:
            self.runs.append(self._store(iter(sorted(self.heap))))
        self.heap = []
        self.heads = [h for h in self.heads if h[1] < len(self.runs) - 1]
        first = next(self.runs[-1], None)
        if first is not None:
            heapq.heappush(self.heads, (first, len(self.runs) - 1))

    def _rest(self, k: int) -> Iterator[tuple]:
        yield from (head for head, run in self.heads if run == k)
        yield from self.runs[k]

    @staticmethod
    def _store(messages: Iterator[tuple]) -> Iterator[tuple]:
        """Write sorted messages and hand out an iterator over what was written."""
        file, block = tempfile.TemporaryFile(), []
        for message in messages:
            block.append(message)
            if len(block) == READ:
                file.write(np.array(block, dtype=np.int64).tobytes())
                block = []
        file.write(np.array(block, dtype=np.int64).tobytes())
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while data := file.read(READ * WIDTH * 8):
                    yield from map(tuple, np.frombuffer(data, dtype=np.int64).reshape(-1, WIDTH).tolist())
        return read()

    def first(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, run = self.heads[0]
            following = next(self.runs[run], None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, run))
            return message
        return heapq.heappop(self.heap)

    def take(self, level: int, address: int) -> list[tuple[int, int]]:
        """The contents of all messages to this address, which must be the next in order."""
        out = []
        while (message := self.first()) is not None and message[:2] == (level, address):
            out.append(self.pop()[2:])
        return out


def subtree_totals(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Add the columns ``leaves`` and ``saved`` of all nodes below to those of each node, within its shard.

    Rows come by (shard, depth descending, conv_id); ``up`` says that the parent (parent_conv_id, depth - 1) is of the same shard.
    """
    queue, shard = SpillingQueue(most), None
    for batch in batches:
        at = {name: batch.column(name).to_pylist() for name in ("shard", "depth", "conv_id", "parent_conv_id", "up", "leaves", "saved")}
        leaves_out, saved_out = [], []
        for now, depth, conv, parent, up, leaves, saved in zip(*at.values()):
            if now != shard:
                queue, shard = SpillingQueue(most), now
            for x, y in queue.take(-depth, conv):
                leaves, saved = leaves + x, saved + y
            if up:
                queue.push((1 - depth, parent, leaves, saved))
            leaves_out.append(leaves)
            saved_out.append(saved)
        names = batch.schema.names
        arrays = [pa.array(leaves_out if n == "leaves" else saved_out, pa.int64()) if n in ("leaves", "saved") else batch.column(n)
                  for n in names]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


BUNDLES = ("kind string, shard long, conv_id long, depth long, bundle_conv long, bundle_depth long, leaves long, saved long")
_BUNDLE_NAMES = [f.split()[0] for f in BUNDLES.split(", ")]
_BUNDLE_TYPES = [pa.string()] + [pa.int64()] * 7


def bundle_sums(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Sums of a shard's bundles, and the bundle of every portal.

    A bundle is all of a shard that hangs below one node of another shard, (bundle_conv, bundle_depth); below the root of the
    whole tree, bundle_depth is -1. A portal is a node below which another shard hangs. Rows come by (shard, depth,
    parent_conv_id, conv_id); a node sends its bundle to its children, addressed by itself.
    """
    queue, shard, sums, rows, last = SpillingQueue(most), None, {}, [], None

    def flush():
        return [("sum", shard, None, None, conv, depth, x, y) for (conv, depth), (x, y) in sums.items()]

    def batch_of(found):
        columns = zip(*found) if found else [[]] * len(_BUNDLE_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BUNDLE_TYPES)], names=_BUNDLE_NAMES)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in (
            "shard", "depth", "conv_id", "parent_conv_id", "up", "leaves", "saved", "n_children", "portal")]
        for now, depth, conv, parent, up, leaves, saved, children, portal in zip(*columns):
            if now != shard:
                rows += flush()
                queue, shard, sums, last = SpillingQueue(most), now, {}, None
            if not up:
                bundle = (0 if parent is None else parent, depth - 1)
            else:
                if last is None or last[0] != (depth, parent):
                    while (message := queue.first()) is not None and message[:2] < (depth, parent):
                        queue.pop()  # its children are all in other shards
                    last = ((depth, parent), queue.take(depth, parent)[0])
                bundle = last[1]
            if children:
                queue.push((depth + 1, conv, *bundle))
            x, y = sums.get(bundle, (0, 0))
            sums[bundle] = (x + leaves, y + saved)
            if portal:
                rows.append(("portal", shard, conv, depth, *bundle, None, None))
        yield batch_of(rows)
        rows = []
    yield batch_of(flush())
