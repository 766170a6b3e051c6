"""A hierarchical navigable small-world graph over unit vectors, searched for many queries in step (numpy)."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np

DEGREE = 16
BUILD_BEAM = 48
BATCH = 512
SPREAD = 4096


def _top(scores: np.ndarray, ids: np.ndarray, flags: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` best columns of every row, best first."""
    if scores.shape[1] > keep:
        part = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
        scores, ids, flags = (np.take_along_axis(x, part, 1) for x in (scores, ids, flags))
    order = np.argsort(-scores, axis=1, kind="stable")
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, flags))


class Graph:
    """Nodes stand in descending order of level, so that layer j holds the first ``counts[j]`` nodes. ``links[j]`` are its neighbours."""

    def __init__(self, vectors: np.ndarray, keys: np.ndarray):
        uniform = (np.argsort(np.argsort(keys, kind="stable")) + 0.5) / max(1, len(keys))  # keys are hashes: their ranks are random
        levels = np.floor(-np.log(uniform) / np.log(DEGREE)).astype(int)
        self.order = np.lexsort((keys, -levels))
        self.x = np.ascontiguousarray(vectors[self.order], np.float32)
        levels = levels[self.order]
        self.counts = [int((levels >= j).sum()) for j in range(int(levels.max(initial=0)) + 1)]
        self.links: list[np.ndarray] = [np.zeros((0, 1), np.int32)] * len(self.counts)
        for layer in range(len(self.counts) - 1, -1, -1):
            self._build(layer)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, order=self.order, x=self.x, counts=np.array(self.counts), **{f"links{j}": a for j, a in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Graph":
        graph, held = cls.__new__(cls), np.load(io.BytesIO(data))
        graph.order, graph.x, graph.counts = held["order"], held["x"], held["counts"].tolist()
        graph.links = [held[f"links{j}"] for j in range(len(graph.counts))]
        return graph

    def _build(self, layer: int) -> None:
        n, above = self.counts[layer], self.counts[layer + 1] if layer + 1 < len(self.counts) else 0
        width = 2 * DEGREE if layer == 0 else DEGREE
        self.links[layer] = np.full((n, width), -1, np.int32)
        done = 0
        while done < n:
            stop = min(n, max(done + 1, min(done + BATCH, max(above, 2 * done, 64))))
            new = np.arange(done, stop)
            if done <= max(above, 64):  # few enough to compare with all
                near = np.broadcast_to(np.arange(stop), (len(new), stop))
                sims = self.x[new] @ self.x[:stop].T
            else:
                starts = self._descend(self.x[new], layer)
                sims, near = self._beam(layer, self.x[new], starts, BUILD_BEAM)
                near = np.concatenate([near, np.broadcast_to(new, (len(new), len(new)))], axis=1)
                sims = np.concatenate([sims, self.x[new] @ self.x[new].T], axis=1)
            sims = np.where((near == new[:, None]) | (near < 0), -2, sims)
            sims, near, _ = _top(sims, near.astype(np.int32), np.zeros(sims.shape, bool), min(BUILD_BEAM, sims.shape[1]))
            chosen = self._diverse(new, near, sims, min(DEGREE, width))
            self.links[layer][new, :chosen.shape[1]] = chosen
            self._link_back(layer, new, chosen)
            done = stop

    def _diverse(self, nodes: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Neighbours that are nearer to the node than to those taken before them; then the nearest of the rest."""
        out = np.full((len(nodes), most), -1, np.int32)
        for lo in range(0, len(nodes), 256):
            cand, own = near[lo:lo + 256], sims[lo:lo + 256]
            vectors = self.x[np.maximum(cand, 0)]
            between = vectors @ vectors.transpose(0, 2, 1)
            taken = np.zeros(cand.shape, bool)
            for k in range(cand.shape[1]):
                close = np.where(taken, between[:, k, :], -2).max(axis=1)
                taken[:, k] = (own[:, k] > -2) & (own[:, k] > close)
            rank = np.where(own <= -2, 2, np.where(taken, 0, 1)) * 1000 + np.arange(cand.shape[1])
            first = np.argsort(rank, axis=1)[:, :most]
            picked = np.take_along_axis(np.where(own > -2, cand, -1), first, 1)
            out[lo:lo + 256, :picked.shape[1]] = picked
        return out

    def _link_back(self, layer: int, new: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[layer]
        source = np.repeat(new, chosen.shape[1])
        target = chosen.reshape(-1)
        keep = target >= 0
        source, target = source[keep], target[keep]
        known = (links[target] == source[:, None]).any(axis=1)
        source, target = source[~known], target[~known]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        while len(target):
            first = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
            nth = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
            now = nth < links.shape[1]
            hubs = target[first]
            extra = np.full((len(hubs), links.shape[1]), -1, np.int32)
            extra[np.searchsorted(hubs, target[now]), nth[now]] = source[now]
            cand = np.concatenate([links[hubs], extra], axis=1)
            sims = np.einsum("hd,hcd->hc", self.x[hubs], self.x[np.maximum(cand, 0)])
            sims = np.where(cand < 0, -2, sims)
            over = (cand >= 0).sum(axis=1) > links.shape[1]
            sims, cand, _ = _top(sims, cand, np.zeros(cand.shape, bool), cand.shape[1])
            links[hubs[~over]] = cand[~over, :links.shape[1]]
            if over.any():
                links[hubs[over]] = self._diverse(hubs[over], cand[over], sims[over], links.shape[1])
            source, target = source[~now], target[~now]

    def _descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        at = np.zeros((len(queries), 1), np.int32)
        for upper in range(len(self.counts) - 1, layer, -1):
            at = self._beam(upper, queries, at, 4)[1]
        return at

    def _beam(self, layer: int, queries: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, nodes) of the best ``width`` nodes met; -1 where there are fewer."""
        links, count = self.links[layer], self.counts[layer]
        rows = np.arange(len(queries))
        seen = np.zeros((len(queries), count + 1), bool)  # the last column stands for no node
        ids = np.full((len(queries), width), -1, np.int32)
        ids[:, :min(width, starts.shape[1])] = starts[:, :width]
        sims = np.where(ids < 0, -2, np.einsum("qd,qcd->qc", queries, self.x[np.maximum(ids, 0)]))
        seen[rows[:, None], ids] = True
        spent = ids < 0
        sims, ids, spent = _top(sims, ids, spent, width)
        active = rows
        while len(active):
            pick = np.argmin(spent[active], axis=1)
            open_ = ~spent[active, pick]
            active, pick = active[open_], pick[open_]
            if not len(active):
                break
            spent[active, pick] = True
            near = links[ids[active, pick]]
            fresh = ~seen[active[:, None], near] & (near >= 0)
            seen[active[:, None], near] = True
            some = fresh.any(axis=1)
            active_now, near, fresh = active[some], near[some], fresh[some]
            if len(active_now):
                found = np.einsum("qd,qcd->qc", queries[active_now], self.x[np.maximum(near, 0)])
                found = np.where(fresh, found, -2).astype(np.float32)
                s, i, f = _top(np.concatenate([sims[active_now], found], axis=1), np.concatenate([ids[active_now], np.where(fresh, near, -1)], axis=1),
                               np.concatenate([spent[active_now], ~fresh], axis=1), width)
                sims[active_now], ids[active_now], spent[active_now] = s, i, f
        return sims, ids

    def pieces(self, queries: np.ndarray, least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs of similarity >= least, a piece at a time and each pair once: a beam to get near, then on through all
        neighbours in range. A piece is at most a block's beams, or ``SPREAD`` nodes' links."""
        queries = np.ascontiguousarray(queries, np.float32)
        step = max(16, min(BATCH, (1 << 25) // max(1, len(self.x))))
        for lo in range(0, len(queries), step):
            part = queries[lo:lo + step]
            sims, ids = self._beam(0, part, self._descend(part, 0), width)
            q, c = np.nonzero((sims >= least) & (ids >= 0))
            seen = np.zeros((len(part), len(self.x) + 1), bool)
            front_q, front_n = q.astype(np.int32), ids[q, c]
            seen[front_q, front_n] = True
            if len(front_q):
                yield lo + front_q.astype(np.int64), self.order[front_n]
            while len(front_q):
                next_q, next_n = [], []
                for k in range(0, len(front_q), SPREAD):
                    near = self.links[0][front_n[k:k + SPREAD]]
                    who = np.repeat(front_q[k:k + SPREAD], near.shape[1])
                    near = near.reshape(-1)
                    fresh = ~seen[who, near] & (near >= 0)
                    pair = np.unique(who[fresh].astype(np.int64) * len(self.x) + near[fresh])
                    who, near = pair // len(self.x), pair % len(self.x)
                    seen[who, near] = True
                    hit = np.einsum("pd,pd->p", part[who], self.x[near]) >= least
                    if hit.any():
                        who, near = who[hit], near[hit]
                        next_q.append(who.astype(np.int32))
                        next_n.append(near.astype(np.int32))
                        yield lo + who, self.order[near]
                front_q, front_n = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (next_q, next_n))

    def scan(self, queries: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same pairs by comparing every query with every node, in blocks."""
        queries = np.ascontiguousarray(queries, np.float32)
        for lo in range(0, len(queries), 128):
            for at in range(0, len(self.x), 1 << 13):
                q, n = np.nonzero(queries[lo:lo + 128] @ self.x[at:at + (1 << 13)].T >= least)
                if len(q):
                    yield lo + q, self.order[at + n]

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """All ``pieces`` joined; only for as many queries as all pairs of fit memory."""
        none = np.zeros(0, np.int64)
        q, n = zip((none, none), *self.pieces(queries, least, width))
        return np.concatenate(q), np.concatenate(n)
