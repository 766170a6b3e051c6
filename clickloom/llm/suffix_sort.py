"""Deep-shallow sorting of strings: multikey quicksort to a shallow depth, then blind tries for what still ties."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np

STRIDE = 8


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def shallow(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, groups: np.ndarray, first: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order the strings ``buffer[start:end]`` within their groups by the bytes from ``first`` up to ``depth``.

    Multikey quicksort over keys of eight bytes, all groups at once: each round parts the ties by one key and goes on with what
    still ties. Returns (order, class): strings in order, and a number that strings share while they tie.
    """
    order = np.argsort(groups, kind="stable")
    tie = groups[order].copy()
    padded = np.concatenate([buffer, np.zeros(STRIDE, np.uint8)])
    for at in range(first, depth, STRIDE):
        new = np.ones(len(order), bool)
        new[1:] = tie[1:] != tie[:-1]
        place = np.flatnonzero(new)
        size = np.diff(np.append(place, len(order)))
        tie = np.repeat(place, size)  # a class is named by where it begins
        todo = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(todo):
            break
        begin = np.minimum(starts[order[todo]] + at, ends[order[todo]])
        room = np.clip(ends[order[todo]] - begin, 0, STRIDE)
        keys = padded[begin[:, None] + np.arange(STRIDE)]
        keys[np.arange(STRIDE) >= room[:, None]] = 0
        keys = keys.view(">u8").reshape(-1).astype(np.uint64)
        by = np.lexsort((room, keys, tie[todo]))
        order[todo] = order[todo][by]
        keys, room, held = keys[by], room[by], tie[todo]
        parted = np.zeros(len(todo), bool)
        parted[1:] = (held[1:] == held[:-1]) & ((keys[1:] != keys[:-1]) | (room[1:] != room[:-1]))
        tie[todo] = np.maximum.accumulate(np.where(parted | np.append(True, held[1:] != held[:-1]), todo, 0))
    return order, tie


class BlindTrie:
    """A trie that keeps only branching depths: a search compares single bytes, then one string in full."""

    __slots__ = ("strings", "root")

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None
        for k in range(len(strings)):
            self.insert(k)

    @staticmethod
    def _byte(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    def insert(self, k: int) -> None:
        s = self.strings[k]
        if self.root is None:
            self.root = [k]  # a leaf lists equal strings; a branch is (depth, children by byte)
            return
        node = self.root
        while isinstance(node, tuple):
            node = node[1].get(self._byte(s, node[0])) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node.append(k)
            return
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, edge = node, self._byte(s, node[0])
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._byte(s, depth)] = [k]
            return
        branch = (depth, {self._byte(other, depth): node, self._byte(s, depth): [k]})
        if parent is None:
            self.root = branch
        else:
            parent[1][edge] = branch

    def sorted(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, groups: np.ndarray, first: int = 0, shallow_depth: int = 32) -> np.ndarray:
    """Order of the strings within their groups. All strings of a group agree in their first ``first`` bytes."""
    order, tie = shallow(buffer, starts, ends, groups, first, first + shallow_depth)
    cut = np.append(np.flatnonzero(np.append(True, tie[1:] != tie[:-1])), len(order))
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if hi - lo > 1:
            own = order[lo:hi]
            strings = [buffer[a:b].tobytes() for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            order[lo:hi] = own[BlindTrie(strings).sorted()]
    return order


def closest_matches(left: list[bytes], right: list[bytes], left_order: list[int], right_rank: list[int]) -> list[tuple[int, int, int, int]]:
    """Pairs (a, b, l, r) of strings that meet at a common point, such that every longest match is among them.

    Strings are joined in descending order of the match of their left sides (neighbours in the sorted order). When two sets
    join, the members of the smaller take their places among the right sides of the larger; only neighbours there can match
    longer than any other at this left length. For n strings these are O(n log n) pairs.
    """
    pairs = []
    joins = sorted(((common(left[a], left[b]), k) for k, (a, b) in enumerate(zip(left_order[:-1], left_order[1:]))), reverse=True)
    owner = list(range(len(left_order)))
    sets = {k: [(right_rank[m], m)] for k, m in enumerate(left_order)}

    def find(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    for match, k in joins:
        a, b = find(k), find(k + 1)
        small, large = (a, b) if len(sets[a]) < len(sets[b]) else (b, a)
        members = sets[large]
        for item in sets.pop(small):
            at = bisect_left(members, item)
            for near in (at - 1, at):
                if 0 <= near < len(members):
                    other = members[near][1]
                    pairs.append((item[1], other, match, common(right[item[1]], right[other])))
            insort(members, item)
        owner[small] = large
    return pairs
