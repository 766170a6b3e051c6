"""Byte-level BPE ids of whole texts, with the tokenizers library.

A byte-level pre-tokenizer always parts a text at some places that bytes show (see ``cuts``), so a text's ids are those of
the units between them. Added tokens of the vocabulary (<|endoftext|>) are units too, with their own id. Most units repeat: each worker remembers them by a 64-bit hash in numpy
tables, and only new ones go to the library, many in one call. Whole texts are covered, and the ids are the library's.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from clickloom.llm.words import Prefix, runs

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The id that ends every document.
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


class Tokens:
    """Remembers units' ids; ``slots`` bounds what it holds (half of them are filled before it starts anew)."""

    def __init__(self, path: str, slots: int = 1 << 22):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        if any(x.single_word or x.lstrip or x.rstrip for x in added):
            raise ValueError("added tokens that take in white space or stand only at words are not known here")
        self.added = frozenset(x.content.encode() for x in added)
        self.pattern = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.id_bytes = np.zeros(self.size, np.int64)  # one character of the byte alphabet stands for one byte
        for token, at in vocabulary.items():
            self.id_bytes[at] = len(token)
        self.slots = slots
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.first = np.zeros(self.slots, np.int32)
        self.count = np.zeros(self.slots, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = self.filled = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not held. Linear probing, all keys at once."""
        mask = np.uint64(self.slots - 1)
        at = (keys & mask).astype(np.int64)
        held = self.keys[at]
        found = np.where(held == keys, at, -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (self.slots - 1)
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (held != 0)]
        return found

    def learn(self, keys: np.ndarray, units: list[bytes]) -> None:
        """Encode distinct new units. Those that end visibly and begin so after at most one space stay apart when joined by line ends."""
        joined = [i for i, u in enumerate(units) if 32 < u[-1] < 127 and u[u[0] == 32] in _OPENS and u not in self.added]
        alone = sorted(set(range(len(units))) - set(joined))
        lengths = np.zeros(len(units), np.int64)
        ids: list[np.ndarray] = []
        groups = [joined[k:k + 1000] for k in range(0, len(joined), 1000)]
        texts = [b"\n".join([units[i] for i in g]).decode("utf-8", "replace") for g in groups]
        for group, one in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            got = np.array(one.ids, np.uint32)
            last = np.searchsorted(np.cumsum(self.id_bytes[got]), np.cumsum([len(units[i]) + 1 for i in group]) - 1)
            lengths[group] = np.diff(last, prepend=-2) - 1
            keep = np.ones(len(got), bool)
            keep[last[:-1] + 1] = False  # the line ends
            ids.append(got[keep])
        singles = [units[i].decode("utf-8", "replace") for i in alone]
        for i, one in zip(alone, self.library.encode_batch_fast(singles, add_special_tokens=False)):
            ids.append(np.array(one.ids, np.uint32))
            lengths[i] = len(one.ids)
        order = np.array(joined + alone, np.int64)
        starts = np.empty(len(units), np.int64)
        starts[order] = self.used + np.cumsum(lengths[order]) - lengths[order]
        total = int(lengths.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + total] = np.concatenate(ids) if ids else 0
        self.used += total
        todo, at = np.arange(len(keys)), (keys & np.uint64(self.slots - 1)).astype(np.int64)
        while len(todo):
            free = self.keys[at[todo]] == 0
            _, winner = np.unique(at[todo[free]], return_index=True)
            placed = todo[free][winner]
            self.keys[at[placed]] = keys[placed]
            self.first[at[placed]], self.count[at[placed]] = starts[placed], lengths[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            at[todo] = np.where(self.keys[at[todo]] == 0, at[todo], (at[todo] + 1) & (self.slots - 1))
        self.filled += len(keys)

    def around_added(self, starts: np.ndarray, body: bytes, offsets: np.ndarray) -> np.ndarray:
        """``starts`` with every added token of a row as a unit of its own: the library takes these out before anything else."""
        spans, at = [], 0
        while self.pattern and (found := self.pattern.search(body, at)):
            end = int(offsets[np.searchsorted(offsets, found.start(), "right")])
            if found.end() > end:  # it runs into the next row; the row itself may hold a shorter or later one
                found = self.pattern.search(body, at, end)
            if found:
                spans.append(found.span())
            at = found.end() if found else end
        if not spans:
            return starts
        begin, end = np.array(spans).T
        nth = np.searchsorted(begin, starts, "right") - 1
        outside = starts[(nth < 0) | (starts >= end[nth])]
        return np.unique(np.concatenate([outside, begin, end[end < len(body)]]))

    def located(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, body: bytes) -> np.ndarray:
        """Slots of units (at most half as many as there are slots), after encoding those that are new."""
        slots = self.find(keys)
        if (slots < 0).any():
            fresh, at = np.unique(keys[slots < 0], return_index=True)
            if self.filled + len(fresh) > self.slots // 2:
                self.clear()
                fresh, at = np.unique(keys, return_index=True)
            else:
                at = np.flatnonzero(slots < 0)[at]
            self.learn(fresh, [body[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            slots = self.find(keys)
        return slots

    def encode(self, column: pa.Array):
        """Yield (first row, last row + 1, ids, offsets of the rows in the ids) for runs of rows; every row ends with END_ID."""
        for first, last, data, offsets in runs(column):
            body = data.tobytes()
            starts = self.around_added(cuts(data, offsets), body, offsets)
            ends = np.append(starts[1:], len(data))
            rows = np.searchsorted(offsets, starts, "right") - 1
            keys = Prefix(data).spans(starts, ends) | np.uint64(1)
            counts, pieces = np.empty(len(keys), np.int64), []
            for a in range(0, len(keys), self.slots // 2):  # the tables hold the units of one part, however long the run
                part = slice(a, a + self.slots // 2)
                slots = self.located(keys[part], starts[part], ends[part], body)
                counts[part] = held = self.count[slots].astype(np.int64)
                before = np.cumsum(held) - held
                pieces.append(self.pool[np.arange(int(held.sum())) + np.repeat(self.first[slots].astype(np.int64) - before, held)])
            per_row = np.bincount(rows, weights=counts, minlength=last - first).astype(np.int64) + 1
            bounds = np.concatenate([[0], np.cumsum(per_row)])
            out = np.empty(int(bounds[-1]), np.uint32)
            if pieces:
                out[np.arange(int(counts.sum())) + np.repeat(rows, counts)] = np.concatenate(pieces)
            out[bounds[1:] - 1] = END_ID
            yield first, last, out, bounds


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at each row, at white space after a visible character, after a single line end, at punctuation after a letter.

    The pre-tokenizer parts a text at all these places. Visible leaves out what may be white space: two characters of two bytes
    and those of three bytes with lead byte E1 to E3. Letters are those of ASCII and of the blocks with lead bytes C3 to C5.
    """
    space = (data >= 9) & (data <= 13) | (data == 32)
    visible = (data > 32) & (data != 127)
    tail = np.flatnonzero((data[1:] == 0x85) | (data[1:] == 0xA0)) + 1
    visible[tail[data[tail - 1] == 0xC2]] = False
    wide = np.flatnonzero((data >= 0xE1) & (data <= 0xE3)) + 2
    visible[wide[wide < len(data)]] = False
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
    latin = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)) + 1
    letter[latin[~((data[latin - 1] == 0xC3) & ((data[latin] == 0x97) | (data[latin] == 0xB7)))]] = True
    point = visible & (data < 128) & ~letter & ~((data >= 48) & (data <= 57))
    begin = np.zeros(len(data), bool)
    begin[1:] = visible[:-1] & space[1:] | letter[:-1] & point[1:]
    begin[2:] |= visible[:-2] & (data[1:-1] == 10) & (visible & (data < 128))[2:]
    inner = offsets[:-1][np.diff(offsets) > 0]
    begin[inner] = True
    return np.flatnonzero(begin)


#: Bytes that begin a visible character for certain.
_OPENS = frozenset([*range(33, 127), 0xC3, 0xC4, 0xC5])

_HELD: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """The worker's own tables for a vocabulary file."""
    if path not in _HELD:
        _HELD[path] = Tokens(path)
    return _HELD[path]
