"""Words, hashes and windows of many texts at once: numpy over Arrow's string buffers, no loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_SALT = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Texts are worked on in runs of about so many bytes, to bound memory.
RUN_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a well-known hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0..n and those of its inverse, modulo 2^64."""
    if len(_POWERS["up"]) <= n:
        size = max(1 << n.bit_length(), 1 << 16) + 1  # no more than the runs need: every worker holds its own
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Prefix:
    """Prefix sums over bytes, from which the hash of any span follows in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SALT[data] * up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end): equal bytes give equal hashes wherever they stand."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the rows' offsets in them. Null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def runs(column: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of rows with about ``most`` bytes; a longer row is a run of its own."""
    data, offsets = string_parts(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (run of bytes that are no white space; words never cross rows)."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~IS_SPACE[data]
    begins, ends = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = inner[solid[inner] & solid[inner + 1]]  # two rows that touch
    begins[cut] = True
    ends[cut - 1] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def first_of_row(rows: np.ndarray, count: int) -> np.ndarray:
    """Where each row's items begin in a list that is grouped by row; one entry more at the end."""
    return np.searchsorted(rows, np.arange(count + 1))
