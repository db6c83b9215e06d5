"""Vectorised word splitting and hashing over Arrow string buffers.

Everything here is a small helper that runs inside a Spark task: it looks at the bytes of one
record batch, a few megabytes at a time, and never keeps a whole partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into numpy arrays at once (one longer text goes alone).
CHUNK_BYTES = 1 << 20

_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def give_back() -> None:
    """Gives memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not with every C library
        pass


def tidy(run: Callable) -> Callable:
    """The task `run`, which at its end gives what it has freed back to the system: executors keep Python workers that wait for work."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def _splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums of products become well spread."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _splitmix(x + _U(0x9E3779B97F4A7C15))


_BYTE = mix(np.arange(256, dtype=_U) + _U(1000))
_BASE = 0xD6E8FEB86659FD93  # odd


def powers(n: int) -> np.ndarray:
    """1, B, B^2, ... modulo 2^64."""
    out = np.empty(max(n, 1), _U)
    out[0] = 1
    if n > 1:
        out[1:] = _U(_BASE)
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    if not large and not pa.types.is_string(column.type):
        column, large = column.cast(pa.large_string()), True
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Ranges of rows of about `most` bytes each; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts, A-Z in lower case, as 64-bit hashes.

    hash[k], start[k], end[k]: word k; ptr[d]:ptr[d + 1] are the words of text d. With `plain`, words
    are runs of letters and digits (any byte above 127 is a letter), and Latin-1 letters lose case too.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, plain: bool = False):
        low = _LOWER[data]
        if plain and len(data):
            after = np.zeros(len(data), bool)
            after[1:] = data[:-1] == 0xC3
            low[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
        solid = _PLAIN[data] if plain else ~_WHITE[data]
        n = len(data)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash, self.ptr, self.low = np.zeros(0, _U), np.zeros(len(offsets), np.int64), low
            return
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        begin[cuts] = solid[cuts]  # a text's first word starts even right after another text's last
        self.start = np.flatnonzero(begin)
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        last[cuts - 1] = solid[cuts - 1]
        self.end = np.flatnonzero(last) + 1
        self.low = low
        self.ptr = np.searchsorted(self.start, offsets)
        self.hash = self._hashes(solid)

    def _hashes(self, solid: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, _U)
        size = self.end - self.start
        at = np.flatnonzero(solid)
        first = np.cumsum(size) - size
        place = np.arange(len(at)) - np.repeat(first, size)
        with np.errstate(over="ignore"):
            parts = _BYTE[self.low[at]] * powers(int(size.max()))[place]
            return mix(np.add.reduceat(parts, first) + size.astype(_U))


_SEAT = mix(np.arange(64, dtype=_U) + _U(77)) | _U(1)


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ptr): the k-word shingles of each text in order, repeats included.

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    h, ptr = mix(words.hash), words.ptr
    count = np.diff(ptr)
    n = len(h)
    with np.errstate(over="ignore"):
        total = np.zeros(n, _U)
        for j in range(k):
            total[: n - j] += h[j:] * _SEAT[j]
        full = mix(total)
        out_count = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
        out_ptr = np.concatenate([[0], np.cumsum(out_count)])
        at = np.repeat(ptr[:-1] - out_ptr[:-1], out_count) + np.arange(out_ptr[-1])
        out = full[at]
        for d in np.flatnonzero((count > 0) & (count < k)):
            w = h[ptr[d] : ptr[d + 1]]
            out[out_ptr[d]] = mix(np.array([(w * _SEAT[: len(w)]).sum(dtype=_U) + _U(len(w))], _U))[0]
    return out, out_ptr


def distinct_sets(values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, with their ptr."""
    values = values.copy()
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[ptr[:-1][np.diff(ptr) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[ptr]
