"""Vectorised word kernels over Arrow string buffers.

Everything here works on the UTF-8 bytes that Arrow already holds, so a batch of texts is split into words and every
word is hashed without making a Python string per word.  Batches are cut into slices of a bounded number of bytes; a
single text longer than the bound makes a slice of its own, so whole texts are always seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_WBASE = 0xD1B54A32D192ED03 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit values, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_BASE))


_BYTE = stream(11, 256)


class _Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_bytes, _words = _Powers(_BASE), _Powers(_WBASE)


def byte_class(separators: bytes, lower: bool = True) -> np.ndarray:
    """A table byte -> 0 for separators, else the byte itself (A-Z as a-z).  A zero byte that is no separator becomes 255, which UTF-8 never uses."""
    table = np.arange(256, dtype=np.uint8)
    table[0] = 255
    if lower:
        table[65:91] += 32
    table[np.frombuffer(separators, dtype=np.uint8)] = 0
    return table


#: Separators of the two word patterns in use; A-Z are lower-cased before the second one is applied.
SPACE_WORDS = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
ALNUM_WORDS = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets (from 0) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n, (_, offsets, data) = len(column), column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of rows with at most `limit` bytes, or one row."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """The words of some texts: byte range, text and 64-bit hash of each."""

    __slots__ = ("end", "first", "hash", "mapped", "row", "start")

    def __init__(self, raw: np.ndarray, offs: np.ndarray, table: np.ndarray, cut: np.ndarray | None = None, hashes: bool = True):
        """cut: more places where a word ends and the next begins, as a mask over bytes."""
        n = len(raw)
        self.mapped = m = table[raw]
        word = m != 0
        breaks = np.zeros(n + 1, dtype=bool)
        breaks[offs] = True
        if cut is not None:
            breaks[:n] |= cut
        begin = word.copy()
        begin[1:] &= ~word[:-1] | breaks[1:n]
        stop = word.copy()
        stop[:-1] &= ~word[1:] | breaks[1:n]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.row = np.searchsorted(offs, self.start, "right") - 1
        #: first[i]: the number of words before text i
        self.first = np.searchsorted(self.start, offs, "left")
        if hashes and n:
            up, down = _bytes.get(n)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE[m] * up, out=total[1:])
            self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.zeros(len(self.start), dtype=np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The word positions at which a window of `size` words of one text starts, and the windows' hashes."""
        n = len(self.start)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[: n - size + 1] == self.row[size - 1 :])
        up, down = _words.get(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hash * up[:n], out=total[1:])
        return at, mix((total[at + size] - total[at]) * down[at] + np.uint64(size))

    def text(self, lo: int, hi: int) -> bytes:
        """The words lo to hi - 1 as they compare, with one space between."""
        return b" ".join(self.mapped[self.start[i] : self.end[i]].tobytes() for i in range(lo, hi))


def shingle_sets(words: Words, n_rows: int, size: int):
    """For each text its sorted distinct shingle hashes; fewer words than `size` count as one shingle, none as an empty set."""
    at, hashes = words.windows(size)
    cuts = np.searchsorted(at, words.first)
    empty = np.zeros(0, np.uint64)
    for i in range(n_rows):
        k = words.first[i + 1] - words.first[i]
        if k == 0:
            yield empty
        elif k < size:
            few = words.hash[words.first[i] : words.first[i + 1]]
            up, _ = _words.get(size + 1)
            yield mix(np.array([(few * up[:k]).sum(dtype=np.uint64) + np.uint64(k)], dtype=np.uint64))
        else:
            own = np.sort(hashes[cuts[i] : cuts[i + 1]])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class WordCache:
    """Values of distinct words, filled once per worker and word; emptied when it holds `limit` words."""

    def __init__(self, limit: int = 1_000_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.index, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def lookup(self, words: Words, raw: np.ndarray, fill, on_clear) -> np.ndarray:
        """For every word the number of its value.  fill(list of bytes) must add one value for each, in order; on_clear() must forget all."""
        keys, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if self.size + len(keys) > self.limit:
            self.clear()
            on_clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        number = np.empty(len(keys), np.int64)
        number[known] = self.index[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            fill([raw[words.start[i] : words.end[i]].tobytes() for i in first[new]])
            number[new] = np.arange(self.size, self.size + len(new))
            self.size += len(new)
            merged = np.concatenate((self.keys, keys[new]))
            order = np.argsort(merged, kind="stable")
            self.keys, self.index = merged[order], np.concatenate((self.index, number[new]))[order]
        return number[inverse]
