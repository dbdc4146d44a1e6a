"""Words and their hashes for many texts at once, on the UTF-8 bytes of Arrow columns.

A block is some whole texts, as bytes with the offsets of each text. Words are
``[^\\x20\\x09-\\x0D]+``; only ASCII separates them, so bytes suffice. Hashes have
64 bits and are the same in every task and run. A block holds about
``BLOCK_BYTES``; a longer text is a block of its own and takes some 60 bytes of
memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it can be inverted
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        step = _BASE if kind == "up" else _BACK
        _powers[kind] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, step)]), dtype=np.uint64)
    return _powers[kind][:n]


class Block:
    """``data``: bytes; ``offsets``: start of each text and the end of the last."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1
        inside = ~_SPACE[data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            before[offsets[:-1][offsets[:-1] < len(data)]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: The first word of each text, and the number of all words.
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A hash of the bytes from each start to its end; A-Z count as a-z if ``lower``."""
        total = np.zeros(len(self.data) + 1, np.uint64)
        terms = (_BYTE_LOWER if lower else _BYTE)[self.data]
        terms *= _power("up", len(self.data) or 1)[: len(self.data)]
        np.cumsum(terms, out=total[1:])
        return mix((total[ends] - total[starts]) * _power("down", len(total))[starts] + (ends - starts).astype(np.uint64))

    def word_hash(self, lower: bool = False) -> np.ndarray:
        return self.span_hash(self.starts, self.ends, lower)

    def count(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbours, from the first to the last that has k."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _BASE
        out += hashes[j : j + n]
    return mix(out + np.uint64(k))


def shingles(block: Block, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, and where those of each text start.

    A text of fewer words has the whole sequence as its one shingle; one without
    words has none.
    """
    words, first = block.word_hash(lower), block.first
    n = block.n_words
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    at = np.zeros(block.n + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    # The place of each shingle's first word: places go on by one within a text.
    place = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], counts)
    every = windows(words, k)
    out = every[np.minimum(place, max(len(every) - 1, 0))] if len(every) else np.zeros(at[-1], np.uint64)
    for short in range(1, k):
        which = np.flatnonzero(n == short)
        if len(which):
            out[at[which]] = windows(words, short)[first[which]]
    return out, at


def arrow_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """Blocks of a text column (null: empty), each with the rows from which to which it goes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, Block(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def list_array(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """Row i holds the values from at[i] to at[i + 1]."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))


def binary_array(values: np.ndarray, at: np.ndarray) -> pa.BinaryArray:
    """Row i holds the bytes of the values from at[i] to at[i + 1]."""
    offsets = (at * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the values from each start to its end."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values) or 1)[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(total))[starts] + (ends - starts).astype(np.uint64))
