"""Vectorised word work on Arrow text columns, shared by the operators.

A slice of documents is handled as one byte buffer. Words are maximal runs
of bytes outside ``[\\x20\\x09-\\x0D]``; they get 64-bit hashes from prefix
sums, so no Python object is made per word. Null texts count as empty.
Nulls, empty texts and texts of any length are allowed; a slice holds whole
documents of about ``SLICE_BYTES`` together (one longer text is a slice of
its own), so a task needs some tens of times that much memory.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = _U(0xD6E8FEB86659FD93)
_GRAM_INV = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept per worker."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1, min(2 * n, SLICE_BYTES + 1))
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def forget_powers() -> None:
    """Free the powers that are kept; they are made again when needed."""
    _powers.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads the bits of a 64-bit hash."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def span_hash(prefix: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [starts, ends) from prefix sums of weighted values."""
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after another, and len + 1 offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if large else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch into runs of whole documents of about ``limit`` bytes."""
    if batch.num_rows == 0:
        return
    _, offsets = text_buffer(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


@dataclass
class Words:
    """Words of a slice of documents. ``first[d]:first[d + 1]`` are the words
    of document d; ``start`` and ``end`` are byte positions in ``raw``."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, col, lower: bool = False) -> "Words":
        raw, offsets = text_buffer(col)
        if lower:
            raw = _LOWER[raw]
        inside = ~IS_SPACE[raw]
        n = len(raw)
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < n]
        before[cuts] = False
        start = np.flatnonzero(inside & ~before)
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        end = np.flatnonzero(inside & ~after) + 1
        return cls(raw, offsets, start, end, np.searchsorted(start, offsets))

    @cached_property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @cached_property
    def byte_prefix(self) -> np.ndarray:
        out = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[self.raw] * powers(_BASE, len(self.raw)), out=out[1:])
        return out

    def bytes_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hash(self.byte_prefix, powers(_BASE_INV, len(self.raw) + 1), starts, ends)

    @cached_property
    def hash(self) -> np.ndarray:
        return self.bytes_hash(self.start, self.end)

    @cached_property
    def word_prefix(self) -> np.ndarray:
        out = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * powers(_GRAM, len(self.hash)), out=out[1:])
        return out

    def sequence_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences [starts, ends)."""
        return span_hash(self.word_prefix, powers(_GRAM_INV, len(self.hash) + 1), starts, ends)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all n-word windows inside one document, their hashes."""
        at = np.arange(len(self.start))
        at = at[at + n <= self.first[1:][self.doc]]
        return at, self.sequence_hash(at, at + n)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n words some window [start, start + length) covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:-1]) > 0


def as_signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
