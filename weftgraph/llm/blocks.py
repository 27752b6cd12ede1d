"""Texts of an Arrow batch as numpy bytes, and hashes over them.

Helpers for the Arrow stages: a batch of texts is cut into blocks of whole documents, so that
the working arrays stay small whatever Spark puts into one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array, and len + 1 offsets into them; null is empty."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about ``limit`` bytes.

    Every row is in exactly one block; a longer text is a block of its own.
    """
    data, offsets = text_bytes(texts)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the hash base (or of its inverse) modulo 2**64."""
    base = _BASE_INVERSE if inverse else _BASE
    known = _powers.get(int(inverse))
    if known is None or len(known) < n:
        known = np.full(max(n, BLOCK_BYTES + 2), base, np.uint64)
        known[0] = 1
        known = _powers[int(inverse)] = np.multiply.accumulate(known)
    return known[:n]


class RollingHash:
    """Polynomial hashes of any range of a sequence of 64-bit unit hashes."""

    def __init__(self, units: np.ndarray):
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * powers(len(units)), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of units[start:end], the same wherever that range lies."""
        if len(start) == 0:
            return np.zeros(0, np.uint64)
        back = powers(len(self.sums), inverse=True)
        return mix((self.sums[end] - self.sums[start]) * back[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """The hash of every k units in a row."""
        n = len(self.sums) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * powers(n, inverse=True) + np.uint64(k))


_is_space = np.zeros(256, bool)
_is_space[[0x20, 9, 10, 11, 12, 13]] = True
_byte_units = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_units(data: np.ndarray) -> np.ndarray:
    return _byte_units[data]


def in_words(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to words."""
    return ~_is_space[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word in the bytes, and len + 1 offsets of the documents in words.

    A word is ``[^\\x20\\x09-\\x0D]+``; these bytes never occur inside a longer UTF-8 character.
    """
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_is_space[data], out=inside[1:-1])
    # A document's first byte starts a word even if the one before it ends without a space.
    step = np.flatnonzero(inside[1:] & ~inside[:-1])
    stop = np.flatnonzero(~inside[1:] & inside[:-1])
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    start = np.sort(np.concatenate([step, cuts]))
    end = np.sort(np.concatenate([stop, cuts]))
    return start, end, np.searchsorted(start, offsets)


def word_units(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return RollingHash(byte_units(data)).ranges(start, end)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
