"""Windows that occur more than once, found through anchors.

Every window of ``window`` units (bytes or words) names as its anchor the leftmost smallest
hash among its grams of ``gram`` units. The choice depends on the window's content alone, so
equal windows have equal anchors. Consecutive windows with one anchor form a *cell*: a start, a
number of windows, the anchor's hash (``key``) and a hash of the content they span (``ch``).
There is about one cell to every ``(window - gram + 2) / 2`` units, and each window is in
exactly one of them.

A count-min sketch bounds how often each key occurs: the sketches of all partitions are added
up cell by cell, estimates are never too low, so a window whose key is estimated to occur once
occurs once. Only the cells whose key may repeat travel on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm import blocks as B

_SEGMENT_BITS = 16
_FLUSH = 1 << 22
_SEEDS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


@dataclass(frozen=True)
class Shape:
    """What a window is: ``units`` is "bytes" or "words"."""

    units: str
    window: int
    gram: int

    def per_cell(self) -> float:
        return (self.window - self.gram + 2) / 2


def units_of(shape: Shape, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit hashes of a block, and the documents' offsets in units."""
    if shape.units == "bytes":
        return B.byte_units(data), offsets
    start, end, counts = B.words(data, offsets)
    return B.word_units(data, start, end), counts


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row, from running minima to both sides."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    tiles = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cells(shape: Shape, units: np.ndarray, offsets: np.ndarray, with_content: bool = True):
    """(document, start in the document, windows, key, ch) of each cell of a block."""
    width = shape.window - shape.gram + 1
    none = np.zeros(0, np.int64)
    if len(units) < shape.window:
        return none, none, none, none, none
    rolling = B.RollingHash(units)
    grams = rolling.grams(shape.gram)
    # The low bits hold the place: ties go to the leftmost, and the place comes with the minimum.
    bits = max(1, int(len(grams)).bit_length())
    low = np.uint64((1 << bits) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_window_minimum(packed, width) & low).astype(np.int64)
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    starts = np.flatnonzero(np.arange(shape.window, shape.window + len(anchor)) <= offsets[doc_of + 1])
    if len(starts) == 0:
        return none, none, none, none, none
    anchor, doc = anchor[starts], doc_of[starts]
    new = np.empty(len(starts), bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    at, anchor, doc = starts[first], anchor[first], doc[first]
    key = B.signed(grams[anchor])
    ch = none
    if with_content:
        whole = rolling.ranges(at, at + count + shape.window - 1)
        ch = B.signed(B.mix(whole + (anchor - at).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    return doc, at - offsets[doc], count, key, ch


def _rows_of_sketch(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each key in each row of the sketch, rows one after the other."""
    shift = np.uint64(64 - bits)
    return [(B.mix(keys.view(np.uint64) ^ s) >> shift).astype(np.int64) + (i << bits) for i, s in enumerate(_SEEDS)]


def _sparse_sketch(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Non-empty cells by segment: places seen once, and places seen more often."""
    if not found:
        return
    places, counts = np.unique(np.concatenate(found), return_counts=True)
    segment = places >> _SEGMENT_BITS
    inside = (places & ((1 << _SEGMENT_BITS) - 1)).astype(np.uint16)
    edges = np.flatnonzero(np.diff(segment, prepend=-1))
    parts = np.append(edges, len(places))
    many = counts > 1
    out = [], [], []
    for a, b in zip(parts[:-1], parts[1:]):
        out[0].append(int(segment[a]))
        out[1].append(inside[a:b][~many[a:b]].tobytes())
        out[2].append(inside[a:b][many[a:b]].tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
        names=["segment", "once", "more"],
    )


def _merge_segments(batches: Iterator[pa.RecordBatch], least: int = 2) -> Iterator[pa.RecordBatch]:
    """Add sketches up, saturating at two; give one bit per cell: counted ``least`` times or more."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
            total = sums.get(segment)
            if total is None:
                total = sums[segment] = np.zeros(1 << _SEGMENT_BITS, np.uint8)
            total[np.frombuffer(more, np.uint16)] = 2
            one = np.frombuffer(once, np.uint16)
            total[one] = np.minimum(total[one] + 1, 2)
    ids = list(sums)
    flags = [np.packbits(sums[i] >= least).tobytes() for i in ids]
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(flags, pa.binary())], names=["segment", "flags"])


class Repeated:
    """Which keys may occur twice: a merged count-min sketch, cut down to one bit per cell."""

    def __init__(self, bits: int, flags: np.ndarray):
        self.bits, self.flags = bits, flags

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        yes = np.ones(len(keys), bool)
        for cell in _rows_of_sketch(keys, self.bits):
            yes &= (self.flags[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
        return yes


def sketch_bits(docs: DataFrame, shape: Shape, text: str, most: int) -> int:
    """Cells for about a third of the load: twice to four times the number of keys, at most 2**most."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    expected = size / (1 if shape.units == "bytes" else 6) / shape.per_cell()
    return int(min(most, max(_SEGMENT_BITS, np.ceil(np.log2(2 * expected + 1)))))


def repeated_keys(docs: DataFrame, shape: Shape, text: str = "text", most_bits: int = 27) -> Repeated:
    """The merged sketch of all keys of ``docs``.

    ``most_bits`` bounds what is broadcast: two rows of 2**27 bits are 32 MiB. Beyond the load
    it is meant for, the sketch lets more keys pass and loses none.
    """
    bits = sketch_bits(docs, shape, text, most_bits)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for _, _, data, offsets in B.blocks(batch.column(0)):
                units, at = units_of(shape, data, offsets)
                keys = cells(shape, units, at, with_content=False)[3]
                found += _rows_of_sketch(keys, bits)
                held += 2 * len(keys)
                if held >= _FLUSH:
                    yield from _sparse_sketch(found)
                    found, held = [], 0
        yield from _sparse_sketch(found)

    parts = docs.select(F.col(text)).mapInArrow(sketch, "segment long, once binary, more binary")
    return _merged(parts, bits, 2)


def _merged(parts: DataFrame, bits: int, least: int) -> Repeated:
    merged = parts.repartition("segment").mapInArrow(lambda it: _merge_segments(it, least), "segment long, flags binary")
    flags = np.zeros(2 << (bits - 3), np.uint8)
    size = 1 << (_SEGMENT_BITS - 3)
    for row in merged.toLocalIterator():
        flags[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.flags, np.uint8)
    return Repeated(bits, flags)


def members(hashes: DataFrame, bits: int) -> Repeated:
    """A Bloom filter of a column of hashes, of ``2 * 2**bits`` bits: says no only where that is so."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _sparse_sketch(_rows_of_sketch(batch.column(0).to_numpy(), bits))

    return _merged(hashes.mapInArrow(sketch, "segment long, once binary, more binary"), bits, 1)


def marked(rows: DataFrame, column: str, known: Repeated, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: whether the filter may hold the value of ``column``."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(name, pa.array(shared.value(B.column(batch, column).to_numpy())))

    return rows.mapInArrow(mark, T.StructType([*rows.schema.fields, T.StructField(name, T.BooleanType())]))


def candidate_cells(docs: DataFrame, shape: Shape, repeated: Repeated, text: str = "text") -> DataFrame:
    """The cells of ``docs`` (doc_id, h, text) whose key may repeat: key, ch, doc_id, h, s0, n."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, hashes = B.column(batch, "doc_id"), B.column(batch, "h")
            for first, _, data, offsets in B.blocks(B.column(batch, text)):
                units, at = units_of(shape, data, offsets)
                doc, start, count, key, ch = cells(shape, units, at)
                keep = np.flatnonzero(known(key)) if len(key) else np.zeros(0, np.int64)
                rows = pa.array(doc[keep] + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep]), pa.array(ch[keep]), ids.take(rows), hashes.take(rows), pa.array(start[keep]), pa.array(count[keep].astype(np.int32))],
                    names=["key", "ch", "doc_id", "h", "s0", "n"],
                )

    schema = "key long, ch long, doc_id long, h long, s0 long, n int"
    return docs.select("doc_id", "h", text).mapInArrow(emit, schema)
