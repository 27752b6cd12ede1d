"""Phrases whose words keep company, from a weighted de Bruijn graph.

1. Texts are cut into pieces and words. Nodes are phrases of ``longest - 1`` words, and an edge joins
   two that overlap in all but one: it is a phrase of ``longest`` words, its weight their count.
   Each word of a piece starts one edge, or near the piece's end a shorter rest.
2. A count-min sketch of words and word pairs (sums over all partitions, estimates never too low)
   tells which of them surely occur less than ``least`` times; a second one those triples of maybe
   frequent pairs that do. No phrase that counts holds any of them, so an edge stops before it, as
   at the end of a piece.
3. Equal edges are added up. How often a shorter phrase occurs is what flows through it: the
   weights of the edges that begin with it, and of the rests that do, the piece-end corrections.
4. Where all of a phrase's flow goes on by one word, to the right or to the left, the path through
   it has no branch: it is compacted into the longer phrase, and only unbranched-over ones are scored.
5. A phrase's cuts are looked up among the counted phrases, which are all at least as frequent.

A sketch has a fixed size (two rows of 2**``bits`` cells, one bit each where it is broadcast). A
fuller one lets more edges pass, and loses none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm import blocks as B
from weftgraph.session import cut_lineage

_SEGMENT = 1 << 16
_FLUSH = 1 << 22
_LIMIT = 1 << 20
_SEEDS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS_PIECE = np.isin(np.arange(256), list(b".,;:!?\x0a\x0b\x0c\x0d"))
_NO_WORD = _ENDS_PIECE | np.isin(np.arange(256), list(b"\x20\x09"))


@dataclass(frozen=True)
class Phrases:
    """Parameters: phrases of 2 to ``longest`` words that occur ``least`` times, ``top`` of each group."""

    longest: int = 5
    least: int = 100
    top: int = 2000
    scale: int = 1000
    bits: int = 26


def stretches(text: np.ndarray, longest: int, limit: int = _LIMIT) -> Iterator[tuple[np.ndarray, int]]:
    """(bytes, how many of them are its own) of a text: at most about ``limit`` of its own, whole words,
    followed by the ``longest - 1`` words after them, in which no phrase begins."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and not _NO_WORD[text[end]]:
            end += 1
        seen, look = 0, end
        while look < len(text) and seen < longest - 1 and not _ENDS_PIECE[text[look]]:
            seen += bool(not _NO_WORD[text[look]] and (look + 1 == len(text) or _NO_WORD[text[look + 1]]))
            look += 1
        yield text[at:look], end - at
        at = end
    yield text[at:], len(text) - at


@dataclass
class _Words:
    """The words of a block: place, hash, how many follow in the piece (itself included, ``longest``
    at most), the text they come from, and whether phrases begin there."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    unit: np.ndarray
    run: np.ndarray
    text: np.ndarray
    own: np.ndarray


def _words(data: np.ndarray, offsets: np.ndarray, own: np.ndarray, salt: np.ndarray, longest: int) -> _Words:
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_NO_WORD[data]
    start = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    # Texts are put together with a line end between two, so no word and no piece goes over.
    piece = np.searchsorted(np.flatnonzero(_ENDS_PIECE[data]), start)
    last = np.searchsorted(piece, piece, side="right")
    run = np.minimum(last - np.arange(len(start)), longest)
    unit = B.mix(B.word_units(data, start, end) + salt[text])
    return _Words(data, start, end, unit, run, text, start - offsets[text] < own[text])


def _blocks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[list, _Words]]:
    """Words of about ``_LIMIT`` bytes of text each, and the groups of their texts."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        groups = B.column(batch, "grp").to_pylist()
        data, offsets = B.text_bytes(B.column(batch, "text"))
        for row, group in enumerate(groups):
            for part, own in stretches(data[offsets[row] : offsets[row + 1]], longest):
                held.append((group, part, own))
                size += len(part)
                if size >= _LIMIT:
                    yield _block(held, longest)
                    held, size = [], 0
    if held:
        yield _block(held, longest)


def _block(held: list[tuple], longest: int) -> tuple[list, _Words]:
    gap = np.array([10], np.uint8)
    data = np.concatenate([x for _, part, _ in held for x in (part, gap)])
    offsets = np.append(0, np.cumsum([len(part) + 1 for _, part, _ in held]))[:-1]
    own = np.array([o for _, _, o in held])
    groups = [g for g, _, _ in held]
    names = {g: np.frombuffer(g.encode(), np.uint8) for g in set(groups)}
    hashed = {g: int(B.word_units(n, np.array([0]), np.array([len(n)]))[0]) for g, n in names.items()}
    # Mixed once more, so that a word that reads like a group's name is no special case.
    salt = B.mix(np.array([hashed[g] for g in groups], np.uint64) ^ _SEEDS[0])
    return groups, _words(data, offsets, own, salt, longest)


def _later(values: np.ndarray, by: int) -> np.ndarray:
    """What lies ``by`` words on; nothing beyond the last."""
    return np.append(values[by:], np.zeros(min(by, len(values)), values.dtype))


def _chain(words: _Words, length: int) -> np.ndarray:
    """A hash of each ``length`` words in a row; it means nothing where the piece ends before."""
    unit = words.unit
    for k in range(1, length):
        unit = B.mix(unit * np.uint64(0xD6E8FEB86659FD93) + _later(words.unit, k))
    return unit


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each key in each row of the sketch, rows one after the other."""
    return [(B.mix(keys ^ seed) >> np.uint64(64 - bits)).astype(np.int64) + (i << bits) for i, seed in enumerate(_SEEDS)]


def _counter(least: int):
    return np.uint8 if least < 256 else np.uint32


def _sketched(found: list[np.ndarray], least: int) -> Iterator[pa.RecordBatch]:
    """Counts of the cells met, up to ``least``, by segment of the sketch."""
    places, counts = np.unique(np.concatenate(found), return_counts=True)
    edges = np.append(np.flatnonzero(np.diff(places >> 16, prepend=-1)), len(places))
    inside = (places & (_SEGMENT - 1)).astype(np.uint16)
    counts = np.minimum(counts, least).astype(_counter(least))
    for at in range(0, len(edges) - 1, 1024):
        part = list(zip(edges[at : at + 1024], edges[at + 1 : at + 1025]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(places[a] >> 16) for a, _ in part], pa.int64()),
                pa.array([inside[a:b].tobytes() for a, b in part], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in part], pa.binary()),
            ],
            names=["segment", "cells", "counts"],
        )


def _added(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """One bit per cell of each segment: whether its sum reaches ``least``; rows come sorted by segment."""
    now, total = None, np.zeros(_SEGMENT, np.int64)
    for batch in batches:
        out = []
        for segment, cells, counts in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if segment != now:
                if now is not None and (total >= least).any():
                    out.append((now, np.packbits(total >= least).tobytes()))
                now, total = segment, np.zeros(_SEGMENT, np.int64)
            total[np.frombuffer(cells, np.uint16)] += np.frombuffer(counts, _counter(least))
        yield _flags(out)
    if now is not None and (total >= least).any():
        yield _flags([(now, np.packbits(total >= least).tobytes())])


def _flags(out: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int64()), pa.array([f for _, f in out], pa.binary())], names=["segment", "flags"])


class Sketch:
    """One bit for each cell of an added-up sketch: whether it counts ``least`` or more."""

    def __init__(self, bits: int, flags: np.ndarray):
        self.bits, self.flags = bits, flags

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        yes = np.ones(len(keys), bool)
        for cell in _cells(keys, self.bits):
            yes &= (self.flags[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
        return yes


@dataclass(frozen=True)
class Frequent:
    """Which words, pairs and triples may be frequent."""

    pairs: Sketch
    triples: Sketch | None = None

    def of_two(self, words: _Words) -> np.ndarray:
        return self.pairs(_chain(words, 2)) & (words.run > 1)

    def of_three(self, words: _Words) -> np.ndarray:
        """Triples in a piece both of whose pairs may be frequent, and they themselves if that is known."""
        pair = self.of_two(words)
        both = pair & _later(pair, 1)
        return both if self.triples is None else both & self.triples(_chain(words, 3))

    def reach(self, words: _Words, longest: int) -> np.ndarray:
        """How many words the longest phrase from each word on has; 0 where the word is rare."""
        going = self.pairs(words.unit)
        length = going.astype(np.int64)
        going &= self.of_two(words)
        length += going
        triple = self.of_three(words)
        for step in range(longest - 2):
            going &= _later(triple, step)
            length += going
        return length


def _sketch(texts: DataFrame, phrases: Phrases, keys_of) -> Sketch:
    """The added-up sketch of the keys that ``keys_of`` gives for each block of words."""
    bits, least, longest = phrases.bits, phrases.least, phrases.longest

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for _, words in _blocks(batches, longest):
            keys = keys_of(words)
            found += _cells(keys, bits)
            held += 2 * len(keys)
            if held >= _FLUSH:
                yield from _sketched(found, least)
                found, held = [], 0
        if held:
            yield from _sketched(found, least)

    parts = texts.mapInArrow(sketch, "segment long, cells binary, counts binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(lambda it: _added(it, least), "segment long, flags binary")
    flags = np.zeros((2 << bits) // 8, np.uint8)
    for row in merged.toLocalIterator():
        flags[row.segment * _SEGMENT // 8 : (row.segment + 1) * _SEGMENT // 8] = np.frombuffer(row.flags, np.uint8)
    return Sketch(bits, flags)


def frequent(texts: DataFrame, phrases: Phrases) -> Frequent:
    """The sketches of words and pairs, and of triples, of ``texts`` (grp, text)."""

    def singles_and_pairs(words: _Words) -> np.ndarray:
        return np.concatenate([words.unit[words.own], _chain(words, 2)[words.own & (words.run > 1)]])

    known = Frequent(_sketch(texts, phrases, singles_and_pairs))
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def triples(words: _Words) -> np.ndarray:
        return _chain(words, 3)[words.own & shared.value.of_three(words)]

    return Frequent(known.pairs, _sketch(texts, phrases, triples))


def _joined(words: _Words, first: np.ndarray, length: np.ndarray) -> pa.Array:
    """The phrases of ``length`` words from ``first`` on, one space between two words."""
    step = lambda n: np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    word = np.repeat(first, length) + step(length)
    size = words.end[word] - words.start[word]
    at = np.append(0, np.cumsum(size + 1))
    out = np.full(at[-1], 0x20, np.uint8)
    inner = step(size)
    out[np.repeat(at[:-1], size) + inner] = words.data[np.repeat(words.start[word], size) + inner]
    ends = at[np.append(0, np.cumsum(length))]
    # Each phrase is followed by one space, which is left out.
    keep = np.ones(len(out), bool)
    keep[ends[1:] - 1] = False
    offsets = (ends - np.arange(len(ends))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out[keep])])


def edges(texts: DataFrame, phrases: Phrases, known: Frequent) -> DataFrame:
    """(grp, phrase, k, weight): the longest phrase from each word that may be frequent, added up, and
    for each group one row without a phrase whose weight is its number of words."""
    longest = phrases.longest
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, words in _blocks(batches, longest):
            names, group = np.unique(np.array(groups, object).astype(str), return_inverse=True)
            total = np.bincount(group[words.text[words.own]], minlength=len(names))
            length = shared.value.reach(words, longest)
            first = np.flatnonzero((length > 0) & words.own)
            length, unit = length[first], words.unit
            key = unit[first]
            for k in range(1, longest):
                more = length > k
                key[more] = B.mix(key[more] * np.uint64(0x9E3779B97F4A7C15) + unit[first[more] + k])
            key = B.mix(key + length.astype(np.uint64))
            _, at, weight = np.unique(key, return_index=True, return_counts=True)
            some = np.concatenate([group[words.text[first[at]]], np.arange(len(names))])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(names), pa.string()).take(pa.array(some)),
                    pa.concat_arrays([_joined(words, first[at], length[at]), pa.nulls(len(names), pa.string())]),
                    pa.array(np.append(length[at], np.zeros(len(names), np.int64)).astype(np.int32)),
                    pa.array(np.append(weight, total).astype(np.int64)),
                ],
                names=["grp", "phrase", "k", "weight"],
            )

    found = texts.mapInArrow(emit, "grp string, phrase string, k int, weight long")
    return found.groupBy("grp", "phrase", "k").agg(F.sum("weight").alias("weight"))


def counted(weights: DataFrame, phrases: Phrases) -> DataFrame:
    """(grp, phrase, k, f) of every phrase that occurs ``least`` times: the flow of the edges through it."""
    heads = F.expr("transform(sequence(1, k), i -> struct(i AS k, substring_index(phrase, ' ', i) AS phrase))")
    flow = weights.where("k > 0").select("grp", "weight", F.explode(heads).alias("head"))
    flow = flow.groupBy("grp", F.col("head.phrase").alias("phrase"), F.col("head.k").alias("k")).agg(F.sum("weight").alias("f"))
    return flow.where(F.col("f") >= phrases.least)


def unbranched(flow: DataFrame) -> DataFrame:
    """The phrases of two words or more through which the graph branches on both sides.

    A phrase all of whose occurrences go on with one word, or come from one, is compacted away: some
    phrase one word longer has its count.
    """
    parts = F.expr("explode(array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k)))")
    most = flow.where("k > 2").select("grp", "f", parts.alias("phrase")).groupBy("grp", "phrase").agg(F.max("f").alias("on"))
    found = flow.where("k > 1").join(most, ["grp", "phrase"], "left")
    return found.where(F.col("on").isNull() | (F.col("on") < F.col("f"))).drop("on")


def scored_phrases(weights: DataFrame, phrases: Phrases) -> DataFrame:
    """(grp, rank, phrase, k, a, l, r, n, score) from ``edges``."""
    n = weights.where("k = 0").select("grp", F.col("weight").alias("n"))
    flow = cut_lineage(counted(weights, phrases))
    cuts = unbranched(flow).select("grp", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    known = flow.where(F.col("k") < phrases.longest)
    cuts = cuts.join(known.select("grp", F.col("phrase").alias("left"), F.col("f").alias("l")), ["grp", "left"])
    cuts = cuts.join(known.select("grp", F.col("phrase").alias("right"), F.col("f").alias("r")), ["grp", "right"]).join(n, "grp")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumns({"above": exact("a") * exact("n") * F.lit(phrases.scale).cast("decimal(10,0)"), "below": exact("l") * exact("r")})
    scored = scored.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("grp", "phrase", "k", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    best = best.select("grp", "phrase", "k", "a", "n", "best.l", "best.r", "best.score")
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= phrases.top)


def collocations(docs: DataFrame, phrases: Phrases = Phrases(), text_col: str = "text", group_col: str = "lang", unknown: str = "und") -> DataFrame:
    """The best phrases of each group: the group column's name, rank, phrase, k, a, l, r, n, score.

    A-Z are lowered; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+`` in them. ``a`` counts a
    phrase's occurrences, overlapping ones too, ``n`` all words of the group. Cut after its first k words
    into parts that occur ``l`` and ``r`` times, a phrase scores floor(scale * a * n / (l * r)); its lowest cut
    counts, the first of equals. Phrases contained in a longer one as frequent are left out. Best first:
    by score, then a, both falling, then the phrase's bytes. A null group is ``unknown``; null and empty
    texts, and groups without frequent phrases, give nothing; equal rows count each; other columns are
    not read. Arithmetic is exact in 38 digits, for groups of up to 10**17 words. Counts are exact up to hashes of 64 bits, compared inside one block of about a megabyte only.
    """
    texts = docs.select(F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit(unknown)).alias("grp"), F.col(f"`{text_col}`").alias("text"))
    weights = cut_lineage(edges(texts, phrases, frequent(texts, phrases)))
    ranked = scored_phrases(weights, phrases)
    long = [F.col(c).cast("long") for c in ("k", "a", "l", "r", "n", "score")]
    return ranked.select(F.col("grp").alias(group_col), F.col("rank").cast("long").alias("rank"), "phrase", *long)
