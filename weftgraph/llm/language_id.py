"""Language identification by partial matching over bytes.

Each language has a tree of byte contexts up to ``order`` long, with counts of the bytes that
follow. A byte costs -log2 of its share among the followers of the longest known context; if it
never followed there, the context's escape is paid and the next shorter context is asked
(escape method C: of n followers, d of them distinct, a byte seen c times has c / (n + d), the
escape d / (n + d)); below the empty context all bytes are alike. The statistics are frozen, so a
text's code length is a sum over places of a function of the last ``order + 1`` bytes. That
function is tabulated for all languages at once and looked up with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm import blocks as B
from weftgraph.llm.sampling import spread
from weftgraph.session import cut_lineage

UNKNOWN = "und"
_MARK = 0x0A  # stands before each text, so that its first bytes have a context too


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: texts in all, bytes of each, drawn in pieces from all of a longer
    text; contexts met less often than ``least`` are left out beyond order 2."""

    texts: int = 6000
    text_bytes: int = 16384
    piece_bytes: int = 1024
    order: int = 4
    least: int = 2


def _keys(data: np.ndarray, length: int) -> np.ndarray:
    """The last ``length`` bytes up to each place as one number; a leading one tells lengths apart."""
    out = np.ones(len(data) - length + 1, np.int64)
    for k in range(length):
        out = out << 8 | data[k : k + len(out)]
    return out


class _Table:
    """Rows of per-language values by key, found through a bucket per hash prefix."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        spot = self._hash(keys)
        order = np.argsort(spot, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.start = np.searchsorted(spot[order] >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.start).max(initial=0))

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        return keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if len(self.keys) == 0:
            return out
        bucket = (self._hash(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        open_ = np.flatnonzero(at < end)
        for step in range(self.deepest):
            place = at[open_] + step
            hit = self.keys[place] == keys[open_]
            out[open_[hit]] = place[hit]
            open_ = open_[~hit & (place + 1 < end[open_])]
            if len(open_) == 0:
                break
        return out


@dataclass
class Model:
    """Languages, and per order the code lengths of known (context, byte) pairs and the escapes."""

    languages: list[str]
    order: int
    costs: list[_Table]
    escapes: list[_Table]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text of a block under each language."""
        texts = len(offsets) - 1
        padded_at = offsets[:-1] + self.order * np.arange(1, texts + 1)
        padded = np.full(len(data) + self.order * texts, _MARK, np.uint8)
        owner = np.repeat(np.arange(texts), np.diff(offsets))
        place = np.arange(len(data)) + self.order * (owner + 1)
        padded[place] = data
        first = place - self.order
        total = np.zeros((len(data), len(self.languages)), np.float32)
        open_ = np.arange(len(data))
        for k in range(self.order, -1, -1):
            if len(open_) == 0:
                break
            key = _keys(padded, k + 1)[first[open_] + self.order - k]
            row = self.costs[k].rows(key)
            hit = row >= 0
            total[open_[hit]] += self.costs[k].values[row[hit]]
            open_, key = open_[~hit], key[~hit]
            row = self.escapes[k].rows(key >> 8)
            known = row >= 0
            total[open_[known]] += self.escapes[k].values[row[known]]
        total[open_] += 8
        sums = np.zeros((texts, len(self.languages)))
        some = np.flatnonzero(np.diff(offsets) > 0)
        if len(some):
            sums[some] = np.add.reduceat(total, offsets[some], axis=0, dtype=np.float64)
        return sums


def _build(languages: list[str], order: int, language: np.ndarray, length: np.ndarray, key: np.ndarray, count: np.ndarray) -> Model:
    """Tabulate escapes and code lengths from the counts of (language, context and byte)."""
    costs, escapes, shorter = [], [], None
    for k in range(order + 1):
        part = length == k + 1
        lang, grams, seen = language[part], key[part], count[part].astype(np.float64)
        gram, gram_row = np.unique(grams, return_inverse=True)
        context, context_row = np.unique(grams >> 8, return_inverse=True)
        followers = np.zeros((len(context), len(languages)))
        distinct = np.zeros((len(context), len(languages)))
        np.add.at(followers, (context_row, lang), seen)
        np.add.at(distinct, (context_row, lang), 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(distinct > 0, -np.log2(distinct / (followers + distinct)), 0.0)
        own = np.full((len(gram), len(languages)), np.nan)
        own[gram_row, lang] = -np.log2(seen / (followers + distinct)[context_row, lang])
        below = np.full((len(gram), len(languages)), 8.0)
        if shorter is not None:
            suffix = (gram & ((1 << (8 * k)) - 1)) | (1 << (8 * k))
            below = shorter.values[shorter.rows(suffix)].astype(np.float64)
        paid = escape[np.searchsorted(context, gram >> 8)] + below
        shorter = _Table(gram, np.where(np.isnan(own), paid, own).astype(np.float32))
        costs.append(shorter)
        escapes.append(_Table(context, escape.astype(np.float32)))
    return Model(languages, order, costs, escapes)


def fit(docs: DataFrame, sample: Sample = Sample(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from at most ``sample.texts`` texts (one of each language at least), as many of each
    language: those with the smallest hashes among its different texts, each taken once.

    Rows without a text or a language teach nothing. The counts are summed up in Spark; only the
    counts of the sample's contexts come to the driver.
    """
    frame = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    frame = frame.withColumn("h", F.xxhash64("text"))
    hashes = cut_lineage(frame.select("lang", "h").distinct())
    sizes = {r.lang: r["count"] for r in hashes.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return _build([UNKNOWN], sample.order, *(np.zeros(0, np.int64),) * 4)
    share = max(1, sample.texts // len(languages))
    least, most = -(1 << 63), (1 << 63) - 1

    def below(limits: dict[str, int]) -> Column:
        bounds = F.create_map(*[x for v, n in limits.items() for x in (F.lit(v), F.lit(n).cast("long"))])
        return F.col("h") <= F.element_at(bounds, F.col("lang"))

    # So low a bound that few hashes come to the driver, so high that a language's share is among them.
    rough = {v: most if (n := 4 * share + 64) >= sizes[v] else least + (n << 64) // sizes[v] for v in languages}
    smallest: dict[str, list[int]] = {v: [] for v in languages}
    for r in hashes.where(below(rough)).collect():
        smallest[r.lang].append(r.h)
    limits = {v: sorted(found)[:share][-1] for v, found in smallest.items()}
    drawn = frame.where(below(limits)).groupBy("lang", "h").agg(F.min(spread(F.encode("text", "UTF-8"), sample.text_bytes, sample.piece_bytes)).alias("text"))
    code = F.create_map(*[F.lit(x) for i, v in enumerate(languages) for x in (v, i)])
    drawn = drawn.select(F.element_at(code, F.col("lang")).alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_numpy()
            found: dict[tuple[int, int], list[np.ndarray]] = {}
            for lang, text in zip(langs.tolist(), batch.column(1).to_pylist()):
                data = np.frombuffer(bytes([_MARK]) * sample.order + text, np.uint8).astype(np.int64)
                for k in range(sample.order + 1):
                    found.setdefault((lang, k + 1), []).append(_keys(data, k + 1)[sample.order - k :])
            for (lang, length), parts in found.items():
                key, n = np.unique(np.concatenate(parts), return_counts=True)
                same = np.ones(len(key), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(same * lang), pa.array(same * length), pa.array(key), pa.array(n)], names=["lang", "length", "key", "n"])

    counts = drawn.mapInArrow(count, "lang int, length int, key long, n long").groupBy("lang", "length", "key").agg(F.sum("n").alias("n"))
    # A longer context is never met more often than its end, so the trees stay whole.
    table = counts.where((F.col("n") >= sample.least) | (F.col("length") <= 3)).toArrow()
    return _build(languages, sample.order, *(table[c].to_numpy().astype(np.int64) for c in ("lang", "length", "key", "n")))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` as (rest, lang_pred, score, bits): the language with the shortest code.

    ``rest`` is a struct of all other columns; ``score`` is the posterior of that language when all
    are as likely at first, ``bits`` the code length per byte under it. Texts without a letter (null
    and empty ones too) are ``und`` with score 0. Equal codes go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    text = F.col(f"`{text_col}`")
    frame = docs.select(F.struct(*others).alias("rest"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = pa.array([*known.languages, UNKNOWN])
        for batch in batches:
            lettered = B.column(batch, "lettered").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in B.blocks(B.column(batch, "text")):
                bits = known.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                has = lettered[first:last]
                best = np.where(has, best, len(known.languages))
                per_byte = np.where(has, least / np.maximum(np.diff(offsets), 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [B.column(batch, "rest").slice(first, last - first), names.take(pa.array(best)), pa.array(np.where(has, score, 0.0)), pa.array(per_byte)],
                    names=["rest", "lang_pred", "score", "bits"],
                )

    schema = [frame.schema["rest"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())]
    return frame.mapInArrow(emit, T.StructType(schema))
