"""Quality by compression: which of two trained dictionaries makes a text smaller.

Two zstandard dictionaries are trained on good and on bad labelled texts. A text is compressed in
pieces with either one; the difference of both sizes over their sum, and how far the text shrinks
at all, become a score through a logistic curve fitted on labelled texts that no dictionary saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm import blocks as B
from weftgraph.llm.sampling import spread

PIECE_BYTES = 4096
#: Texts with a lower score are rejected.
ACCEPT = 0.3


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: texts of each label, bytes of each text, drawn in pieces from all of a
    longer one, dictionary size."""

    texts: int = 2000
    text_bytes: int = 16384
    dictionary_bytes: int = 65536


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


class _Scorer:
    def __init__(self, model: Model):
        level = zstd.ZstdCompressionParameters.from_level(3, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.weights = np.array(model.weights)
        self.sides = []
        for raw in (model.good, model.bad):
            known = zstd.ZstdCompressionDict(raw)
            known.precompute_compress(compression_params=level)
            self.sides.append(zstd.ZstdCompressor(dict_data=known, compression_params=level))

    def features(self, text: bytes) -> tuple[float, float]:
        """Difference of the compressed sizes over their sum, and size over the text's size."""
        size = [0, 0]
        for at in range(0, len(text), PIECE_BYTES):
            for k in (0, 1):
                size[k] += len(self.sides[k].compress(text[at : at + PIECE_BYTES]))
        total = size[0] + size[1]
        return ((size[1] - size[0]) / total, total / (2 * len(text))) if total else (0.0, 0.0)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_terms(features) @ self.weights, -30, 30)))


def _terms(features: np.ndarray) -> np.ndarray:
    d, r = features[:, 0] * 10, features[:, 1] * 4
    return np.stack([np.ones(len(d)), d, r, d * r, d * d, r * r], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a lightly shrunk logistic regression, by Newton steps, each halved until it gains.

    Without that, labels that the features tell apart well can drive the weights off to any size.
    """

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5e-2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step, now = np.linalg.solve(bend, slope), loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        w = w + step
    return w


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts' beginning where there is too little to train on."""
    pieces = [t[at : at + PIECE_BYTES] for t in texts for at in range(0, len(t), PIECE_BYTES)]
    try:
        return zstd.train_dictionary(size, pieces).as_bytes()
    except zstd.ZstdError:
        return (b"\n".join(pieces) or b"\n" * 8)[:size]


def fit(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from at most ``sample.texts`` labelled texts of each label, drawn by a hash of the id.

    Only the drawn ids are joined with the texts, so the join's small side has a proven size.
    Labels other than 0 and 1, labels without a text and empty texts teach nothing; an id counts once.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    drawn = None
    for value in (0, 1):
        part = own.where(F.col("_label") == value).orderBy(F.xxhash64("_id", F.lit(7)), "_id").limit(sample.texts)
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.encode(F.col(text_col), "UTF-8").alias("_text"))
    rows = (
        texts.join(F.broadcast(drawn), "_id")
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.min(spread(F.col("_text"), sample.text_bytes, PIECE_BYTES)).alias("_text"))
        .where(F.length("_text") > 0)
        .withColumn("_order", F.xxhash64("_id", F.lit(11)))
        .collect()
    )
    rows.sort(key=lambda r: (r._order, bytes(r._text), r._label))
    sides = [[bytes(r._text) for r in rows if r._label == v] for v in (1, 0)]
    raw = [_dictionary(s[::2], sample.dictionary_bytes) for s in sides]
    blank = _Scorer(Model(*raw, (0.0,) * 6))
    kept = [(t, y) for side, y in zip(sides, (1.0, 0.0)) for t in side[1::2]]
    if not kept:
        return Model(*raw, (0.0,) * 6)
    x = _terms(np.array([blank.features(t) for t, _ in kept]))
    return Model(*raw, tuple(_logistic(x, np.array([y for _, y in kept])).tolist()))


def scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` as (rest, text, score): the score is from 0 to 1, higher where label 1 is likelier.

    ``rest`` is a struct of all other columns. The whole text counts. Null and empty texts get the
    score of a text that neither dictionary favours. Equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    frame = docs.select(F.struct(*others).alias("rest"), F.col(f"`{text_col}`").alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            data, offsets = B.text_bytes(B.column(batch, "text"))
            whole = memoryview(data)
            found = [scorer.features(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            score = scorer.score(np.array(found).reshape(-1, 2))
            yield pa.RecordBatch.from_arrays([B.column(batch, "rest"), B.column(batch, "text"), pa.array(score)], names=["rest", "text", "score"])

    fields = [frame.schema["rest"], frame.schema["text"], T.StructField("score", T.DoubleType())]
    return frame.mapInArrow(emit, T.StructType(fields))
