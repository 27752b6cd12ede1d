"""Documents with their removed stretches: the end of both window deduplications."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm import blocks as B


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, text, rest): ``h`` tells texts of one id apart, ``rest`` carries all other columns.

    Inside a struct the caller's columns can have any names.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("h"),
        F.col(f"`{text_col}`").alias("text"),
        F.struct(*others).alias("rest"),
    )


def with_lists(docs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """``docs`` with the rows of each document as an array of structs, null where there are none.

    The array is bounded by the document: equal rows, as repeated rows of a table give them, count once.
    """
    fields = [c for c in rows.columns if c not in ("doc_id", "h")]
    lists = rows.groupBy("doc_id", "h").agg(F.collect_set(F.struct(*fields)).alias(name))
    lists = lists.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    return docs.join(lists, docs.doc_id.eqNullSafe(F.col("_id")) & (docs.h == F.col("_h")), "left").drop("_id", "_h")


def list_parts(lists: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Row number of each element, and the elements of a list array; null is empty."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten()


def covered(length: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of ``length`` places lie in one of the ranges [lo, hi)."""
    change = np.bincount(lo, minlength=length + 1) - np.bincount(hi, minlength=length + 1)
    return np.cumsum(change[:length]) > 0


def binary_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def remove_spans(docs: DataFrame, spans: DataFrame, units: str) -> DataFrame:
    """``docs`` (keyed) less the spans (doc_id, h, lo, hi) in bytes or words.

    Gives rest, text, kept, n_units, n_removed, n_spans. Bytes: ``kept`` is binary, the bytes
    left over; words: a string, the words left over with one space between them.
    """
    kind = pa.binary() if units == "bytes" else pa.string()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_of, parts = list_parts(B.column(batch, "spans"))
            lo = parts.field(0).to_numpy(zero_copy_only=False)
            hi = parts.field(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in B.blocks(B.column(batch, "text")):
                part = slice(*np.searchsorted(row_of, [first, last]))
                if units == "bytes":
                    at = offsets
                else:
                    start, end, at = B.words(data, offsets)
                total = int(at[-1])
                base = at[row_of[part] - first]
                gone = covered(total, base + lo[part], base + hi[part])
                upto = np.append(0, np.cumsum(gone))
                fresh = gone.copy()
                fresh[1:] &= ~gone[:-1]
                inner = at[1:-1][at[1:-1] < total]
                fresh[inner] = gone[inner]
                runs = np.append(0, np.cumsum(fresh))
                kept_at = at - upto[at]
                if units == "bytes":
                    kept = binary_array(data[~gone], kept_at, kind)
                else:
                    kept = _joined(data, start[~gone], end[~gone], kept_at)
                counts = [np.diff(at), np.diff(upto[at]), np.diff(runs[at])]
                size = last - first
                yield pa.RecordBatch.from_arrays(
                    [B.column(batch, "rest").slice(first, size), B.column(batch, "text").slice(first, size), kept, *map(pa.array, counts)],
                    names=["rest", "text", "kept", "n_units", "n_removed", "n_spans"],
                )

    schema = T.StructType(
        [
            docs.schema["rest"],
            T.StructField("text", T.StringType()),
            T.StructField("kept", T.BinaryType() if units == "bytes" else T.StringType()),
            *(T.StructField(c, T.LongType()) for c in ("n_units", "n_removed", "n_spans")),
        ]
    )
    return with_lists(docs, spans, "spans").select("rest", "text", "spans").mapInArrow(cut, schema)


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> pa.Array:
    """The given words of each document, one space between two."""
    size = end - start + 1
    last = at[1:][np.diff(at) > 0] - 1
    size[last] -= 1
    out_at = np.append(0, np.cumsum(size))
    out = np.full(int(out_at[-1]), 0x20, np.uint8)
    length = end - start
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(out_at[:-1], length) + step] = data[np.repeat(start, length) + step]
    return binary_array(out, out_at[at], pa.string())
