"""Words of documents that a repeated window covers, with a count-min prefilter.

1. Each partition sketches the anchors of its windows (``anchors.py``); the merged sketch never
   underestimates, so windows estimated to occur once are dropped and none is lost.
2. A second pass groups exactly what is left: first whole cells by content, then, where one
   anchor has several contents, their single windows.
3. Most repeated cells are told by a Bloom filter of the contents that occur once: what it does
   not hold occurs more often. The others are joined with the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import anchors as A
from weftgraph.llm import blocks as B
from weftgraph.llm.spans import keyed, list_parts, remove_spans, with_lists
from weftgraph.session import cut_lineage


def _windows(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """One row per window of the wanted cells: (key, wh, c, doc_id, h, lo)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell = list_parts(B.column(batch, "cells"))
            place = {cell.type.field(i).name: cell.field(i).to_numpy(zero_copy_only=False) for i in range(cell.type.num_fields)}
            ids, hashes = B.column(batch, "doc_id"), B.column(batch, "h")
            for first, last, data, offsets in B.blocks(B.column(batch, "text")):
                start, end, at = B.words(data, offsets)
                rolling = B.RollingHash(B.word_units(data, start, end))
                part = slice(*np.searchsorted(row, [first, last]))
                n = place["n"][part]
                of = np.repeat(np.arange(len(n)), n)
                lo = place["s0"][part][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                begin = at[row[part][of] - first] + lo
                rows = pa.array(row[part][of])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place["key"][part][of]), pa.array(B.signed(rolling.ranges(begin, begin + window))), pa.array(place["c"][part][of]), ids.take(rows), hashes.take(rows), pa.array(lo)],
                    names=["key", "wh", "c", "doc_id", "h", "lo"],
                )

    joined = with_lists(docs.select("doc_id", "h", "text"), wanted, "cells").where(F.col("cells").isNotNull())
    return joined.mapInArrow(emit, "key long, wh long, c long, doc_id long, h long, lo long")


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = 12) -> DataFrame:
    """(doc_id, h, lo, hi): stretches of words covered by windows that occur more than once."""
    shape = A.Shape("words", window, gram)
    repeated = A.repeated_keys(docs, shape)
    cells = cut_lineage(A.candidate_cells(docs, shape, repeated))
    contents = cut_lineage(
        cells.groupBy("key", "ch").agg(
            F.count("*").alias("c"), F.min(F.struct("doc_id", "h", "s0")).alias("first"), F.first("n").alias("n")
        )
    )
    several = contents.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    wanted = contents.join(several, "key").select("first.doc_id", "first.h", "first.s0", "n", "key", "c")
    single = cut_lineage(_windows(docs, wanted, window))
    often = single.groupBy("key", "wh").agg(F.sum("c").alias("total")).where("total > 1")
    alone = single.where("c = 1").join(often, ["key", "wh"], "left_semi")
    # A cell whose content is surely not among those that occur once occurs more often; only where
    # the filter is not sure the contents are asked.
    once = A.members(contents.where("c = 1").select("ch"), repeated.bits)
    asked = A.marked(cells, "ch", once, "maybe_once")
    unsure = asked.where("maybe_once").join(contents.where("c > 1").select("key", "ch"), ["key", "ch"], "left_semi")
    whole = asked.where("not maybe_once").unionByName(unsure)
    return whole.select(
        "doc_id", "h", F.col("s0").alias("lo"), (F.col("s0") + F.col("n") + (window - 1)).alias("hi")
    ).unionByName(alone.select("doc_id", "h", "lo", (F.col("lo") + window).alias("hi")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Each document's words less those that a window occurring more than once covers.

    A word is ``[^\\x20\\x09-\\x0D]+``. Returns ``rest`` (a struct of all other columns),
    ``text``, ``kept`` (the words left over, one space between two), ``n_units`` (words),
    ``n_removed``, ``n_spans``. Every occurrence goes, the first one too; windows are judged on the
    input. A null, empty or blank text has no words; a text of fewer than ``window`` words loses
    none; repeated rows are occurrences like any other; an empty table gives an empty table.
    """
    frame = keyed(docs, id_col, text_col)
    return remove_spans(frame, repeated_spans(frame, window), "words")
