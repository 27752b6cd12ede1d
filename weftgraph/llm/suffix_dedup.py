"""Bytes of documents that an earlier string covers, by suffix arrays of shards.

1. Anchors (``anchors.py``) give the cells whose windows may repeat; a sketch spares the rest.
2. Cells of equal content are brought down to the earliest one; every window of the later ones
   starts earlier too.
3. What is left are *different* contents around one anchor. They are dealt into shards by anchor,
   so that two equal windows meet in one shard. Each shard is one string; induced sorting gives
   its suffix array, permuted common prefixes tell which windows are equal, and of each class
   all but the earliest window are marked.
4. An anchor with more than ``split`` contents (a line of a third of all documents, say) is
   dealt out to several shards. These also report the earliest window of each class, and a second
   exchange compares the reports by the window's hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import anchors as A
from weftgraph.llm import blocks as B
from weftgraph.llm import suffix_array as S
from weftgraph.llm.spans import keyed, list_parts, remove_spans, with_lists
from weftgraph.session import cut_lineage

SHARD_BYTES = 1 << 20
CUT_BYTES = 1 << 22
_FOUND = "doc_id long, h long, lo long, hi long, key long, wh long"


def _cut_out(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The bytes of the wanted cells: (key, ch, shard, split, doc_id, h, s0, n, content)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(B.column(batch, "text"))
            row, cell = list_parts(B.column(batch, "cells"))
            place = {cell.type.field(i).name: cell.field(i) for i in range(cell.type.num_fields)}
            s0 = place["s0"].to_numpy(zero_copy_only=False)
            size = place["n"].to_numpy(zero_copy_only=False) + window - 1
            start = offsets[row] + s0
            ends = np.cumsum(size)
            # Contents overlap and add up to several times the text; a few megabytes go out at a time.
            first = 0
            while first < len(size):
                done = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + CUT_BYTES, side="right")))
                at = np.append(0, ends[first:last] - done)
                step = np.arange(int(at[-1])) - np.repeat(at[:-1], size[first:last])
                bytes_ = data[np.repeat(start[first:last], size[first:last]) + step]
                content = pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(bytes_)])
                rows, part = pa.array(row[first:last]), slice(first, last)
                yield pa.RecordBatch.from_arrays(
                    [
                        place["shard"][part], place["split"][part], B.column(batch, "doc_id").take(rows), B.column(batch, "h").take(rows),
                        place["key"][part], place["s0"][part], place["n"][part], content.cast(pa.binary()),
                    ],
                    names=["shard", "split", "doc_id", "h", "key", "s0", "n", "content"],
                )
                first = last

    joined = with_lists(docs.select("doc_id", "h", "text"), wanted, "cells").where(F.col("cells").isNotNull())
    return joined.mapInArrow(emit, "shard long, split boolean, doc_id long, h long, key long, s0 long, n int, content binary")


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the runs of consecutive numbers in ``places``."""
    gap = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, gap + 1)], places[np.append(gap, len(places) - 1)]


def _later_windows(window: int):
    def of_shard(table: pa.Table) -> pa.Table:
        """Runs of windows that an earlier window of the shard equals; for split anchors also
        the earliest window of each class, with its hash."""
        table = table.combine_chunks()
        content = table["content"].chunk(0) if table.num_rows else pa.array([], pa.binary())
        data, at = B.text_bytes(content)
        size = np.diff(at)
        n = table["n"].to_numpy()
        s0, h = table["s0"].to_numpy(), table["h"].to_numpy()
        has_id = table["doc_id"].is_valid().to_numpy(zero_copy_only=False)
        ids = table["doc_id"].fill_null(0).to_numpy()
        # One string: letters from 2 on, 1 after each content, 0 at the end.
        begin = at[:-1] + np.arange(len(size))
        s = np.ones(len(data) + len(size) + 1, np.int64)
        s[-1] = 0
        owner = np.repeat(np.arange(len(size)), size)
        s[np.arange(len(data)) + owner] = data.astype(np.int64) + 2
        sa = S.suffix_array(s)
        plcp = S.permuted_common_prefixes(s, sa)
        # The place of a window in the order of the input, for places where one starts.
        order = np.lexsort([h, ids, has_id])
        fresh = np.append(True, (np.diff(h[order]) != 0) | (np.diff(ids[order]) != 0) | (np.diff(has_id[order].astype(int)) != 0))
        doc_rank = np.empty(len(order), np.int64)
        doc_rank[order] = np.cumsum(fresh)
        of = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        place = np.full(len(s), -1, np.int64)
        place[begin[of] + offset] = (doc_rank[of] << 40) + s0[of] + offset
        window_of = np.full(len(s), -1, np.int64)
        window_of[begin[of] + offset] = np.arange(len(of))
        run = np.cumsum(plcp[sa] < window)
        keep = place[sa] >= 0
        in_order, run, at_place = sa[keep], run[keep], place[sa[keep]]
        edges = np.flatnonzero(np.append(True, np.diff(run) != 0))
        least = np.repeat(np.minimum.reduceat(at_place, edges), np.diff(np.append(edges, len(run))))
        later = np.zeros(len(of), bool)
        later[window_of[in_order[at_place > least]]] = True
        # Neighbouring windows of one content make one run; a gap of one keeps contents apart.
        lo, hi = _runs((np.arange(len(of)) + of)[later]) if later.any() else (np.zeros(0, np.int64),) * 2
        lo_of = np.searchsorted(np.cumsum(n) + np.arange(len(n)) + 1, lo, side="right")
        base = np.cumsum(n) - n + np.arange(len(n))
        columns = [lo_of, lo - base[lo_of] + s0[lo_of], hi - base[lo_of] + s0[lo_of] + window]
        marks = [np.zeros(len(lo), np.int64), np.zeros(len(lo), bool)]
        split = table["split"].to_numpy()
        if split.any():
            first = window_of[in_order[at_place == least]]
            first = first[split[of[first]]]
            # Of equal places (a repeated row) any one will do.
            rolling = B.RollingHash(B.byte_units(data))
            start = at[of[first]] + offset[first]
            wh = B.signed(rolling.ranges(start, start + window))
            start = s0[of[first]] + offset[first]
            columns = [np.append(a, b) for a, b in zip(columns, (of[first], start, start + window))]
            marks = [np.append(marks[0], wh), np.append(marks[1], np.ones(len(first), bool))]
        rows = pa.array(columns[0])
        return pa.table(
            {
                "doc_id": table["doc_id"].take(rows),
                "h": table["h"].take(rows),
                "lo": pa.array(columns[1]),
                "hi": pa.array(columns[2]),
                "key": table["key"].take(rows),
                "wh": pa.array(marks[0], mask=~marks[1]),
            }
        )

    return of_shard


def repeated_spans(docs: DataFrame, window: int = 100, gram: int = 48, split: int = 2000) -> DataFrame:
    """(doc_id, h, lo, hi): stretches of bytes covered by windows that also start earlier.

    ``docs`` as from ``keyed``. Earlier means a smaller doc_id (null first) or the same document
    and an earlier start; documents that share an id count in the order of their text's hash.
    """
    shape = A.Shape("bytes", window, gram)
    cells = cut_lineage(A.candidate_cells(docs, shape, A.repeated_keys(docs, shape)))
    contents = cut_lineage(
        cells.groupBy("key", "ch").agg(F.min(F.struct("doc_id", "h", "s0")).alias("first"), F.first("n").alias("n"))
    )
    several = contents.groupBy("key").agg(F.count("*").alias("m"), F.sum(F.col("n") + (window - 1)).alias("size")).where("m > 1")
    several = cut_lineage(several)
    total = several.agg(F.sum("size")).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(partitions, -(-total // SHARD_BYTES))
    salt = F.when(F.col("m") > split, F.pmod("ch", F.ceil(F.col("m") / split))).otherwise(0)
    wanted = contents.join(several, "key").select(
        "first.doc_id", "first.h", "first.s0", "n", "key",
        F.pmod(F.xxhash64("key", salt), F.lit(shards)).alias("shard"), (F.col("m") > split).alias("split"),
    )
    found = cut_lineage(_cut_out(docs, wanted, window).groupBy("shard").applyInArrow(_later_windows(window), _FOUND))

    firsts = contents.select("key", "ch", "first")
    copies = (
        cells.join(firsts, ["key", "ch"])
        .where(~F.struct("doc_id", "h", "s0").eqNullSafe(F.col("first")))
        .select("doc_id", "h", F.col("s0").alias("lo"), (F.col("s0") + F.col("n") + (window - 1)).alias("hi"))
    )
    reports = found.where("wh is not null")
    earliest = reports.groupBy("key", "wh").agg(F.min(F.struct("doc_id", "h", "lo")).alias("first"))
    across = reports.join(earliest, ["key", "wh"]).where(F.struct("doc_id", "h", "lo") > F.col("first"))
    ends = ["doc_id", "h", "lo", "hi"]
    return copies.unionByName(found.where("wh is null").select(*ends)).unionByName(across.select(*ends))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100) -> DataFrame:
    """Each document's bytes less those that a ``window``-byte string starting earlier covers.

    Returns ``rest`` (a struct of all other columns), ``text``, ``kept`` (binary), ``n_units``
    (bytes), ``n_removed``, ``n_spans``. Strings are judged on the input; overlaps count.
    A null or empty text has 0 bytes and empty ``kept``; a text shorter than the window loses
    nothing; of equal texts the one with the smallest id stays; rows equal in id and text count
    as one document and get the same result; an empty table gives an empty table.
    """
    frame = keyed(docs, id_col, text_col)
    return remove_spans(frame, repeated_spans(frame, window), "bytes")
