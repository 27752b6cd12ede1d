"""Whole groups out of the Arrow batches of rows that lie sorted by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def in_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` dealt out and sorted by ``keys``, which are whole numbers without nulls."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold only whole groups, with the n + 1 offsets of their groups.

    What is held at once is a batch and one group, so groups have to be bounded.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if table.num_rows == 0:
            continue
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        edges = np.flatnonzero(new)
        rest = table.slice(edges[-1])
        if len(edges) > 1:
            yield table.slice(0, edges[-1]).combine_chunks(), edges
    if rest is not None:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])
