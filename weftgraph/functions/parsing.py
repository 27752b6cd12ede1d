"""Reading JSON text once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parsed(df: DataFrame, parsed: Column, out: str) -> DataFrame:
    """Add ``parsed`` as column ``out``, evaluated once per row.

    A later filter on its fields would otherwise be pushed below the column, with the whole
    text parsed again for every field it names. Filters are not pushed through a generator,
    and exploding an array of one keeps every row as it is.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(out))
