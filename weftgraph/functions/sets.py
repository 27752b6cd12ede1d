"""Set operations on keys that cost one shuffle and no sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``left`` that ``right`` does not hold.

    Both sides are unioned and grouped by the key. Equal keys combine inside each task
    before the shuffle, so a key repeated without limit travels as one row per task, and
    no join has to sort either side. As in an anti join, a key with a null part is absent.
    """
    keys = list(keys)
    here = left.select(*keys, F.lit(1).alias("_here"), F.lit(0).alias("_there"))
    there = right.select(*keys, F.lit(0).alias("_here"), F.lit(1).alias("_there"))
    blank = F.lit(False)
    for key in keys:
        blank = blank | F.col(key).isNull()
    return (
        here.unionByName(there)
        .groupBy(*keys)
        .agg(F.max("_here").alias("_here"), F.max("_there").alias("_there"))
        .where((F.col("_here") == 1) & ((F.col("_there") == 0) | blank))
        .select(*keys)
    )
