"""Positions in a global order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from weftgraph.session import cut_lineage


def numbered(rows: DataFrame, *order: Column, position: str = "position") -> DataFrame:
    """``rows`` with their 0-based place in the given order.

    Rows are dealt out by range and numbered inside their range; what a range starts at is a
    running sum over one number per range. The rows should be narrow: they are written once.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = dealt.withColumn("_inside", inside).join(starts, "_range")
    return placed.withColumn(position, F.col("_start") + F.col("_inside")).drop("_range", "_inside", "_start")


def first_beyond(rows: DataFrame, value: str, budget: int, *order: Column) -> Row | None:
    """The row at which the sum of ``value`` over the rows in order reaches ``budget``, with ``_before``: the
    sum of those before it. None if all rows together stay below.

    Rows are dealt out by range; a sum per range tells which range holds the row, and only that one is looked into.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sums = dealt.groupBy("_range").agg(F.sum(value).alias("_sum"))
    upto = sums.withColumn("_upto", F.sum("_sum").over(Window.orderBy("_range")))
    met = upto.where(F.col("_upto") >= budget).orderBy("_range").limit(1).collect()
    if not met:
        return None
    start = met[0]["_upto"] - met[0]["_sum"]
    inside = F.sum(value).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = dealt.where(F.col("_range") == met[0]["_range"]).withColumn("_before", start + inside - F.col(value))
    return found.where(F.col("_before") + F.col(value) >= budget).orderBy("_before").limit(1).collect()[0]
