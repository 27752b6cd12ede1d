"""First-seen keys of an append stream: new (group, member) pairs as they turn up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str | None = None
) -> DataFrame:
    """A streaming frame with the first row of every key.

    With ``delay``, state older than the watermark is dropped and a key that pauses for
    longer counts as new again; without it every key is remembered. Meant for keys that
    repeat seldom: each row is shuffled to its key. For few, often repeated keys use
    :func:`track_first_seen`.
    """
    if delay is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def track_first_seen(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str,
    out: str,
    checkpoint: str,
    compact_every: int = 50,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Append the first sighting of every key to ``out``; process what is there and stop.

    Every micro-batch is first reduced to one row per key, combining inside the tasks, so
    a key making up most of the stream costs one row per task in the shuffle. The reduced
    rows are compared with the known keys and written under the batch number, with the time
    of the earliest row of that batch and the rows in it; late rows of a known key change nothing.

    Known keys are one table, rewritten beside ``out`` every ``compact_every`` batches, and the
    batches since. With ``forget_after`` (an interval such as ``7 days``) the table drops keys
    first seen longer than that before the newest one; such a key then counts as new again. Without
    it, the table holds every key.

    A batch repeated after a failure overwrites its own folders only, so each key is kept
    exactly once. The checkpoint is the watermark: it says which input has been read.
    """
    keys = list(keys)

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.groupBy(*keys).agg(
            F.min(event_time).alias("first_seen"), F.count(F.lit(1)).alias("rows_in_batch")
        )
        earlier = known_keys(spark, out, batch_id, compact_every)
        if earlier is not None:
            seen = seen.join(earlier.select(*keys), keys, "left_anti")
        seen.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id and batch_id % compact_every == 0:
            # From the table before: this one may be a torn copy of an attempt that failed.
            before = batch_id - compact_every
            table = _read_known(spark, out, before, batch_id + 1).select(*keys, "first_seen")
            if forget_after is not None:
                newest = table.agg(F.max("first_seen")).first()[0]
                table = table.where(F.col("first_seen") >= F.lit(newest) - F.expr(f"INTERVAL {forget_after}"))
            table.write.mode("overwrite").parquet(f"{out}.known/{batch_id}")

    return (
        stream.writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def known_keys(
    spark: SparkSession, out: str, before_batch: int, compact_every: int = 50
) -> DataFrame | None:
    """The keys known before the given batch; ``None`` when there are none.

    The latest table before the batch is complete: its own batch ended after writing it.
    """
    table = max(before_batch - 1, 0) // compact_every * compact_every
    return _read_known(spark, out, table, before_batch)


def _read_known(spark: SparkSession, out: str, table: int, before_batch: int) -> DataFrame | None:
    """The table made by batch ``table`` (0: none was) and the batches after it."""
    recent = range(table + 1 if table else 0, before_batch)
    paths = [f"{out}/batch={n}" for n in recent if _exists(spark, f"{out}/batch={n}")]
    paths += [f"{out}.known/{table}"] * bool(table)
    return spark.read.parquet(*paths) if paths else None


def _exists(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
