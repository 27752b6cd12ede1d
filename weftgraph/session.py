"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Runtime settings the plans rely on. Broadcasts are left to Spark's own size checks.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where this costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession, first_partitions: int | None = None) -> SparkSession:
    """Apply the SQL settings the operators expect to a running session.

    With ``first_partitions`` a shuffle begins with at least so many partitions, which Spark joins again up to
    its advisory size: what a task holds then follows that size and not the input's, whatever
    ``spark.sql.shuffle.partitions`` says. Without it a number set by an earlier call is taken back.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    if first_partitions is None:
        spark.conf.unset(_FIRST_PARTITIONS)
    else:
        spark.conf.set(_FIRST_PARTITIONS, max(first_partitions, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only when the session names none (local tests) a temporary folder is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = known.get() if known.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        found = tempfile.mkdtemp(prefix="weftgraph-")
        spark.sparkContext.setCheckpointDir(found)
    return str(found).rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy is reliable storage, so a lost executor costs a re-read and not a recompute.
    """
    spark = df.sparkSession
    path = new_dir(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame of a few driver-side rows (specs, catalogs) whose size Spark knows.

    Handed over as Arrow it becomes a local relation, so joins with it are planned by its
    true size; plain Python rows would count as unboundedly large.
    """
    parsed = T._parse_datatype_string(schema)
    columns = list(zip(*rows)) if rows else [()] * len(parsed.fields)
    arrow = to_arrow_schema(parsed)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, parsed)
