"""State on plain parquet: numbered versions, never changed in place.

A version becomes visible through a row in the manifest, which is written after the data.
A run that dies half-way leaves a folder nobody reads, and its number is written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.session import local_rows

_MANIFEST = "version long, path string"


def versions(spark: SparkSession, base: str) -> DataFrame:
    """The published versions: version, path."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{base}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_rows(spark, [], _MANIFEST)


def latest_version(spark: SparkSession, base: str) -> int:
    """The newest version number, 0 before the first."""
    row = versions(spark, base).agg(F.max("version").alias("v")).first()
    return int(row.v or 0)


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version and publish it.

    One writer per ``base``. Partitioning nodes by ``node_type`` or edges by ``edge_type``
    lets the per-type views read one folder only.
    """
    spark = df.sparkSession
    number = latest_version(spark, base) + 1
    path = f"{base}/data/v{number:06d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    local_rows(spark, [(number, path)], _MANIFEST).coalesce(1).write.mode("append").parquet(
        f"{base}/manifest"
    )
    return number


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A version of the state, the newest one by default."""
    wanted = latest_version(spark, base) if version is None else version
    row = versions(spark, base).where(F.col("version") == wanted).first()
    if row is None:
        raise ValueError(f"{base} has no version {wanted}")
    return spark.read.parquet(row.path)
