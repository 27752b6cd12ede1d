"""Parquet tables and the catalogs that describe them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.graph import union_all
from weftgraph.session import local_rows

CATALOG = (
    "table_schema string, table_name string, column_name string, data_type string, comment string"
)


class Tables:
    """The parquet tables of one folder, each opened on first use and then reused.

    Opening a table lists its files and reads a footer, so one run opens each table once.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    def all(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several tables by name; those not yet open are opened side by side."""
        names = list(names)
        with ThreadPoolExecutor(max_workers=8) as pool:
            return dict(zip(names, pool.map(self.__getitem__, names)))


def catalog_snapshot(tables: Mapping[str, DataFrame], schema: str = "src") -> DataFrame:
    """One row per column of the given frames, read from their schemas alone."""
    rows = [
        (schema, table, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for table, df in tables.items()
        for f in df.schema.fields
    ]
    spark = next(iter(tables.values())).sparkSession
    return local_rows(spark, rows, CATALOG)


def _described(spark: SparkSession, database: str) -> list[tuple]:
    """(table, comment, columns) of the tables of a database; the catalog is asked side by side."""
    found = [t for t in spark.catalog.listTables(database) if not t.isTemporary]

    def columns(table) -> list:
        return spark.catalog.listColumns(f"{database}.{table.name}")

    with ThreadPoolExecutor(max_workers=16) as pool:
        return [(t.name, t.description, c) for t, c in zip(found, pool.map(columns, found))]


def catalog_of_database(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of every table of a database in the session's catalog."""
    rows = [
        (database, table, c.name, c.dataType, c.description)
        for table, _, columns in _described(spark, database)
        for c in columns
    ]
    return local_rows(spark, rows, CATALOG)


def comments_of_database(spark: SparkSession, database: str) -> DataFrame:
    """The comments of a database as prompts take them: table_schema, table_name, column_name
    (null for the table's own), comment. What has no comment has no row."""
    rows = []
    for table, comment, columns in _described(spark, database):
        rows += [(database, table, None, comment)] * bool(comment)
        rows += [(database, table, c.name, c.description) for c in columns if c.description]
    return local_rows(
        spark, rows, "table_schema string, table_name string, column_name string, comment string"
    )


def row_counts(tables: Mapping[str, DataFrame], schema: str = "src") -> DataFrame:
    """Rows per table; parquet answers this from its footers."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return union_all(counted)


def observed_catalog(df: DataFrame, json_col: str, by: Sequence[str]) -> DataFrame:
    """The catalog found inside JSON rows: one row per (group, key, type), with counts.

    Each text is parsed once; equal (group, key, type) rows combine before the shuffle.
    Types are the JSON ones: number, string, boolean, object, array, null.
    """
    found = df.select(
        *by, F.explode(F.from_json(F.col(json_col), "map<string,variant>")).alias("json_key", "_v")
    )
    full = F.schema_of_variant("_v")
    kind = (
        F.when(full.startswith("OBJECT"), "object")
        .when(full.startswith("ARRAY"), "array")
        .when(full == "STRING", "string")
        .when(full == "BOOLEAN", "boolean")
        .when(full == "VOID", "null")
        .otherwise("number")
    )
    return (
        found.select(*by, "json_key", kind.alias("json_type"))
        .groupBy(*by, "json_key", "json_type")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
