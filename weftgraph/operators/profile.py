"""Keys and references found in the data, for sources that declare none.

A profile reads only the columns it is about, combines equal values inside each task
before anything is shuffled, and ends in one row per key or reference.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.operators.graph import union_all
from weftgraph.session import local_rows

# Fixed value: the one-letter table prefix of a column name.
STEM_PREFIX = "^[a-z]_"


@dataclass(frozen=True)
class KeyPair:
    """A possible reference: ``child.child_col`` may point at ``parent.parent_col``."""

    child: str
    child_col: str
    parent: str
    parent_col: str


def type_family(data_type: T.DataType) -> str:
    """Types that can be compared as keys share a family."""
    if isinstance(data_type, T.IntegralType):
        return "integer"
    return data_type.typeName()


def candidate_key_pairs(
    schemas: Mapping[str, T.StructType],
    single_keys: Mapping[str, str],
    stem_prefix: str = STEM_PREFIX,
) -> list[KeyPair]:
    """Pairs whose column names share a stem and whose types share a family.

    ``single_keys`` maps a table to its one-column key. Only the schemas are read; the
    result is what :func:`profile_inclusion` then tests on the data.
    """

    def stem(name: str) -> str:
        return re.sub(stem_prefix, "", name.lower())

    targets: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for parent in sorted(single_keys):
        field = schemas[parent][single_keys[parent]]
        slot = (stem(field.name), type_family(field.dataType))
        targets.setdefault(slot, []).append((parent, field.name))

    pairs = []
    for child in sorted(schemas):
        for field in schemas[child].fields:
            for parent, parent_col in targets.get((stem(field.name), type_family(field.dataType)), ()):
                if (child, field.name) != (parent, parent_col):
                    pairs.append(KeyPair(child, field.name, parent, parent_col))
    return pairs


def profile_uniqueness(
    tables: Mapping[str, DataFrame], candidates: Sequence[tuple[str, Sequence[str]]]
) -> DataFrame:
    """Per candidate key: rows, distinct complete keys, rows with a null part, verdict.

    Output: table_name, key_columns (one text), key_parts (the same as an array), n_rows,
    n_distinct, n_null, is_unique.

    Keys of the same shape (the type families of their columns) share one aggregation, in
    which integers stay integers and a key is named by a number.
    """
    by_shape: dict[tuple[str, ...], list[DataFrame]] = {}
    names = []
    for number, (table, key) in enumerate(candidates):
        df = tables[table]
        shape = tuple(_key_type(df, c) for c in key)
        values = [F.col(f"`{c}`").cast(t).alias(f"v{i}") for i, (c, t) in enumerate(zip(key, shape))]
        by_shape.setdefault(shape, []).append(df.select(F.lit(number).alias("no"), *values))
        names.append((number, table, ",".join(key), list(key)))

    counted = []
    for shape, keyed in by_shape.items():
        values = [f"v{i}" for i in range(len(shape))]
        complete = F.lit(True)
        for value in values:
            complete = complete & F.col(value).isNotNull()
        counted.append(
            union_all(keyed)
            .groupBy("no", *values)
            .agg(F.count(F.lit(1)).alias("held"))
            .groupBy("no")
            .agg(
                F.sum("held").alias("n_rows"),
                F.count(F.when(complete, 1)).alias("n_distinct"),
                F.sum(F.when(~complete, F.col("held"))).alias("n_null"),
            )
        )
    return (
        _named(names, "no int, table_name string, key_columns string, key_parts array<string>", tables)
        .join(union_all(counted), "no", "left")
        .drop("no")
        .fillna(0, ["n_rows", "n_distinct", "n_null"])
        .withColumn("is_unique", F.col("n_rows") == F.col("n_distinct"))
    )


def profile_inclusion(tables: Mapping[str, DataFrame], pairs: Sequence[KeyPair]) -> DataFrame:
    """Per pair: set rows, distinct values, and how many of each have no parent row.

    Output: child, child_col, parent, parent_col, n_rows, n_distinct, n_missing_rows,
    n_missing, inclusion (share of distinct values found; null without any value).

    Every column is read and shuffled once for each type it is compared in, however many pairs it is
    in: values are counted per column, combined in each task first, and the columns that hold a value are
    then brought together, a list as long as there are columns. Which of a value's columns are the parents of
    another is looked up in the list of pairs; nothing is joined by value. Both sides are read as their
    :func:`common_type`; a pair without one is refused.
    """
    spark = next(iter(tables.values())).sparkSession
    columns: dict[str, dict[tuple[str, str], int]] = {}
    names, asked = [], {}
    for number, pair in enumerate(pairs):
        ends = ((pair.child, pair.child_col), (pair.parent, pair.parent_col))
        types = [tables[t].schema[c].dataType for t, c in ends]
        as_type = common_type(*types)
        if as_type is None:
            raise ValueError(f"{pair} compares {types[0]} with {types[1]}")
        held = columns.setdefault(as_type, {})
        child, parent = (held.setdefault(end, len(held)) for end in ends)
        asked.setdefault(as_type, []).append((number, child, parent))
        names.append((number, pair.child, pair.child_col, pair.parent, pair.parent_col))

    counted = []
    for as_type, held in columns.items():
        values = [
            tables[t].where(F.col(f"`{c}`").isNotNull()).select(F.lit(no).alias("column"), F.col(f"`{c}`").cast(as_type).alias("value"))
            for (t, c), no in held.items()
        ]
        uses = union_all(values).groupBy("value", "column").agg(F.count(F.lit(1)).alias("used"))
        by_value = uses.groupBy("value").agg(F.collect_list(F.struct("column", "used")).alias("uses"))
        tested = local_rows(spark, asked[as_type], "no int, child int, parent int")
        there = F.array_contains("columns", F.col("parent"))
        counted.append(
            by_value.select(F.col("uses.column").alias("columns"), F.explode("uses").alias("u"))
            .join(tested, F.col("u.column") == F.col("child"))
            .groupBy("no")
            .agg(
                F.sum("u.used").alias("n_rows"),
                F.count(F.lit(1)).alias("n_distinct"),
                F.sum(F.when(~there, F.col("u.used"))).alias("n_missing_rows"),
                F.count(F.when(~there, 1)).alias("n_missing"),
            )
        )
    share = (F.col("n_distinct") - F.col("n_missing")) / F.col("n_distinct")
    return (
        _named(names, "no int, child string, child_col string, parent string, parent_col string", tables)
        .join(union_all(counted), "no", "left")
        .drop("no")
        .fillna(0, ["n_rows", "n_distinct", "n_missing_rows", "n_missing"])
        .withColumn("inclusion", F.when(F.col("n_distinct") > 0, share))
    )


def common_type(a: T.DataType, b: T.DataType) -> str | None:
    """The type in which values of both are compared without loss; ``None`` if there is none."""
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return "bigint"
    exact = (T.IntegralType, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        scale = max(getattr(t, "scale", 0) for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in (a, b))
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else None
    if isinstance(a, T.FractionalType) and isinstance(b, T.FractionalType) and not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType):
        return "double"
    times = (T.DateType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times) and type(a) is not type(b):
        return "timestamp_ntz"
    return a.simpleString() if a.simpleString() == b.simpleString() else None


def _key_type(df: DataFrame, column: str) -> str:
    """The type a key column is grouped in."""
    return "bigint" if type_family(df.schema[column].dataType) == "integer" else "string"


def _named(rows: list[tuple], schema: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return local_rows(spark, rows, schema)


def primary_keys(uniqueness: DataFrame, schema: str) -> DataFrame:
    """Profiled keys in the declared form: table_schema, table_name, column_name."""
    return uniqueness.where("is_unique").select(
        F.lit(schema).alias("table_schema"),
        "table_name",
        F.explode("key_parts").alias("column_name"),
    )


def foreign_keys(
    inclusion: DataFrame, uniqueness: DataFrame, schema: str, least: float = 1.0
) -> DataFrame:
    """Profiled references in the declared form.

    A pair counts when the share of its values found is at least ``least``, some value is
    set, and the parent column is unique on its own.
    """
    unique = uniqueness.where("is_unique").select(
        F.col("table_name").alias("parent"), F.col("key_columns").alias("parent_col")
    )
    return (
        inclusion.where(F.col("inclusion") >= least)
        .join(unique, ["parent", "parent_col"], "left_semi")
        .select(
            F.lit(schema).alias("table_schema"),
            F.col("child").alias("table_name"),
            F.col("child_col").alias("column_name"),
            F.lit(schema).alias("ref_table_schema"),
            F.col("parent").alias("ref_table_name"),
        )
    )
