"""Classify detected changes by rule.

Inputs follow the catalog shapes: changes (run_id, table_schema, table_name, column_name,
data_type, change_type, ...), foreign keys (table_schema, table_name, column_name,
ref_table_schema, ref_table_name), primary keys, columns, and node types (node_type,
source_object). Candidates come out as run_id, table_schema, table_name, column_name,
object_kind, rule_applied, proposed_name, edge_from, edge_to, raw_details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.text import (
    KEY_SUFFIX,
    SOURCE_PREFIX,
    without_key_suffix,
    without_source_prefix,
)
from weftgraph.operators.detect import NEW_COLUMN, NEW_TABLE

# Object kinds and rule names.
ATTRIBUTE = "ATTRIBUTE"
EDGE_TYPE = "EDGE_TYPE"
NODE_TYPE = "NODE_TYPE"
FLAGGED = "FLAGGED"
COLUMN_TO_ATTRIBUTE = "COLUMN_TO_ATTRIBUTE"
FK_TO_EDGE = "FK_TO_EDGE"
FEW_FKS = "FEW_FKS"
FKS_NOT_IDENTITY = "FKS_NOT_IDENTITY"
PURE_JUNCTION = "PURE_JUNCTION"
REIFIED_ENTITY = "REIFIED_ENTITY?"

_TABLE = ["table_schema", "table_name"]
_COLUMN = [*_TABLE, "column_name"]
_CANDIDATE = [
    "run_id",
    *_COLUMN,
    "object_kind",
    "rule_applied",
    "proposed_name",
    "edge_from",
    "edge_to",
    "raw_details",
]


def source_object(schema: str = "table_schema", table: str = "table_name") -> Column:
    """``schema.table``, the form node types name their source in."""
    return F.concat(F.col(schema), F.lit("."), F.col(table))


def single_columns(changes: DataFrame) -> DataFrame:
    """New columns of tables that are not themselves new in the same run."""
    whole = changes.where(F.col("change_type") == NEW_TABLE).select("run_id", *_TABLE).distinct()
    new = changes.where(F.col("change_type") == NEW_COLUMN)
    return new.join(whole, ["run_id", *_TABLE], "left_anti")


def classify_attributes(changes: DataFrame, fks: DataFrame) -> DataFrame:
    """A new column that references nothing becomes an attribute."""
    plain = single_columns(changes).join(fks.select(*_COLUMN).distinct(), _COLUMN, "left_anti")
    return _candidates(
        plain,
        object_kind=F.lit(ATTRIBUTE),
        rule_applied=F.lit(COLUMN_TO_ATTRIBUTE),
        proposed_name=F.lower("column_name"),
        raw_details=F.to_json(F.struct("data_type", "change_type")),
    )


def classify_references(
    changes: DataFrame, fks: DataFrame, node_types: DataFrame, suffix: str = KEY_SUFFIX
) -> DataFrame:
    """A new reference between two known node types becomes an edge type.

    ``node_types`` holds one row per ``source_object``; more would repeat candidates.
    """
    known = _resolved(changes, fks, node_types).where(
        F.col("edge_from").isNotNull() & F.col("edge_to").isNotNull()
    )
    own = (F.col("table_schema") == F.col("ref_table_schema")) & (
        F.col("table_name") == F.col("ref_table_name")
    )
    details = F.struct(
        F.col("column_name").alias("fk_column"),
        source_object("ref_table_schema", "ref_table_name").alias("referenced_table"),
        own.alias("self_referencing"),
    )
    return _candidates(
        known,
        object_kind=F.lit(EDGE_TYPE),
        rule_applied=F.lit(FK_TO_EDGE),
        proposed_name=without_key_suffix(F.col("column_name"), suffix),
        edge_from=F.col("edge_from"),
        edge_to=F.col("edge_to"),
        raw_details=F.to_json(details),
    )


def unresolved_references(
    changes: DataFrame, fks: DataFrame, node_types: DataFrame
) -> DataFrame:
    """New references left out of the edge rule, with the end that is not a node type."""
    from_gone, to_gone = F.col("edge_from").isNull(), F.col("edge_to").isNull()
    reason = (
        F.when(from_gone & to_gone, "BOTH_UNKNOWN")
        .when(from_gone, "SOURCE_UNKNOWN")
        .when(to_gone, "TARGET_UNKNOWN")
    )
    return (
        _resolved(changes, fks, node_types)
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("run_id", *_COLUMN, "ref_table_schema", "ref_table_name", "reason")
    )


def classify_columns(
    changes: DataFrame, fks: DataFrame, node_types: DataFrame, suffix: str = KEY_SUFFIX
) -> DataFrame:
    """Both column rules together."""
    return classify_attributes(changes, fks).unionByName(
        classify_references(changes, fks, node_types, suffix)
    )


def table_shapes(
    tables: DataFrame, fks: DataFrame, pks: DataFrame, columns: DataFrame
) -> DataFrame:
    """Shape counts per table: fk_count, pk_count, fk_in_pk, total_columns, attr_count.

    ``tables`` holds (table_schema, table_name) and any further columns, which are kept.
    Attributes are all columns outside the key, so the number says little unless the
    references make up the key.
    """
    fk_cols = fks.select(*_COLUMN).distinct()
    pk_cols = pks.select(*_COLUMN)

    def per_table(rows: DataFrame, out: str) -> DataFrame:
        return rows.groupBy(*_TABLE).agg(F.count(F.lit(1)).alias(out))

    counts = {
        "fk_count": per_table(fk_cols, "fk_count"),
        "pk_count": per_table(pk_cols, "pk_count"),
        "fk_in_pk": per_table(pk_cols.join(fk_cols, _COLUMN, "left_semi"), "fk_in_pk"),
        "total_columns": per_table(columns, "total_columns"),
    }
    shaped = tables
    for name, rows in counts.items():
        shaped = shaped.join(rows, _TABLE, "left").withColumn(
            name, F.coalesce(F.col(name), F.lit(0).cast("long"))
        )
    return shaped.withColumn("attr_count", F.col("total_columns") - F.col("pk_count"))


def classify_shapes(shapes: DataFrame) -> DataFrame:
    """Add object_kind and rule_applied; the first rule that holds decides.

    A table with two references and no key at all is FLAGGED: none of its (zero) key
    columns is missing among the references.
    """
    rule = (
        F.when(F.col("fk_count") < 2, FEW_FKS)
        .when(F.col("fk_in_pk") < F.col("pk_count"), FKS_NOT_IDENTITY)
        .when(F.col("attr_count") <= 1, PURE_JUNCTION)
        .otherwise(REIFIED_ENTITY)
    )
    kind = (
        F.when(F.col("rule_applied").isin(FEW_FKS, FKS_NOT_IDENTITY), NODE_TYPE)
        .when(F.col("rule_applied") == PURE_JUNCTION, EDGE_TYPE)
        .otherwise(FLAGGED)
    )
    return shapes.withColumn("rule_applied", rule).withColumn("object_kind", kind)


def whole_references(fks: DataFrame) -> DataFrame:
    """One row per reference: ``column_name`` lists a composite reference's columns, comma between two.

    Columns that share a ``ref_name`` are one reference to one table, in the order of the columns
    they refer to (``ref_column_name``, if there, else their own): that of the parts of a composite id. A null
    ``ref_name``, or none at all, makes a column a reference of its own. A reference is as wide as a key.
    """
    if "ref_name" not in fks.columns:
        return fks
    target = ["ref_table_schema", "ref_table_name"]
    own = F.when(F.col("ref_name").isNull(), F.col("column_name"))
    place = F.col("ref_column_name" if "ref_column_name" in fks.columns else "column_name").alias("at")
    columns = F.array_sort(F.collect_set(F.struct(place, F.col("column_name").alias("col"))))
    grouped = fks.groupBy(*_TABLE, *target, "ref_name", own.alias("_own")).agg(columns.alias("_cols"))
    return grouped.select(*_TABLE, F.array_join("_cols.col", ",").alias("column_name"), *target, "ref_name")


def first_two_references(fks: DataFrame) -> DataFrame:
    """Per table, what its first two references point at: ref_table_1, ref_table_2.

    A composite reference (:func:`whole_references`) counts once. The rank filter is applied before the shuffle too, so a table keeps at most two rows
    per task.
    """
    order = Window.partitionBy(*_TABLE).orderBy(
        "column_name", "ref_table_schema", "ref_table_name"
    )
    target = source_object("ref_table_schema", "ref_table_name")
    return (
        whole_references(fks)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= 2)
        .groupBy(*_TABLE)
        .agg(
            F.max(F.when(F.col("rank") == 1, target)).alias("ref_table_1"),
            F.max(F.when(F.col("rank") == 2, target)).alias("ref_table_2"),
        )
    )


def classify_tables(
    changes: DataFrame,
    fks: DataFrame,
    pks: DataFrame,
    columns: DataFrame,
    node_types: DataFrame,
    prefix: str = SOURCE_PREFIX,
) -> DataFrame:
    """One candidate per new table, with its shape and, where the references make up the
    key, the two node types it ties together."""
    new = changes.where(F.col("change_type") == NEW_TABLE).select("run_id", *_TABLE)
    judged = classify_shapes(table_shapes(new, fks, pks, columns))

    paired = F.col("object_kind").isin(EDGE_TYPE, FLAGGED)
    ended = (
        judged.join(first_two_references(fks), _TABLE, "left")
        .withColumn("ref_table_1", F.when(paired, F.col("ref_table_1")))
        .withColumn("ref_table_2", F.when(paired, F.col("ref_table_2")))
    )
    for end, ref in (("edge_from", "ref_table_1"), ("edge_to", "ref_table_2")):
        names = node_types.select(F.col("node_type").alias(end), F.col("source_object").alias(ref))
        ended = ended.join(names, ref, "left")

    details = F.struct(
        "fk_count",
        "pk_count",
        "fk_in_pk",
        "total_columns",
        "attr_count",
        "ref_table_1",
        "ref_table_2",
    )
    return _candidates(
        ended.withColumn("column_name", F.lit(None).cast("string")),
        object_kind=F.col("object_kind"),
        rule_applied=F.col("rule_applied"),
        proposed_name=without_source_prefix(F.col("table_name"), prefix),
        edge_from=F.col("edge_from"),
        edge_to=F.col("edge_to"),
        raw_details=F.to_json(details),
    )


def candidate_summary(candidates: DataFrame) -> DataFrame:
    """Candidates per kind and rule."""
    return (
        candidates.groupBy("object_kind", "rule_applied")
        .agg(F.count(F.lit(1)).alias("candidates"))
        .orderBy("object_kind", "rule_applied")
    )


def table_candidates(candidates: DataFrame) -> DataFrame:
    """The table-level candidates in table order."""
    return candidates.where(F.col("column_name").isNull()).orderBy("table_name", "table_schema")


def duplicated_sources(node_types: DataFrame) -> DataFrame:
    """Sources registered for more than one node type, which would repeat candidates."""
    counted = node_types.groupBy("source_object").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def _resolved(changes: DataFrame, fks: DataFrame, node_types: DataFrame) -> DataFrame:
    """New single reference columns with the node types of both ends, null if unknown."""
    refs = fks.select(*_COLUMN, "ref_table_schema", "ref_table_name").distinct()
    rows = (
        single_columns(changes)
        .join(refs, _COLUMN)
        .withColumn("_from", source_object())
        .withColumn("_to", source_object("ref_table_schema", "ref_table_name"))
    )
    for end, ref in (("edge_from", "_from"), ("edge_to", "_to")):
        names = node_types.select(F.col("node_type").alias(end), F.col("source_object").alias(ref))
        rows = rows.join(names, ref, "left")
    return rows


def _candidates(rows: DataFrame, **values: Column) -> DataFrame:
    absent = F.lit(None).cast("string")
    ends = {"edge_from": absent, "edge_to": absent}
    named = {**ends, **values}
    plain = [c for c in _CANDIDATE if c not in named]
    return rows.select(*plain, *(c.alias(n) for n, c in named.items())).select(*_CANDIDATE)
