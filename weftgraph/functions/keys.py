"""Natural ids, hash keys and property maps, as plain ``Column`` expressions.

Keys are SHA-256 hashes of natural keys, so two executors (or a retried task) always
produce the same key, and an edge can be built from its source row alone without looking
the node up first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPE_SEPARATOR = ":"
ID_SEPARATOR = "_"


def natural_id(key_cols: Sequence[str]) -> Column:
    """The key columns as one string, in column-name order.

    Any null part makes the whole id null (``concat``, not ``concat_ws``): skipping nulls
    would let different keys meet in one id.
    """
    parts: list[Column] = []
    for name in sorted(key_cols):
        if parts:
            parts.append(F.lit(ID_SEPARATOR))
        parts.append(F.col(f"`{name}`").cast("string"))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def key_text(key_cols: Sequence[str]) -> Column:
    """What a node's surrogate key is made of: its id, but with the parts of a composite key told
    apart. A separator inside a part is escaped, so ('a_b', 'c') and ('a', 'b_c') differ although
    both show the id ``a_b_c``. Null when a part is null.
    """
    if len(key_cols) == 1:
        return natural_id(key_cols)
    parts: list[Column] = []
    for name in sorted(key_cols):
        if parts:
            parts.append(F.lit(ID_SEPARATOR))
        text = F.col(f"`{name}`").cast("string")
        for mark in ("\\", ID_SEPARATOR):
            text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
        parts.append(text)
    return F.concat(*parts)


def parts_key(*parts: Column | str) -> Column:
    """SHA-256 over any number of parts, told apart by their lengths in bytes; null is no empty text."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def node_key(node_type: Column, node_id: Column) -> Column:
    """Surrogate key of a node, from its type and :func:`key_text`; null when that is null."""
    return F.sha2(F.concat(node_type, F.lit(TYPE_SEPARATOR), node_id), 256)


def edge_key(edge_type: Column, src_sk: Column, dst_sk: Column) -> Column:
    """Surrogate key of an edge, from its type and both end points."""
    return F.sha2(F.concat_ws(TYPE_SEPARATOR, edge_type, src_sk, dst_sk), 256)


def content_key(schema: Column, table: Column, column: Column, *more: Column) -> Column:
    """SHA-256 of ``schema.table.column``; a table-level row has an empty column part.

    ``more`` appends parts such as the referenced table, so that one column holding two
    references gives two different keys. Null extra parts add nothing.
    """
    base = F.concat(schema, F.lit("."), table, F.lit("."), F.coalesce(column, F.lit("")))
    for part in more:
        base = F.concat(base, F.coalesce(F.concat(F.lit(">"), part), F.lit("")))
    return F.sha2(base, 256)


def plain_text(value: Column, data_type: T.DataType) -> Column:
    """A scalar as text that does not depend on the engine: numbers without an exponent.

    Very large and very small numbers (from 1e18, below 1e-15) keep theirs.
    """
    text = value.cast("string")
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return text
    exact = text.cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(exact, "0+$", ""), r"\.$", ".0")
    fits = F.abs(value).between(1e-15, 1e18)
    return F.when(F.contains(text, F.lit("E")) & fits, plain).otherwise(text)


def props_of(columns: Iterable[tuple[str, T.DataType]]) -> Column:
    """A ``map<string,string>`` of the given columns without their null values.

    Scalars become text as in :func:`plain_text`; nested values are written as JSON.
    """
    entries: list[Column] = []
    all_set = F.lit(True)
    for name, data_type in columns:
        value = F.col(f"`{name}`")
        nested = isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))
        entries.append(F.lit(name))
        entries.append(F.to_json(value) if nested else plain_text(value, data_type))
        all_set = all_set & value.isNotNull()
    if not entries:
        return no_props()
    whole = F.create_map(*entries)
    # Rows without nulls, usually most of them, skip the filter.
    return F.when(all_set, whole).otherwise(
        F.map_filter(whole, lambda _, value: value.isNotNull())
    )


def no_props() -> Column:
    """An empty property map."""
    return F.create_map().cast("map<string,string>")
