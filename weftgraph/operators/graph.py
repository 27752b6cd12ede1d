"""Build and read a property graph held in two frames, ``nodes`` and ``edges``.

nodes: node_sk, node_id, node_type, props, source_object, load_ts
edges: edge_sk, edge_type, src_sk, dst_sk, src_type, src_id, dst_type, dst_id, props,
       source_object, load_ts

Edges carry the natural ids of both ends. An edge is therefore built from its own source
row, and reading edges back as views or triples needs no join with the nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.keys import (
    TYPE_SEPARATOR,
    edge_key,
    key_text,
    natural_id,
    no_props,
    node_key,
    props_of,
)
from weftgraph.functions.sets import absent_keys
from weftgraph.functions.text import KEY_SUFFIX, without_key_suffix
from weftgraph.session import local_rows
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec

BOTH_ENDS = ("src", "dst")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name. Pairs are joined level by level: the plan of many frames
    then stays shallow, and each is analysed a few times only."""
    level = list(frames)
    while len(level) > 1:
        pairs = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


# ---------------------------------------------------------------- building


def build_nodes(df: DataFrame, spec: NodeSpec, load_ts: Column | None = None) -> DataFrame:
    """One node per source row; every non-key column becomes a property.

    Several key columns give a reified node whose id joins them in name order. Rows with a
    null key part have no identity and are left out.
    """
    _require(df, spec.key_cols, spec.source)
    keys = set(spec.key_cols)
    props = props_of((f.name, f.dataType) for f in df.schema.fields if f.name not in keys)
    node_id = natural_id(spec.key_cols)
    return df.where(node_id.isNotNull()).select(
        node_key(F.lit(spec.node_type), key_text(spec.key_cols)).alias("node_sk"),
        node_id.alias("node_id"),
        F.lit(spec.node_type).alias("node_type"),
        props.alias("props"),
        F.lit(spec.source).alias("source_object"),
        _stamp(load_ts).alias("load_ts"),
    )


def build_fk_edges(
    df: DataFrame,
    spec: FkEdgeSpec,
    nodes: DataFrame | None = None,
    check: Sequence[str] = BOTH_ENDS,
    load_ts: Column | None = None,
) -> DataFrame:
    """One edge per source row with a non-null reference.

    The source's surrogate key is made from its key columns; the target is known by its id alone,
    so the reference to a composite key has to hold that key's text (``key_text``).

    ``check`` names the ends that must exist in ``nodes`` (the meaning of an inner join
    with the node table). An end known to exist needs no check and costs no shuffle: the
    source end when ``df`` is the very table the nodes were built from, the target end
    when the reference was profiled as complete.
    """
    _require(df, (*spec.key_cols, spec.fk_col), spec.source)
    ends = df.select(
        natural_id(spec.key_cols).alias("src_id"),
        key_text(spec.key_cols).alias("_src_key"),
        F.col(f"`{spec.fk_col}`").cast("string").alias("dst_id"),
        no_props().alias("props"),
    )
    return _edges_from_ends(
        ends, spec.edge_type, spec.from_type, spec.to_type, spec.source, nodes, check, load_ts
    )


def build_junction_edges(
    df: DataFrame,
    spec: JunctionEdgeSpec,
    nodes: DataFrame | None = None,
    check: Sequence[str] = BOTH_ENDS,
    load_ts: Column | None = None,
) -> DataFrame:
    """One edge per junction row; its other columns become edge properties."""
    _require(df, (spec.from_col, spec.to_col), spec.source)
    own = [f for f in df.schema.fields if f.name not in (spec.from_col, spec.to_col)]
    ends = df.select(
        F.col(f"`{spec.from_col}`").cast("string").alias("src_id"),
        F.col(f"`{spec.to_col}`").cast("string").alias("dst_id"),
        props_of((f.name, f.dataType) for f in own).alias("props"),
    )
    return _edges_from_ends(
        ends, spec.edge_type, spec.from_type, spec.to_type, spec.source, nodes, check, load_ts
    )


def bundled_edge_specs(
    node: NodeSpec, references: Mapping[str, str | None], suffix: str = KEY_SUFFIX
) -> list[FkEdgeSpec]:
    """Edge specs tying a table promoted to a node to everything it references.

    ``references`` maps a reference column to the node type it points at; ``None`` marks a
    target that is not a known type, which gives no edge.
    """
    specs = []
    for fk_col in sorted(references):
        to_type = references[fk_col]
        if to_type is not None:
            name = f"{node.node_type}_{re.sub(suffix, '', fk_col)}"
            specs.append(
                FkEdgeSpec(name, node.source, node.node_type, node.key_cols, fk_col, to_type)
            )
    return specs


def build_bundled_edges(
    df: DataFrame,
    node: NodeSpec,
    references: Mapping[str, str | None],
    nodes: DataFrame | None = None,
    check: Sequence[str] = BOTH_ENDS,
    suffix: str = KEY_SUFFIX,
    load_ts: Column | None = None,
) -> DataFrame | None:
    """All edges of :func:`bundled_edge_specs`; ``None`` when no target is known."""
    specs = bundled_edge_specs(node, references, suffix)
    if not specs:
        return None
    return union_all(build_fk_edges(df, spec, nodes, check, load_ts) for spec in specs)


def known_nodes(rows: DataFrame, nodes: DataFrame, node_type: str, id_col: str) -> DataFrame:
    """Keep the rows whose ``id_col`` names an existing node of the type.

    A semi join on the natural id alone: nothing but ids is shuffled from the node side,
    and duplicates among the nodes never multiply the rows. A target with very many
    referring rows is split at run time (a semi join's left side can be split by AQE).
    """
    ids = nodes.where(F.col("node_type") == node_type).select(F.col("node_id").alias(id_col))
    return rows.join(ids, id_col, "left_semi")


def _edges_from_ends(
    ends: DataFrame,
    edge_type: str,
    from_type: str,
    to_type: str,
    source: str,
    nodes: DataFrame | None,
    check: Sequence[str],
    load_ts: Column | None,
) -> DataFrame:
    kept = ends.where(F.col("src_id").isNotNull() & F.col("dst_id").isNotNull())
    if nodes is not None:
        if "src" in check:
            kept = known_nodes(kept, nodes, from_type, "src_id")
        if "dst" in check:
            kept = known_nodes(kept, nodes, to_type, "dst_id")
    src_sk = node_key(F.lit(from_type), F.col("_src_key" if "_src_key" in ends.columns else "src_id"))
    dst_sk = node_key(F.lit(to_type), F.col("dst_id"))
    return kept.select(
        edge_key(F.lit(edge_type), src_sk, dst_sk).alias("edge_sk"),
        F.lit(edge_type).alias("edge_type"),
        src_sk.alias("src_sk"),
        dst_sk.alias("dst_sk"),
        F.lit(from_type).alias("src_type"),
        "src_id",
        F.lit(to_type).alias("dst_type"),
        "dst_id",
        "props",
        F.lit(source).alias("source_object"),
        _stamp(load_ts).alias("load_ts"),
    )


# ---------------------------------------------------------------- reading


def with_endpoints(
    edges: DataFrame, nodes: DataFrame, ends: tuple[str, str] | None = None
) -> DataFrame:
    """Add the natural ids to edges that hold surrogate keys only; orphans drop out.

    ``ends`` names the two node types, where the edges are of one edge type: only nodes of these
    types are then read and shuffled.
    """
    bare = edges.drop("src_type", "src_id", "dst_type", "dst_id")
    for number, end in enumerate(BOTH_ENDS):
        typed = nodes if ends is None else nodes.where(F.col("node_type") == ends[number])
        ids = typed.select(
            F.col("node_sk").alias(f"{end}_sk"),
            F.col("node_type").alias(f"{end}_type"),
            F.col("node_id").alias(f"{end}_id"),
        )
        bare = bare.join(ids, f"{end}_sk")
    return bare


def attribute_triples(nodes: DataFrame) -> DataFrame:
    """One (subject, predicate, object) row per stored property."""
    return nodes.select(
        F.concat("node_type", F.lit(TYPE_SEPARATOR), "node_id").alias("subject"),
        F.explode("props").alias("predicate", "object"),
        F.lit("ATTRIBUTE").alias("triple_kind"),
    )


def edge_triples(edges: DataFrame) -> DataFrame:
    """One (source node, edge type, target node) row per edge."""
    return edges.select(
        F.concat("src_type", F.lit(TYPE_SEPARATOR), "src_id").alias("subject"),
        F.col("edge_type").alias("predicate"),
        F.concat("dst_type", F.lit(TYPE_SEPARATOR), "dst_id").alias("object"),
        F.lit("EDGE").alias("triple_kind"),
    )


def triples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Attribute and edge triples together, duplicates kept."""
    return attribute_triples(nodes).unionByName(edge_triples(edges))


def node_view(
    nodes: DataFrame,
    node_type: str,
    props: Mapping[str, str] | None = None,
    id_name: str = "node_id",
) -> DataFrame:
    """The nodes of one type; ``props`` maps property names to the type to read them as."""
    typed = nodes.where(F.col("node_type") == node_type)
    if props is None:
        return typed.select("node_sk", F.col("node_id").alias(id_name), "props")
    return typed.select(
        "node_sk",
        F.col("node_id").alias(id_name),
        *(F.col("props").getItem(name).cast(kind).alias(name) for name, kind in props.items()),
    )


def edge_view(
    edges: DataFrame,
    edge_type: str,
    src_name: str = "src_id",
    dst_name: str = "dst_id",
    nodes: DataFrame | None = None,
    ends: tuple[str, str] | None = None,
) -> DataFrame:
    """The edges of one type with both natural ids under business names.

    Passing ``nodes`` joins both ends again, for edges that were stored without natural
    ids or without an existence check; ``ends`` is the edge type's two node types.
    """
    typed = edges.where(F.col("edge_type") == edge_type)
    if nodes is not None:
        typed = with_endpoints(typed, nodes, ends)
    return typed.select(
        "edge_sk",
        F.col("src_id").alias(src_name),
        F.col("dst_id").alias(dst_name),
        "props",
    )


def register_views(
    nodes: DataFrame, edges: DataFrame, node_types: Iterable[str], edge_types: Iterable[str]
) -> list[str]:
    """Temporary views: one per node type and edge type, and one of all triples."""
    names = []
    for kinds, view in ((node_types, node_view), (edge_types, edge_view)):
        frame = nodes if view is node_view else edges
        for kind in kinds:
            name = f"v_{kind.lower()}"
            view(frame, kind).createOrReplaceTempView(name)
            names.append(name)
    triples(nodes, edges).createOrReplaceTempView("v_triples")
    return [*names, "v_triples"]


# ---------------------------------------------------------------- types and checks


def _registry_columns(
    name: str, descriptions: Mapping[str, str] | None, created: datetime | None
) -> tuple[str, str | None, datetime]:
    shown = " ".join(word.capitalize() for word in name.split("_"))
    return shown, (descriptions or {}).get(name), created or datetime.now()


def node_type_rows(
    specs: Sequence[NodeSpec],
    spark,
    descriptions: Mapping[str, str] | None = None,
    created: datetime | None = None,
) -> DataFrame:
    """Registry rows (node_type, display_name, description, created_ts, source_object) of the specs."""
    rows = [(s.node_type, *_registry_columns(s.node_type, descriptions, created), s.source) for s in specs]
    return local_rows(
        spark,
        rows,
        "node_type string, display_name string, description string, created_ts timestamp_ntz, source_object string",
    )


def edge_type_rows(
    specs: Sequence[FkEdgeSpec | JunctionEdgeSpec],
    spark,
    descriptions: Mapping[str, str] | None = None,
    created: datetime | None = None,
) -> DataFrame:
    """Registry rows (edge_type, display_name, description, created_ts, from_node_type, to_node_type,
    source_object) of the specs."""
    return local_rows(
        spark,
        [
            (s.edge_type, *_registry_columns(s.edge_type, descriptions, created), s.from_type, s.to_type, s.source)
            for s in specs
        ],
        "edge_type string, display_name string, description string, created_ts timestamp_ntz, "
        "from_node_type string, to_node_type string, source_object string",
    )


def insert_missing(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], prefer: str | None = None
) -> DataFrame:
    """``existing`` plus the ``new`` rows whose key it lacks; existing rows always win.

    ``new`` is reduced to one row per key: the one with the smallest ``prefer`` value, or
    any of them when no column is named. The reduction combines before the shuffle.
    """
    return existing.unionByName(missing_rows(existing, new, keys, prefer))


def missing_rows(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], prefer: str | None = None
) -> DataFrame:
    """The rows :func:`insert_missing` would add."""
    keys = list(keys)
    return one_per_key(new, keys, prefer).join(existing.select(*keys), keys, "left_anti")


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: str | None = None) -> DataFrame:
    """One row per key, the smallest by ``prefer`` when it is given."""
    keys = list(keys)
    if prefer is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.col(prefer)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def type_counts(df: DataFrame, type_col: str, out: str = "n") -> DataFrame:
    """Rows per type, in type order."""
    return df.groupBy(type_col).agg(F.count(F.lit(1)).alias(out)).orderBy(type_col)


def orphan_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges with a missing source or target node, each once.

    The end points are first reduced to the missing keys (a hub shrinks to one row per task
    before any shuffle); only these are then matched with the edges.
    """
    flagged = edges
    for end in BOTH_ENDS:
        keys = _end_keys(edges, end)
        missing = _missing_ends(edges, nodes, end).withColumn(f"_no_{end}", F.lit(True))
        flagged = flagged.join(missing, keys, "left")
    bad = F.col("_no_src").isNotNull() | F.col("_no_dst").isNotNull()
    return flagged.where(bad).select(*edges.columns)


def orphan_count(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: the number of orphan edges."""
    return orphan_edges(edges, nodes).agg(F.count(F.lit(1)).alias("orphans"))


def _end_keys(edges: DataFrame, end: str) -> list[str]:
    """The natural key of an end where edges carry it (shorter), else the hash key."""
    natural = [f"{end}_type", f"{end}_id"]
    return natural if set(natural) <= set(edges.columns) else [f"{end}_sk"]


def _missing_ends(edges: DataFrame, nodes: DataFrame, end: str) -> DataFrame:
    keys = _end_keys(edges, end)
    there = nodes.select(*(F.col(k.replace(f"{end}_", "node_")).alias(k) for k in keys))
    return absent_keys(edges, there, keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """The keys held by more than one row; on nodes, (node_type, node_id)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


# ---------------------------------------------------------------- shared


def _stamp(load_ts: Column | None) -> Column:
    return F.localtimestamp() if load_ts is None else load_ts


def _require(df: DataFrame, names: Sequence[str], source: str) -> None:
    gone = [n for n in names if n not in df.columns]
    if gone:
        raise ValueError(f"{source} has no column {', '.join(gone)}")
