"""The operators at work on the star-schema tables: one query per key.

Every query reads whole tables. Where an operator needs an input the tables do not have
(an earlier snapshot, proposals, decisions), it is derived from their rows, so that its
size follows theirs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.keys import content_key
from weftgraph.operators import classify, decide, detect, draft, graph, kept, profile, references, review
from weftgraph.plans.cycle import run_cycle
from weftgraph.session import configure, cut_lineage, new_dir
from weftgraph.sources import digests
from weftgraph.sources.digests import Tree
from weftgraph.sources.tables import (
    Tables,
    catalog_snapshot,
    observed_catalog,
    row_counts,
)
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec, ScopeRule
from weftgraph.streaming.first_seen import track_first_seen

Query = Callable[[Tables], DataFrame]

# Partitions that the shuffles of the largest sorts begin with; Spark joins them again by size. Up to 200 (its
# bypassMergeThreshold) rows go to their partitions' files as they come, and the writing task holds none.
FIRST_PARTITIONS = 200

SCHEMA = "src"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

NODES = [
    NodeSpec("REGION", "src.region", ("r_regionkey",)),
    NodeSpec("NATION", "src.nation", ("n_nationkey",)),
    NodeSpec("CUSTOMER", "src.customer", ("c_custkey",)),
    NodeSpec("SUPPLIER", "src.supplier", ("s_suppkey",)),
    NodeSpec("PART", "src.part", ("p_partkey",)),
    NodeSpec("ORDERS", "src.orders", ("o_orderkey",)),
]
FK_EDGES = [
    FkEdgeSpec("NATION_IN_REGION", "src.nation", "NATION", ("n_nationkey",), "n_regionkey", "REGION"),
    FkEdgeSpec(
        "CUSTOMER_HAS_NATION", "src.customer", "CUSTOMER", ("c_custkey",), "c_nationkey", "NATION"
    ),
    FkEdgeSpec(
        "SUPPLIER_HAS_NATION", "src.supplier", "SUPPLIER", ("s_suppkey",), "s_nationkey", "NATION"
    ),
    FkEdgeSpec("ORDER_HAS_CUSTOMER", "src.orders", "ORDERS", ("o_orderkey",), "o_custkey", "CUSTOMER"),
]
SUPPLIES = JunctionEdgeSpec(
    "PART_FROM_SUPPLIER", "src.part_supplier", "PART", "l_partkey", "SUPPLIER", "l_suppkey"
)
SELF_EDGE = FkEdgeSpec(
    "CUSTOMER_REFERRED_BY",
    "src.customer_ref",
    "CUSTOMER",
    ("c_custkey",),
    "ref_custkey",
    "CUSTOMER",
)
SUPPLY_NODE = NodeSpec("SUPPLY", "src.part_supplier_stats", ("l_partkey", "l_suppkey"))

SINGLE_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "labels": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
}
WATERMARK = datetime(1996, 1, 1)


# ---------------------------------------------------------------- inputs


def _source(spec: NodeSpec | FkEdgeSpec) -> str:
    return spec.source.split(".")[1]


def _nodes(t: Tables, types: list[NodeSpec] = NODES) -> DataFrame:
    t.all(_source(s) for s in types)
    return graph.union_all(
        graph.build_nodes(t[_source(s)], s) for s in types
    )


def _fk_edges(t: Tables, specs: list[FkEdgeSpec] = FK_EDGES) -> DataFrame:
    """Edges whose target exists. The source end is the row the node is built from."""
    targets = {s.node_type: s for s in NODES}
    return graph.union_all(
        graph.build_fk_edges(
            t[_source(s)], s, _nodes(t, [targets[s.to_type]]), ["dst"]
        )
        for s in specs
    )


def part_supplier(t: Tables) -> DataFrame:
    """Distinct (part, supplier) pairs with the quantity ordered."""
    return (
        t["lineitem"]
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum("l_quantity").cast("long").alias("quantity"))
    )


def part_supplier_stats(t: Tables) -> DataFrame:
    """The pairs with three measures of their own."""
    return (
        t["lineitem"]
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum("l_quantity").cast("long").alias("quantity"),
            F.count(F.lit(1)).alias("n_lines"),
            F.min("l_shipdate").cast("date").alias("first_ship"),
        )
    )


def order_line(t: Tables) -> DataFrame:
    """Lines unique on (order, line number)."""
    return (
        t["lineitem"]
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_partkey").alias("l_partkey"), F.max("l_suppkey").alias("l_suppkey"))
    )


def customer_ref(t: Tables) -> DataFrame:
    """Customers with a reference to the one before them; the first has none."""
    ref = F.when(F.col("c_custkey") > 0, F.col("c_custkey") - 1)
    return t["customer"].withColumn("ref_custkey", ref)


def _as_text(name: str) -> Column:
    return F.col(name).cast("string")


def _remainder(name: str, by: int) -> Column:
    return F.col(name) % F.lit(by)


# ---------------------------------------------------------------- graph


def kg_nodes(t: Tables) -> DataFrame:
    return _nodes(t).select(
        "node_type", "node_id", "source_object", F.size("props").cast("long").alias("n_props")
    )


def kg_node_sk(t: Tables) -> DataFrame:
    return _nodes(t).select("node_type", "node_id", "node_sk")


def kg_fk_edges(t: Tables) -> DataFrame:
    return _fk_edges(t).select("edge_type", "src_id", "dst_id")


def kg_junction_edges(t: Tables) -> DataFrame:
    nodes = _nodes(t, [s for s in NODES if s.node_type in ("PART", "SUPPLIER")])
    return graph.build_junction_edges(part_supplier(t), SUPPLIES, nodes).select(
        "edge_type", "src_id", "dst_id", F.col("props")["quantity"].alias("quantity")
    )


def kg_self_edges(t: Tables) -> DataFrame:
    nodes = _nodes(t, [s for s in NODES if s.node_type == "CUSTOMER"])
    return graph.build_fk_edges(customer_ref(t), SELF_EDGE, nodes, ["dst"]).select(
        "edge_type", "src_type", "src_id", "dst_type", "dst_id"
    )


def kg_reified_nodes(t: Tables) -> DataFrame:
    return graph.node_view(
        graph.build_nodes(part_supplier_stats(t), SUPPLY_NODE),
        "SUPPLY",
        {"quantity": "bigint", "n_lines": "bigint", "first_ship": "date"},
    ).drop("node_sk")


def kg_bundled_edges(t: Tables) -> DataFrame:
    nodes = _nodes(t, [s for s in NODES if s.node_type in ("PART", "SUPPLIER")])
    references = {"l_partkey": "PART", "l_suppkey": "SUPPLIER", "first_ship": None}
    return graph.build_bundled_edges(
        part_supplier_stats(t), SUPPLY_NODE, references, nodes, ["dst"], suffix="key$"
    ).select("edge_type", "src_id", "dst_type", "dst_id")


def kg_attribute_triples(t: Tables) -> DataFrame:
    return graph.attribute_triples(_nodes(t))


def kg_triples(t: Tables) -> DataFrame:
    return graph.triples(_nodes(t), _fk_edges(t))


def kg_node_view(t: Tables) -> DataFrame:
    props = {"c_name": "string", "c_mktsegment": "string", "c_nationkey": "int"}
    return graph.node_view(_nodes(t), "CUSTOMER", props, "customer_id").drop("node_sk")


def kg_edge_view(t: Tables) -> DataFrame:
    return graph.edge_view(
        _fk_edges(t), "ORDER_HAS_CUSTOMER", "order_id", "customer_id"
    ).select("order_id", "customer_id")


def kg_edge_view_by_key(t: Tables) -> DataFrame:
    """The same view from edges that hold surrogate keys only."""
    stored = _fk_edges(t).drop("src_type", "src_id", "dst_type", "dst_id")
    return graph.edge_view(
        stored, "CUSTOMER_HAS_NATION", "customer_id", "nation_id", _nodes(t), ("CUSTOMER", "NATION")
    ).select("customer_id", "nation_id")


def kg_orders_per_nation(t: Tables) -> DataFrame:
    """Two edge types followed one after the other.

    Orders are counted per customer before anything is joined, so a customer with very many
    orders is one row by then. The join with the customers' own edges is the existence
    check, so the order edges need none of their own.
    """
    by_type = {e.edge_type: e for e in FK_EDGES}
    orders = graph.build_fk_edges(t["orders"], by_type["ORDER_HAS_CUSTOMER"])
    customers = _fk_edges(t, [by_type["CUSTOMER_HAS_NATION"]])
    ordered = graph.edge_view(orders, "ORDER_HAS_CUSTOMER", "order_id", "customer_id")
    lives = graph.edge_view(customers, "CUSTOMER_HAS_NATION", "customer_id", "nation_id")
    per_customer = ordered.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(lives.select("customer_id", "nation_id"), "customer_id")
        .groupBy("nation_id")
        .agg(F.sum("n").alias("orders"))
    )


def kg_type_counts(t: Tables) -> DataFrame:
    """Registered types with their rows; a type registered twice stays once."""
    node_types = graph.node_type_rows(NODES, t.spark)
    edge_types = graph.edge_type_rows(FK_EDGES, t.spark)
    first = node_types.where(F.col("node_type").isin("REGION", "NATION"))
    registered = graph.insert_missing(first, node_types, ["node_type"])
    nodes = registered.join(graph.type_counts(_nodes(t), "node_type"), "node_type", "left")
    edges = edge_types.join(
        graph.type_counts(_fk_edges(t), "edge_type"), "edge_type", "left"
    )
    absent = F.lit(None).cast("string")
    return nodes.select(
        F.col("node_type").alias("type_name"),
        absent.alias("from_type"),
        absent.alias("to_type"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).unionByName(
        edges.select(
            F.col("edge_type").alias("type_name"),
            F.col("from_node_type").alias("from_type"),
            F.col("to_node_type").alias("to_type"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def _unchecked_supplies(t: Tables) -> tuple[DataFrame, DataFrame]:
    edges = graph.build_junction_edges(part_supplier(t), SUPPLIES)
    by_type = {s.node_type: s for s in NODES}
    small = t["part"].where("p_size <= 25")
    nodes = graph.build_nodes(small, by_type["PART"]).unionByName(
        graph.build_nodes(t["supplier"], by_type["SUPPLIER"])
    )
    return edges, nodes


def kg_orphans(t: Tables) -> DataFrame:
    return graph.orphan_count(*_unchecked_supplies(t))


def kg_orphan_edges(t: Tables) -> DataFrame:
    return graph.orphan_edges(*_unchecked_supplies(t)).select("src_id", "dst_id")


def kg_duplicate_keys(t: Tables) -> DataFrame:
    spec = NodeSpec("LINE", "src.lineitem", ("l_orderkey", "l_linenumber"))
    nodes = graph.build_nodes(t["lineitem"], spec)
    return graph.duplicate_keys(nodes, ["node_type", "node_id"])


def kept_orphans(t: Tables) -> DataFrame:
    """Customers that orders name and no row holds, kept from the changes between two versions of both tables."""
    base = new_dir(t.spark, "kept")
    customers = Tree(("c_custkey",), (), (), 1, 16)
    orders = Tree(("o_custkey", "o_orderkey"), (), (), 1, 16)
    state = kept.presence_tree(1, 16)
    kind = F.lit("CUSTOMER").alias("node_type")
    nodes = lambda rows: rows.select(kind, F.col("c_custkey").cast("string").alias("node_id"), *rows.columns[1:])
    ends = lambda rows: rows.select(kind, F.col("o_custkey").cast("string").alias("node_id"), *rows.columns[2:])
    was = t["customer"].select("c_custkey"), t["orders"].select("o_custkey", "o_orderkey")
    now = was[0].where(_remainder("c_custkey", 10) != 3), was[1].where(_remainder("o_orderkey", 7) != 0)
    for customer, order in (was, now):
        digests.write(customer, f"{base}/customer", customers)
        digests.write(order, f"{base}/orders", orders)
    kept.keep(nodes(was[0]), ends(was[1]), f"{base}/state", state)
    gone = digests.signed_changes(t.spark, f"{base}/customer", customers)
    cancelled = digests.signed_changes(t.spark, f"{base}/orders", orders)
    kept.fold(nodes(gone), ends(cancelled), f"{base}/state", state)
    return kept.orphans(digests.read(t.spark, f"{base}/state", state))


def insert_missing(t: Tables) -> DataFrame:
    rows = t["customer"].select("c_custkey", "c_name")
    existing = rows.where(_remainder("c_custkey", 2) == 0).withColumn("origin", F.lit("existing"))
    new = rows.withColumn("origin", F.lit("new"))
    again = rows.withColumn("origin", F.lit("newer"))
    return graph.insert_missing(existing, new.unionByName(again), ["c_custkey"], "origin")


# ---------------------------------------------------------------- detection


def scope_filter(t: Tables) -> DataFrame:
    rules = [ScopeRule("INCLUDE", "src1%", "%"), ScopeRule("EXCLUDE", "%", "fr")]
    documents = t["documents"].select("doc_id", "source", "lang")
    return detect.in_scope(documents, rules, "source", "lang")


def scope_rules(t: Tables) -> DataFrame:
    """The same with a frame of rules, as many as there are suppliers."""
    key = F.col("s_suppkey")
    rules = t["supplier"].select(
        F.when(key % 3 == 0, "EXCLUDE").otherwise("INCLUDE").alias("filter_type"),
        F.concat(F.lit("src"), (key % 13).cast("string"), F.when(key % 2 == 0, "%").otherwise("_")).alias(
            "schema_pattern"
        ),
        F.when(key % 3 == 0, "_r").otherwise("%").alias("table_pattern"),
    )
    documents = t["documents"].select("doc_id", "source", "lang")
    return detect.in_scope(documents, rules, "source", "lang")


def scope_inner_rules(t: Tables) -> DataFrame:
    """Customers by name, under rules that know only a part of the name or of the segment, one per supplier."""
    key = F.col("s_suppkey")
    digits = key.cast("string")
    inside = F.when(key % 3 == 0, F.concat(F.lit("%"), digits, F.lit("_")))
    rules = t["supplier"].select(
        F.when(key % 4 == 0, "EXCLUDE").otherwise("INCLUDE").alias("filter_type"),
        F.when(key % 5 == 0, F.concat(F.lit("%"), F.right("s_name", F.lit(1)), F.lit("%"))).when(key % 9 == 1, "%UIL%").otherwise("%").alias("schema_pattern"),
        inside.otherwise(F.concat(F.lit("%0"), digits, F.lit("%"))).alias("table_pattern"),
    )
    return detect.in_scope(t["customer"].select("c_custkey", "c_mktsegment", "c_name"), rules, "c_mktsegment", "c_name")


def _order_snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(current, previous): orders grouped by customer, with the status as the value."""
    rows = t["orders"].select("o_custkey", "o_orderkey", "o_orderstatus")
    current = rows.where(_remainder("o_orderkey", 11) != 0)
    touched = F.when(_remainder("o_orderkey", 7) == 0, "X").otherwise(F.col("o_orderstatus"))
    previous = rows.where(_remainder("o_orderkey", 10) != 0).withColumn("o_orderstatus", touched)
    return current, previous


def snapshot_diff(t: Tables) -> DataFrame:
    return detect.snapshot_diff(
        *_order_snapshots(t), ["o_custkey", "o_orderkey"], ["o_orderstatus"]
    )


def stored_changes(t: Tables) -> DataFrame:
    """Two stored versions of all orders, which differ for every fortieth customer; compared by digests."""
    tree = Tree(("o_custkey", "o_orderkey"), ("o_orderstatus",), ("o_custkey",), branches=64, leaves=2)
    base = new_dir(t.spark, "orders")
    now = t["orders"].select("o_custkey", "o_orderkey", "o_orderstatus")
    some, third = _remainder("o_custkey", 40) == 0, _remainder("o_orderkey", 3)
    status = F.when(some & (third == 1), "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    was = now.where(~some | (third != 0)).select("o_custkey", "o_orderkey", status)
    digests.write(was, base, tree)
    digests.write(now.where(~some | (third != 2)), base, tree)
    return digests.changes(t.spark, base, tree)


def _early_orders(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t["orders"].select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"
    )
    before = F.col("o_orderdate") < F.lit(WATERMARK).cast("timestamp_ntz")
    return rows.drop("o_orderdate"), rows.where(before).drop("o_orderdate")


def new_groups(t: Tables) -> DataFrame:
    return detect.new_groups(*_early_orders(t), ["o_custkey"])


def diff_demoted(t: Tables) -> DataFrame:
    return detect.detect_changes(
        *_early_orders(t), ["o_custkey"], "o_orderkey", ["o_orderstatus"]
    )


def fingerprint_refresh(t: Tables) -> DataFrame:
    current, previous = _order_snapshots(t)
    scope = _remainder("o_custkey", 2) == 0
    return detect.refreshed(previous, current.where(scope), scope)


def _order_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(children, parents): orders under customers, with created and deleted times."""
    orders = t["orders"].select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    shipped = (
        t["lineitem"]
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    children = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").select(
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
        F.col("o_orderdate").alias("created"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("deleted"),
    )
    parents = (
        orders.groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("created"))
        .withColumn("deleted", F.lit(None).cast("timestamp_ntz"))
    )
    return children, parents


def changes_since(t: Tables) -> DataFrame:
    children, parents = _order_history(t)
    keep = ["o_custkey", "o_orderkey", "o_orderstatus"]
    return detect.changes_since(children, parents, "o_custkey", WATERMARK, keep)


def new_since(t: Tables) -> DataFrame:
    _, parents = _order_history(t)
    return detect.new_since(parents, WATERMARK, ["o_custkey"])


def next_watermark(t: Tables) -> DataFrame:
    return detect.next_watermark(_order_history(t), WATERMARK, overlap_seconds=3600)


def _event_runs(t: Tables) -> DataFrame:
    events = t["events"].select("ts")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("ts").alias("detected_ts")
    )


def latest_run(t: Tables) -> DataFrame:
    return detect.run_summary(_event_runs(t))


def catalog_columns(t: Tables) -> DataFrame:
    tables = t.all(TABLES)
    place = ["table_schema", "table_name"]
    columns = detect.members_per_group(catalog_snapshot(tables, SCHEMA), place, "n_columns")
    return columns.join(row_counts(tables, SCHEMA), place).drop("table_schema")


def observed_keys(t: Tables) -> DataFrame:
    return observed_catalog(t["events"], "props", ["event_type"])


def observed_changes(t: Tables) -> DataFrame:
    """The catalog seen in the rows compared with that of an earlier part of the rows."""
    early = (F.col("event_type") != "error") & (F.col("event_id") % 3 != 0)
    now = observed_catalog(t["events"], "props", ["event_type"])
    was = observed_catalog(t["events"].where(early), "props", ["event_type"]).where(
        F.col("event_type") != "click"
    )
    return detect.detect_changes(now, was, ["event_type"], "json_key", ["json_type"])


# ---------------------------------------------------------------- keys


_MORE_KEYS = [
    ("conversations", ("conv_id", "turn")),
    ("lineitem", ("l_orderkey", "l_linenumber")),
]
_BASE_KEYS = [*((t, (c,)) for t, c in SINGLE_KEYS.items()), *_MORE_KEYS]
_DERIVED_KEYS = [
    ("part_supplier", ("l_partkey", "l_suppkey")),
    ("part_supplier_stats", ("l_partkey", "l_suppkey")),
    ("order_line", ("l_linenumber", "l_orderkey")),
]


def _key_pairs(tables: dict[str, DataFrame]) -> list[profile.KeyPair]:
    named = profile.candidate_key_pairs({t: df.schema for t, df in tables.items()}, SINGLE_KEYS)
    return [*named, profile.KeyPair("events", "user_id", "customer", "c_custkey")]


def key_uniqueness(t: Tables) -> DataFrame:
    tables = t.all(TABLES)
    more = [
        ("lineitem", ("l_partkey", "l_suppkey")),
        ("orders", ("o_custkey",)),
        ("customer", ("c_name",)),
    ]
    return profile.profile_uniqueness(tables, [*_BASE_KEYS, *more]).drop("key_parts")


def key_inclusion(t: Tables) -> DataFrame:
    tables = t.all(TABLES)
    return profile.profile_inclusion(tables, _key_pairs(tables))


def _profiled(
    t: Tables, derived: bool
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(tables, primary keys, foreign keys), the keys found in the data."""
    tables = t.all(TABLES)
    keys = list(_BASE_KEYS)
    if derived:
        # Aggregates of the largest table: computed once, then read by every profile branch.
        stats = cut_lineage(part_supplier_stats(t))
        tables["part_supplier_stats"] = stats
        # The pair table without measures has the junction shape.
        tables["part_supplier"] = stats.select("l_partkey", "l_suppkey")
        tables["order_line"] = cut_lineage(order_line(t))
        keys += _DERIVED_KEYS
    unique = cut_lineage(profile.profile_uniqueness(tables, keys))
    inclusion = profile.profile_inclusion(tables, _key_pairs(tables))
    # One row per key or reference. Written once, since many joins read them.
    pks = profile.primary_keys(unique, SCHEMA)
    fks = cut_lineage(profile.foreign_keys(inclusion, unique, SCHEMA))
    return tables, pks, fks


def found_inclusions(t: Tables) -> DataFrame:
    """Every pair of columns of all tables of which one holds all values of the other."""
    return references.discover_inclusions(t.all(TABLES))


def _with_pairs(t: Tables) -> dict[str, DataFrame]:
    """All tables and the two with composite keys that lineitem gives."""
    stats = cut_lineage(part_supplier_stats(t))
    pairs = {"part_supplier": stats.select("l_partkey", "l_suppkey"), "order_line": cut_lineage(order_line(t))}
    return t.all(TABLES) | pairs


def _composites(t: Tables) -> list[references.CompositeReference]:
    # Every value of every column still in question is grouped.
    configure(t.spark, FIRST_PARTITIONS)
    tables = _with_pairs(t)
    singles = references.discover_inclusions(tables)
    keys = [*_MORE_KEYS, *(k for k in _DERIVED_KEYS if k[0] in tables)]
    return references.discover_composites(tables, singles, keys)


def composite_references(t: Tables) -> DataFrame:
    """References to whole composite keys, one row per reference."""
    rows = references.reference_rows(t.spark, _composites(t), SCHEMA)
    return classify.whole_references(rows).select("table_name", F.col("column_name").alias("columns"), "ref_table_name", "ref_name")


def screened_keys(t: Tables) -> DataFrame:
    """Which columns, and which pairs of columns, identify the rows of their table."""
    tables = t.all(TABLES)
    candidates = [(table, (c,)) for table, c, _ in references.compared_columns(tables)]
    candidates += [*_MORE_KEYS, ("lineitem", ("l_partkey", "l_suppkey")), ("orders", ("o_custkey", "o_orderdate"))]
    return references.screened_uniqueness(tables, candidates).select("table_name", "key_columns", "n_rows", "n_null", "is_unique")


def screened_references(t: Tables) -> DataFrame:
    """Columns whose values all occur in a one-column key, names aside."""
    tables = t.all(TABLES)
    pairs = references.pairs_of_class(tables, list(SINGLE_KEYS.items()))
    found = references.screened_inclusion(tables, pairs)
    return found.where("n_distinct > 0 AND n_missing = 0").select("child", "child_col", "parent", "parent_col", "n_rows", "n_distinct")


# ---------------------------------------------------------------- classification


def _new_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Every column of every table, as new in one run."""
    return catalog_snapshot(tables, SCHEMA).select(
        F.lit("run-1").alias("run_id"),
        "table_schema",
        "table_name",
        "column_name",
        "data_type",
        F.lit(detect.NEW_COLUMN).alias("change_type"),
    )


def classify_columns(t: Tables) -> DataFrame:
    tables, _, fks = _profiled(t, derived=False)
    types = graph.node_type_rows(NODES, t.spark)
    return classify.classify_columns(_new_columns(tables), fks, types, suffix="key$").select(
        "table_name",
        "column_name",
        "object_kind",
        "rule_applied",
        "proposed_name",
        "edge_from",
        "edge_to",
    )


def unresolved_references(t: Tables) -> DataFrame:
    tables, _, fks = _profiled(t, derived=False)
    types = graph.node_type_rows(NODES, t.spark)
    return classify.unresolved_references(_new_columns(tables), fks, types).select(
        "table_name", "column_name", "ref_table_name", "reason"
    )


def _new_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return catalog_snapshot(tables, SCHEMA).select(
        F.lit("run-1").alias("run_id"),
        "table_schema",
        "table_name",
        F.lit(detect.NEW_TABLE).alias("change_type"),
    ).distinct()


def table_shapes(t: Tables) -> DataFrame:
    tables, pks, fks = _profiled(t, derived=True)
    columns = catalog_snapshot(tables, SCHEMA)
    new = columns.select("table_schema", "table_name").distinct()
    return classify.table_shapes(new, fks, pks, columns).drop("table_schema")


def classify_tables(t: Tables) -> DataFrame:
    tables, pks, fks = _profiled(t, derived=True)
    candidates = classify.classify_tables(
        _new_tables(tables),
        fks,
        pks,
        catalog_snapshot(tables, SCHEMA),
        graph.node_type_rows(NODES, t.spark),
        prefix="^part_",
    )
    return classify.table_candidates(candidates).select(
        "table_name", "object_kind", "rule_applied", "proposed_name", "edge_from", "edge_to"
    )


def candidate_summary(t: Tables) -> DataFrame:
    tables, pks, fks = _profiled(t, derived=True)
    types = graph.node_type_rows(NODES, t.spark)
    rows = classify.classify_tables(
        _new_tables(tables), fks, pks, catalog_snapshot(tables, SCHEMA), types
    )
    return classify.candidate_summary(rows)


# ---------------------------------------------------------------- review


def _order_candidates(t: Tables) -> DataFrame:
    """One candidate per order: schema = priority, table = customer, column = order."""
    orders = t["orders"]
    kinds = F.element_at(
        F.array(*(F.lit(k) for k in review.KINDS)), (_remainder("o_orderkey", 4) + 1).cast("int")
    )
    rows = orders.select(
        _as_text("o_orderkey").alias("candidate_id"),
        F.lit("run-1").alias("run_id"),
        F.col("o_orderpriority").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
        F.concat(F.lit("o"), _as_text("o_orderkey")).alias("column_name"),
        kinds.alias("object_kind"),
        F.lit(classify.FK_TO_EDGE).alias("rule_applied"),
        F.concat(F.lit("ORDER_"), F.col("o_orderstatus")).alias("proposed_name"),
        F.lit("ORDERS").alias("edge_from"),
        F.when(_remainder("o_orderkey", 5) != 0, F.lit("CUSTOMER")).alias("edge_to"),
        F.lit(None).cast("string").alias("raw_details"),
    )
    return review.as_candidates(rows)


def _prompts(t: Tables) -> DataFrame:
    orders, customers = (t[name] for name in ("orders", "customer"))
    place = orders.select(
        F.col("o_orderpriority").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
        F.concat(F.lit("o"), _as_text("o_orderkey")).alias("column_name"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("comment"),
    ).where(_remainder("o_orderkey", 3) == 0)
    # Only one of the priorities has table comments.
    about = customers.select(
        F.lit("5-LOW").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("c_custkey")).alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("comment"),
    )
    return review.build_prompts(_order_candidates(t), place.unionByName(about), "wholesale")


def review_prompts(t: Tables) -> DataFrame:
    return _prompts(t).select("candidate_id", F.sha2("prompt", 256).alias("prompt_hash"))


def hook_answers(t: Tables) -> DataFrame:
    """Every prompt through the hook for a caller's reviewer, here one that goes by its length."""

    def by_length(prompts):
        answer = '{"agrees_with_rule":%s,"recommended_object_kind":"EDGE_TYPE","confidence":%s,"rationale":"prompt of %d characters","industry_note":""}'
        return [answer % (str(n % 2 == 0).lower(), n % 128 / 128, n) for n in prompts.str.len()]

    parsed = review.parse_responses(review.score_prompts(_prompts(t), by_length))
    return parsed.select("candidate_id", "ai_agrees_with_rule", "ai_recommended_kind", "ai_confidence", "ai_rationale")


def review_scores(t: Tables) -> DataFrame:
    """References judged on evidence: share of values found, uniqueness of the target."""
    tables = t.all(TABLES)
    pairs = [*_key_pairs(tables), profile.KeyPair("events", "user_id", "orders", "o_custkey")]
    inclusion = profile.profile_inclusion(tables, pairs)
    keys = sorted({(p.parent, (p.parent_col,)) for p in pairs})
    unique = profile.profile_uniqueness(tables, keys).select(
        F.col("table_name").alias("parent"),
        F.col("key_columns").alias("parent_col"),
        (F.col("n_distinct") / F.col("n_rows")).alias("uniqueness"),
    )
    rows = inclusion.join(unique, ["parent", "parent_col"]).select(
        F.lit("run-1").alias("run_id"),
        F.lit(SCHEMA).alias("table_schema"),
        F.col("child").alias("table_name"),
        F.col("child_col").alias("column_name"),
        F.lit(classify.EDGE_TYPE).alias("object_kind"),
        F.lit(classify.FK_TO_EDGE).alias("rule_applied"),
        F.concat_ws(".", "parent", "parent_col").alias("edge_to"),
        "inclusion",
        "uniqueness",
    )
    candidates = review.as_candidates(rows)
    parsed = review.parse_responses(review.evidence_responses(candidates))
    return review.write_back(candidates, parsed).select(
        "table_name",
        "column_name",
        "edge_to",
        "ai_recommended_kind",
        "ai_agrees_with_rule",
        F.round("ai_confidence", 6).alias("confidence"),
        review.confidence_band(F.col("ai_confidence")).alias("band"),
    )


def _event_answers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(candidates, responses) from events: some answers are out of range, of an unknown
    kind or cut off, and some candidates have an opinion already."""
    events = t["events"].select("event_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = (
        F.when(F.col("event_type") == "click", "ATTRIBUTE")
        .when(F.col("event_type") == "view", "EDGE_TYPE")
        .when(F.col("event_type") == "purchase", "NODE_TYPE")
        .when(F.col("event_type") == "signup", "FLAGGED")
        .otherwise("OTHER")
    )
    answer = F.to_json(
        F.struct(
            (_remainder("event_id", 2) == 0).alias("agrees_with_rule"),
            kind.alias("recommended_object_kind"),
            (k / F.lit(64.0)).alias("confidence"),
            F.col("event_type").alias("rationale"),
            F.lit("").alias("industry_note"),
        )
    )
    response = F.when(_remainder("event_id", 13) == 0, F.substring(answer, 1, 20)).otherwise(answer)
    responses = events.select(_as_text("event_id").alias("candidate_id"), response.alias("response"))
    had = _remainder("event_id", 5) == 0
    candidates = events.select(
        _as_text("event_id").alias("candidate_id"),
        F.when(had, True).alias("ai_agrees_with_rule"),
        F.when(had, F.lit("ATTRIBUTE")).alias("ai_recommended_kind"),
        F.when(had, F.lit(0.25)).alias("ai_confidence"),
        F.when(had, F.lit("earlier")).alias("ai_rationale"),
        F.when(had, F.lit("")).alias("ai_industry_note"),
    )
    return candidates, responses


def review_parse(t: Tables) -> DataFrame:
    candidates, responses = _event_answers(t)
    return review.write_back(candidates, review.parse_responses(responses)).drop(
        "ai_industry_note"
    )


def review_rejects(t: Tables) -> DataFrame:
    _, responses = _event_answers(t)
    rejected = review.rejected_responses(review.parse_responses(responses))
    return rejected.select("candidate_id", F.length("response").cast("long").alias("n_chars"))


# ---------------------------------------------------------------- proposals


def review_listing(t: Tables) -> DataFrame:
    """Rule beside opinion, the opinions being those of half of the candidates."""
    candidates = _order_candidates(t)
    number = F.col("candidate_id").cast("long")
    answers = candidates.where(number % 2 == 0).select(
        "candidate_id",
        F.to_json(
            F.struct(
                (number % 3 == 0).alias("agrees_with_rule"),
                F.lit("NODE_TYPE").alias("recommended_object_kind"),
                F.lit(0.75).alias("confidence"),
                F.col("table_name").alias("rationale"),
                F.lit("none").alias("industry_note"),
            )
        ).alias("response"),
    )
    return review.review_listing(review.write_back(candidates, review.parse_responses(answers)))


def confidence_bands(t: Tables) -> DataFrame:
    """Valid answers per band."""
    _, responses = _event_answers(t)
    band = review.confidence_band(F.col("ai_confidence")).alias("band")
    valid = review.parse_responses(responses).where("is_valid")
    return valid.groupBy(band).agg(F.count(F.lit(1)).alias("n"))


def fingerprints(t: Tables) -> DataFrame:
    return t["orders"].select(
        "o_orderkey",
        content_key(
            F.col("o_orderpriority"), _as_text("o_custkey"), _as_text("o_orderkey")
        ).alias("fingerprint_key"),
    )


def _order_changes(t: Tables) -> DataFrame:
    return t["orders"].select(
        F.lit("run-1").alias("run_id"),
        F.col("o_orderpriority").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
        F.concat(F.lit("o"), _as_text("o_orderkey")).alias("column_name"),
        F.col("o_orderdate").alias("detected_ts"),
    )


def _order_proposals(t: Tables) -> DataFrame:
    """Every order as a proposal, pending."""
    opinion = F.when(F.col("object_kind") == classify.FLAGGED, F.lit("NODE_TYPE"))
    candidates = _order_candidates(t).withColumn("ai_recommended_kind", opinion)
    return review.to_proposals(candidates, _order_changes(t))


def persist_dedup(t: Tables) -> DataFrame:
    candidates = _order_candidates(t)
    number = F.col("candidate_id").cast("long")
    again = candidates.where(number % 5 == 0).withColumn(
        "candidate_id", F.concat(F.lit("x"), "candidate_id")
    )
    statuses = F.array(*(F.lit(s) for s in ("PENDING", "APPROVED", "REJECTED", "DEFERRED")))
    existing = candidates.where(number % 3 == 0).select(
        review.fingerprint().alias("fingerprint_key"),
        F.element_at(statuses, (number % 4 + 1).cast("int")).alias("status"),
    )
    added = review.new_proposals(
        candidates.unionByName(again), _order_changes(t), existing
    )
    return added.select(
        "fingerprint_key",
        F.get_json_object("source_object", "$.candidate_id").alias("candidate_id"),
        "object_kind",
        "final_object_kind",
        "final_name",
        "status",
        "detected_ts",
    )


def pending_queue(t: Tables) -> DataFrame:
    number = F.substring(F.get_json_object("source_object", "$.column_name"), 2, 20).cast("long")
    status = F.when(number % 4 == 0, "APPROVED").when(number % 4 == 1, "DEFERRED")
    proposals = _order_proposals(t).withColumn(
        "status", F.coalesce(status, F.col("status"))
    )
    return review.pending_queue(proposals).select(
        "table_schema",
        "table_name",
        "column_name",
        "final_name",
        "final_object_kind",
        "rule_object_kind",
        "edge_from",
        "edge_to",
        "detected_ts",
    )


# ---------------------------------------------------------------- decisions


def _decision_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(proposals, decisions, artifacts): three decisions on every order, made so that all
    checks fire, and some on orders that do not exist."""
    # Whole decisions are sorted and joined by proposal, so that what a task holds follows its partition.
    configure(t.spark, FIRST_PARTITIONS)
    orders = t["orders"].select("o_orderkey", "o_orderdate", "o_orderstatus")

    def pick(values: list[str | None], number: Column) -> Column:
        listed = F.array(*(F.lit(v).cast("string") for v in values))
        return F.element_at(listed, (number % len(values) + 1).cast("int"))

    key = F.col("o_orderkey")
    proposals = orders.select(
        _as_text("o_orderkey").alias("proposal_id"),
        pick(["PENDING", "PENDING", "DEFERRED", "APPROVED", "PENDING", None], key).alias("status"),
        F.concat(F.lit("name_"), F.col("o_orderstatus")).alias("final_name"),
        pick(["EDGE_TYPE", "FLAGGED", "ATTRIBUTE", None], key).alias("final_object_kind"),
        F.lit(None).cast("string").alias("decided_by"),
        F.lit(None).cast("timestamp_ntz").alias("decided_ts"),
        F.lit(None).cast("string").alias("rationale"),
    )
    artifacts = orders.where(key % 9 == 0).select(_as_text("o_orderkey").alias("proposal_id"))
    mix = key * 3 + F.col("decision_seq") * 5
    unknown = F.when(key % 50 == 0, F.lit("none-")).otherwise(F.lit(""))
    decisions = orders.withColumn(
        "decision_seq", F.explode(F.array(*(F.lit(i).cast("long") for i in (1, 2, 3))))
    ).select(
        F.concat(unknown, _as_text("o_orderkey")).alias("proposal_id"),
        "decision_seq",
        pick(
            ["deferred", "APPROVED", "Deferred", "DEFERRED", "rejected", "MAYBE", "APPROVED", None],
            F.floor(mix / 2),
        ).alias("status"),
        F.concat(F.lit("reason "), _as_text("decision_seq")).alias("rationale"),
        F.when(mix % 4 == 1, F.concat(F.lit("renamed_"), _as_text("decision_seq"))).alias(
            "final_name"
        ),
        pick([None, "edge_type", None, "FLAGGED", None, "node_type", None], mix).alias("final_kind"),
        F.lit("reviewer").alias("decided_by"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("decision_seq").cast("int"))).alias(
            "decided_ts"
        ),
    )
    return proposals, decisions, artifacts


def judge_decisions(t: Tables) -> DataFrame:
    return decide.judge_decisions(*_decision_inputs(t)).select(
        "proposal_id", "decision_seq", "result"
    )


def apply_decisions(t: Tables) -> DataFrame:
    inputs = _decision_inputs(t)
    return decide.apply_decisions(inputs[0], decide.judge_decisions(*inputs))


def decision_audit(t: Tables) -> DataFrame:
    judged = decide.judge_decisions(*_decision_inputs(t))
    return decide.audit_rows(judged)


def recent_decisions(t: Tables) -> DataFrame:
    inputs = _decision_inputs(t)
    applied = decide.apply_decisions(inputs[0], decide.judge_decisions(*inputs))
    return decide.recent_decisions(applied).select("proposal_id", "status", "decided_ts")


# ---------------------------------------------------------------- drafting


def _draft_inputs(t: Tables) -> dict[str, DataFrame]:
    """Proposals from orders; tables are customers, with two key columns and two references
    each, to a nation and to a segment. Only some of the targets are node types."""
    orders = t["orders"]
    number = F.col("o_orderkey")
    kind = F.element_at(
        F.array(*(F.lit(k) for k in ("ATTRIBUTE", "EDGE_TYPE", "NODE_TYPE", "NODE_TYPE"))),
        (number % 4 + 1).cast("int"),
    )
    source = F.struct(
        F.col("o_orderpriority").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
        F.when(number % 3 != 0, F.concat(F.lit("o"), _as_text("o_orderkey"))).alias("column_name"),
    )
    proposals = orders.select(
        number.cast("string").alias("proposal_id"),
        F.when(number % 7 == 0, "PENDING").otherwise("APPROVED").alias("status"),
        F.when(number % 10 != 0, kind).alias("final_object_kind"),
        F.concat(F.lit("new_order_"), F.lower("o_orderstatus")).alias("final_name"),
        F.lit("ORDERS").alias("edge_from"),
        F.when(number % 5 != 0, F.lit("CUSTOMER")).alias("edge_to"),
        F.to_json(source).alias("source_object"),
    )
    artifacts = orders.where(number % 8 == 1).select(
        _as_text("o_orderkey").alias("proposal_id")
    )
    customers = t["customer"]
    table = [
        F.lit("5-LOW").alias("table_schema"),
        F.concat(F.lit("c"), _as_text("c_custkey")).alias("table_name"),
    ]
    pks = customers.select(
        *table,
        F.explode(
            F.array(F.concat(F.lit("k"), _as_text("c_nationkey")), F.lit("a_id"))
        ).alias("column_name"),
    )
    reference = F.array(
        F.struct(
            F.lit("nation_ID").alias("column_name"),
            F.concat(F.lit("n"), _as_text("c_nationkey")).alias("ref_table_name"),
        ),
        F.struct(
            F.lit("market_CODE").alias("column_name"),
            F.concat(F.lit("m"), F.col("c_mktsegment")).alias("ref_table_name"),
        ),
    )
    fks = (
        customers.select(*table, F.explode(reference).alias("r"))
        .select("table_schema", "table_name", "r.*")
        .withColumn("ref_table_schema", F.lit("ref"))
    )
    nations = t["nation"].where("n_nationkey < 20")
    types = nations.select(
        F.concat(F.lit("NATION_"), _as_text("n_nationkey")).alias("node_type"),
        F.concat(F.lit("ref.n"), _as_text("n_nationkey")).alias("source_object"),
    ).unionByName(
        customers.where(_remainder("c_custkey", 2) == 0).select(
            F.concat(F.lit("C"), _as_text("c_custkey")).alias("node_type"),
            F.concat(F.lit("5-LOW.c"), _as_text("c_custkey")).alias("source_object"),
        )
    )
    return {
        "proposals": proposals,
        "artifacts": artifacts,
        "pks": pks,
        "fks": fks,
        "node_types": types,
    }


def plan_work(t: Tables) -> DataFrame:
    given = _draft_inputs(t)
    return draft.pending_work(given["proposals"], given["artifacts"]).select(
        "proposal_id", "final_object_kind", "column_name", "skip_reason"
    )


def work_count(t: Tables) -> DataFrame:
    given = _draft_inputs(t)
    return draft.work_count(given["proposals"], given["artifacts"])


def _plan(t: Tables) -> DataFrame:
    given = _draft_inputs(t)
    work = draft.pending_work(given["proposals"], given["artifacts"])
    return draft.plan_changes(work, given["pks"], given["fks"], given["node_types"])


def plan_changes(t: Tables) -> DataFrame:
    return _plan(t).select(
        "proposal_id",
        "artifact_type",
        "object_kind",
        "type_name",
        "display_name",
        "owner_type",
        "from_type",
        "to_type",
        F.array_join("key_columns", ",").alias("key_columns"),
        "src_column",
        "dst_column",
        "source_object",
        "source_column",
        "skip_reason",
    )


def draft_text(t: Tables) -> DataFrame:
    drafts = draft.with_draft_text(_plan(t), "-- draft")
    return drafts.select(
        "proposal_id", "artifact_type", "type_name", F.sha2("template_sql", 256).alias("text_hash")
    )


def attach_descriptions(t: Tables) -> DataFrame:
    """Drafts and descriptions from orders, the latter with quotes, dollars and line breaks."""
    orders = t["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    name = F.concat(F.lit("T"), key.cast("string"))
    is_view = key % 3 == 0
    is_load = key % 3 == 1
    kind = F.when(key % 2 == 0, "NODE_TYPE").otherwise("EDGE_TYPE")
    sentence = draft.view_sentence(kind, name)
    artifacts = orders.select(
        key.cast("string").alias("artifact_id"),
        F.when(is_view, draft.VIEW_DDL)
        .when(is_load, draft.POPULATION_SCRIPT)
        .otherwise(draft.NODE_TYPE_DDL)
        .alias("artifact_type"),
        kind.alias("object_kind"),
        name.alias("type_name"),
        F.when(is_view, F.concat(F.lit("VIEW '"), sentence, F.lit("' AS SELECT")))
        .when(is_load, F.lit("INSERT"))
        .otherwise(F.lit(f"VALUES ('{draft.DESCRIPTION_SLOT}')"))
        .alias("template_sql"),
        F.when(key % 5 == 0, "done before").alias("ai_refined_sql"),
        F.lit(None).cast("string").alias("ai_notes"),
    )
    text = F.concat(
        F.lit("it's $1 \\2\n for  "), F.col("o_orderpriority"), F.lit("\t"), F.col("o_orderstatus")
    )
    descriptions = orders.where(key % 7 != 0).select(
        key.cast("string").alias("artifact_id"), text.alias("description")
    )
    return draft.attach_descriptions(artifacts, descriptions).select(
        "artifact_id", "ai_refined_sql", "ai_notes"
    )


def _order_artifacts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(artifacts, proposals): orders drafted under the proposal of their customer."""
    orders = t["orders"]
    artifacts = orders.select(
        _as_text("o_orderkey").alias("artifact_id"),
        _as_text("o_custkey").alias("proposal_id"),
        F.col("o_orderpriority").alias("artifact_type"),
        F.lit("DRAFT").alias("dev_status"),
        F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('"\n')).alias("template_sql"),
        F.when(_remainder("o_orderkey", 2) == 0, "refined").alias("ai_refined_sql"),
        F.lit(None).cast("string").alias("ai_notes"),
        F.col("o_orderdate").alias("generated_ts"),
    )
    customers = t["customer"]
    source = F.struct(
        F.col("c_mktsegment").alias("table_schema"),
        F.col("c_name").alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
    )
    proposals = customers.select(
        _as_text("c_custkey").alias("proposal_id"),
        F.col("c_name").alias("final_name"),
        F.lit("NODE_TYPE").alias("final_object_kind"),
        F.lit(None).cast("string").alias("edge_from"),
        F.lit(None).cast("string").alias("edge_to"),
        F.to_json(source).alias("source_object"),
    )
    return artifacts, proposals


def description_prompts(t: Tables) -> DataFrame:
    customers = t["customer"]
    comments = customers.where(_remainder("c_custkey", 2) == 0).select(
        F.col("c_mktsegment").alias("table_schema"),
        F.col("c_name").alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.lit("nation "), _as_text("c_nationkey")).alias("comment"),
    )
    prompts = draft.description_prompts(*_order_artifacts(t), comments, "wholesale")
    return prompts.select("artifact_id", F.sha2("prompt", 256).alias("prompt_hash"))


def description_answers(t: Tables) -> DataFrame:
    """Readable descriptions among answers of which some are empty and some cut off."""
    key = F.col("event_id")
    text = F.when(key % 3 == 0, " ").otherwise(F.col("event_type"))
    answer = F.to_json(F.struct(text.alias("description")))
    response = F.when(key % 5 == 0, F.substring(answer, 1, 12)).otherwise(answer)
    answers = t["events"].select(key.cast("string").alias("artifact_id"), response.alias("response"))
    return draft.parse_descriptions(answers)


def artifact_listing(t: Tables) -> DataFrame:
    return draft.artifact_listing(*_order_artifacts(t)).select(
        "proposal_id",
        "final_name",
        "artifact_id",
        "artifact_type",
        "ai_refined_sql",
        "generated_ts",
        "proposal_latest_ts",
    )


def export_json(t: Tables) -> DataFrame:
    exported = draft.export_rows(*_order_artifacts(t))
    fields = [
        "proposal_id",
        "final_name",
        "final_object_kind",
        "edge_from",
        "edge_to",
        "table_schema",
        "table_name",
        "column_name",
        "artifact_id",
        "artifact_type",
        "dev_status",
        "template_sql",
        "ai_refined_sql",
        "ai_notes",
    ]
    parsed = F.from_json("value", ", ".join(f"{f} string" for f in fields))
    return exported.select(parsed.alias("r")).select("r.*")


# ---------------------------------------------------------------- the whole cycle


def refresh_cycle(t: Tables) -> DataFrame:
    """New proposals of one cycle over a catalog with a table per customer and a column per
    order; the baseline is what was there before 1996. Every fourth column references the
    table of an even customer, and even customers are node types."""

    def catalog(orders: DataFrame) -> DataFrame:
        return orders.select(
            F.lit(SCHEMA).alias("table_schema"),
            F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
            F.concat(F.lit("o"), _as_text("o_orderkey")).alias("column_name"),
            F.col("o_orderstatus").alias("data_type"),
        )

    now, was = _early_orders(t)
    even = F.col("o_custkey") - _remainder("o_custkey", 2)
    fks = now.where(_remainder("o_orderkey", 4) == 0).select(
        F.lit(SCHEMA).alias("table_schema"),
        F.concat(F.lit("c"), _as_text("o_custkey")).alias("table_name"),
        F.concat(F.lit("o"), _as_text("o_orderkey")).alias("column_name"),
        F.lit(SCHEMA).alias("ref_table_schema"),
        F.concat(F.lit("c"), even.cast("string")).alias("ref_table_name"),
    )
    no_keys = fks.select("table_schema", "table_name", "column_name").where(F.lit(False))
    types = t["customer"].where(_remainder("c_custkey", 2) == 0).select(
        F.concat(F.lit("C"), _as_text("c_custkey")).alias("node_type"),
        F.concat(F.lit(f"{SCHEMA}.c"), _as_text("c_custkey")).alias("source_object"),
    )
    place = catalog(now.where(_remainder("o_orderkey", 9) == 0))
    existing = place.select(
        content_key(F.col("table_schema"), F.col("table_name"), F.col("column_name")).alias(
            "fingerprint_key"
        ),
        F.lit("REJECTED").alias("status"),
    )
    rules = [ScopeRule("INCLUDE", SCHEMA, "c%"), ScopeRule("EXCLUDE", "%", "c1%")]
    cycle = run_cycle("run-1", catalog(now), catalog(was), rules, fks, no_keys, types, existing)
    return review.unpack_source(cycle.new_proposals).select(
        "table_name",
        "column_name",
        "object_kind",
        "rule_applied",
        "final_object_kind",
        "proposed_name",
        "edge_from",
        "edge_to",
        "status",
    )


# ---------------------------------------------------------------- stream


def stream_first_seen(t: Tables) -> DataFrame:
    """Events in four files, each a micro-batch over the whole range of times; so the later files
    hold late rows. First sightings of (event type, JSON key, user), with time and rows."""
    work = new_dir(t.spark, "first-seen")
    events = t["events"]
    for part in range(4):
        rows = events.where(_remainder("event_id", 4) == part)
        rows.repartition(1).write.mode("append").parquet(f"{work}/in")
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    keyed = stream.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        "user_id",
        F.explode(F.json_object_keys("props")).alias("json_key"),
    )
    keys = ["event_type", "json_key", "user_id"]
    track_first_seen(keyed, keys, "ts", f"{work}/out", f"{work}/state", compact_every=2).awaitTermination()
    seen = t.spark.read.parquet(f"{work}/out")
    return seen.select(*keys, F.col("first_seen").cast("timestamp_ntz").alias("first_seen"), "rows_in_batch", "batch")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        kg_nodes,
        kg_node_sk,
        kg_fk_edges,
        kg_junction_edges,
        kg_self_edges,
        kg_reified_nodes,
        kg_bundled_edges,
        kg_attribute_triples,
        kg_triples,
        kg_node_view,
        kg_edge_view,
        kg_edge_view_by_key,
        kg_orders_per_nation,
        kg_type_counts,
        kg_orphans,
        kg_orphan_edges,
        kg_duplicate_keys,
        kept_orphans,
        insert_missing,
        scope_filter,
        scope_rules,
        scope_inner_rules,
        snapshot_diff,
        stored_changes,
        new_groups,
        diff_demoted,
        fingerprint_refresh,
        changes_since,
        new_since,
        next_watermark,
        latest_run,
        catalog_columns,
        observed_changes,
        key_uniqueness,
        key_inclusion,
        found_inclusions,
        composite_references,
        screened_keys,
        screened_references,
        classify_columns,
        unresolved_references,
        table_shapes,
        classify_tables,
        candidate_summary,
        review_prompts,
        hook_answers,
        review_scores,
        review_parse,
        review_rejects,
        review_listing,
        confidence_bands,
        fingerprints,
        persist_dedup,
        pending_queue,
        judge_decisions,
        apply_decisions,
        decision_audit,
        recent_decisions,
        plan_work,
        work_count,
        plan_changes,
        draft_text,
        attach_descriptions,
        description_prompts,
        description_answers,
        artifact_listing,
        export_json,
        refresh_cycle,
        stream_first_seen,
    )
}
QUERIES["observed_catalog"] = observed_keys


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by key, each with the session settings applied first."""

    def prepared(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(Tables(configure(spark), sf_dir))

        run.__name__ = query.__name__
        return run

    return {name: prepared(query) for name, query in QUERIES.items()}
