"""What the plans look like, and that a key holding a third of all rows is handled."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from weftgraph.operators import decide, detect, graph, profile
from weftgraph.plans import star_schema
from weftgraph.plans.star_schema import part_supplier
from weftgraph.sources.tables import Tables
from weftgraph.specs import FkEdgeSpec, NodeSpec

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "BroadcastNestedLoopJoin")


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("key", sorted(set(star_schema.queries()) - {"stream_first_seen", "hook_answers"}))
def test_no_python_and_no_cross_products(spark, key):
    plan = plan_of(contract.queries()[key](spark, FOLDER))
    assert not [name for name in FORBIDDEN if name in plan]


def test_views_over_edges_need_no_shuffle(spark):
    t = Tables(spark, FOLDER)
    spec = FkEdgeSpec("O", "s.orders", "ORDERS", ("o_orderkey",), "o_custkey", "CUSTOMER")
    edges = graph.build_fk_edges(t["orders"], spec)
    plan = plan_of(graph.edge_view(edges, "O", "order_id", "customer_id").select("order_id"))
    assert "Exchange" not in plan and "sha2" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "IsNotNull(o_custkey)" in plan


def test_type_filter_prunes_whole_branches(spark):
    t = Tables(spark, FOLDER)
    both = graph.build_nodes(t["customer"], NodeSpec("C", "s.c", ("c_custkey",))).unionByName(
        graph.build_nodes(t["part"], NodeSpec("P", "s.p", ("p_partkey",)))
    )
    plan = plan_of(graph.node_view(both, "P", {"p_name": "string"}))
    assert "part.parquet" in plan and "customer.parquet" not in plan


def test_edge_view_by_key_reads_two_node_tables(spark):
    plan = plan_of(contract.queries()["kg_edge_view_by_key"](spark, FOLDER))
    read = {name for name in ("region", "nation", "customer", "supplier", "part", "orders") if f"{name}.parquet" in plan}
    assert read == {"nation", "customer"}


def test_scope_becomes_a_pushed_filter(spark):
    plan = plan_of(contract.queries()["scope_filter"](spark, FOLDER))
    assert "StringStartsWith(source,src1)" in plan and "text:" not in plan


def test_rule_frames_have_one_plan_of_any_length(spark):
    """The same joins for three rules and for a hundred thousand, and none is a broadcast of all rules."""
    rows = spark.range(10).select(F.lit("s").alias("table_schema"), F.col("id").cast("string").alias("table_name"))
    shapes = []
    for n in (3, 100_000):
        rules = spark.range(n).select(F.lit("INCLUDE").alias("filter_type"), F.lit("s").alias("schema_pattern"),
                                      F.concat(F.lit("a"), F.col("id").cast("string"), F.lit("%")).alias("table_pattern"))
        plan = detect.in_scope(rows, rules)._jdf.queryExecution().optimizedPlan().toString()
        shapes.append([line.strip(" :+-").split(" ")[0] for line in plan.splitlines()])
    assert shapes[0] == shapes[1]


def test_profiles_shuffle_combined_values_once(spark):
    t = Tables(spark, FOLDER)
    tables = t.all(["lineitem", "orders"])
    pair = profile.KeyPair("lineitem", "l_orderkey", "orders", "o_orderkey")
    plan = plan_of(profile.profile_inclusion(tables, [pair]))
    assert "SortMergeJoin" not in plan and "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert plan.index("partial_sum") < plan.index("Exchange hashpartitioning(no") or "partial_sum" in plan


def _with_hot_customer(spark):
    """Orders of which every third belongs to one customer, and wide enough to be split."""
    rows = spark.range(60_000, numPartitions=12).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1500).cast("long").alias("o_custkey"),
    )
    customers = spark.range(1500).select(F.col("id").alias("c_custkey"), F.lit("n").alias("name"))
    return rows, customers


def test_existence_check_splits_a_hot_target(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        orders, customers = _with_hot_customer(spark)
        nodes = graph.build_nodes(customers, NodeSpec("CUSTOMER", "s.c", ("c_custkey",)))
        spec = FkEdgeSpec("O", "s.orders", "ORDERS", ("o_orderkey",), "o_custkey", "CUSTOMER")
        edges = graph.build_fk_edges(orders, spec, nodes, ["dst"])
        # The whole rows are counted, so that nothing is pruned from the plan that runs.
        assert len(edges.select("src_id", "dst_id").collect()) == 60_000
        kept = edges.select("src_id", "dst_id")
        kept.collect()
        assert "skew=true" in plan_of(kept)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_window_over_decisions_is_placed_by_chunk(spark):
    t = Tables(spark, FOLDER)
    proposals = t["orders"].select(
        F.col("o_orderkey").cast("string").alias("proposal_id"),
        F.lit("PENDING").alias("status"),
        F.lit("FLAGGED").alias("final_object_kind"),
    )
    decisions = t["lineitem"].select(
        F.when(F.col("l_orderkey") >= 0, "1").alias("proposal_id"),
        F.monotonically_increasing_id().alias("decision_seq"),
        F.lit("DEFERRED").alias("status"),
        *(F.lit(None).cast("string").alias(c) for c in ("rationale", "final_name", "final_kind", "decided_by")),
        F.localtimestamp().alias("decided_ts"),
    )
    plan = plan_of(decide.judge_decisions(proposals, decisions, proposals.select("proposal_id")))
    assert "hashpartitioning(proposal_id#" in plan
    assert any("_chunk#" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_junction_source_is_combined_before_the_shuffle(spark):
    plan = plan_of(part_supplier(Tables(spark, FOLDER)))
    assert "partial_sum" in plan
