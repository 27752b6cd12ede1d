from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.session import local_rows
from weftgraph.sources.tables import Tables
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec

PERSON = NodeSpec("PERSON", "s.person", ("id",))
BOSS = FkEdgeSpec("HAS_BOSS", "s.person", "PERSON", ("id",), "boss", "PERSON")


def people(spark):
    rows = [(1, "a", None), (2, None, 1), (3, "c", 9), (None, "d", 1)]
    return local_rows(spark, rows, "id long, name string, boss long")


def test_null_keys_and_null_props_are_left_out(spark):
    rows = {r.node_id: r.props for r in graph.build_nodes(people(spark), PERSON).collect()}
    assert rows == {"1": {"name": "a"}, "2": {"boss": "1"}, "3": {"name": "c", "boss": "9"}}


def test_composite_ids_follow_column_names(spark):
    df = local_rows(spark, [(1, 2, "x"), (1, None, "y")], "b long, a long, v string")
    spec = NodeSpec("PAIR", "s.pair", ("b", "a"))
    assert [r.node_id for r in graph.build_nodes(df, spec).collect()] == ["2_1"]


def test_nested_and_key_only_props(spark):
    df = local_rows(spark, [(1, [1, 2])], "id long, v array<int>")
    assert graph.build_nodes(df, PERSON).first().props == {"v": "[1,2]"}
    assert graph.build_nodes(df.select("id"), PERSON).first().props == {}


def test_self_loop_edges(spark):
    nodes = graph.build_nodes(people(spark), PERSON)
    checked = graph.build_fk_edges(people(spark), BOSS, nodes)
    assert [(r.src_id, r.dst_id) for r in checked.collect()] == [("2", "1")]
    unchecked = graph.build_fk_edges(people(spark), BOSS)
    assert sorted((r.src_id, r.dst_id) for r in unchecked.collect()) == [("2", "1"), ("3", "9")]
    row = checked.first()
    keys = {r.node_id: r.node_sk for r in nodes.collect()}
    assert (row.src_sk, row.dst_sk) == (keys["2"], keys["1"])


def test_duplicate_nodes_do_not_multiply_edges(spark):
    nodes = graph.build_nodes(people(spark), PERSON)
    assert graph.build_fk_edges(people(spark), BOSS, nodes.unionByName(nodes)).count() == 1


def test_orphan_with_both_ends_missing_counts_once(spark):
    nodes = graph.build_nodes(people(spark), PERSON)
    pairs = local_rows(spark, [(1, 2), (1, 8), (7, 2), (7, 8)], "x long, y long")
    edges = graph.build_junction_edges(pairs, JunctionEdgeSpec("E", "s.e", "PERSON", "x", "PERSON", "y"))
    for shape in (edges, edges.drop("src_type", "src_id", "dst_type", "dst_id")):
        assert graph.orphan_count(shape, nodes).first().orphans == 3


def test_views_and_registration(spark):
    nodes = graph.build_nodes(people(spark), PERSON)
    edges = graph.build_fk_edges(people(spark), BOSS, nodes)
    names = graph.register_views(nodes, edges, ["PERSON"], ["HAS_BOSS"])
    assert names == ["v_person", "v_has_boss", "v_triples"]
    assert spark.table("v_person").count() == 3
    assert spark.sql("SELECT src_id, dst_id FROM v_has_boss").collect() == [("2", "1")]
    assert spark.table("v_triples").where("triple_kind = 'EDGE'").first().object == "PERSON:1"


def test_loading_twice_changes_nothing(spark):
    nodes = graph.build_nodes(people(spark), PERSON)
    again = graph.insert_missing(nodes, nodes, ["node_type", "node_id"])
    assert again.count() == nodes.count()
    edges = graph.build_fk_edges(people(spark), BOSS, nodes)
    key = ["edge_type", "src_sk", "dst_sk"]
    assert graph.insert_missing(edges, edges, key).count() == edges.count()
    assert graph.duplicate_keys(nodes.unionByName(nodes), ["node_type", "node_id"]).count() == 3


def test_insert_missing_takes_the_preferred_row(spark):
    old = local_rows(spark, [(1, "kept")], "k long, v string")
    new = local_rows(spark, [(1, "no"), (2, "b"), (2, "a")], "k long, v string")
    rows = graph.insert_missing(old, new, ["k"], "v").collect()
    assert sorted(map(tuple, rows)) == [(1, "kept"), (2, "a")]


def test_every_edge_end_exists(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    customer = NodeSpec("CUSTOMER", "s.customer", ("c_custkey",))
    nodes = graph.build_nodes(t["customer"].where("c_custkey % 2 = 0"), customer)
    spec = FkEdgeSpec("O", "s.orders", "ORDERS", ("o_orderkey",), "o_custkey", "CUSTOMER")
    edges = graph.build_fk_edges(t["orders"], spec, nodes, ["dst"])
    assert 0 < edges.count() == t["orders"].where("o_custkey % 2 = 0").count()
    assert edges.where(F.col("dst_id").cast("long") % 2 != 0).count() == 0


def test_composite_keys_with_separators_stay_apart(spark):
    """One shown id, two nodes; edges built from the key columns name the right one."""
    rows = local_rows(spark, [("a_b", "c", 1), ("a", "b_c", 2), ("a\\", "b", 3)], "k string, l string, r long")
    nodes = {r.props["r"]: (r.node_id, r.node_sk) for r in graph.build_nodes(rows, NodeSpec("N", "s.n", ("k", "l"))).collect()}
    assert nodes["1"][0] == nodes["2"][0] == "a_b_c" and len({sk for _, sk in nodes.values()}) == 3
    edges = graph.build_fk_edges(rows, FkEdgeSpec("E", "s.n", "N", ("k", "l"), "r", "R")).collect()
    assert {e.dst_id: e.src_sk for e in edges} == {r: sk for r, (_, sk) in nodes.items()}


def test_number_text_has_no_exponent(spark):
    values = [1e7, 123456789.25, -2.5e10, 1e-5, 0.0, 12.5, 1e17, 1e300, None]
    rows = local_rows(spark, [(i, v) for i, v in enumerate(values)], "i long, v double")
    props = {r.node_id: r.props for r in graph.build_nodes(rows, NodeSpec("N", "s.n", ("i",))).collect()}
    texts = [props[str(i)].get("v") for i in range(len(values))]
    assert texts == ["10000000.0", "123456789.25", "-25000000000.0", "0.00001", "0.0", "12.5", "100000000000000000.0", "1.0E300", None]
