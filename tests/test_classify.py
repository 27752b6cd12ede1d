import json
from datetime import datetime

import pytest
from pyspark.sql import types as T

from weftgraph.operators import classify, graph, profile
from weftgraph.session import local_rows
from weftgraph.sources.tables import comments_of_database
from weftgraph.specs import FkEdgeSpec, NodeSpec

TABLE = "table_schema string, table_name string"
COLUMN = f"{TABLE}, column_name string"
FK = f"{COLUMN}, ref_table_schema string, ref_table_name string"
CHANGE = f"run_id string, {COLUMN}, data_type string, change_type string"
TYPE = "node_type string, source_object string"


def changes(spark, rows):
    return local_rows(spark, [("r", "s", *r) for r in rows], CHANGE)


def fks(spark, rows):
    return local_rows(spark, [("s", t, c, "s", p) for t, c, p in rows], FK)


def types(spark, names):
    return local_rows(spark, [(n, f"s.{n}") for n in names], TYPE)


def test_column_rules(spark):
    found = changes(spark, [
        ("A", "SIZE", "int", "NEW_COLUMN"), ("A", "B_ID", "int", "NEW_COLUMN"),
        ("A", "X_CODE", "int", "NEW_COLUMN"), ("A", "OLD", None, "DROPPED_COLUMN"),
        ("A", "KIND", "text", "TYPE_CHANGED"), ("N", "SIZE", "int", "NEW_COLUMN"),
        ("N", None, None, "NEW_TABLE"),
    ])
    keys = fks(spark, [("A", "B_ID", "B"), ("A", "X_CODE", "X"), ("A", "B_ID", "B")])
    known = types(spark, ["A", "B"])
    rows = classify.classify_columns(found, keys, known).collect()
    assert sorted((r.column_name, r.object_kind, r.proposed_name, r.edge_to) for r in rows) == [
        ("B_ID", "EDGE_TYPE", "B", "B"), ("SIZE", "ATTRIBUTE", "size", None)
    ]
    lost = classify.unresolved_references(found, keys, known).collect()
    assert [(r.column_name, r.reason) for r in lost] == [("X_CODE", "TARGET_UNKNOWN")]


def test_column_with_two_targets_gives_two_candidates(spark):
    found = changes(spark, [("A", "B_ID", "int", "NEW_COLUMN")])
    keys = fks(spark, [("A", "B_ID", "B"), ("A", "B_ID", "C")])
    rows = classify.classify_references(found, keys, types(spark, ["A", "B", "C"])).collect()
    assert sorted(r.edge_to for r in rows) == ["B", "C"]


def test_table_rules(spark):
    """Every branch, the keyless table included: no key column is missing among the
    references, so it is flagged."""
    shapes = {
        # table: (references, key, further columns)
        "FEW": (["B"], ["FEW_ID"], 2),
        "OWN": (["B", "C"], ["OWN_ID"], 0),
        "PART": (["B", "C"], ["B", "D"], 0),
        "PURE": (["B", "C"], ["B", "C"], 1),
        "RICH": (["B", "C"], ["B", "C"], 2),
        "KEYLESS": (["B", "C"], [], 3),
        "TRIPLE": (["D", "B", "C"], ["D", "B", "C"], 0),
    }
    fk_rows, pk_rows, columns = [], [], []
    for table, (refs, key, more) in shapes.items():
        fk_rows += [(table, f"{r}_ID" if r in "BCD" else r, r) for r in refs]
        pk_rows += [("s", table, f"{k}_ID" if k in "BCD" else k) for k in key]
        names = {c for t, c, _ in fk_rows if t == table} | {c for _, t, c in pk_rows if t == table}
        columns += [("s", table, c) for c in names | {f"M{i}" for i in range(more)}]
    found = changes(spark, [(t, None, None, "NEW_TABLE") for t in [*shapes, "BARE"]])
    rows = classify.classify_tables(
        found, fks(spark, fk_rows), local_rows(spark, pk_rows, COLUMN),
        local_rows(spark, columns, COLUMN), types(spark, ["B", "C"]),
    ).collect()
    got = {r.table_name: r for r in rows}
    assert {t: r.rule_applied for t, r in got.items()} == {
        "FEW": "FEW_FKS", "OWN": "FKS_NOT_IDENTITY", "PART": "FKS_NOT_IDENTITY",
        "PURE": "PURE_JUNCTION", "RICH": "REIFIED_ENTITY?", "KEYLESS": "REIFIED_ENTITY?",
        "TRIPLE": "PURE_JUNCTION", "BARE": "FEW_FKS",
    }
    assert (got["OWN"].edge_from, got["OWN"].edge_to) == (None, None)
    assert "ref_table_1" not in json.loads(got["OWN"].raw_details)
    assert (got["PURE"].edge_from, got["PURE"].edge_to) == ("B", "C")
    # Only the first two references by name count.
    assert (got["TRIPLE"].edge_from, got["TRIPLE"].edge_to) == ("B", "C")
    assert json.loads(got["BARE"].raw_details)["total_columns"] == 0


def test_unknown_end_stays_null(spark):
    found = changes(spark, [("SRC_J", None, None, "NEW_TABLE")])
    keys = fks(spark, [("SRC_J", "A_ID", "A"), ("SRC_J", "B_ID", "B")])
    pks = local_rows(spark, [("s", "SRC_J", "A_ID"), ("s", "SRC_J", "B_ID")], COLUMN)
    row = classify.classify_tables(found, keys, pks, pks, types(spark, ["B"])).first()
    assert (row.proposed_name, row.edge_from, row.edge_to) == ("J", None, "B")


def test_sources_of_several_types_are_found(spark):
    rows = local_rows(spark, [("A", "s.a"), ("B", "s.a"), ("C", "s.c")], TYPE)
    assert [r.source_object for r in classify.duplicated_sources(rows).collect()] == ["s.a"]


def test_profiles_with_nulls_duplicates_and_empty_tables(spark):
    tables = {
        "p": local_rows(spark, [(1, "x"), (2, "y"), (2, "y"), (None, "z")], "k int, t string"),
        "c": local_rows(spark, [(1,), (3,), (3,), (None,)], "k long"),
        "e": local_rows(spark, [], "k long"),
    }
    rows = profile.profile_uniqueness(tables, [("p", ["k"]), ("p", ["k", "t"]), ("p", ["t"]), ("e", ["k"])])
    assert sorted(map(tuple, rows.drop("key_parts").collect())) == [
        ("e", "k", 0, 0, 0, True), ("p", "k", 4, 2, 1, False),
        ("p", "k,t", 4, 2, 1, False), ("p", "t", 4, 3, 0, False),
    ]
    pairs = [profile.KeyPair("c", "k", "p", "k"), profile.KeyPair("e", "k", "p", "k")]
    found = {r.child: r for r in profile.profile_inclusion(tables, pairs).collect()}
    assert (found["c"].n_rows, found["c"].n_distinct, found["c"].n_missing_rows, found["c"].n_missing) == (3, 2, 2, 1)
    assert found["c"].inclusion == 0.5 and found["e"].inclusion is None


def test_name_pairs_strip_one_letter_only():
    def schema(*fields):
        return T.StructType([T.StructField(n, t) for n, t in fields])

    schemas = {
        "orders": schema(("o_orderkey", T.LongType()), ("o_custkey", T.IntegerType())),
        "customer": schema(("c_custkey", T.LongType()), ("doc_id", T.LongType())),
        "pages": schema(("page_id", T.LongType()), ("o_custkey", T.StringType())),
    }
    pairs = profile.candidate_key_pairs(schemas, {"customer": "c_custkey", "pages": "page_id"})
    assert pairs == [profile.KeyPair("orders", "o_custkey", "customer", "c_custkey")]


def test_inclusion_compares_in_a_common_type(spark):
    child = spark.sql("SELECT cast(v AS decimal(10,2)) AS d, cast(v AS int) AS i, cast(v AS string) AS s FROM VALUES (1.5), (2.25), (9) AS t(v)")
    parent = spark.sql("SELECT cast(v AS decimal(10,3)) AS d, cast(v AS bigint) AS i, cast(v AS string) AS s FROM VALUES (1.5), (2.25), (3) AS t(v)")
    tables = {"c": child, "p": parent}
    pairs = [profile.KeyPair("c", x, "p", y) for x, y in (("d", "d"), ("i", "i"), ("i", "d"), ("s", "s"))]
    found = {(r.child_col, r.parent_col): (r.n_distinct, r.n_missing) for r in profile.profile_inclusion(tables, pairs).collect()}
    assert found == {("d", "d"): (3, 1), ("i", "i"): (3, 1), ("i", "d"): (3, 3), ("s", "s"): (3, 1)}
    with pytest.raises(ValueError):
        profile.profile_inclusion(tables, [profile.KeyPair("c", "i", "p", "s")])


def test_keys_keep_column_names_with_commas(spark):
    table = local_rows(spark, [(1, 1), (1, 2)], "`a,b` long, c long")
    unique = profile.profile_uniqueness({"t": table}, [("t", ("a,b", "c"))])
    assert sorted(r.column_name for r in profile.primary_keys(unique, "s").collect()) == ["a,b", "c"]


def test_registry_rows_describe_types(spark):
    rows = graph.node_type_rows([NodeSpec("SEA_PORT", "s.port", ("id",))], spark, {"SEA_PORT": "where ships land"}, datetime(2024, 1, 1))
    assert [tuple(r) for r in rows.collect()] == [("SEA_PORT", "Sea Port", "where ships land", datetime(2024, 1, 1), "s.port")]
    edge = FkEdgeSpec("HAS_PORT", "s.ship", "SHIP", ("id",), "port", "SEA_PORT")
    assert graph.edge_type_rows([edge], spark).first().display_name == "Has Port"


def test_comments_of_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE quay LOCATION '{tmp_path}/quay'")
    spark.sql("CREATE TABLE quay.crane (id BIGINT COMMENT 'key', reach DOUBLE) USING parquet COMMENT 'lifts things'")
    spark.sql("CREATE TABLE quay.plain (id BIGINT) USING parquet")
    assert sorted((r.table_name, r.column_name or "", r.comment) for r in comments_of_database(spark, "quay").collect()) == [
        ("crane", "", "lifts things"), ("crane", "id", "key")
    ]
    spark.sql("DROP DATABASE quay CASCADE")
