import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import detect
from weftgraph.session import local_rows
from weftgraph.sources.tables import catalog_of_database, observed_catalog
from weftgraph.specs import ScopeRule

SNAPSHOT = "table_schema string, table_name string, column_name string, data_type string"
GROUP = ["table_schema", "table_name"]


def snapshot(spark, rows):
    return local_rows(spark, [("s", *r) for r in rows], SNAPSHOT)


def test_scope_underscore_is_a_wildcard_and_exclude_wins(spark):
    rows = snapshot(spark, [("SRC_A", "c", "t"), ("SRCXB", "c", "t"), ("SRC_OLD", "c", "t"), ("Z", "c", "t")])
    rules = [ScopeRule("INCLUDE", "%", "SRC_%"), ScopeRule("EXCLUDE", "s", "%OLD")]
    kept = detect.in_scope(rows, rules)
    assert sorted(r.table_name for r in kept.collect()) == ["SRCXB", "SRC_A"]
    frame = local_rows(
        spark,
        [(r.filter_type, r.schema_pattern, r.table_pattern) for r in rules],
        "filter_type string, schema_pattern string, table_pattern string",
    )
    assert sorted(r.table_name for r in detect.in_scope(rows, frame).collect()) == ["SRCXB", "SRC_A"]


RULES = "filter_type string, schema_pattern string, table_pattern string"


def test_rule_frames_of_every_kind_agree_with_the_filter(spark):
    """Patterns with and without literal starts and ends, in either place, and null ones."""
    tables = ["SRC_A", "SRCXB", "old_SRC", "a%b", "a_b", "axb", "", "Z", "mid_x_mid", "x"]
    names = [(s, t, "c", "t") for s in ("s", "src", "rc", "") for t in tables] + [(None, "Z", "c", "t"), ("s", None, "c", "t")]
    rows = local_rows(spark, names, SNAPSHOT)
    patterns = ["%", "%x%", "SRC%", "%SRC", "SRC_A", "_", "a\\%b", "a\\_b", "%\\_b", "", "%mid%", "_x_"]
    for kind_of in (lambda i: "INCLUDE", lambda i: "EXCLUDE" if i % 2 else "include"):
        for schema in ("%", "s%", "%c", "_c", "src"):
            rules = [ScopeRule("INCLUDE", "%", "%")] * (kind_of(1) == "EXCLUDE")
            rules += [ScopeRule(kind_of(i), schema, p) for i, p in enumerate(patterns[:: 2 if schema == "_c" else 1])]
            frame = local_rows(spark, [(r.filter_type, r.schema_pattern, r.table_pattern) for r in rules]
                               + [(None, "%", "%"), ("EXCLUDE", None, "%"), ("EXCLUDE", "%", None)], RULES)
            listed = Counter(map(tuple, detect.in_scope(rows, rules).collect()))
            assert Counter(map(tuple, detect.in_scope(rows, frame).collect())) == listed


def test_null_rules_of_a_list_match_nothing(spark):
    rows = snapshot(spark, [("T", "c", "t")])
    odd = [ScopeRule(None, "%", "%"), ScopeRule("EXCLUDE", None, "%"), ScopeRule("EXCLUDE", "%", None)]
    assert detect.in_scope(rows, [*odd, ScopeRule("INCLUDE", "%", "%")]).count() == 1
    assert detect.in_scope(rows, odd).count() == 0


def test_open_rules_meet_names_in_parts(spark):
    """Rules without a literal are dealt out: no part sees all names."""
    rows = spark.range(3000).select(F.lit("s").alias("table_schema"), F.format_string("t%05d", "id").alias("table_name"))
    rules = spark.range(200).select(F.lit("INCLUDE").alias("filter_type"), F.lit("%").alias("schema_pattern"),
                                    F.format_string("%%%02d%%", "id").alias("table_pattern"))
    wanted = rows.where(" or ".join(f"table_name like '%{i:02d}%'" for i in range(200))).count()
    assert detect.in_scope(rows, rules).count() == wanted


def test_rules_with_literals_inside_agree_with_the_filter(spark):
    """Literals of one to many characters inside either pattern, repeated grams, escapes and rules twice."""
    words = ["", "a", "ab", "aaa", "aaaa", "zebra", "a_b", "a%b", "abcabc", "xabcx", "größe", "𝒳y", "x.y", "\\z"]
    rows = local_rows(spark, [(s, t, "c", "t") for s in words for t in words], SNAPSHOT)
    patterns = ["%a%", "%aa%", "%aaa%", "%ebr%", "_ab%", "%a\\_b%", "%\\%%", "%bca_%", "_röß_", "%𝒳%", "%.%", "%\\\\z%", "%abc%x%", "%none%"]
    for part in range(5):
        some = patterns[part::5]
        excluded = [("%", p) for p in some] + [(p, "%") for p in some[1:]] + [("%a%", "%b%")] * (part == 0) + [(some[0], "%ab%")] * 2
        rules = [ScopeRule("INCLUDE", "%", "%"), *(ScopeRule("EXCLUDE", *e) for e in excluded)]
        for given in (rules, [ScopeRule("INCLUDE", *e) for e in excluded]):
            frame = local_rows(spark, [(r.filter_type, r.schema_pattern, r.table_pattern) for r in given], RULES)
            listed = Counter(map(tuple, detect.in_scope(rows, given).collect()))
            assert Counter(map(tuple, detect.in_scope(rows, frame).collect())) == listed, some


def test_a_name_meets_only_rules_that_share_a_rare_gram(spark):
    """20,000 names and 2,000 rules ``%x%``: few of the 40 million pairs are compared, and none is lost."""
    names = spark.range(20_000).select(F.lit("s").alias("table_schema"), F.concat(F.lit("tab_"), F.md5(F.col("id").cast("string")), F.lit("_v1")).alias("table_name"))
    rules = spark.range(2_000).select(F.lit("INCLUDE").alias("filter_type"), F.lit("%").alias("schema_pattern"),
                                      F.concat(F.lit("%"), F.substring(F.md5(F.col("id").cast("string")), 9, 12), F.lit("%_v1%")).alias("table_pattern"))
    columns = {"schema_pattern": "table_schema", "table_pattern": "table_name"}
    keyed, wanted = detect._keyed_names_and_rules(names, rules, "INCLUDE", columns)
    pairs = keyed.join(wanted, (F.col("_at") == F.col("_by")) & (F.col("_key") == F.col("_text"))).count()
    assert 2_000 <= pairs < 20_000 * 2_000 / 100
    assert detect.in_scope(names, rules).count() == 2_000


def test_catalog_pattern(spark):
    rows = local_rows(spark, [("db1", "s", "T"), ("db2", "s", "T"), ("db2", "s", "U")],
                      "db string, table_schema string, table_name string")
    rules = [ScopeRule("INCLUDE", "%", "%", "db_"), ScopeRule("EXCLUDE", "s", "T", "%2")]
    frame = local_rows(
        spark,
        [(r.filter_type, r.schema_pattern, r.table_pattern, r.catalog_pattern) for r in rules],
        "filter_type string, schema_pattern string, table_pattern string, catalog_pattern string",
    )
    for given in (rules, frame):
        kept = detect.in_scope(rows, given, catalog_col="db").collect()
        assert sorted(map(tuple, kept)) == [("db1", "s", "T"), ("db2", "s", "U")]


def test_catalog_of_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE lending LOCATION '{tmp_path}/lending'")
    spark.sql("CREATE TABLE lending.loan (id BIGINT COMMENT 'key', due DATE) USING parquet")
    rows = catalog_of_database(spark, "lending").collect()
    assert [tuple(r) for r in rows] == [
        ("lending", "loan", "id", "bigint", "key"), ("lending", "loan", "due", "date", None)
    ]
    spark.sql("DROP DATABASE lending CASCADE")


def test_null_names_are_out_of_scope(spark):
    rows = local_rows(spark, [(None, "T", "c", "t"), ("s", "T", "c", "t")], SNAPSHOT)
    rules = [ScopeRule("INCLUDE", "%", "%"), ScopeRule("EXCLUDE", "x", "%")]
    assert detect.in_scope(rows, rules).count() == 1


def test_diff_with_null_key_parts(spark):
    was = local_rows(spark, [("s", "T", None, "t"), (None, None, None, "t"), ("s", "U", None, "t")], SNAPSHOT)
    now = local_rows(spark, [("s", "T", None, "u"), (None, None, None, "t"), (None, "V", "c", "t")], SNAPSHOT)
    keys = [*GROUP, "column_name"]
    assert detect.snapshot_diff(was, was, keys, ["data_type"]).count() == 0
    rows = {tuple(r) for r in detect.snapshot_diff(now, was, keys, ["data_type"]).collect()}
    assert rows == {
        ("s", "T", None, "u", "TYPE_CHANGED"), (None, "V", "c", "t", "NEW_COLUMN"), ("s", "U", None, None, "DROPPED_COLUMN")
    }


def test_diff_of_a_snapshot_with_itself_is_empty(spark):
    rows = snapshot(spark, [("A", "x", "int"), ("A", "y", None)])
    assert detect.snapshot_diff(rows, rows, [*GROUP, "column_name"], ["data_type"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_applying_the_diff_gives_the_current_state(spark, seed):
    rng = random.Random(seed)

    def draw():
        keys = {(rng.choice("ABC"), rng.choice("vwxyz")) for _ in range(9)}
        return {k: rng.choice(["int", "text", None]) for k in keys}

    was, now = draw(), draw()
    frames = [snapshot(spark, [(*k, v) for k, v in d.items()]) for d in (now, was)]
    state = dict(was)
    for r in detect.snapshot_diff(*frames, [*GROUP, "column_name"], ["data_type"]).collect():
        key = (r.table_name, r.column_name)
        if r.change_type == detect.DROPPED_COLUMN:
            assert state.pop(key, "gone") != "gone" and r.data_type is None
        else:
            assert (key in was) == (r.change_type == detect.TYPE_CHANGED)
            state[key] = r.data_type
    assert state == now


def test_new_group_is_reported_as_a_whole(spark):
    was = snapshot(spark, [("A", "x", "int")])
    now = snapshot(spark, [("A", "x", "int"), ("A", "y", "int"), ("B", "x", "int"), ("B", "y", "int")])
    rows = detect.detect_changes(now, was, GROUP, "column_name", ["data_type"]).collect()
    assert sorted((r.table_name, r.column_name or "", r.change_type) for r in rows) == [
        ("A", "y", "NEW_COLUMN"),
        ("B", "", "NEW_TABLE"),
    ]


def test_dropped_table_shows_as_dropped_columns(spark):
    was = snapshot(spark, [("A", "x", "int"), ("A", "y", "int")])
    rows = detect.detect_changes(was.limit(0), was, GROUP, "column_name", ["data_type"]).collect()
    assert [r.change_type for r in rows] == ["DROPPED_COLUMN"] * 2


def test_refresh_keeps_rows_outside_the_scope(spark):
    was = snapshot(spark, [("A", "x", "int"), ("B", "x", "int")])
    now = snapshot(spark, [("A", "z", "int")])
    rows = detect.refreshed(was, now, [ScopeRule("INCLUDE", "s", "A")]).collect()
    assert sorted((r.table_name, r.column_name) for r in rows) == [("A", "z"), ("B", "x")]


def test_history_limits_are_strict_and_deletion_comes_first(spark):
    child = "table_id long, column_name string, created timestamp_ntz, deleted timestamp_ntz"
    children = local_rows(spark, [
        (1, "at", None, None), (1, "new", None, None), (1, "both", None, None),
        (1, "gone", None, None), (2, "young", None, None), (3, "dead", None, None),
    ], child)
    wm = detect.FIRST_WATERMARK.replace(year=2000)
    at, later, before = (F.lit(wm.replace(year=y)).cast("timestamp_ntz") for y in (2000, 2001, 1999))
    name = F.col("column_name")
    children = children.withColumn(
        "created", F.when(name.isin("new", "both", "young", "dead"), later).when(name == "at", at).otherwise(before)
    ).withColumn("deleted", F.when(name.isin("both", "gone"), later))
    parents = local_rows(spark, [(1,), (2,), (3,)], "table_id long").select(
        "table_id",
        F.when(F.col("table_id") == 2, later).otherwise(at).alias("created"),
        F.when(F.col("table_id") == 3, later).alias("deleted"),
    )
    rows = detect.changes_since(children, parents, "table_id", wm, ["table_id", "column_name"]).collect()
    assert {r.column_name: r.change_type for r in rows} == {
        "new": "NEW_COLUMN", "both": "DROPPED_COLUMN", "gone": "DROPPED_COLUMN"
    }
    assert [r.table_id for r in detect.new_since(parents, wm, ["table_id"]).collect()] == [2]


def test_watermark_never_moves_back(spark):
    empty = local_rows(spark, [], "created timestamp_ntz, deleted timestamp_ntz")
    wm = detect.FIRST_WATERMARK.replace(year=2000)
    assert detect.next_watermark([empty], wm).first().last_run_ts == wm
    assert detect.next_watermark([empty]).first().last_run_ts == detect.FIRST_WATERMARK


def test_latest_run(spark):
    rows = local_rows(spark, [("a", 1), ("b", 2), ("b", 3)], "run_id string, detected_ts long")
    assert detect.latest_run(rows).first().run_id == "b"
    assert detect.run_summary(rows).first() == ("b", 2)
    assert detect.run_summary(rows, "a").first() == ("a", 1)
    assert detect.run_summary(rows, "none").first() == ("none", 0)


def test_observed_types(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": [1], "d": {"e": 1}}', '{"b": null, "f": true}', "broken", None]
    rows = local_rows(spark, [("g", t) for t in texts], "g string, j string")
    found = {(r.json_key, r.json_type): r.n_rows for r in observed_catalog(rows, "j", ["g"]).collect()}
    assert found == {
        ("a", "number"): 2, ("b", "string"): 1, ("c", "array"): 1,
        ("d", "object"): 1, ("b", "null"): 1, ("f", "boolean"): 1,
    }
