"""Keys and references from values: against counting in Python, with odd values and hot ones."""

import itertools

import pytest

from weftgraph.operators import classify, draft, profile, references


@pytest.fixture(scope="module")
def tables(spark):
    frame = spark.createDataFrame
    return {
        "place": frame([(i, f"p{i}", float(i)) for i in range(50)], "id int, name string, size double"),
        "visit": frame(
            [(i % 50 if i % 7 else None, i % 10, f"p{i % 50}", -0.0 if i % 2 else 0.0) for i in range(400)], "place long, day short, label string, size double"
        ),
        "slot": frame([(p, d, p * 10 + d) for p in range(50) for d in range(10)], "place long, day long, no long"),
        "hot": frame([(3, "x" * 5000, None)] * 300 + [(99, "y", None)], "place int, name string, nothing long"),
        "odd": frame([(1, [1], b"b")], "id long, list array<int>, raw binary"),
    }


def _values(tables):
    out = {}
    for t, c, kind in references.compared_columns(tables):
        out[t, c, kind] = {r[0] for r in tables[t].select(c).collect() if r[0] is not None}
    return out


def _want(tables):
    values = _values(tables)
    return {
        (a[0], a[1], b[0], b[1], len(values[a])) for a, b in itertools.permutations(values, 2) if a[2] == b[2] and values[a] and values[a] <= values[b]
    }


def test_inclusions(tables):
    assert {tuple(r) for r in references.discover_inclusions(tables).collect()} == _want(tables)
    assert ("hot", "nothing") not in {r[:2] for r in _want(tables)}


def test_inclusions_over_more_columns_than_bits(spark):
    wide = spark.range(20).selectExpr(*(f"id + {i % 3} AS c{i}" for i in range(70)))
    found = references.discover_inclusions({"wide": wide})
    assert {tuple(r) for r in found.collect()} == _want({"wide": wide})


def test_nothing_to_compare_is_refused(tables):
    with pytest.raises(ValueError):
        references.discover_inclusions({"odd": tables["odd"].select("list", "raw")})
    assert references.discover_inclusions({"none": tables["place"].where("false")}).count() == 0


def test_one_shuffle_of_combined_values(tables):
    plan = references.discover_inclusions(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or") >= 1 and "Join" in plan
    text = references.discover_inclusions(tables)._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(kind") == 2  # by value, then by set of columns


def _tuples(frame, cols):
    return {r for r in map(tuple, frame.select(*cols).collect()) if None not in r}


def test_composites(tables):
    singles = references.discover_inclusions(tables)
    keys = [("slot", ("place", "day")), ("slot", ("place", "day", "no")), ("place", ("id",))]
    found = references.discover_composites(tables, singles, keys)
    want = set()
    for parent, key in keys[:2]:
        held = _tuples(tables[parent], key)
        for t, df in tables.items():
            whole = [c for table, c, kind in references.compared_columns(tables) if table == t and kind == "bigint"]
            for cols in itertools.permutations(whole, len(key)):
                own = _tuples(df, cols)
                if own and own <= held and (t, cols) != (parent, key):
                    want.add(references.CompositeReference(t, cols, parent, key))
    assert set(found) == want and len(found) == len(want)
    assert references.CompositeReference("visit", ("place", "day"), "slot", ("place", "day")) in want


def test_a_composite_reference_counts_once(spark, tables):
    found = [references.CompositeReference("visit", ("place", "day"), "slot", ("place", "day"))]
    rows = references.reference_rows(spark, found, "src")
    single = spark.createDataFrame([("src", "visit", "zone", "src", "place", None, None)], rows.schema)
    fks = rows.unionByName(single)
    ends = classify.first_two_references(fks).collect()
    assert [(r.ref_table_1, r.ref_table_2) for r in ends] == [("src.slot", "src.place")]
    types = spark.createDataFrame([("SLOT", "src.slot"), ("PLACE", "src.place")], "node_type string, source_object string")
    listed = draft.reference_lists(fks, types).collect()[0]
    assert [r.column_name for r in listed.references] == ["day,place", "zone"]
    assert {(r.column_name, r.to_type) for r in listed.ties} == {(listed.references[0].column_name, "SLOT"), ("zone", "PLACE")}


def test_a_composite_reference_is_drafted_as_one_id(spark):
    text = "proposal_id string, artifact_type string, object_kind string, type_name string, display_name string, from_type string, to_type string, owner_type string, src_column string, dst_column string, source_object string, source_column string, skip_reason string"
    plan = spark.createDataFrame([("1", draft.POPULATION_SCRIPT, "EDGE_TYPE", "E", "E", "A", "B", None, "day,place", "zone", "src.visit", None, None)], text)
    plan = plan.selectExpr("*", "array('k') AS key_columns")
    sql = draft.with_draft_text(plan).first().template_sql
    assert "cast(day as string) || '_' || cast(place as string)" in sql and "EXCEPT (day,place, zone)" in sql
    with pytest.raises(ValueError):
        draft.edge_specs([plan.first()])


def test_screened_keys_have_the_exact_verdicts(tables):
    candidates = [(t, (c,)) for t, c, _ in references.compared_columns(tables)] + [("slot", ("place", "day")), ("visit", ("place", "day"))]
    exact = {(r.table_name, r.key_columns): r for r in profile.profile_uniqueness(tables, candidates).collect()}
    found = references.screened_uniqueness(tables, candidates).collect()
    assert len(found) == len(candidates)
    for r in found:
        want = exact[r.table_name, r.key_columns]
        assert (r.is_unique, r.n_rows, r.n_null) == (want.is_unique, want.n_rows, want.n_null)
        assert r.n_distinct == (None if r.ruled_out else want.n_distinct)
    assert {(r.table_name, r.key_columns) for r in found if r.ruled_out} >= {("hot", "place"), ("visit", "day"), ("slot", "place")}
    only = references.screened_uniqueness(tables, [("hot", ("place",)), ("place", ("id",))])
    assert "nothing" not in only._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_disprove_no_true_inclusion(tables):
    parents = [("place", "id"), ("place", "name"), ("slot", "no"), ("place", "size")]
    pairs = references.pairs_of_class(tables, parents)
    left = references.undisproved(tables, pairs)
    true = {r[:4] for r in _want(tables)}
    named = {(p.child, p.child_col, p.parent, p.parent_col) for p in left}
    assert {x for x in true if x[2:] in parents} <= named and len(left) < len(pairs)
    exact = {(r.child, r.child_col, r.parent, r.parent_col): r for r in profile.profile_inclusion(tables, pairs).collect()}
    for r in references.screened_inclusion(tables, pairs).collect():
        assert r == exact[r.child, r.child_col, r.parent, r.parent_col]
    assert references.screened_inclusion(tables, [profile.KeyPair("slot", "no", "place", "id")]).count() == 0


def test_sketches_over_many_values(spark):
    """More values than a sketch keeps: the true inclusion stays, one missing value in a hundred is seen."""
    many = {"all": spark.range(60_000).toDF("v"), "some": spark.range(0, 60_000, 7).toDF("v"), "more": spark.range(0, 60_600, 3).toDF("v")}
    pairs = [profile.KeyPair(c, "v", "all", "v") for c in ("some", "more")]
    assert references.undisproved(many, pairs) == pairs[:1]


def test_only_what_sketches_leave_open_is_grouped(spark):
    """A column that no other can hold is not in the index, nor a tuple that its key lacks; tuples are read once."""
    ids = spark.range(9000)
    tables = {
        "all": ids.selectExpr("id AS p", "id % 90 AS q", "id + 1000000 AS lonely"),
        "some": ids.where("id % 3 = 0").selectExpr("id AS p", "id % 90 AS q", "cast((id * 7) % 9000 AS int) AS r"),
    }
    found = references.discover_inclusions(tables)
    assert {tuple(r) for r in found.collect()} == _want(tables)
    assert "lonely" not in found._jdf.queryExecution().optimizedPlan().toString()
    asked = [("all", ("p", "q"), "some", ("p", "q")), ("some", ("q", "p"), "all", ("q", "p")), ("all", ("p", "q"), "some", ("r", "q"))]
    classes = {(t, c): kind for t, c, kind in references.compared_columns(tables)}
    sides, pairs = references._sides(asked, classes)
    assert len(sides) == 3 and pairs[:2] == [(0, 1), (1, 0)]
    assert references._undisproved_tuples(tables, asked, classes) == asked[:1]
    assert references._included(tables, asked, classes) == asked[:1]
    keys = [("all", ("p", "q")), ("some", ("q", "p"))]
    assert references.discover_composites(tables, found, keys) == [references.CompositeReference("some", ("p", "q"), "all", ("p", "q"))]
