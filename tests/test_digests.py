"""Versions compared by digests: the same changes as a full comparison, reading what differs."""

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import detect
from weftgraph.session import local_rows
from weftgraph.sources import digests
from weftgraph.sources.digests import Tree

TREE = Tree(("grp", "name"), ("kind", "size"), ("grp",), 8, 4)
SCHEMA = "grp string, name string, kind string, size double"


def frame(spark, rows):
    return local_rows(spark, sorted(rows, key=repr), SCHEMA)


def snapshot(rng, groups=40):
    """One group holds a third of the rows; keys and values hold nulls and empty texts."""
    rows = {(rng.choice([f"g{i}" for i in range(groups)] + [None, ""]), f"c{i}"): (rng.choice("xy") if i % 5 else None, float(i % 3)) for i in range(400)}
    rows |= {("hot", f"c{i}"): ("x", None) for i in range(200)}
    return rows | {("hot", None): (None, None), (None, "hot"): ("x", 1.0)}


def as_rows(state):
    return [(*k, *v) for k, v in state.items()]


def files(df):
    return {f.split("/leaves/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "state")


def test_changes_equal_a_full_comparison(spark, base):
    rng = random.Random(5)
    was = snapshot(rng)
    digests.write(frame(spark, as_rows(was)), base, TREE)
    for _ in range(3):
        now = dict(was)
        for key in rng.sample(sorted(was, key=repr), 12):
            del now[key]
        for key in rng.sample(sorted(now, key=repr), 12):
            now[key] = (rng.choice(["x", "z", None]), rng.choice([0.0, None]))
        now |= {("hot", f"new{rng.random()}"): ("n", 1.0), ("fresh", "a"): (None, None)}
        digests.write(frame(spark, as_rows(now)), base, TREE)
        full = detect.snapshot_diff(frame(spark, as_rows(now)), frame(spark, as_rows(was)), TREE.keys, TREE.values)
        found = digests.changes(spark, base, TREE)
        assert found.columns == full.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, full.collect())) != []
        assert sorted(map(repr, digests.read(spark, base, TREE).collect())) == sorted(map(repr, frame(spark, as_rows(now)).collect()))
        was = now


def test_only_leaves_that_differ_are_read_and_written(spark, base):
    was = snapshot(random.Random(6))
    digests.write(frame(spark, as_rows(was)), base, TREE)
    now = was | {("hot", "c7"): ("changed", None)}
    digests.write(frame(spark, as_rows(now)), base, TREE)
    found = digests.changes(spark, base, TREE)
    assert [tuple(r) for r in found.collect()] == [("hot", "c7", "changed", None, detect.TYPE_CHANGED)]
    # The leaf before and after, of 36 folders or so.
    assert len(files(found)) == 2 and len({f.split("/")[1] for f in files(found)}) == 1
    first, second = (digests.read(spark, base, TREE, n) for n in (1, 2))
    assert len(files(second) - files(first)) == 1 and len(files(second)) == len(files(first)) > 20
    assert "PythonRDD" not in found._jdf.queryExecution().toString()


def test_equal_versions_read_nothing(spark, base):
    rows = as_rows(snapshot(random.Random(7)))
    digests.write(frame(spark, rows), base, TREE)
    digests.write(frame(spark, rows[::-1]).repartition(5), base, TREE)
    found = digests.changes(spark, base, TREE)
    assert found.inputFiles() == [] and found.count() == 0


def test_rows_and_their_number_count(spark, base):
    """Two copies of one row are not two copies of another; a null is not an empty text or its neighbour's place."""
    tree = Tree(("name",), ("kind", "size"), (), 1, 1)
    states = [
        [("g", "a", "x", 1.0)] * 2,
        [("g", "a", "y", 1.0)] * 2,
        [("g", "a", "y", 1.0)] * 3,
        [("g", "a", None, 1.0)] * 3,
        [("g", "a", "", 1.0)] * 3,
    ]
    for rows in states:
        digests.write(frame(spark, rows), base, tree)
    for number in range(2, len(states) + 1):
        assert digests.changes(spark, base, tree, number, number - 1).inputFiles()


def test_empty_versions_and_the_first_one(spark, base):
    rows = as_rows(snapshot(random.Random(8)))
    digests.write(frame(spark, rows), base, TREE)
    assert digests.changes(spark, base, TREE).where(F.col("change_type") == detect.NEW_COLUMN).count() == len(rows)
    digests.write(frame(spark, []), base, TREE)
    assert digests.changes(spark, base, TREE).where(F.col("change_type") == detect.DROPPED_COLUMN).count() == len(rows)
    assert digests.read(spark, base, TREE).count() == 0
    digests.write(frame(spark, []), base, TREE)
    assert digests.changes(spark, base, TREE).count() == 0
    assert digests.changes(spark, base, TREE, 2, 1).count() == len(rows)


def test_refresh_keeps_what_is_out_of_scope(spark, base):
    was = snapshot(random.Random(9))
    digests.write(frame(spark, as_rows(was)), base, TREE)
    scope = F.col("grp") == "hot"
    digests.refresh(frame(spark, [("hot", "only", "x", 1.0)]), base, TREE, scope)
    kept = {k: v for k, v in was.items() if k[0] != "hot"} | {("hot", "only"): ("x", 1.0)}
    assert sorted(map(repr, digests.read(spark, base, TREE).collect())) == sorted(map(repr, frame(spark, as_rows(kept)).collect()))
    first, second = (files(digests.read(spark, base, TREE, n)) for n in (1, 2))
    # One branch of eight was in scope.
    assert len(second - first) <= 4 < len(second & first)


def test_another_tree_and_unknown_versions_are_refused(spark, base):
    with pytest.raises(ValueError, match="no version"):
        digests.read(spark, base, TREE)
    digests.write(frame(spark, [("g", "a", "x", 1.0)]), base, TREE)
    with pytest.raises(ValueError, match="another tree"):
        digests.changes(spark, base, Tree(TREE.keys, TREE.values, TREE.group, 8, 8))
    with pytest.raises(ValueError, match="made of keys"):
        Tree(("a",), ("b",), ("b",))
    with pytest.raises(ValueError, match="name folders"):
        Tree(("a",), ("digest_leaf",))
