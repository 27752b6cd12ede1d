"""Kept counts equal a full recount after every version, and only what changed is read."""

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import kept
from weftgraph.session import local_rows
from weftgraph.sources import digests
from weftgraph.sources.digests import Tree

NODES = Tree(("node_type", "node_id"), ("name",), ("node_type",), 8, 4)
EDGES = Tree(("src", "dst"), (), (), 1, 32)
STATE = kept.presence_tree(8, 8)


def nodes_of(spark, rows):
    return local_rows(spark, rows, "node_type string, node_id string, name string")


def edges_of(spark, rows):
    return local_rows(spark, rows, "src string, dst string")


def ends_of(edges):
    weight = ["weight"] if "weight" in edges.columns else []
    sides = [edges.select(F.lit(kind).alias("node_type"), F.col(c).alias("node_id"), *weight) for kind, c in (("A", "src"), ("B", "dst"))]
    return sides[0].unionByName(sides[1])


def bag(df):
    return sorted(map(repr, df.collect()))


def test_three_versions_equal_a_recount(spark, tmp_path):
    rng = random.Random(11)
    stored = {k: str(tmp_path / k) for k in ("nodes", "edges", "state")}
    # Rows twice, nulls, and one end in a third of the edges.
    nodes = [(rng.choice("AB"), str(rng.randrange(60)), rng.choice(["x", None])) for _ in range(150)] + [("A", None, "x"), (None, "1", "x")]
    edges = [("hot" if i % 3 == 0 else str(rng.randrange(80)), str(rng.randrange(80))) for i in range(200)] + [(None, "1"), ("1", None)]
    for version in range(4):
        digests.write(nodes_of(spark, nodes), stored["nodes"], NODES)
        digests.write(edges_of(spark, edges), stored["edges"], EDGES)
        if version == 0:
            kept.keep(nodes_of(spark, nodes), ends_of(edges_of(spark, edges)), stored["state"], STATE)
        else:
            changed = digests.signed_changes(spark, stored["nodes"], NODES)
            kept.fold(changed, ends_of(digests.signed_changes(spark, stored["edges"], EDGES)), stored["state"], STATE)
        state = digests.read(spark, stored["state"], STATE)
        whole = kept.presence(nodes_of(spark, nodes), ends_of(edges_of(spark, edges)))
        assert bag(state) == bag(whole)
        for report in (kept.type_counts, kept.duplicates, kept.orphans):
            assert bag(report(state)) == bag(report(whole)) != []
        nodes = [*rng.sample(nodes, len(nodes) - 6), ("A", "hot", "x"), ("B", "fresh", None), ("B", "fresh", None)]
        edges = [*rng.sample(edges, len(edges) - 6), ("hot", "nobody"), ("hot", "nobody")]


def test_one_change_reads_and_writes_one_leaf(spark, tmp_path):
    base = str(tmp_path / "state")
    nodes = nodes_of(spark, [("A", str(i), "x") for i in range(300)])
    none = nodes.select("node_type", "node_id").limit(0)
    kept.keep(nodes, none, base, STATE)
    change = local_rows(spark, [("A", "7", 1)], "node_type string, node_id string, weight int")
    assert kept.fold(change, none, base, STATE) == 2
    first, second = (set(digests.read(spark, base, STATE, n).inputFiles()) for n in (1, 2))
    assert len({f.rsplit("/", 1)[0] for f in second - first}) == 1 and len(second & first) > 5
    assert bag(kept.duplicates(digests.read(spark, base, STATE))) == ["Row(node_type='A', node_id='7', n=2)"]
    # No change, no version; and an empty state is a state.
    assert kept.fold(change.limit(0), none, base, STATE) == 2
    gone = nodes.select("node_type", "node_id", F.lit(-1).alias("weight"))
    kept.fold(gone.unionByName(change.withColumn("weight", -F.col("weight"))), none, base, STATE)
    assert digests.read(spark, base, STATE).count() == 0


def test_a_fold_stays_inside_its_leaves(spark, tmp_path):
    base = str(tmp_path / "state")
    nodes = nodes_of(spark, [("A", str(i), "x") for i in range(50)])
    with pytest.raises(ValueError, match="no version"):
        digests.patch(nodes, base, NODES, lambda old, new: old)
    digests.write(nodes, base, NODES)
    with pytest.raises(ValueError, match="not given"):
        digests.patch(nodes.where("node_id = '1'"), base, NODES, lambda old, new: nodes)
    assert digests.read(spark, base, NODES).count() == 50
