"""Counts, duplicates and orphans of a graph, kept up to date from changes alone.

The state has one row per id: how many node rows hold it and how many edge ends point at it. Both
are sums, so signed change rows are simply added. An id with two node rows is a duplicate, one
that is pointed at and has none is an orphan; counts per type are sums over the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.sources import digests
from weftgraph.sources.digests import Tree

_KEYS = ("node_type", "node_id")
_SUMS = ("n_nodes", "n_ends")


def presence_tree(branches: int = 64, leaves: int = 64) -> Tree:
    return Tree(_KEYS, _SUMS, ("node_type",), branches, leaves)


def presence(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """node_type, node_id, n_nodes, n_ends of two frames with node_type and node_id: node rows, and what
    edges point at, one row per end. A column ``weight`` counts a row so many times, negative in
    changes. Ids with a null part are nobody's and are left out; so are sums of zero.

    Equal ids combine inside the tasks, so an id that a third of all edges points at is a row per task.
    """

    def weighed(df: DataFrame, name: str) -> DataFrame:
        weight = F.col("weight") if "weight" in df.columns else F.lit(1)
        sums = [(weight if s == name else F.lit(0)).cast("long").alias(s) for s in _SUMS]
        return df.select(*_KEYS, *sums).dropna(subset=list(_KEYS))

    return _added(weighed(nodes, "n_nodes").unionByName(weighed(ends, "n_ends")))


def keep(nodes: DataFrame, ends: DataFrame, base: str, tree: Tree) -> int:
    """Count everything, once, and keep it as the first version of ``base``."""
    return digests.write(presence(nodes, ends), base, tree)


def fold(node_changes: DataFrame, end_changes: DataFrame, base: str, tree: Tree) -> int:
    """Add signed changes (see :func:`~weftgraph.sources.digests.signed_changes`) to what is kept, as the
    next version. Of the state only the leaves with ids that changed are read and written."""
    deltas = presence(node_changes, end_changes)
    return digests.patch(deltas, base, tree, lambda kept, new: _added(kept.unionByName(new)))


def type_counts(state: DataFrame) -> DataFrame:
    """node_type and n, its node rows; types without a node are left out."""
    return state.groupBy("node_type").agg(F.sum("n_nodes").alias("n")).where("n <> 0")


def duplicates(state: DataFrame) -> DataFrame:
    """Ids that more than one node row holds: node_type, node_id, n."""
    return state.where("n_nodes > 1").select(*_KEYS, F.col("n_nodes").alias("n"))


def orphans(state: DataFrame) -> DataFrame:
    """Ids that edges point at and no node holds: node_type, node_id, n, the ends that point there."""
    return state.where("n_nodes <= 0 and n_ends > 0").select(*_KEYS, F.col("n_ends").alias("n"))


def _added(rows: DataFrame) -> DataFrame:
    sums = [F.sum(s).alias(s) for s in _SUMS]
    return rows.groupBy(*_KEYS).agg(*sums).where("n_nodes <> 0 or n_ends <> 0")
