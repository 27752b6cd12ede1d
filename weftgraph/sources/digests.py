"""Snapshots kept with digests, so that two versions are compared without reading what is equal.

Rows are dealt into leaves by their key alone: a branch by the hash of the group columns, a leaf
of that branch by the hash of the whole key. Changes that fall into few groups meet few branches,
and a group of any size still spreads over all leaves of its branch. Every leaf is a folder of
its own, with a count and 96 bits of sums over the hashes of its rows, which do not depend on order.

A version is the list of its leaves with their digests and folders. A new version writes the
leaves that differ and names the old folders for the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.operators import detect
from weftgraph.session import local_rows
from weftgraph.sources import versions

_LEAF = "digest_leaf"
_WRITE = "digest_write"
_SUMS = ("s0", "s1", "s2", "s3")
_TABLE = "leaf int, n long, s0 long, s1 long, s2 long, s3 long, place string, fields string"
# The row of a version that describes it as a whole; leaves count from 0.
_WHOLE = -1


@dataclass(frozen=True)
class Tree:
    """What a snapshot is keyed and compared by. ``group`` names those of the keys whose rows share a
    branch (none: all rows do). A version has at most ``branches * leaves`` folders, whose list the
    driver holds."""

    keys: tuple[str, ...]
    values: tuple[str, ...]
    group: tuple[str, ...] = ()
    branches: int = 64
    leaves: int = 64

    def __post_init__(self) -> None:
        if not self.keys or set(self.group) - set(self.keys):
            raise ValueError("the group has to be made of keys")
        if {_LEAF, _WRITE} & {*self.keys, *self.values}:
            raise ValueError(f"{_LEAF} and {_WRITE} name folders")


def write(df: DataFrame, base: str, tree: Tree) -> int:
    """Keep the keys and values of ``df`` as the next version of ``base``; one writer per base.

    ``df`` is read once for its digests, and again for the leaves that differ from the version before.
    The digests kept are those of what was written. Nulls are values like any other; repeated
    rows count; an empty frame is a version without leaves. Values have to be of types Spark can
    hash (no maps). A version that dies half-way leaves folders nobody reads.
    """
    spark = df.sparkSession
    rows = df.select(*(F.col(f"`{c}`") for c in (*tree.keys, *tree.values)))
    schema = rows.schema
    known = _leaves(spark, base, versions.latest_version(spark, base), tree)[0]
    rows = rows.withColumn(_LEAF, _leaf(tree))
    found = {r[0]: tuple(r[1:]) for r in _digests(rows, tree).collect()}
    kept = {leaf: known[leaf] for leaf, digest in found.items() if leaf in known and known[leaf][:-1] == digest}
    fresh = sorted(set(found) - set(kept))
    if fresh:
        kept |= _write_leaves(rows.where(_one_of(fresh, tree)), base, tree)
    return _publish(spark, base, tree, schema, kept)


def read(spark: SparkSession, base: str, tree: Tree, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest one by default."""
    wanted = versions.latest_version(spark, base) if version is None else version
    leaves, schema = _leaves(spark, base, wanted, tree)
    if schema is None:
        raise ValueError(f"{base} has no version {wanted}")
    return _rows(spark, base, schema, [leaf[-1] for leaf in leaves.values()])


def changes(
    spark: SparkSession,
    base: str,
    tree: Tree,
    now: int | None = None,
    was: int | None = None,
    labels: tuple[str, str, str] = (detect.NEW_COLUMN, detect.DROPPED_COLUMN, detect.TYPE_CHANGED),
) -> DataFrame:
    """What :func:`~weftgraph.operators.detect.snapshot_diff` gives for two versions, by default the
    newest and the one before it; only leaves whose digests differ are read.

    Version 0 is an empty snapshot. A changed leaf is missed where its count and 96 bits of
    hash sums are equal by chance.
    """
    return detect.snapshot_diff(*_differing(spark, base, tree, now, was), tree.keys, tree.values, labels)


def signed_changes(
    spark: SparkSession, base: str, tree: Tree, now: int | None = None, was: int | None = None
) -> DataFrame:
    """The same as signed rows: keys, values and ``weight``, how many more of these rows the newer version
    holds. Unlike :func:`changes` this tells repeated rows of one key, and the values that went."""
    current, previous = _differing(spark, base, tree, now, was)
    both = current.withColumn("weight", F.lit(1)).unionByName(previous.withColumn("weight", F.lit(-1)))
    return both.groupBy(*tree.keys, *tree.values).agg(F.sum("weight").alias("weight")).where("weight <> 0")


def patch(
    deltas: DataFrame, base: str, tree: Tree, fold: Callable[[DataFrame, DataFrame], DataFrame]
) -> int:
    """Replace what is kept under the keys of ``deltas`` by ``fold(kept, deltas)``, as the next version.

    Only leaves that hold such keys are read and written; ``fold`` is given all rows of these and has to
    give back what stays of them. ``deltas`` holds the keys and whatever ``fold`` needs, and is read
    more than once. Without deltas nothing happens and the version stays.
    """
    spark = deltas.sparkSession
    number = versions.latest_version(spark, base)
    leaves, schema = _leaves(spark, base, number, tree)
    if schema is None:
        raise ValueError(f"{base} has no version")
    met = {r[0] for r in deltas.select(_leaf(tree)).distinct().collect()}
    if not met:
        return number
    rows = fold(_rows(spark, base, schema, [leaves[n][-1] for n in sorted(met & leaves.keys())]), deltas)
    rows = rows.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields))
    written = _write_leaves(rows.withColumn(_LEAF, _leaf(tree)), base, tree)
    if written.keys() - met:
        raise ValueError("fold gave back keys of leaves it was not given")
    kept = {n: row for n, row in leaves.items() if n not in met} | written
    return _publish(spark, base, tree, schema, kept)


def refresh(current: DataFrame, base: str, tree: Tree, scope: Column) -> int:
    """Replace the rows in scope by those of ``current``, which holds nothing else, as the next
    version. Leaves without a change keep their folders."""
    spark = current.sparkSession
    return write(detect.refreshed(read(spark, base, tree), current, scope), base, tree)


def _write_leaves(rows: DataFrame, base: str, tree: Tree) -> dict[int, tuple]:
    """Leaves as written: (n, sums, folder) of each."""
    place = f"{base}/leaves/{_WRITE}={uuid.uuid4().hex}"
    # Small leaves share a task and a large one is split, by the sizes met at run time.
    rows.hint("rebalance", _LEAF).write.partitionBy(_LEAF).parquet(place)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(place)
    return {r[0]: (*r[1:], f"{place}/{_LEAF}={r[0]}") for r in _digests(stored, tree).collect()}


def _publish(spark: SparkSession, base: str, tree: Tree, schema: T.StructType, kept: dict[int, tuple]) -> int:
    fields = json.dumps([_described(tree), schema.json()])
    table = [(leaf, *kept[leaf], None) for leaf in sorted(kept)]
    whole = (_WHOLE, sum(k[0] for k in kept.values()), *[None] * len(_SUMS), None, fields)
    return versions.write_version(local_rows(spark, [whole, *table], _TABLE).coalesce(1), base)


def _differing(
    spark: SparkSession, base: str, tree: Tree, now: int | None, was: int | None
) -> tuple[DataFrame, DataFrame]:
    """(current, previous): the rows of the leaves that differ."""
    now = versions.latest_version(spark, base) if now is None else now
    was = max(now - 1, 0) if was is None else was
    current, schema = _leaves(spark, base, now, tree)
    previous, old_schema = _leaves(spark, base, was, tree)
    for version, found in ((now, schema), (was, old_schema or was == 0)):
        if not found:
            raise ValueError(f"{base} has no version {version}")
    # One folder under two versions has one digest; equal digests in two folders are equal rows.
    equal = {leaf for leaf in current.keys() & previous.keys() if current[leaf][:-1] == previous[leaf][:-1]}
    return tuple(
        _rows(spark, base, found, [leaves[leaf][-1] for leaf in sorted(leaves.keys() - equal)])
        for leaves, found in ((current, schema), (previous, old_schema or schema))
    )


def _described(tree: Tree) -> list:
    return [list(tree.keys), list(tree.values), list(tree.group), tree.branches, tree.leaves]


def _hash(seed: int, columns: Sequence[str]) -> Column:
    """A hash in which a null has a place: Spark's own passes over nulls."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def _leaf(tree: Tree) -> Column:
    branch = F.pmod(_hash(1, tree.group), F.lit(tree.branches)) if tree.group else F.lit(0)
    return (branch * tree.leaves + F.pmod(_hash(2, tree.keys), F.lit(tree.leaves))).cast("int")


def _digests(rows: DataFrame, tree: Tree) -> DataFrame:
    """leaf, n and four sums; combined inside the tasks, so one row per leaf and task is shuffled.

    Summing 24 bits at a time leaves room for 2**39 rows in a leaf; beyond that Spark raises.
    """
    columns = (*tree.keys, *tree.values)
    rows = rows.select(_LEAF, _hash(3, columns).alias("h0"), _hash(4, columns).alias("h1"))
    bits = [F.shiftright(h, at).bitwiseAND((1 << 24) - 1) for h in ("h0", "h1") for at in (0, 24)]
    sums = [F.sum(b).alias(name) for b, name in zip(bits, _SUMS)]
    return rows.groupBy(F.col(_LEAF).cast("int").alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *sums)


def _one_of(leaves: list[int], tree: Tree) -> Column:
    every = len(leaves) == max(1, tree.branches if tree.group else 1) * tree.leaves
    return F.lit(True) if every else F.col(_LEAF).isin(leaves)


def _leaves(
    spark: SparkSession, base: str, version: int, tree: Tree
) -> tuple[dict[int, tuple], T.StructType | None]:
    """(n, sums, folder) of each leaf of a version, and its columns; nothing for version 0."""
    if not version:
        return {}, None
    table = [tuple(r) for r in versions.read_version(spark, base, version).collect()]
    described, schema = json.loads(next(r[-1] for r in table if r[0] == _WHOLE))
    if described != _described(tree):
        raise ValueError(f"version {version} of {base} was written with another tree")
    leaves = {r[0]: r[1:-1] for r in table if r[0] != _WHOLE}
    return leaves, T.StructType.fromJson(json.loads(schema))


def _rows(spark: SparkSession, base: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("basePath", f"{base}/leaves")
    return stored.parquet(*folders).select(*(F.col(f"`{c}`") for c in schema.names))
