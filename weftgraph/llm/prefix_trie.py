"""The trie of conversation prefixes, from vertical bitmaps.

1. Turns are narrow rows (conversation, turn, role, MD5 of role and text, bytes of text), numbered by
   one range sort over all conversations. A conversation is cut into pieces of ``segment`` turns.
2. Conversations are numbered by id and dealt into shards of ``per_shard`` neighbours. A shard
   and a segment make one bounded group: pieces are bits, and an index holds for each (position,
   turn) the bitset of the pieces with that turn there.
3. The group is walked depth first: the lowest piece left names a turn, the node's bitset
   intersected with that turn's posting is a child, its popcount the child's members, and what
   ends there the child's end list. No other turn is tried.
4. A node's key is a hash of its turns, the same in every shard, so shards' nodes are added up by
   key. A shard covers a range of ids, so its end lists follow one another.

What a subtree sums up is a sum over its members, by letting each node belong to its smallest
member: a second walk adds these numbers up, and no node is sent to all its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm import blocks as B
from weftgraph.llm.ordered import numbered
from weftgraph.session import cut_lineage

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODES = "node binary, parent binary, depth long, bytes long, path long, conv_id long, n_convs long, place long, ends array<long>"
_SUMS = "node binary, weight long, leaves long"


@dataclass(frozen=True)
class Shape:
    """How many conversations a shard has, and how many turns a segment."""

    per_shard: int = 2048
    segment: int = 128


def turn_rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, position from 1, hash, bytes) of each turn, in order."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        role.alias("role"),
        F.unhex(said).alias("hash"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("hash")]
    placed = cut_lineage(numbered(rows, *order, position="at").select("conv_id", "at", "hash", "bytes"))
    first = placed.groupBy("conv_id").agg(F.min("at").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first") + 1).alias("position"), "hash", "bytes")


def shared_openings(rows: DataFrame, base: Column, opening: Column, longest: int) -> DataFrame:
    """The turns of conversations that open with another's first turns.

    Conversation c takes the first ``opening`` turns (``longest`` at most) of conversation
    ``base``, or as many as that has, and goes on with its own after its first ``opening``. Both
    are expressions over conv_id; a base has to stand for a bounded number of conversations.
    """
    rows = cut_lineage(rows)
    heads = rows.where(F.col("position") <= longest)
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", base.alias("base"), opening.alias("opening"))
    lengths = heads.groupBy(F.col("conv_id").alias("base")).agg(F.max("position").alias("known"))
    convs = cut_lineage(convs.join(lengths, "base", "left").withColumn("taken", F.least("opening", F.coalesce("known", F.lit(0)))))
    lent = convs.join(heads.withColumnRenamed("conv_id", "base"), "base").where("position <= taken").select("conv_id", "position", "hash", "bytes")
    own = rows.join(convs.select("conv_id", "opening", "taken"), "conv_id").where("position > opening")
    return lent.union(own.select("conv_id", (F.col("position") - F.col("opening") + F.col("taken")).alias("position"), "hash", "bytes"))


def _pieces(rows: DataFrame, convs: DataFrame, shape: Shape) -> DataFrame:
    """Pieces of at most ``segment`` turns: shard, segment, conv_id, last, start and end key, path, hashes, sizes.

    ``last`` tells a conversation's last piece, ``path`` the bytes of the pieces before.
    """
    segment = F.floor((F.col("position") - 1) / shape.segment).alias("segment")
    turns = F.array_sort(F.collect_list(F.struct("position", "hash", "bytes"))).alias("turns")
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("size")
    pieces = rows.groupBy("conv_id", segment).agg(turns)
    pieces = pieces.select("conv_id", "segment", F.col("turns.hash").alias("hashes"), F.col("turns.bytes").alias("sizes"))
    pieces = cut_lineage(pieces.select("*", total))
    # The end of a full piece and the start of the next are one key: all full pieces so far with their places.
    digest = [F.xxhash64(F.lit(i), "segment", "hashes").alias(n) for i, n in enumerate("uv")]
    full = pieces.where(F.size("hashes") == shape.segment).select("conv_id", "segment", "size", *digest)
    so_far = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    key = F.concat(*(F.unhex(F.lpad(F.hex(F.bit_xor(n).over(so_far)), 16, "0")) for n in "uv"))
    ends = cut_lineage(full.select("conv_id", "segment", key.alias("end"), F.sum("size").over(so_far).alias("path")))
    starts = ends.select("conv_id", (F.col("segment") + 1).alias("segment"), F.col("end").alias("start"), "path")
    found = pieces.join(starts, ["conv_id", "segment"], "left").join(ends.drop("path"), ["conv_id", "segment"], "left").join(convs, "conv_id")
    return cut_lineage(
        found.select(
            "shard",
            "segment",
            "conv_id",
            (F.col("segment") * shape.segment + F.size("hashes") == F.col("n_turns")).alias("last"),
            F.coalesce("start", F.lit(ROOT)).alias("start"),
            "end",
            F.coalesce("path", F.lit(0)).cast("long").alias("path"),
            "hashes",
            "sizes",
        )
    )


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


class _Group:
    """The pieces of one shard and segment as bits, in the order of their ids."""

    def __init__(self, table: pa.Table, length: int):
        table = table.sort_by("conv_id")
        self.ids, self.turns, self.sizes, self.start, self.end, self.path, last = (
            table[c].to_pylist() for c in ("conv_id", "hashes", "sizes", "start", "end", "path", "last")
        )
        self.depth = int(table["segment"][0].as_py()) * length
        self.index: dict[tuple[int, bytes], int] = {}
        self.stop: dict[int, int] = {}
        self.roots: dict[bytes, int] = {}
        self.last = 0
        for i, turns in enumerate(self.turns):
            bit = 1 << i
            for place in enumerate(turns):
                self.index[place] = self.index.get(place, 0) | bit
            self.stop[len(turns)] = self.stop.get(len(turns), 0) | bit
            self.roots[self.start[i]] = self.roots.get(self.start[i], 0) | bit
            self.last |= bit * last[i]

    def nodes(self) -> Iterator[tuple[bytes, bytes, int, int, int, int]]:
        """(key, parent, depth, bytes, path, bitset) of each node, depth first."""
        stack = [(0, bits, key, self.path[next(_bits(bits))]) for key, bits in self.roots.items()]
        while stack:
            at, bits, parent, path = stack.pop()
            left = bits & ~self.stop.get(at, 0)
            while left:
                lowest = (left & -left).bit_length() - 1
                turn, size = self.turns[lowest][at], self.sizes[lowest][at]
                child = left & self.index[at, turn]
                left ^= child
                full = self.end[lowest] is not None and at + 1 == len(self.turns[lowest])
                key = self.end[lowest] if full else hashlib.blake2b(parent + turn, digest_size=16).digest()
                yield key, parent, self.depth + at + 1, size, path + size, child
                stack.append((at + 1, child, key, path + size))

    def ended(self, depth: int, bits: int) -> list[int]:
        return [self.ids[i] for i in _bits(bits & self.last & self.stop.get(depth - self.depth, 0))]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_KEY = [("node", pa.binary()), ("parent", pa.binary())]
_LONGS = [(c, pa.int64()) for c in ("depth", "bytes", "path", "conv_id", "n_convs", "place")]
_NODES_ARROW = pa.schema([*_KEY, *_LONGS, ("ends", pa.list_(pa.int64()))])
_SUMS_ARROW = pa.schema([("node", pa.binary()), ("weight", pa.int64()), ("leaves", pa.int64())])


def _walk(length: int):
    def run(table: pa.Table) -> pa.Table:
        group, place = _Group(table, length), table["shard"][0].as_py()
        rows = [
            (key, parent, depth, size, path, group.ids[next(_bits(bits))], bits.bit_count(), place, group.ended(depth, bits))
            for key, parent, depth, size, path, bits in group.nodes()
        ]
        return _batch(rows, _NODES_ARROW)

    return run


def _add_up(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("conv_id")
        group, weight, leaf = _Group(table, length), table["weight"].to_pylist(), table["leaf"].to_pylist()
        rows = []
        for key, _, _, _, _, bits in group.nodes():
            members = list(_bits(bits))
            rows.append((key, sum(weight[i] for i in members), sum(leaf[i] for i in members)))
        return _batch(rows, _SUMS_ARROW)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, fed list after list; rows come sorted by node and place."""
    node, state = None, None
    for batch in batches:
        out = []
        for key, ids in zip(B.column(batch, "node").to_pylist(), B.column(batch, "ends")):
            text = ",".join(map(str, ids.as_py())).encode()
            if key == node:
                state.update(b"," + text)
                continue
            if node is not None:
                out.append((node, state.hexdigest()))
            node, state = key, hashlib.sha256(text)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def prefix_nodes(rows: DataFrame, ids: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, position from 1, hash, bytes).

    ``ids`` holds the conv_id of each conversation once, those without turns too. Gives node and
    parent (16-byte keys), depth, conv_id (the smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. Without conversations there are no nodes.
    Nodes are told apart by 128-bit hashes. A conversation of any length and a node with any number of members
    are many bounded groups; only a node's end list is hashed in one task, from lists in order.
    """
    totals = rows.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sum("bytes").alias("total"))
    convs = numbered(ids, F.col("conv_id"), position="number").join(totals, "conv_id", "left")
    convs = cut_lineage(
        convs.select("conv_id", F.floor(F.col("number") / shape.per_shard).alias("shard"), F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("total", F.lit(0)).alias("total"))
    )
    pieces = _pieces(rows, convs.select("conv_id", "shard", "n_turns"), shape)

    partial = cut_lineage(pieces.groupBy("shard", "segment").applyInArrow(_walk(shape.segment), _NODES))
    turnless = F.array_sort(F.collect_list(F.when(F.col("n_turns") == 0, F.col("conv_id"))))
    zero = F.lit(0).cast("long")
    top = convs.groupBy(F.col("shard").alias("place")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), turnless.alias("ends"))
    top = top.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), *(zero.alias(c) for c in ("depth", "bytes", "path")), "conv_id", "n_convs", "place", "ends")
    partial = partial.unionByName(top)
    same = [F.first(c).alias(c) for c in ("parent", "depth", "bytes", "path")]  # equal wherever the node is met
    nodes = partial.groupBy("node").agg(*same, F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    # Each conversation's own nodes are the last of its path; what its path costs before them is shared.
    own = nodes.where("depth > 0").groupBy("conv_id").agg(
        F.min_by(F.col("path") - F.col("bytes"), "depth").alias("weight"), F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf")
    )
    members = convs.join(own, "conv_id", "left").select(
        "conv_id", "shard", F.coalesce("weight", "total").alias("weight"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    members = cut_lineage(members)
    summed = pieces.join(members.drop("shard"), "conv_id").groupBy("shard", "segment").applyInArrow(_add_up(shape.segment), _SUMS)
    summed = summed.union(members.select(F.lit(ROOT), "weight", "leaf"))
    summed = summed.groupBy("node").agg(F.sum("weight").alias("weight"), F.sum("leaves").alias("leaves"))

    lists = partial.where(F.size("ends") > 0).select("node", "place", "ends").repartition("node").sortWithinPartitions("node", "place")
    digests = lists.mapInArrow(_digests, "node binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = (
        nodes.join(summed, "node")
        .join(digests, "node", "left")
        .join(members.select("conv_id", F.col("weight").alias("owned")), "conv_id")
        .join(parents, "parent", "left")
    )
    before = (F.col("n_convs") - 1) * (F.col("path") - F.col("bytes"))
    return found.select(
        "node",
        "parent",
        "depth",
        "conv_id",
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.greatest("leaves", (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("weight") - F.col("owned") - before).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def conversation_trie(
    turns: DataFrame,
    base: Column | None = None,
    opening: Column | None = None,
    longest: int = 8,
    shape: Shape = Shape(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``prefix_nodes`` of the conversations of ``turns``, with openings shared if ``base`` is given.

    Turns of a conversation are in the order of ``turn``, null first; turns with one number stand in
    the order of role and then of the MD5 of role and text; equal rows are so many turns. A null role
    or text is empty; rows without a conversation id belong to none; further columns are not read.
    ``saved_tokens`` counts bytes: what would be spared, over the subtree, if each prefix were kept once.
    """
    rows = turn_rows(turns, conv_col, turn_col, role_col, text_col)
    ids = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
    if base is not None and opening is not None:
        rows = shared_openings(rows, base, opening, longest)
    return prefix_nodes(cut_lineage(rows), ids, shape)
