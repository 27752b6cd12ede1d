"""Approximate nearest neighbours with a vantage-point tree per shard.

Largest inner product becomes smallest distance by one more coordinate: with M the largest norm,
x -> (x, sqrt(M^2 - |x|^2)) and q -> (q, 0) have |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Vectors are dealt
into shards by a hash of their id; each shard builds a tree in which a vantage point splits the
others by the median of their distances. A block of queries walks down together: a half is left
out for a query when ``factor`` times the nearest distance found so far cannot reach over the
median sphere. Factor 1 is the triangle inequality and gives exact results; less prunes more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.session import cut_lineage

_LEAF = 512


@dataclass(frozen=True)
class Search:
    neighbours: int = 20
    factor: float = 1.0
    per_shard: int = 8192
    per_block: int = 1024


class _Tree:
    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._split(np.arange(len(points)))

    def _split(self, rows: np.ndarray):
        if len(rows) <= _LEAF:
            return rows
        # The vantage point is the one farthest from the middle of a few; ties by row.
        few = rows[:: max(1, len(rows) // 64)]
        centre = self.points[few].mean(axis=0)
        at = few[((self.points[few] - centre) ** 2).sum(axis=1).argmax()]
        distance = np.sqrt(((self.points[rows] - self.points[at]) ** 2).sum(axis=1))
        middle = float(np.median(distance))
        near = distance <= middle
        if near.all():
            return rows  # copies: no sphere parts them
        return at, middle, self._split(rows[near]), self._split(rows[~near])


class _Block:
    """Queries with the nearest found so far."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, data: np.ndarray, search: Search, shift: float):
        self.queries, self.own, self.ids, self.data, self.search = queries, own, ids, data, search
        self.square = (queries**2).sum(axis=1)
        self.shift = shift
        k = search.neighbours
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def radius(self, which: np.ndarray) -> np.ndarray:
        worst = self.score[which, -1]
        with np.errstate(invalid="ignore"):
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(self.square[which] + self.shift - 2 * worst, 0)))

    def scan(self, rows: np.ndarray, which: np.ndarray) -> None:
        for at in range(0, len(rows), 4 * _LEAF):
            part = rows[at : at + 4 * _LEAF]
            score = self.queries[which] @ self.data[part].T
            score[self.ids[part][None, :] == self.own[which][:, None]] = -np.inf
            # Only queries that gain anything are sorted.
            gain = score.max(axis=1) >= self.score[which, -1]
            rows_in = which[gain]
            if len(rows_in) == 0:
                continue
            all_score = np.concatenate([self.score[rows_in], score[gain]], axis=1)
            all_ids = np.concatenate([self.found[rows_in], np.broadcast_to(self.ids[part], (len(rows_in), len(part)))], axis=1)
            all_ids = np.where(np.isinf(all_score), np.iinfo(np.int64).max, all_ids)
            order = np.lexsort([all_ids, -all_score], axis=1)[:, : self.search.neighbours]
            self.score[rows_in] = np.take_along_axis(all_score, order, axis=1)
            self.found[rows_in] = np.take_along_axis(all_ids, order, axis=1)


def _walk(tree: _Tree, node, block: _Block, which: np.ndarray, lifted: np.ndarray) -> None:
    if len(which) == 0:
        return
    if isinstance(node, np.ndarray):
        block.scan(node, which)
        return
    at, middle, near, far = node
    distance = np.sqrt(np.maximum(((lifted[which] - tree.points[at]) ** 2).sum(axis=1), 0))
    inside = distance <= middle
    _walk(tree, near, block, which[inside], lifted)
    _walk(tree, far, block, which[~inside], lifted)
    # The other half: only where the ball of the nearest so far reaches over the sphere.
    reach = np.abs(distance - middle) <= block.radius(which) * block.search.factor + 1e-9
    _walk(tree, far, block, which[inside & reach], lifted)
    _walk(tree, near, block, which[~inside & reach], lifted)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    flat = vectors.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def nearest(vectors: DataFrame, queries: DataFrame, search: Search = Search(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest by inner product among ``vectors``.

    Nearest first, ties to the smaller id, never the row with the query's own id. Vectors that are
    null or empty, zero, or hold null or non-finite components take no part, on either side, nor
    do null ids; vectors of different lengths are searched apart. Equal vectors are all candidates;
    rows repeating an id count once. Fewer candidates than asked for are all returned; without
    candidates or queries there are no rows.
    """

    def sound(frame: DataFrame) -> DataFrame:
        v = F.col("v")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (
            frame.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
            .groupBy("id")
            .agg(F.min("v").alias("v"))
        )

    points = cut_lineage(sound(vectors))
    asked = cut_lineage(sound(queries))
    size = F.size("v").alias("size")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    # One row per length of vector: how many there are, and the largest squared norm.
    known = points.groupBy(size).agg(F.count("*").alias("n"), F.max(norm).alias("most")).withColumn("shards", F.ceil(F.col("n") / search.per_shard))
    wanted = asked.groupBy(size).agg(F.ceil(F.count("*") / search.per_block).alias("blocks"))
    plan = cut_lineage(known.join(wanted, "size"))

    hashed = F.xxhash64("id")
    dealt = points.select("id", "v", size).join(plan, "size").withColumn("shard", F.pmod(hashed, F.col("shards")))
    cells = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("size", "shard", "block", "most", F.lit(False).alias("asks"), "id", "v")
    asks = asked.select("id", "v", size).join(plan, "size").withColumn("block", F.pmod(hashed, F.col("blocks")))
    asks = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asks = asks.select("size", "shard", "block", "most", F.lit(True).alias("asks"), "id", "v")

    def of_cell(table: pa.Table) -> pa.Table:
        is_query = table["asks"].to_numpy()
        ids, v = table["id"].to_numpy(), _matrix(table["v"])
        out = pa.schema([("shard", pa.int64()), ("query_id", pa.int64()), ("found", pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))])
        if is_query.all() or not is_query.any():
            return out.empty_table()
        order = np.argsort(ids[~is_query], kind="stable")
        data, data_ids = v[~is_query][order], ids[~is_query][order]
        most = float(table["most"][0].as_py())
        lift = np.sqrt(np.maximum(most - (data**2).sum(axis=1), 0))[:, None]
        tree = _Tree(np.concatenate([data, lift], axis=1))
        queries_in = v[is_query]
        block = _Block(queries_in, ids[is_query], data_ids, data, search, most)
        lifted = np.concatenate([queries_in, np.zeros((len(queries_in), 1))], axis=1)
        _walk(tree, tree.root, block, np.arange(len(queries_in)), lifted)
        real = ~np.isinf(block.score)
        at = np.append(0, np.cumsum(real.sum(axis=1))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(block.score[real]), pa.array(block.found[real])], names=["score", "vec_id"])
        shard = pa.array(np.full(len(at) - 1, table["shard"][0].as_py(), np.int64))
        return pa.table({"shard": shard, "query_id": pa.array(ids[is_query]), "found": pa.ListArray.from_arrays(pa.array(at), pairs)}, schema=out)

    kind = "shard long, query_id long, found array<struct<score: double, vec_id: long>>"
    parts = cells.unionByName(asks).groupBy("size", "shard", "block").applyInArrow(of_cell, kind)
    # Nearest first: by falling score, then by rising id. A list per shard, merged per query.
    by = lambda a, b: F.when(a.score != b.score, F.when(a.score > b.score, -1).otherwise(1)).otherwise(F.when(a.vec_id < b.vec_id, -1).otherwise(1))
    best = F.slice(F.array_sort(F.flatten(F.collect_list("found")), by), 1, search.neighbours).alias("found")
    # In two steps, so that the lists put together stay short with any number of shards.
    merged = parts.groupBy("query_id", F.floor(F.col("shard") / 256).alias("some")).agg(best).groupBy("query_id").agg(best)
    return merged.select("query_id", F.posexplode("found").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"
    )
