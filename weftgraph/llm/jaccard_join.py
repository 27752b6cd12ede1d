"""Similarity join on word shingles with Bayesian pruning of candidates.

1. A text is its set of ``shingle``-word shingles; texts with one set are one class, and a class
   is handled once however many copies it has.
2. MinHash signatures, cut into bands, give candidates: classes sharing a band's values. The
   members of a bucket are dealt into blocks of ``block``; a task compares two blocks, so that a
   bucket of any size is many bounded pieces. A pair is looked at in its first common band only.
3. A pair's MinHash values are compared a few at a time. With a uniform prior the similarity's
   posterior after m matches in n is Beta(m + 1, n - m + 1); the pair is dropped as soon as the
   chance of reaching the threshold is below ``tolerance``.
4. The shingle sets of members with a surviving pair are shipped to that pair's block, and the
   similarity is counted exactly.

No stage writes out pairs: links are counted per member inside the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm import blocks as B
from weftgraph.llm.spans import keyed, list_parts, with_lists
from weftgraph.session import cut_lineage

_STEP = 16
_PAIRS = 1 << 19
_GROUP = ["k", "i", "j"]


@dataclass(frozen=True)
class Join:
    """Parameters. 25 bands of 5 miss one pair in 20,000 at a similarity of exactly 0.8."""

    threshold: float = 0.8
    shingle: int = 5
    hashes: int = 128
    bands: int = 25
    rows: int = 5
    tolerance: float = 1e-5
    block: int = 512


def least_matches(threshold: float, tolerance: float, compared: int) -> int:
    """The fewest matches of ``compared`` that leave the threshold a chance of ``tolerance``."""
    chance = 0.0
    for m in range(compared + 1):
        # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
        chance += math.comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if chance >= tolerance:
            return m
    return compared + 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document; fewer than k words are one shingle."""
    start, end, at = B.words(data, offsets)
    rolling = B.RollingHash(B.word_units(data, start, end))
    grams = rolling.grams(k)
    short = rolling.ranges(at[:-1], at[1:])
    for a, b, whole in zip(at[:-1].tolist(), at[1:].tolist(), short):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield np.array([whole] if b > a else [], np.uint64)


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = B.mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    return seeds[:hashes, None], seeds[hashes:, None] | np.uint64(1)


def signature(members: np.ndarray, hashes: int) -> np.ndarray:
    """16 bits of the smallest value under each hash function."""
    flip, factor = _coefficients(hashes)
    least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 1024):
        np.minimum(least, ((members[None, at : at + 1024] ^ flip) * factor).min(axis=1), out=least)
    return (B.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def _signatures(frame: DataFrame, join: Join) -> DataFrame:
    """(doc_id, h, cls, n, sig): ``cls`` is a 128-bit hash of the shingle set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n, sig = [], [], []
            for _, _, data, offsets in B.blocks(B.column(batch, "text")):
                for s in shingle_sets(data, offsets, join.shingle):
                    both = np.array([s.sum(dtype=np.uint64), B.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
                    cls.append(both.tobytes())
                    n.append(len(s))
                    sig.append(signature(s, join.hashes).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [B.column(batch, "doc_id"), B.column(batch, "h"), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "h", "cls", "n", "sig"],
            )

    return frame.select("doc_id", "h", "text").mapInArrow(emit, "doc_id long, h long, cls binary, n long, sig binary")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and the groups' offsets; rows come sorted by group."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if table.num_rows == 0:
            continue
        edges = _edges(table)
        rest = table.slice(edges[-1])
        if len(edges) > 1:
            yield table.slice(0, edges[-1]).combine_chunks(), edges
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def _edges(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in _GROUP:
        new[1:] |= np.diff(table[name].to_numpy()) != 0
    return np.flatnonzero(new)


def _pairs(edges: np.ndarray, first_side: np.ndarray, crossed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs inside groups: all pairs of one block, or those between two blocks."""
    size = np.diff(edges)
    twos = edges[:-1][(size == 2) & ~crossed[edges[:-1]]]
    left, right, held = [twos], [twos + 1], len(twos)
    for a, b in zip(edges[:-1][size > 1], edges[1:][size > 1]):
        if crossed[a]:
            p, q = np.flatnonzero(first_side[a:b]), np.flatnonzero(~first_side[a:b])
            left.append(np.repeat(p, len(q)) + a)
            right.append(np.tile(q, len(p)) + a)
        elif b - a > 2:
            p, q = np.triu_indices(b - a, 1)
            left.append(p + a)
            right.append(q + a)
        else:
            continue
        held += len(left[-1])
        if held >= _PAIRS:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def _survivors(join: Join, table: pa.Table, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the groups' first common bands that pass the comparison of MinHash values."""
    sig = np.frombuffer(B.text_bytes(table["sig"].chunk(0))[0], np.uint16).reshape(-1, join.hashes)
    band = table["band"].to_numpy()
    i, j, x = (table[c].to_numpy() for c in ("i", "j", "x"))
    checks = [(n, least_matches(join.threshold, join.tolerance, n)) for n in range(_STEP, join.hashes + 1, _STEP)]
    out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in _pairs(edges, x == i, i != j):
        matches = np.zeros(len(p), np.int64)
        for n, least in checks:
            part = slice(n - _STEP, n)
            matches += (sig[p, part] == sig[q, part]).sum(axis=1)
            keep = matches >= least
            p, q, matches = p[keep], q[keep], matches[keep]
        wide = join.bands * join.rows
        same = (sig[p, :wide] == sig[q, :wide]).reshape(len(p), join.bands, join.rows).all(axis=2)
        first = same.argmax(axis=1) == band[p]
        out[0].append(p[first])
        out[1].append(q[first])
    return np.concatenate(out[0]), np.concatenate(out[1])


def _screen(join: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_groups(batches):
            p, q = _survivors(join, table, edges)
            rows = pa.array(np.unique(np.concatenate([p, q])))
            yield from table.select([*_GROUP, "x", "band", "doc_id", "h", "cls"]).take(rows).combine_chunks().to_batches()

    return run


def _attach_sets(join: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = B.column(batch, "places")
            row_of, place = list_parts(lists)
            for first, last, data, offsets in B.blocks(B.column(batch, "text")):
                sets = list(shingle_sets(data, offsets, join.shingle))
                part = slice(*np.searchsorted(row_of, [first, last]))
                own = (row_of[part] - first).tolist()
                sig = [signature(s, join.hashes).tobytes() for s in sets]
                inner = place.slice(part.start, part.stop - part.start)
                names = [inner.type.field(f).name for f in range(inner.type.num_fields)]
                yield pa.RecordBatch.from_arrays(
                    [*(inner.field(f) for f in range(len(names))), pa.array([sig[r] for r in own], pa.binary()), pa.array([sets[r].tobytes() for r in own], pa.binary())],
                    names=[*names, "sig", "members"],
                )

    return run


def _intersections(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of the pairs (p, q)."""
    if len(p) <= 4:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(p, q)], np.int64)
    size = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for at in range(0, int(column[-1]) + 1, width):
        part = slice(*np.searchsorted(column, [at, at + width]))
        held = np.zeros((len(sets), width), np.float32)
        held[row[part], column[part] - at] = 1
        common += held @ held.T
    return common[p, q].astype(np.int64)


def _verify(join: Join):
    """Per member with a link: its links in this piece, and the smallest class tied to it here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_groups(batches):
            p, q = _survivors(join, table, edges)
            group = np.searchsorted(edges, p, side="right") - 1
            order = np.argsort(group, kind="stable")
            p, q, group = p[order], q[order], group[order]
            data, at = B.text_bytes(table["members"].chunk(0))
            sets = lambda r: data[at[r] : at[r + 1]].view(np.uint64)
            size = np.diff(at) // 8
            linked = np.zeros(len(p), bool)
            starts = np.flatnonzero(np.append(True, np.diff(group) != 0)) if len(p) else []
            for a, b in zip(starts, [*starts[1:], len(p)]):
                used, local = np.unique(np.concatenate([p[a:b], q[a:b]]), return_inverse=True)
                both = _intersections([sets(r) for r in used], local[: b - a], local[b - a :])
                linked[a:b] = both >= join.threshold * (size[p[a:b]] + size[q[a:b]] - both) - 1e-9
            p, q = p[linked], q[linked]
            links = np.bincount(np.concatenate([p, q]), minlength=table.num_rows)
            root = np.arange(table.num_rows)
            while len(p):
                least = np.minimum(root[p], root[q])
                before = root.copy()
                np.minimum.at(root, p, least)
                np.minimum.at(root, q, least)
                root = root[root]
                if (root == before).all():
                    break
            rows = pa.array(np.flatnonzero(links))
            cls = table["cls"].chunk(0)
            yield pa.RecordBatch.from_arrays(
                [cls.take(rows), pa.array(links).take(rows), cls.take(pa.array(root)).take(rows)], names=["cls", "links", "root"]
            )

    return run


def _in_groups(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node each node of ``edges`` (a, b) is connected to.

    Each round takes the smallest label next door and then the label of that label, so that the
    rounds grow with the logarithm of the longest way.
    """
    both = cut_lineage(edges.union(edges.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("far"))
        step = step.join(jump, step.label == jump.at, "left").select("node", "was", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = cut_lineage(step)
        labels = step.select("node", "label")
        if step.where("label <> was").isEmpty():
            return labels


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """One row per row of ``docs``: doc_id, h, class_id, n_links, group_id.

    ``class_id`` is the smallest id among the texts with the same shingle set, ``n_links`` the
    number of other classes at ``threshold`` or more, ``group_id`` the smallest id of all classes
    connected through links. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.
    Texts of fewer words than a shingle are one shingle; texts without words (null, empty, blank)
    are one class without links; repeated rows are members of one class; null ids take part, and a
    class of null ids only has a null class_id; an empty table gives an empty table.
    """
    return _classes(keyed(docs, id_col, text_col), join).drop("label")


def _classes(frame: DataFrame, join: Join) -> DataFrame:
    rows = cut_lineage(_signatures(frame, join))
    first = F.min(F.struct("doc_id", "h")).alias("first")
    classes = cut_lineage(
        rows.groupBy("cls").agg(F.min("doc_id").alias("class_id"), first, F.first("n").alias("n"), F.first("sig").alias("sig"))
    )
    width = 2 * join.rows
    keys = [F.xxhash64(F.substring("sig", 1 + width * b, width), F.lit(b)) for b in range(join.bands)]
    bands = classes.where("n > 0").select("cls", F.posexplode(F.array(*keys)).alias("band", "k"))
    crowded = bands.groupBy("k").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / join.block).cast("int")
    members = (
        bands.join(crowded, "k")
        .withColumn("blocks", blocks)
        .withColumn("x", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .join(classes.select("cls", "first.doc_id", "first.h", "sig"), "cls")
        .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("x", "y"), "j": F.greatest("x", "y")})
        .select(*_GROUP, "x", "band", "doc_id", "h", "cls", "sig")
    )
    place = "k long, i int, j int, x int, band int"
    screened = cut_lineage(_in_groups(members).mapInArrow(_screen(join), f"{place}, doc_id long, h long, cls binary"))
    shipped = with_lists(frame.select("doc_id", "h", "text"), screened, "places").where(F.col("places").isNotNull())
    # Rows equal in id and text all match: one of them stands for the class.
    shipped = shipped.groupBy("doc_id", "h").agg(F.first("text").alias("text"), F.first("places").alias("places"))
    shipped = shipped.mapInArrow(_attach_sets(join), f"{place}, cls binary, sig binary, members binary")
    found = cut_lineage(_in_groups(shipped).mapInArrow(_verify(join), "cls binary, links long, root binary"))

    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    labels = components(found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")).distinct())
    known = (
        classes.select("cls", "class_id")
        .join(links, "cls", "left")
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("label", F.coalesce("label", "cls"))
    )
    known = cut_lineage(known)
    groups = known.groupBy("label").agg(F.min("class_id").alias("group_id"))
    known = known.join(groups, "label").select("cls", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id", "label")
    return rows.select("doc_id", "h", "cls").join(known, "cls").drop("cls")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """``docs`` with one row of each connected group: that with the smallest id (null first).

    Texts without words are one group. Of rows with the smallest id one stays.
    """
    frame = keyed(docs, id_col, text_col)
    first = _classes(frame, join).groupBy("label").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    keep = first.select(F.xxhash64("first.doc_id", "first.h").alias("_key"))
    frame = frame.withColumn("_key", F.xxhash64("doc_id", "h"))
    kept = frame.join(keep, "_key", "left_semi")
    kept = kept.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("_key"))).where("_nth = 1")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])
