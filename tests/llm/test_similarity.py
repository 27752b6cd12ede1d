"""Operators 3 and 4 against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.rows import FOLDER, awkward, documents, empty, words
from weftgraph.llm import jaccard_join, vector_search
from weftgraph.llm.queries import queries


def brute_links(rows, threshold=0.8, k=5):
    """(id, class, links, group) of each row by comparing all pairs of distinct shingle sets."""
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    sets = {}
    of = []
    for i, text in rows:
        w = words(text)
        s = frozenset(tuple(w[p : p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
        sets.setdefault(s, []).append(i)
        of.append(s)
    keys = list(sets)
    links, group = Counter(), {s: s for s in keys}

    def root(s):
        while group[s] is not s:
            s = group[s]
        return s

    for x in range(len(keys)):
        for y in range(x):
            a, b = keys[x], keys[y]
            if a and b and len(a & b) >= threshold * len(a | b):
                links[a] += 1
                links[b] += 1
                group[root(a)] = root(b)
    members = {}
    for s in keys:
        members.setdefault(root(s), []).extend(sets[s])
    return Counter((i, low(sets[s]), links[s], low(members[root(s)])) for (i, _), s in zip(rows, of))


def near_copies(spark, size=60):
    """One large group of near copies, chains of ever more edits, and copies of copies."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    rows = []
    for i in range(size):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, rows[i % 7][1]) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def repeated_rows_with_near_copies(spark):
    """A row that occurs 30 times, one that occurs twice without an id, and a near copy of each."""
    a, b = [f"w{i}" for i in range(150)], [f"v{i}" for i in range(150)]
    rows = [(1, " ".join(a))] * 30 + [(2, " ".join([*a[:-1], "other"]))] + [(None, " ".join(b))] * 2 + [(3, " ".join([*b[:-1], "other"]))]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("block", [512, 7])
def test_repeated_rows_count_once(spark, block):
    docs = repeated_rows_with_near_copies(spark)
    found = jaccard_join.similarity_classes(docs, join=jaccard_join.Join(block=block)).collect()
    assert len(found) == 34 and {r.n_links for r in found} == {1}
    assert Counter((r.doc_id, r.class_id, r.n_links, r.group_id) for r in found) == brute_links([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("make", [documents, awkward, near_copies])
@pytest.mark.parametrize("block", [512, 7])
def test_links(spark, make, block):
    docs = make(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = jaccard_join.similarity_classes(docs, join=jaccard_join.Join(block=block))
    got = Counter((r.doc_id, r.class_id, r.n_links, r.group_id) for r in found.collect())
    assert got == brute_links(rows)


def test_one_of_each_group_stays(spark):
    docs = near_copies(spark).withColumnsRenamed({"text": "body", "doc_id": "h"})
    kept = jaccard_join.without_near_copies(docs, "h", "body")
    assert kept.columns == docs.columns
    groups = {g for _, _, _, g in brute_links([tuple(r) for r in near_copies(spark).collect()])}
    assert sorted(r.h for r in kept.collect()) == sorted(groups)
    rows = [tuple(r) for r in awkward(spark).select("doc_id", "text").collect()]
    groups = {g for _, _, _, g in brute_links(rows)}
    assert jaccard_join.without_near_copies(awkward(spark)).count() == len(groups)


def test_empty(spark):
    docs = empty(documents(spark))
    assert jaccard_join.similarity_classes(docs).count() == 0
    assert jaccard_join.without_near_copies(docs).count() == 0


def test_least_matches():
    """Against the posterior's integral: the tail above the threshold, just reached and just missed."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for n in (16, 64, 128):
        m = jaccard_join.least_matches(0.8, 1e-3, n)
        tail = [
            (grid**x * (1 - grid) ** (n - x))[grid >= 0.8].sum() / (grid**x * (1 - grid) ** (n - x)).sum() for x in (m - 1, m)
        ]
        assert tail[0] < 1e-3 <= tail[1]


def test_components(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("x", "y")]
    edges = spark.createDataFrame([(a.encode(), b.encode()) for a, b in chain], "a binary, b binary")
    found = {bytes(r.node): bytes(r.label) for r in jaccard_join.components(edges).collect()}
    assert set(found.values()) == {b"n000", b"x"} and found[b"n040"] == b"n000" and found[b"y"] == b"x"


def test_queries_links(spark):
    found = queries()["op4_jaccard_join"](spark, FOLDER)
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.class_id, r.n_links, r.group_id) for r in found.collect()) == brute_links(rows)


def brute_nearest(rows, queries_, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float64)
    out = set()
    for q in queries_:
        if q in good:
            order = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out |= {(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(order[:k])}
    return out


def _hits(frame):
    rows = frame.collect()
    out = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("per_shard", [8192, 50])
def test_nearest_is_exact_at_factor_one(spark, per_shard):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(3) * (1 + i % 5)]) for i in range(900)]
    rows += [(2000 + i, rows[0][1]) for i in range(60)]  # one very common vector
    rows += [(3000, None), (3001, []), (3002, [0.0] * 6), (3003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3020, [math.nan] * 6), (3040, [1.0, 2.0]), (None, [1.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 20 = 0")
    found = vector_search.nearest(vectors, asked, vector_search.Search(per_shard=per_shard, per_block=16))
    assert _hits(found) == brute_nearest(rows, [i for i, _ in rows if i is not None and i % 20 == 0])
    assert vector_search.nearest(empty(vectors), empty(vectors)).count() == 0
    assert vector_search.nearest(vectors, empty(vectors)).count() == 0


def test_query_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = brute_nearest(rows, [i for i, _ in rows if i % 20 == 0])
    assert _hits(queries()["op3_vector_search"](spark, FOLDER)) == want


def test_pruning_loses_little(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = {h[:1] + h[2:3] for h in brute_nearest(rows, [i for i, _ in rows if i % 20 == 0])}
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.nearest(vectors, vectors.where("vec_id % 20 = 0"), vector_search.Search(factor=0.8))
    assert len({h[:1] + h[2:3] for h in _hits(found)} & want) >= 0.9 * len(want)


