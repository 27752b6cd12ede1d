"""Operator 12 against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.rows import FOLDER, empty
from weftgraph.llm import near_vectors
from weftgraph.llm.queries import queries


def brute(rows, threshold=0.98):
    """(id, links, component, kept) of each row; rows equal in id, label and vector are one vector."""
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i, label, tuple(x + 0.0 for x in v)] = None
    keys = list(good)
    unit = [np.array(k[2]) / max(map(abs, k[2])) for k in keys]
    unit = [v / np.linalg.norm(v) for v in unit]
    links, group = Counter(), list(range(len(keys)))

    def root(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(keys)):
        for b in range(a):
            if keys[a][1] == keys[b][1] and len(unit[a]) == len(unit[b]) and (keys[a][2] == keys[b][2] or unit[a] @ unit[b] >= threshold):
                links[a] += 1
                links[b] += 1
                group[root(a)] = root(b)
    least = {}
    for a, k in enumerate(keys):
        least[root(a)] = min(least.get(root(a), k[0]), k[0])
    place = {k: a for a, k in enumerate(keys)}
    out = []
    for i, v, label in rows:
        a = place.get((i, label, tuple(x + 0.0 for x in v))) if v and None not in v else None
        low = i if a is None else least[root(a)]
        out.append((i, links[a] if a is not None else 0, low, low == i))
    return Counter(out)


def clusters(spark, dim, size=400):
    """Random vectors, a large group near one of them, chains of ever farther ones, and odd rows."""
    rng = np.random.default_rng(dim)
    unit = lambda x: x / np.linalg.norm(x)
    rows = [(i, rng.normal(size=dim), i % 3) for i in range(size)]
    centre = rng.normal(size=dim)
    rows += [(1000 + i, centre + 0.09 * np.linalg.norm(centre) * unit(rng.normal(size=dim)), 1) for i in range(size // 2)]
    at = unit(rng.normal(size=dim))
    for i in range(30):
        rows.append((2000 + i, at, 2))
        side = rng.normal(size=dim)
        at = unit(at + 0.19 * unit(side - (side @ at) * at))
    rows = [(i, [float(x) for x in v], label) for i, v, label in rows]
    rows += [(3000 + i, rows[7 + i % 2][1], 1) for i in range(50)]
    rows += [(3100, [2 * x for x in rows[7][1]], 1), (3101, rows[7][1], 2), (7, rows[7][1], 1), (7, rows[8][1], 1)]
    rows += [(3200, None, 1), (3201, [], 1), (3202, [0.0] * dim, 1), (3203, [None, *[1.0] * (dim - 1)], 1), (3204, [math.nan] * dim, 1)]
    rows += [(3205, [math.inf] * dim, 1), (None, rows[7][1], 1), (3206, rows[7][1], None), (3207, [1.0], 1), (3208, [2.0], 1), (3209, [-0.0, 1.0], 1), (3210, [0.0, 1.0], 1)]
    rows += [(3211, [1e300] * dim, 2), (3212, [1e-300] * dim, 2)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)


def _found(frame):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect())


@pytest.mark.parametrize("dim, block", [(64, 512), (64, 40), (5, 512)])
def test_links_and_components(spark, dim, block):
    vectors = clusters(spark, dim)
    found = near_vectors.near_duplicates(vectors, near_vectors.Near(block=block))
    assert _found(found) == brute([tuple(r) for r in vectors.collect()])


def test_clashing_names_and_empty_table(spark):
    vectors = clusters(spark, 8).withColumnsRenamed({"vec_id": "h", "embedding": "keys", "label": "k"}).selectExpr("*", "1 AS cls", "2 AS rest")
    found = near_vectors.near_duplicates(vectors, id_col="h", vector_col="keys", label_col="k")
    assert _found(found) == brute([tuple(r)[:3] for r in vectors.collect()])
    assert found.select("rest.*").columns == vectors.columns
    assert near_vectors.near_duplicates(empty(vectors), id_col="h", vector_col="keys", label_col="k").count() == 0


def test_hadamard_keeps_lengths_and_hashes_agree():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 16))
    assert np.allclose((near_vectors.hadamard(x) ** 2).sum(axis=1), 16 * (x**2).sum(axis=1))
    label = np.zeros(50, np.int64)
    near = near_vectors.Near()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    both = near_vectors.bucket_keys(unit, label, near)
    assert (near_vectors.bucket_keys(unit[7:9], label[:2], near) == both[7:9]).all()
    assert all(len(set(t)) == near.probes for row in both.tolist() for t in row)


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.98: the share that shares no bucket with one of them at home."""
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(2, 20_000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1)[:, None]
    label = np.zeros(len(a), np.int64)
    p, q = (near_vectors.bucket_keys(x, label, near_vectors.Near()) for x in (a, b))
    met = (p == q[:, :, :1]).any(axis=2) | (q == p[:, :, :1]).any(axis=2)
    assert met[:, 0].mean() > 0.8 and (~met.any(axis=1)).sum() <= 1


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = queries()["op12_near_vectors"](spark, FOLDER)
    assert dict(found.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert _found(found) == brute(rows)
