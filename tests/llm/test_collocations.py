"""Operator 11 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import awkward, documents, empty
from weftgraph.llm import collocations
from weftgraph.llm.queries import queries

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=100, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[p : p + k]) for p in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and p[i:j] in candidates and 100 * a >= 100 * candidates[p[i:j]]:
                        inside.add(p[i:j])
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _found(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def phrases(spark):
    """Frequent words, pairs and passages, marks of all kinds, and no language for some."""
    rng = random.Random(9)
    common = ["The", "cat", "é", "O'Hara", "a-b", "naïve", "ÀB"]
    rows = []
    for i in range(300):
        words = [rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["over the lazy dog again and again", "x x x x x x x", "end.", "\t", "a, b; c\rd\x0be", "?"]))
        rows.append((i, rng.choice(["en", "de", None, "en"]), rng.choice([" ", "  ", "\t", " \n"]).join(words), 1))
    rows += [(900, "en", None, 1), (901, "en", "", 1), (None, "only", "", 1), (902, "en", rows[0][2], 1), (902, "en", rows[0][2], 1)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, k int").repartition(4)


@pytest.mark.parametrize("make, least", [(phrases, 20), (phrases, 100), (documents, 10), (awkward, 3)])
@pytest.mark.parametrize("bits", [26, 16])
def test_phrases(spark, make, least, bits):
    docs = make(spark)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    want = brute(rows, least)
    assert want
    assert _found(collocations.collocations(docs, collocations.Phrases(least=least, bits=bits))) == want


def test_a_sketch_that_says_yes_to_all_changes_nothing(spark):
    docs = phrases(spark).select(F.lit("x").alias("grp"), "text")
    counts = []
    for flags in (255, None):
        asked = collocations.Phrases(least=30, bits=16)
        known = collocations.frequent(docs, asked) if flags is None else collocations.Frequent(collocations.Sketch(16, np.full((2 << 16) // 8, 255, np.uint8)))
        flow = collocations.counted(collocations.edges(docs, asked, known), asked)
        counts.append(sorted(map(tuple, flow.collect())))
    assert counts[0] == counts[1]


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(30)}" for _ in range(5000)) + ". " + "long" * 300 + " tail of it"
    data = np.frombuffer(text.encode(), np.uint8)
    parts = list(collocations.stretches(data, 5, 64))
    assert b"".join(p[:own].tobytes() for p, own in parts) == data.tobytes()
    assert max(own for _, own in parts[:-4]) < 64 + 8
    docs = spark.createDataFrame([(1, "en", " ".join([text] * 40)), (2, "en", text)], "doc_id long, lang string, text string")
    assert docs.where("length(text) > 1048576").count() == 0
    big = docs.union(spark.createDataFrame([(3, "de", " ".join([text] * 150))], docs.schema))
    rows = [tuple(r) for r in big.select("lang", "text").collect()]
    assert _found(collocations.collocations(big, collocations.Phrases(top=300))) == brute(rows, top=300)


def test_products_beyond_64_bits(spark):
    n, a, left, right = 4 * 10**16, 3 * 10**16, 3 * 10**16 + 1, 3 * 10**16 + 7
    weights = spark.createDataFrame(
        [("x", "p q", 2, a), ("x", "p", 1, left - a), ("x", "q", 1, right), ("x", None, 0, n)], "grp string, phrase string, k int, weight long"
    )
    row = collocations.scored_phrases(weights, collocations.Phrases()).collect()[0]
    assert (row.a, row.l, row.r, row.n, row.score) == (a, left, right, n, 1000 * a * n // (left * right))


def test_empty_table_and_clashing_names(spark):
    docs = phrases(spark)
    assert collocations.collocations(empty(docs)).count() == 0
    renamed = docs.withColumnsRenamed({"text": "phrase", "lang": "weight"}).selectExpr("*", "1 AS grp", "'x' AS text", "2 AS n")
    found = collocations.collocations(renamed, collocations.Phrases(least=20), "phrase", "weight")
    assert sorted(tuple(r[c if c != "lang" else "weight"] for c in COLUMNS) for r in found.collect()) == brute([tuple(r) for r in docs.select("lang", "text").collect()], 20)


def test_query(spark):
    found = queries()["op11_collocations"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert _found(found) == brute([tuple(r) for r in docs.select("lang", "text").collect()])
    assert dict(found.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in found.columns}
