"""Operators 7 and 8, and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.rows import FOLDER, awkward, documents, empty, words
from tests.llm.test_dedup import brute_words
from tests.llm.test_similarity import brute_links
from weftgraph.llm import mixing, packing, quality
from weftgraph.llm.queries import TOKENIZER, queries
from weftgraph.session import cut_lineage


def brute_pieces(rows, tokens=2048):
    encode = Tokenizer.from_file(TOKENIZER)
    out = []
    for i, text in rows:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), tokens)):
            part = ids[at : at + tokens]
            out.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


def check_placement(rows, tokens=2048):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return len(places)


def test_packing_query(spark):
    rows = queries()["op7_packing"](spark, FOLDER).collect()
    want = brute_pieces([(r.doc_id, r.text) for r in documents(spark).collect()])
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_placement(rows) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_ids_are_those_of_the_plain_call(spark):
    """Special tokens, what becomes one in lower case, capitals with combining marks, and random strings."""
    rng = random.Random(3)
    pool = [*"abzABZéÉßÀÖØÞþÿñµªºǅİıſΣςσn\u0303\u0301\u0308 \t\n\r\x0b\x0c\x85\xa0.,;:!?'\"<>|-_()[]0123٣½²中文日กำ🙂\u200d\ufeff"]
    pool += ["'s", "'T", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " the ", " word,", "'T\u0308"]
    texts = ["a <|endoftext|> b", "a <|EndOfText|> b", "'T\u0308", "(word)word's.été,", "x" * 3000 + ","]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = packing.tokenize(docs, TOKENIZER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == brute_pieces(list(enumerate(texts)))


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("piece", F.lit("clash"))
    extra = spark.createDataFrame([(50, "<|endoftext|> it's  ÀÉ x y\x1cz ́e 3rd")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute_pieces([tuple(r) for r in docs.collect()])
    check_placement(rows)
    assert packing.pack_documents(empty(docs), TOKENIZER).count() == 0
    piece = packing.tokenize(extra, TOKENIZER, with_ids=True).first()
    assert zlib.crc32(np.array(piece.ids, "<u4").tobytes()) == piece.ids_crc32 and len(piece.ids) == piece.length


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 120, 2000)
    capacity = packing.Capacity(tokens=120, documents=3, cost=9000, rule=rule) if rule == "dot" else packing.Capacity(tokens=120, documents=3, cost=14400)
    lengths = lengths[lengths**2 <= (capacity.cost or 0)]
    sequence, offset = packing.place(lengths, capacity)
    for s in np.unique(sequence):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()
        assert lengths[own].sum() <= 120 and len(own) <= 3 and (lengths[own] ** 2).sum() <= capacity.cost


def brute_targets(size, most=3):
    """By resharing the excess until none is above."""
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, fixed = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= most * size[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * size[s] for s in over}


def _check_mix(rows, texts):
    size = defaultdict(int)
    for r, source, text in texts:
        size[source] += len(words(text))
    goal = brute_targets(size)
    taken = defaultdict(int)
    for r in rows:
        source = dict((i, s) for i, s, _ in texts)[r.doc_id]
        assert r.source_size == size[source] and r.target == pytest.approx(goal[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for s in size:
        assert taken[s] == pytest.approx(goal[s], abs=1)


def test_mixing_query(spark):
    texts = [(r.doc_id, r.source, r.text) for r in documents(spark).collect()]
    rows = queries()["op8_mixing"](spark, FOLDER).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(words(t)) for i, _, t in texts}
    _check_mix(rows, texts)
    again = queries()["op8_mixing"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_capped_sources(spark):
    """A source far below its share, a null one, an empty one, and a hot one."""
    texts = [(i, "hot", "w " * 50) for i in range(300)] + [(1000 + i, "aa", "w w w") for i in range(3)]
    texts += [(2000, None, "w " * 9), (2001, "zz", ""), (2002, "zz", None), (2003, "b", "w " * 4000)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string")
    frame = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    taken = F.aggregate("entries", F.lit(0).cast("long"), lambda n, e: n + e.words).alias("taken")
    _check_mix(mixing.schedule(frame).select("rest.doc_id", "size", "source_size", "target", taken).collect(), texts)


@pytest.mark.parametrize("packets", [1 << 16, 4])
def test_taken_follows_from_one_global_order(spark, monkeypatch, packets):
    """The queue of all sources replayed: packets in the order of finish until the budget is used up."""
    monkeypatch.setattr(mixing, "_MOST_PACKETS", packets)
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "b", "b", "b", None]), rng.randrange(0, 90)) for i in range(400)] + [(900, "tiny", 3), (901, "zero", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    found = mixing.schedule(docs).collect()
    order = {s: k for k, s in enumerate(sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or "")))}
    queue = []
    for r in found:
        for e in r.entries:
            start = round(e.finish * r.target) - r.size if r.target else 0
            if not r.size or start >= r.target:
                continue
            step = r.size if e.finish <= 1 else -(-r.size // packets)
            for p in range(0, r.size, step):
                words_ = min(step, r.size - p)
                queue.append(((start + p + words_) / r.target, order[r.rest.source], start + p, words_, (r.rest.doc_id, e["pass"])))
    left, want = sum(s for _, _, s in rows), Counter()
    for *_, words_, key in sorted(queue):
        want[key] += min(left, words_)
        left -= min(left, words_)
    assert left == 0
    assert {(r.rest.doc_id, e["pass"]): e.words for r in found for e in r.entries if e.words} == {k: n for k, n in want.items() if n}


def test_mix_takes_what_the_schedule_says(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in mixed.collect():
        assert texts[r.doc_id].startswith(r.text)
        got[r.doc_id] += len(words(r.text))
    want = {r.doc_id: r.taken for r in queries()["op8_mixing"](spark, FOLDER).collect() if r.taken}
    assert got == want


def test_mixing_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("size", F.lit("clash"))
    assert mixing.schedule(docs.withColumn("size", mixing.word_count(F.col("text")))).count() == 13
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(empty(docs)).count() == 0
    assert mixing.schedule(docs.select("doc_id", "source", F.lit(None).cast("long").alias("size"))).where("target <> 0").count() == 0


def test_pipeline(spark):
    """Each stage on what the one before kept, against brute force."""
    docs = documents(spark)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    scores = {r.rest.doc_id: r.score for r in quality.scores(docs, quality.fit(docs, labels)).collect()}
    pairs = lambda frame: [(r.doc_id, r.text) for r in frame.collect()]
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = cut_lineage(stage(spark, before, FOLDER))
        if k < 4:
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        rows = pairs(before)
        if k == 0:
            assert {i for i, _ in pairs(after)} == {i for i, _ in rows if scores[i] >= 0.3}
        elif k == 1:
            assert sorted(i for i, _ in pairs(after)) == sorted({g for _, _, _, g in brute_links(rows)})
        elif k == 2:
            removed = {i: n for (i, _, n, _) in brute_words(rows, 35)}
            texts = dict(rows)
            for i, text in pairs(after):
                assert (text == texts[i]) if removed[i] == 0 else (len(words(text)) == len(words(texts[i])) - removed[i])
        elif k == 3:
            size = defaultdict(int)
            for r in before.collect():
                size[r.source] += len(words(r.text))
            taken = Counter()
            for r in after.collect():
                taken[r.source] += len(words(r.text))
            for s, goal in brute_targets(size).items():
                assert taken[s] == pytest.approx(goal, abs=1)
        else:
            found = after.collect()
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == brute_pieces(rows)
            check_placement(found)
        before = after
