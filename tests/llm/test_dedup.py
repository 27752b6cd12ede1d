"""Operators 5 and 6 against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import awkward, documents, empty, words
from weftgraph.llm import anchors, suffix_array, suffix_dedup, substring_dedup
from weftgraph.llm.queries import queries
from weftgraph.llm.spans import keyed, remove_spans


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _cover(length, starts, window):
    gone = np.zeros(length, bool)
    for p in starts:
        gone[p : p + window] = True
    return gone


def brute_bytes(rows, window):
    """Per (id, text): bytes, removed, spans and hash of the rest; null ids first."""
    order = lambda i: (i is not None, i or 0)
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - window + 1):
            part = data[p : p + window]
            first[part] = min(first.get(part, (order(i), p)), (order(i), p))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        starts = [p for p in range(len(data) - window + 1) if first[data[p : p + window]] < (order(i), p)]
        gone = _cover(len(data), starts, window)
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, _sha(bytes(np.frombuffer(data, np.uint8)[~gone]))))
    return Counter(out)


def brute_words(rows, window):
    count = Counter()
    for _, text in rows:
        w = words(text)
        count.update(tuple(w[p : p + window]) for p in range(len(w) - window + 1))
    out = []
    for i, text in rows:
        w = words(text)
        gone = _cover(len(w), [p for p in range(len(w) - window + 1) if count[tuple(w[p : p + window])] > 1], window)
        out.append((i, len(w), int(gone.sum()), _sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return Counter(out)


def _rows(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def _bag(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("text", ["", "a", "banana", "mississippi", "aaaaaaa", "abababab", "cabbage" * 9])
@pytest.mark.parametrize("induce", [None, "_induce_by_bucket", "_induce_by_place"])
def test_suffix_array(text, induce, monkeypatch):
    if induce:
        chosen = getattr(suffix_array, induce)
        monkeypatch.setattr(suffix_array, "_induce_by_bucket", chosen)
        monkeypatch.setattr(suffix_array, "_induce_by_place", chosen)
    s = np.append(np.frombuffer(text.encode(), np.uint8).astype(np.int64), 0)
    sa = suffix_array.suffix_array(s)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    plcp = suffix_array.permuted_common_prefixes(s, sa)
    for a, b in zip(sa[1:].tolist(), sa[:-1].tolist()):
        common = 0
        while s[a + common : a + common + 1].tolist() == s[b + common : b + common + 1].tolist() != []:
            common += 1
        assert plcp[a] == common


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(3)
    shape = anchors.Shape("bytes", 20, 6)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    doc, start, n, key, _ = anchors.cells(shape, *anchors.units_of(shape, data, np.array([0, 1000, 1010, 3000])))
    at = np.array([0, 1000, 1010])[doc] + start
    known = {}
    total = 0
    for a, m, k in zip(at.tolist(), n.tolist(), key.tolist()):
        for p in range(a, a + m):
            assert known.setdefault(data[p : p + 20].tobytes(), k) == k
            total += 1
    assert total == 981 + 0 + 1971  # every window of every document, once


def test_sketch_loses_nothing(spark):
    """A key that occurs twice is always estimated to repeat, however full the sketch."""
    docs = keyed(documents(spark), "doc_id", "text")
    shape = anchors.Shape("words", 35, 12)
    full = anchors.repeated_keys(docs, shape, most_bits=16)
    wide = anchors.candidate_cells(docs, shape, anchors.repeated_keys(docs, shape)).groupBy("key").count().where("count > 1")
    tight = anchors.candidate_cells(docs, shape, full).groupBy("key").count().where("count > 1")
    assert wide.exceptAll(tight).count() == tight.exceptAll(wide).count() == 0


@pytest.mark.parametrize("make", [documents, awkward])
@pytest.mark.parametrize("split", [2000, 2])
def test_bytes(spark, make, split):
    docs = make(spark)
    frame = keyed(docs, "doc_id", "text")
    found = remove_spans(frame, suffix_dedup.repeated_spans(frame, 100, 48, split), "bytes")
    got = _bag(found.select("rest.doc_id", "n_units", "n_removed", "n_spans", F.sha2("kept", 256)))
    assert got == brute_bytes(_rows(docs), 100)


def test_contents_go_out_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 300)
    test_bytes(spark, awkward, 2)


@pytest.mark.parametrize("make", [documents, awkward])
def test_words(spark, make):
    docs = make(spark)
    found = substring_dedup.remove_repeats(docs)
    assert _bag(found.select("rest.doc_id", "n_units", "n_removed", F.sha2("kept", 256))) == brute_words(_rows(docs), 35)


@pytest.mark.parametrize("module", [suffix_dedup, substring_dedup])
def test_other_columns_and_empty_tables(spark, module):
    docs = awkward(spark)
    found = module.remove_repeats(docs)
    assert _bag(found.select("rest.doc_id", "rest.n", "rest.h")) == _bag(docs.select("doc_id", "n", "h"))
    assert module.remove_repeats(empty(docs)).count() == 0


def test_queries(spark):
    folder = "/root/testdata/sf0.001"
    rows = _rows(documents(spark))
    five = queries()["op5_suffix_dedup"](spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    six = queries()["op6_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert _bag(five) == brute_bytes(rows, 100)
    assert _bag(six) == brute_words(rows, 35)
