"""Operators 1, 2, 9 and 10: against brute force, and on held-out rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import FOLDER, awkward, documents, empty
from tests.oracle import compare
from weftgraph.llm import fingerprints, language_id, license_scan, quality
from weftgraph.llm.sampling import spread
from weftgraph.llm.queries import ORACLES, queries

LARGER = "/root/testdata/sf0.01"


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# Operator 1


def brute_license(text, least=0.8):
    grams = license_scan.template_bigrams(license_scan.TEMPLATES)
    units = (text or "").split("\n") + [p for p in re.split(r"\n[ \t\r]*\n", text or "") if "\n" in p]
    found = []
    for unit in units:
        w = re.findall(r"[^\W_]+", unit.lower())
        own = {f"{a} {b}" for a, b in zip(w, w[1:])}
        best = max(((2 * len(own & set(g)) / (len(own) + len(g)), -i, n) for i, (n, g) in enumerate(grams)), default=(0, 0, ""))
        if own and best[0] >= least:
            found.append(best)
    best = max(found, default=(None, 0, None))
    return best[2], best[0], len(found)


NOTICES = [
    (1, "Some prose here.\nReleased under the MIT License.\nMore prose."),
    (2, "licensed  under the APACHE license; version 2.0"),
    (3, "x\n\n" + license_scan.TEMPLATES["MIT"][1].replace(" ", "\n", 9) + "\n \nyes"),
    (4, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY 4.0."),
    (5, None),
    (6, ""),
    (7, "Licensed"),
]


def test_license_scan(spark):
    rows = NOTICES + [(r.doc_id, r.text) for r in documents(spark).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = {(r.rest.doc_id): (r.license, r.score, r.n_matches) for r in license_scan.scan(frame).collect() if r.rest.license == "clash"}
    want = {i: brute_license(t) for i, t in dict(reversed(rows)).items()}
    for i, t in rows[: len(NOTICES)]:
        assert brute_license(t) in [(r.license, r.score, r.n_matches) for r in license_scan.scan(frame.where(F.col("doc_id") == i)).collect()]
    assert {i: got[i] for i in want if i > 7} == {i: want[i] for i in want if i > 7}
    assert license_scan.scan(empty(frame)).count() == 0
    assert license_scan.scan(awkward(spark)).where("n_matches > 0").count() == 0


GNU_HEADER = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by "
    "the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
MIT_NO_ATTRIBUTION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."
)
BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_2_BLOCK = f"""/*
 * {BSD_OPENING.replace(" are permitted", chr(10) + " * are permitted")}
 *
 * 1. Redistributions of source code must retain the above copyright notice, this list of conditions
 *    and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
 *    and the following disclaimer in the documentation and/or other materials provided with the distribution.
 */"""


@pytest.mark.parametrize(
    "text, license",
    [
        (GNU_HEADER.format("program", "General", "2"), "GPL-2.0"),
        (GNU_HEADER.format("program", "General", "3"), "GPL-3.0"),
        (GNU_HEADER.format("program", "Affero General", "3"), "AGPL-3.0"),
        (GNU_HEADER.format("library", "Lesser General", "2.1"), "LGPL-2.1"),
        (GNU_HEADER.format("library", "Lesser General", "3"), "LGPL-3.0"),
        ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This project is released under the MIT License.", "MIT"),
        (MIT_NO_ATTRIBUTION, "MIT-0"),
        (MIT_NO_ATTRIBUTION[:-1] + ", subject to the following conditions:", "MIT"),
        (BSD_OPENING, "BSD-2-Clause OR BSD-3-Clause"),
        (BSD_2_BLOCK, "BSD-2-Clause"),
    ],
)
def test_licenses_that_open_alike(spark, text, license):
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.license == license


def test_license_sql(spark):
    rows, problem = compare(spark, FOLDER, queries()["op1_license_scan"], ORACLES["op1_license_scan"])
    assert problem == "" and rows == 200


# Operator 2


def brute_code(model_texts, order, least, text):
    """Bits of ``text`` by walking contexts from the longest to the empty one."""
    counts = {}
    for t in model_texts:
        data = b"\n" * order + t
        for p in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[p - k : p], {}).setdefault(data[p], 0)
                counts[data[p - k : p]][data[p]] += 1
    for c in list(counts):
        counts[c] = {b: n for b, n in counts[c].items() if len(c) < 3 or n >= least}
    bits, data = 0.0, b"\n" * order + text
    for p in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[p - k : p])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if data[p] in seen:
                bits -= np.log2(seen[data[p]] / total)
                break
            bits -= np.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("the dog", "en"), ("le chat est là", "fr"), ("un chien", "fr")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    probe = ["the hat", "là là", "", "zzÿ", "cat"]
    data = [t.encode() for t in probe]
    offsets = np.append(0, np.cumsum([len(d) for d in data]))
    bits = model.code_lengths(np.frombuffer(b"".join(data), np.uint8), offsets)
    for i, d in enumerate(data):
        for j, lang in enumerate(("en", "fr")):
            want = brute_code([t.encode() for _, t, v in rows if v == lang], 4, 2, d)
            assert bits[i, j] == pytest.approx(want, rel=1e-5)


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("rest", F.lit(1))
    found = {r.rest.doc_id: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {3, 4, 5, 10}
    assert all(0 <= r.score <= 1 for r in found.values()) and found[3].score == 0
    assert language_id.predict(empty(docs), language_id.fit(empty(docs))).count() == 0
    assert language_id.predict(docs, language_id.fit(empty(docs))).where("lang_pred <> 'und'").count() == 0


def test_copies_do_not_sway_the_sample(spark):
    """Each language is learnt, from texts that count once: many copies change nothing."""
    rows = [(f"wort{i % 3} und satz{i % 3} am see", "de") for i in range(9)]
    rows += [(f"the {i} cat sat on mat {i * 7919}", "en") for i in range(300)]
    copied = rows[:3] * 4000 + rows[9:] + rows[9:12] * 2000
    frames = [spark.createDataFrame(r, "text string, lang string") for r in (rows, copied)]
    sample = language_id.Sample(texts=4)
    once, often = (language_id.fit(f, sample) for f in frames)
    assert once.languages == often.languages == ["de", "en"]
    for a, b in zip(once.costs + once.escapes, often.costs + often.escapes):
        assert np.array_equal(a.keys, b.keys) and np.array_equal(a.values, b.values)
    # The followers of the empty context in each language's two texts.
    probe = np.frombuffer(b"wort am see", np.uint8)
    bits = often.code_lengths(probe, np.array([0, len(probe)]))[0]
    assert bits[0] < bits[1]


def test_languages_held_out(spark):
    found = queries()["op2_language_id"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


# Operator 9


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = queries()["op9_quality"](spark, LARGER).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in held if r.quality == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (9, 0), (3, 1), (99, 0), (8, None), (8, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.scores(docs, model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 and r.rest.score == "clash" for r in rows)
    assert len({r.score for r in rows if r.text in (None, "")}) == 1
    assert quality.fit(docs, labels) == model
    assert quality.scores(empty(docs), quality.fit(empty(docs), empty(labels))).count() == 0


# Operator 10


def test_signature(spark):
    """Equal texts agree; the slots hold the tuple of smallest numbered k-mers in text order."""
    texts = ["", "one", "one two", "a b a b a b a b", "a b " * 400, "x" * 1000, "b a " * 400]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    sig = {r.i: r.s for r in frame.select("i", fingerprints.signature(F.col("t")).alias("s")).collect()}
    assert sig[0] == [] and len(sig[1]) == len(sig[2]) == 1
    assert all(len({s >> 32 for s in v}) == len(v) for v in sig.values())
    # 400 repetitions are 400 different numbered k-mers, so most slots are in use.
    assert len(sig[4]) > 60
    numbered = frame.where("i = 3").select(fingerprints._numbered(fingerprints._kmers(F.split("t", " "), 2)).alias("n")).first().n
    assert len(set(numbered)) == 7


def brute_pieces(text, piece=12):
    """Words, and longer runs cut where their characters say so, one character at a time."""
    out = []
    for run in re.findall(r"[^\x20\x09-\x0D]+", text):
        at = 0
        while at < len(run):
            if len(run) - at <= piece:
                out.append(run[at:])
                break
            end = at
            if ord(run[at]) < 128:
                while end < len(run) and end - at < piece and ord(run[end]) < 128:
                    end += 1
                    if run[end - 1] in "'/7?GOW_gow":
                        break
                out.append(run[at:end])
            else:
                while end < len(run) and ord(run[end]) >= 128:
                    end += 1
                if end - at <= piece:
                    out.append(run[at:end])
                else:
                    data, part = run[at:end].encode(), b""
                    for i, b in enumerate(data):
                        part += bytes([b])
                        if b in b"\x8b\x9b\xab\xbb" or len(part) == 3 * piece or i == len(data) - 1:
                            out.append(part.decode("latin-1"))
                            part = b""
            at = end
    return out


MIXED = [
    "", "a", "twelve chars", "thirteenchars thirteenthchars/more", "GATTACA" * 30, "\u4f60\u597d" * 40, "\u0e01\u0e32\u0e19" * 30 + "abc" + "\U0001f600" * 20,
    "https://example.org/a/b?q=wow_" * 5, "x" * 100, "\u00a0\u3000" * 10, "\x00\x01" * 20 + "\u00e9", "".join(chr(0x4E00 + (i * i * 7) % 9000) for i in range(900)),
]


def test_pieces(spark):
    frame = spark.createDataFrame(list(enumerate(MIXED)), "i int, t string")
    for r in frame.select("i", fingerprints._pieces(F.col("t"), 12).alias("p")).collect():
        assert r.p == brute_pieces(MIXED[r.i]), MIXED[r.i][:40]


@pytest.mark.parametrize("place", [0, 5, 700, 1500])
def test_one_character_put_into_a_long_run(spark, place):
    """Chinese, Thai-like and encoded text without spaces stay near their copies."""
    rng = np.random.default_rng(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    runs = [
        "".join(chr(0x4E00 + c) for c in rng.integers(0, 5000, 1500)),
        "".join(chr(0x0E01 + c) for c in rng.integers(0, 46, 1500)),
        "".join(letters[c] for c in rng.integers(0, 64, 1500)),
    ]
    frame = spark.createDataFrame([(r, r[:place] + r[7] + r[place:]) for r in runs], "a string, b string")
    sig = lambda c: fingerprints.signature(F.col(c))
    assert all(r.near > 0.9 for r in frame.select(fingerprints.likeness(sig("a"), sig("b")).alias("near")).collect())


def brute_signature(spark, texts, k=2, slots=64, keep=2):
    """Order MinHash in plain Python; only the 64-bit hash itself is asked of Spark."""

    def hashes(rows, column):
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + column)
        cols = [c for c in frame.columns if c != "i"]
        return [r.h for r in frame.select("i", F.xxhash64(*cols).alias("h")).orderBy("i").collect()]

    grams = []
    for d, text in enumerate(texts):
        p = brute_pieces(text)
        grams += [(d, g) for g in (zip(p, p[1:]) if len(p) >= k else [])]
    gram_hash = [h >> 28 for h in hashes([g for _, g in grams], "a string, b string")]
    seen, numbers, places = {}, [], []
    for (d, _), h in zip(grams, gram_hash):
        numbers.append(seen.get((d, h), 0))
        seen[d, h] = numbers[-1] + 1
    size = {}
    for d, _ in grams:
        places.append(size.get(d, 0))
        size[d] = places[-1] + 1
    numbered = hashes(list(zip(gram_hash, numbers)), "a long, n int")
    held = {}
    for (d, _), h, at in zip(grams, numbered, places):
        held.setdefault((d, (h >> 58) + slots // 2), []).append((h >> 28, at))
    tuples = [[h & (2**36 - 1) for h, _ in sorted(sorted(v)[:keep], key=lambda x: x[1])] for v in held.values()]
    codes = hashes([(t,) for t in tuples], "v array<long>")
    out = {d: set() for d in range(len(texts))}
    for (d, slot), code in zip(held, codes):
        out[d].add((slot << 32) | ((code & (2**64 - 1)) >> 32))
    return out


def test_signatures_by_brute_force(spark):
    texts = [t for t in MIXED if len(brute_pieces(t)) >= 2] + [r.text for r in documents(spark).where("text is not null").orderBy("doc_id").limit(40).collect()]
    texts = [t for t in texts if len(brute_pieces(t)) >= 2]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.s for r in frame.select("i", fingerprints.signature(F.col("t")).alias("s")).collect()}
    want = brute_signature(spark, texts)
    assert {i: set(s) for i, s in got.items()} == want
    a, b = want[0], want[1]
    used = {x >> 32 for x in a | b}
    near = frame.where("i < 2").agg(F.max_by("t", -F.col("i")).alias("a"), F.max_by("t", "i").alias("b"))
    r = near.select(fingerprints.likeness(fingerprints.signature(F.col("a")), fingerprints.signature(F.col("b"))).alias("n")).first()
    assert r.n == pytest.approx(len(a & b) / len(used))


def brute_edit(rows):
    """(n, edited) by id; rows are distinct by id."""
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, text) in enumerate(order):
        t, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest())
    return out


def test_order_minhash_query(spark):
    rows = queries()["op10_order_minhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == brute_edit([(r.doc_id, r.text) for r in documents(spark).collect()])
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    prints = {}
    for r in rows:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    long_ = [r for r in rows if r.n_chars >= 40]
    assert np.mean([r.near_edited > r.near_next for r in long_]) > 0.95


def test_order_minhash_feels_order(spark):
    w = [f"word{i}" for i in range(300)]
    swapped = w[150:] + w[:150]
    frame = spark.createDataFrame([(" ".join(w), " ".join(swapped), " ".join([*w[:150], "other", *w[150:]]))], "a string, moved string, edited string")
    sig = lambda c: fingerprints.signature(F.col(c))
    r = frame.select(fingerprints.likeness(sig("a"), sig("moved")).alias("moved"), fingerprints.likeness(sig("a"), sig("edited")).alias("edited")).first()
    assert r.edited > 0.9 > 0.75 > r.moved


def test_order_minhash_of_awkward_rows(spark):
    docs = awkward(spark).withColumnsRenamed({"n": "sig", "source": "edited"})
    rows = fingerprints.edit_check(docs).collect()
    assert len(rows) == 13
    by = {r.doc_id: r for r in rows}
    assert by[3].fingerprint == by[4].fingerprint == "" and by[3].near_edited == 1 and by[3].near_next == 1 and by[3].edited == ""
    assert len({tuple(r) for r in rows if r.doc_id == 8}) == 1
    assert by[1].near_next == 1  # the next text is the same
    assert fingerprints.edit_check(empty(docs)).count() == 0
    alone = fingerprints.edit_check(docs.where("doc_id = 1")).first()
    assert alone.near_next == 1 and alone.n_chars == len(alone.edited)




def test_what_is_learnt_from_is_spread_over_long_texts(spark):
    texts = [b"".join(bytes([k % 251]) * 8 for k in range(n)) for n in (0, 5, 128, 129, 4000)] + [None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t binary")
    found = {r.i: r.s for r in frame.select("i", spread(F.col("t"), 1024, 64).alias("s")).collect()}
    assert found[5] is None and all(bytes(found[i]) == texts[i] for i in range(3))
    assert 1024 - 64 < len(found[3]) <= 1024
    parts = [bytes(found[4])[at : at + 64] for at in range(0, 1024, 64)]
    places = [next(p for p in range(0, 32000, 64) if texts[4][p : p + 64] == part) for part in parts]
    assert len(found[4]) == 1024 and min(places) < 12_000 and max(places) > 4_000


def test_the_end_of_a_long_text_is_learnt_from(spark):
    """Texts that begin alike and differ only beyond the bound on bytes."""
    same = "0123456789 " * 1600
    rows = [(i, same + ("good words are here " if i % 2 else "zzz qqq xxx spam ") * 6000, i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    tails = spark.createDataFrame([(1, "good words are here " * 50), (0, "zzz qqq xxx spam " * 50)], "doc_id long, text string")
    found = {r.rest.doc_id: r.score for r in quality.scores(tails, model).collect()}
    assert found[1] > 0.5 > found[0]


def test_the_curve_stays_finite_where_labels_are_told_apart():
    """Features like those of a real sample that drove plain Newton steps away: nearly separable labels."""
    rng = np.random.default_rng(5)
    for gap in (0.02, 0.05, 0.2):
        y = (rng.random(2000) < 0.5).astype(float)
        x = quality._terms(np.stack([(2 * y - 1) * gap + rng.normal(size=2000) * 0.01, 0.4 + 0.1 * y + rng.normal(size=2000) * 0.02], axis=1))
        w = quality._logistic(x, y)
        assert np.abs(w).max() < 1000 and ((x @ w > 0) == (y == 1)).mean() > 0.95
