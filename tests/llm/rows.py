"""Small inputs with the awkward cases, and helpers to compare."""

from __future__ import annotations

import re

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall old tree near the river bank and hum"


def awkward(spark):
    """Documents with nulls in every column, repeated rows, empty and very long texts, and
    extra columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, SENTENCE, "en", "a", 1, "x"),
        (2, SENTENCE, "en", None, 1, "x"),
        (3, None, None, None, None, None),
        (None, SENTENCE + " twice", "en", "a", 1, "x"),
        (4, "", "de", "b", 0, ""),
        (5, "   \n\t ", "de", "b", 0, ""),
        (6, "a" * 5000, "fr", "b", 0, ""),
        (7, "é" * 300 + " ü", "fr", "c", 0, ""),
        (8, long, "en", "a", 0, ""),
        (8, long, "en", "a", 0, ""),
        (9, "x", "en", "a", 0, ""),
        (10, "12345 67890 !!", "en", "a", 0, ""),
        (11, SENTENCE * 12, "en", "a", 0, ""),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, h string").repartition(3)


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def empty(frame):
    return frame.where("false")


def words(text):
    return WORD.findall(text or "")
