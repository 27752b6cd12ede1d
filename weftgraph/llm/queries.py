"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import weftgraph
from weftgraph import configure
from weftgraph.llm import (
    collocations,
    fingerprints,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    near_vectors,
    oracles,
    packing,
    prefix_trie,
    quality,
    substring_dedup,
    suffix_dedup,
    vector_search,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _ship_package(spark: SparkSession) -> None:
    """Hand the package to Python workers that could not import it by themselves."""
    root = Path(weftgraph.__file__).resolve().parents[1]
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in (Path.cwd().resolve(), *known) or spark in _shipped:
        return
    archive = shutil.make_archive(tempfile.mkdtemp() + "/weftgraph", "zip", root, "weftgraph")
    spark.sparkContext.addPyFile(archive)
    _shipped.append(spark)


_shipped: list[SparkSession] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    _ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("rest.doc_id", "license", "score", "n_matches")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(3) != 1))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("rest.doc_id", "lang_pred", "score").withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(False)))


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(20)) == 0))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "group_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "rest.doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "rest.doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    taken = F.aggregate("entries", F.lit(0).cast("long"), lambda n, e: n + e.words).alias("taken")
    return mixing.schedule(docs).select("rest.doc_id", "size", "source_size", "target", taken)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0)
    found = quality.scores(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return found.select(
        "rest.doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted")
    )


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edit_check(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("k")


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("conv_id")
    opening = F.crc32(ids.cast("string").cast("binary")) % 9
    nodes = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), ids - ids % 5, opening)
    return nodes.drop("node", "parent")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_license_scan,
        op2_language_id,
        op3_vector_search,
        op4_jaccard_join,
        op5_suffix_dedup,
        op6_substring_dedup,
        op7_packing,
        op8_mixing,
        op9_quality,
        op10_order_minhash,
        op11_collocations,
        op12_near_vectors,
        op13_prefix_trie,
    )
    return {f.__name__: f for f in found}


def _license_sql() -> str:
    """Lines and paragraphs against the templates, by joins on bigrams."""
    wordings = license_scan.template_bigrams(license_scan.TEMPLATES)
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(n)}, {len(g)}, {quoted(b)})" for i, (n, g) in enumerate(wordings) for b in g)
    return f"""
WITH template(i, license, n, gram) AS (VALUES {rows}),
units AS (
  SELECT doc_id, row_number() OVER () AS u, unit FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents
    UNION ALL
    SELECT doc_id, unit FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) AS unit FROM documents)
    WHERE contains(unit, chr(10)))),
split AS (SELECT doc_id, u, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
grams AS (SELECT DISTINCT doc_id, u, w[k] || ' ' || w[k + 1] AS gram FROM (SELECT *, unnest(range(1, len(w))) AS k FROM split WHERE len(w) > 1)),
sized AS (SELECT *, count(*) OVER (PARTITION BY u) AS m FROM grams),
dice AS (
  SELECT doc_id, u, i, license, 2.0::DOUBLE * count(*) / (m + n) AS score
  FROM sized JOIN template USING (gram) GROUP BY doc_id, u, i, license, m, n),
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS nth FROM dice WHERE score >= 0.8) WHERE nth = 1),
best AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_matches, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS place FROM hits)
SELECT d.doc_id, b.license, b.score, coalesce(b.n_matches, 0)::INTEGER AS n_matches
FROM documents d LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (doc_id)
"""


ORACLES: dict[str, str] = {
    "op1_license_scan": _license_sql(),
    "op11_collocations": oracles.COLLOCATIONS,
    "op12_near_vectors": oracles.NEAR_VECTORS,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
