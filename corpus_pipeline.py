"""A corpus from raw documents to packed sequences, as stages that each read the last one's Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph import configure
from weftgraph.llm import jaccard_join, mixing, packing, quality, substring_dedup
from weftgraph.llm.queries import TOKENIZER, fold, table
from weftgraph.session import cut_lineage

#: The classifier, the similarity join and the tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels, does not reject."""
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0)
    scored = quality.scores(docs, quality.fit(docs, labels))
    kept = scored.where(F.col("score") >= quality.ACCEPT)
    return kept.select(*(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    configure(spark)
    return jaccard_join.without_near_copies(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the words of repeated passages; untouched ones keep their text as it was."""
    configure(spark)
    found = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)}
    return found.select(*(changed.get(c, F.col("rest").getField(c) if c != "text" else F.col(c)).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document may come up to three times."""
    configure(spark)
    found = mixing.mix(docs)
    return found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    configure(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_near_copies),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
