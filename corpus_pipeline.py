"""The corpus pipeline: from raw documents to packed sequences.

Each stage is a function of (spark, docs, sf_dir). What it returns is written as Parquet and read again for
the next one, so no stage computes another's work twice and a lost executor costs one stage's tasks only.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import quoted
from tidemark.llm import decontaminate, neardup, packing, paragraphs, toxicity
from tidemark.llm.frames import table
from tidemark.session import shared_dir


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose key is not in ``ids`` (gone), whatever other columns they have."""
    docs, ids = docs.alias("docs"), ids.alias("ids")
    return docs.join(ids, F.col("docs.doc_id").eqNullSafe(F.col("ids.gone")), "left_anti")


def _aside(docs: DataFrame) -> DataFrame:
    """Key, text and, in one column, all others, so that no operator's own column takes the name of one of theirs."""
    others = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.struct(*others).alias("others"))


def _back(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in columns])


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject. Null and empty texts stay."""
    field = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_aside(docs), field)
    return _back(scored.filter(F.col("toxic_score") < toxicity.THRESHOLD), docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest key; texts without words all stay.

    A key that several rows share goes only if none of them stays; of rows that share key and text one stays.
    """
    found = neardup.near_duplicates(docs)
    by_key = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    by_key = neardup.kept(by_key)
    if not by_key.filter("n > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    return _without(docs, by_key.filter("NOT kept").select(F.col("doc_id").alias("gone")))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the paragraphs and passages that an earlier document has; n_chars follows the text."""
    left = _back(paragraphs.deduplicate(_aside(docs)), docs.columns)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated").select(F.col("doc_id").alias("gone")).distinct())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.best_fit(docs)


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("substring_dedup", without_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Training, components and packing are iterative, so SQL has no equivalent; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
