"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    decontaminate,
    filteraudit,
    language,
    mainpage,
    neardup,
    packing,
    paragraphs,
    quality,
    suffixes,
    tokencounts,
    toxicity,
    vectorcodes,
)
from tidemark.llm.frames import table
from tidemark.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_composite_density_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainpage.extract(table(spark, sf_dir, "pages"))


def op2_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents"))


def op5_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op7_variable_capacity_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op8_offset_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count(table(spark, sf_dir, "documents"))


def op9_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_paragraph_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document, with the words before, the words removed and the runs removed."""
    return paragraphs.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_lehmer_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hilbert_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op13_relational_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be read back from the formatted conversations, conversation -7 included."""
    return chat.digests(chat.format_chats(chat.with_hostile_example(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_composite_density_extraction": op1_composite_density_extraction,
    "op2_hierarchical_language": op2_hierarchical_language,
    "op3_crf_toxicity": op3_crf_toxicity,
    "op4_difference_cover_dedup": op4_difference_cover_dedup,
    "op5_risk_controlled_quality": op5_risk_controlled_quality,
    "op6_bayesian_minhash": op6_bayesian_minhash,
    "op7_variable_capacity_packing": op7_variable_capacity_packing,
    "op8_offset_token_counts": op8_offset_token_counts,
    "op9_winnowing_decontamination": op9_winnowing_decontamination,
    "op10_paragraph_banding": op10_paragraph_banding,
    "op11_lehmer_filter_audit": op11_lehmer_filter_audit,
    "op12_hilbert_vector_codes": op12_hilbert_vector_codes,
    "op13_relational_chats": op13_relational_chats,
}
