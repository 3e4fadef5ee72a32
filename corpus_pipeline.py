"""From raw documents to packed training sequences: the stages of the pipeline, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldsignal.llm import decontaminate, packing, quality, simhash, suffixdedup
from fieldsignal.llm.common import table
from fieldsignal.llm.queries import tokenizer_path
from fieldsignal.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that stand earlier."""
    return suffixdedup.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints, byte strings and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
