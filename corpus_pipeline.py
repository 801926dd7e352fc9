"""From raw documents to packed training sequences, one written table after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import ngram_join, packing, quality, suffix_dedup, toxicity
from tallybook.llm.blocks import written_table


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, _labels(spark, sf_dir))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.keep_clean(docs, _labels(spark, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles (five words, 0.8 or more), the one with the smallest id."""
    return ngram_join.one_per_component(docs, size=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 100 bytes that came before."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_clean),
    ("near duplicates", one_of_each_group),
    ("repeated passages", without_repeats),
    ("packing", packed),
]

# The stages are models, a suffix sort and a tokenizer; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
