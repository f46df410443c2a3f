"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, token files.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
reread as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tontine.llm import decontaminate as decontamination
from tontine.llm import mixing, near_dup, quality, token_files
from tontine.llm.common import materialize, on_workers, read_table


@on_workers
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


@on_workers
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near-duplicates."""
    return near_dup.drop_near_duplicates(docs)


@on_workers
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule clears."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


@on_workers
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


@on_workers
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    return token_files.token_output(docs)


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix_sources), ("tokens", token_output)]

#: A trained classifier and a tokenizer's vocabulary are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
