"""The registered queries: each applies its operator, with production parameters, to whole tables
and derives the agreed digest columns from what the operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm import decontaminate, fingerprints, lexical, licenses, line_dedup, mixing, near_dup, neighbours, prefix_trie, quality, secrets, token_files, url_filter
from tontine.llm.common import on_workers, read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files at source/lang/thousand/id: the tables have no paths of their own."""
    d = read_table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    path = F.concat_ws("/", part(F.col("source")), part(F.col("lang")), part(F.floor(F.col("doc_id") / 1000)), F.concat(part(F.col("doc_id")), F.lit(".txt")))
    return licenses.scan(d.select("doc_id", "text", path.alias("path")), keep=("doc_id",))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    index = line_dedup.LineIndex(spark)
    postings = index.insert(docs)
    out = index.dedup(docs, postings)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages")).drop("antecedent")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fingerprints.edit_report(read_table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprints.as_text(F.col("marks")).alias("fingerprint"),
                    fingerprints.as_text(F.col("edited_marks")).alias("edited_fingerprint"), "near_edited", "near_next")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: on_workers(f) for f in (op1_license_scan, op2_decontaminate, op3_near_dup, op4_line_dedup, op5_mixing, op6_neighbours, op7_secret_scan,
                                   op8_token_files, op9_quality, op10_url_filter, op11_fingerprints,
                                   op12_lexical_search, op13_prefix_trie)}
