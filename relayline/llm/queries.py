"""One query per operator over whole tables, as the contracts ask, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayline.llm import (bpe, chat, collocations, divergence, importance, metric_search, mixing, near_vectors,
                           ngram_join, phrase_names, pii, secret_scan, toxicity)
from relayline.llm.common import table
from relayline.llm.oracle import ORACLE_SQL


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    fixed = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], rows.schema)
    return chat.digests(rows.unionByName(fixed))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, inside=50, first=2000)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), least=3, first=200)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_names.compare(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_quality_resampling, op3_pii, op4_exact_top_k, op5_chat_formatting, op6_bpe, op7_secret_scans, op8_mixing, op9_toxicity,
    op10_embedding_near_dedup, op11_phrase_collocations, op12_source_divergence,
    op13_document_fingerprints, pipeline)}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
