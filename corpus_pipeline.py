"""A training-corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet under the shared folder and reads it again as
the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relayline.llm import bpe, importance, mixing, ngram_join, secret_scan
from relayline.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards good labels rejects go."""
    return importance.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity 0.8 stays."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become marks of their kind."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and a digest of what they decode to."""
    return bpe.tokenise(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixture),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


#: The quality, join and BPE stages are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
