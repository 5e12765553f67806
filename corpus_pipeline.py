"""The corpus pipeline: filter, deduplicate, mix, encode and decode the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
A null or empty text fails the quality rules; rows that repeat a doc_id are judged alike
and stay or go together; rows without a doc_id are filtered by their text only. Extra
columns are carried along. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaymill.llm import bpe, exact, mixing, quality, simhash
from assaymill.llm.common import written
from assaymill.llm.queries import VOCABULARIES, table

#: The part of each domain's tokens that the mixing stage keeps.
KEEP = {"good": 1.0, "poor": 0.5, "toxic": 0.02}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the isolation forest."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    return simhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring the domains' tokens to their targets."""
    return mixing.thin(docs, table(spark, sf_dir, "labels"), KEEP)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, number of tokens of each document, and the SHA-256 of the text that the ids decode to."""
    coded = bpe.encode(docs, f"{VOCABULARIES}/byte_bpe_50k.json", decoded=True)
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix),
    ("encoding", encode),
]

#: The forest, the fingerprints and the classifier have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
