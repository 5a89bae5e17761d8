"""Training-data pipeline over `documents`: quality rules, line dedup, near dedup, secret scan, packing.

Each stage reads all that its predecessor kept, as Parquet, and its decisions take effect: rejected documents go, aligned
lines are deleted, one document of each near-duplicate group stays, secrets are replaced, and what is left is packed.

Edge cases, for each stage on its own: quality_rules rejects null and empty texts, as they have too few words; the others
keep them as they are (packing gives a document without text its closing id alone). line_dedup drops a document of
which the lines that went leave no word, never one that had none. Texts are taken whole, however long. Repeated rows are
judged alike and stay or go together; of copies under different ids line_dedup and near_dedup keep the smallest id. Rows
with a null id are judged like others. Nulls in other columns, and further columns whatever their names, are passed on; an
empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import bbit_minhash, line_alignment, secret_markov, weak_rules, window_packing
from tabularium.session import written


def counted(docs: DataFrame) -> DataFrame:
    """n_chars set to the length of the text, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_rules.judge(docs, keep_rows=True).filter("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(line_alignment.dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bbit_minhash.keep_one(docs, words=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(secret_markov.redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    return window_packing.pack(docs, definition, public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("secret_scan", secret_scan), ("packing", packing)]

# Expectation-maximisation, alignment and trained models are not for SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
