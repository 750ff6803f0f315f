"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm.common import table
from flightloom.llm.line_dedup import dedup_lines
from flightloom.llm.mixing import mix
from flightloom.llm.packing import pack
from flightloom.llm.simhash import keep_one_of_each
from flightloom.llm.toxicity import reject_toxic

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more go."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the boilerplate lines of their source; n_chars follows. Every document stays."""
    cleaned = dedup_lines(docs)
    length = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, sorted by training position."""
    return mix(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their ids."""
    return pack(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Scores of a trained model and a tokenizer's ids are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
