"""Exact deduplication: local winners, salted merge, global merge, full texts compared throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import whole_text
from flightloom.session import settle

SALTS = 32  # parts into which the copies of one text are dealt before they meet


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(docs: DataFrame, digest=sha256_of, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest doc_id), group_size.

    The first aggregation combines copies inside each task before anything is shuffled and then
    merges each (digest, salt); the second merges the at most ``salts`` winners per digest. Both
    group by the text itself, so two texts with one digest never meet.
    """
    rows = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id",
        "text",
        digest(F.col("text")).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    salted = rows.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_dedup(docs: DataFrame, digest=sha256_of, salts: int = SALTS) -> DataFrame:
    """For every row of ``docs`` its doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical; null counts as empty. The row with the largest doc_id stays; a
    null id stays only where all ids of the group are null. Rows that repeat a doc_id and text
    count one by one and have the same ``kept``. Extra columns are ignored; an empty table gives an
    empty result.

    Texts travel in the two merges only. The groups come back to the documents by digest: narrow
    rows, where the optimizer splits a digest with very many copies. Should two texts share a digest,
    their documents are told apart by the text itself.
    """
    groups = settle(text_groups(docs, digest, salts).drop("text"), "text-groups")
    texts = docs.select("doc_id", whole_text().alias("text"))
    # the text itself stays behind: only digests go to the groups
    rows = texts.select("doc_id", digest(F.col("text")).alias("digest"), F.sha2("text", 256).alias("text_sha256"))
    shared = groups.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1")
    if shared.isEmpty():
        matched = rows.join(groups, "digest")
    else:
        clash = settle(shared.select("digest"), "shared-digests")
        doubtful = texts.withColumn("digest", digest(F.col("text"))).join(clash, "digest", "left_semi")
        of_text = doubtful.join(text_groups(doubtful, digest, salts).drop("digest"), "text").select(
            "doc_id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")
        )
        matched = rows.join(groups.join(clash, "digest", "left_anti"), "digest").drop("digest").unionByName(of_text)
    return matched.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
