"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from flightloom.llm import oracles
from flightloom.llm.common import table, whole_text
from flightloom.llm.embedding_graph import near_duplicate_vectors
from flightloom.llm.exact_dedup import exact_dedup
from flightloom.llm.licenses import scan_licenses
from flightloom.llm.line_dedup import dedup_lines
from flightloom.llm.mixing import mix
from flightloom.llm.packing import pack
from flightloom.llm.periodic_runs import find_runs
from flightloom.llm.prefix_trie import chained, trie_nodes, turn_lists
from flightloom.llm.quality_rules import judge_documents, words_of
from flightloom.llm.sharding import shard_documents
from flightloom.llm.simhash import near_duplicates
from flightloom.llm.token_codes import token_round_trip
from flightloom.llm.toxicity import score_documents


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_codes(spark, sf_dir):
    return token_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_mixing(spark, sf_dir):
    """The mix in training order, put together again per document, untaken ones included."""
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), with_plan=True).drop("text")
    document = [c for c in mixed.columns if c not in ("mix_copy", "mix_position")]
    taken = F.when(F.col("mix_copy").isNotNull(), F.struct("mix_copy", "mix_position"))
    rows = mixed.groupBy(document).agg(
        F.coalesce(F.sum(F.when(F.col("mix_copy").isNotNull(), F.col("mix_size"))), F.lit(0)).cast("long").alias("taken"),
        F.array_sort(F.collect_set(taken)).alias("copies"),
        # empty documents under one id start at the same word: they share their positions
        F.count_if(F.coalesce("mix_copy", F.lit(0)) == 0).alias("n"),
    )
    return rows.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        "taken",
        F.col("copies.mix_position").alias("positions"),
    )


def op7_toxicity(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_graph(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def with_planted_repeats(docs):
    """The query's rows: in every tenth document, by crc32 of its id, the end of the text becomes periodic."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    docs = docs.select("doc_id", whole_text().alias("text"))
    docs = docs.withColumn("__words", F.when(h % 10 == 0, words_of(F.col("text"))))
    n = F.size("__words")
    docs = docs.withColumn("__n", n).withColumn("__a", F.when(F.col("__n") > 0, (g % F.col("__n")).cast("int")))
    rest = F.col("__n") - F.col("__a")
    docs = docs.withColumn("__p", (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    period = F.slice("__words", F.col("__a") + 1, F.col("__p"))
    repeats = F.ceil(rest / F.col("__p")).cast("int")
    whole = F.concat(F.slice("__words", F.lit(1), F.col("__a")), F.flatten(F.array_repeat(period, repeats)))
    planted = F.array_join(F.slice(whole, F.lit(1), F.col("__n")), " ")
    return docs.select("doc_id", F.when(F.col("__a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    rows = find_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = {name: F.col(f"strongest.{name}") for name in ("start", "length", "period")}
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[c.alias(name) for name, c in best.items()],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_quality_rules(spark, sf_dir):
    return judge_documents(table(spark, sf_dir, "documents")).drop("clean_text")


def with_shared_openings(lists):
    """The query's paths: each conversation begins with the first turns of the first one of its block of five ids."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    firsts = lists.filter("conv_id = __group").select("__group", F.col("turns").alias("__first"))
    rows = lists.join(firsts, "__group", "left")
    none = F.array().cast(lists.schema["turns"].dataType)
    opening = F.slice(F.coalesce("__first", none), F.lit(1), h)
    return rows.select("conv_id", F.concat(opening, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op13_prefix_trie(spark, sf_dir):
    block = F.col("conv_id") - F.col("conv_id") % 5
    lists = turn_lists(table(spark, sf_dir, "conversations"), block)
    return trie_nodes(chained(with_shared_openings(lists)))


def registry():
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def sql():
    return oracles.SQL
