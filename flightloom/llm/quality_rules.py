"""Quality rules of a text, and rejection of documents that consist of their site's common lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import null_safe_key, whole_text
from flightloom.session import settle

LEAST_WORDS = 50  # a document needs so many words, also after its common lines are removed
MOST_REPEATED = 50  # percent of the words that may lie in repeated three-word windows
WINDOW = 3
SHARE = 0.05  # a line in more than this share of a site's documents is common
LEAST_DOCS = 5  # and in at least so many of them
LEAST_LEFT = 50  # percent of the words that have to be left without the common lines
BROADCAST_LINES = 500_000  # 16-byte digests, so about 20 MB; beyond it the sites are joined

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def normal_line(line: Column) -> Column:
    """In lower case, blanks as one space; empty for a line without a word."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_digest(line: Column) -> Column:
    """128 bits of the normalised line; null without a word."""
    bare = normal_line(line)
    return F.when(bare != "", F.unhex(F.md5(bare)))


def hashed_windows(words: Column) -> Column:
    """The three-word windows as (hash, place), sorted, so that equal ones are neighbours."""
    later = [F.slice(words, k + 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))) for k in range(WINDOW)]
    windows = F.arrays_zip(*[part.alias(f"w{k}") for k, part in enumerate(later)])
    return F.sort_array(
        F.transform(windows, lambda w, i: F.struct(F.xxhash64(*[w[f"w{k}"] for k in range(WINDOW)]).alias("h"), i.alias("i")))
    )


def repeated_words(ordered: Column, words: Column) -> Column:
    """How many words lie in a three-word window that occurs twice or more.

    Neighbours of one hash are compared word by word; n log n steps in all.
    """
    following = F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1)))

    def both(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for k in range(WINDOW):
            equal = equal & (F.get(words, x["i"] + k) == F.get(words, y["i"] + k))
        return F.when(equal, F.array(*[w["i"] + k for w in (x, y) for k in range(WINDOW)]))

    pairs = F.array_compact(F.zip_with(ordered, following, both))
    return F.size(F.array_distinct(F.flatten(pairs)))


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` (__id, __host, __text) with the measures of each text and ``base_failed``."""
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counted = docs.withColumns({"__words": words_of(text), "__worded": lines})
    counted = counted.withColumn("__ordered", hashed_windows(F.col("__words")))
    counted = counted.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__worded") - F.size(F.array_distinct("__worded"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("__ordered"), F.col("__words")).cast("long"),
        }
    )
    few = F.col("n_words") < LEAST_WORDS
    monotone = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return counted.withColumn("base_failed", few | monotone).drop("__words", "__worded", "__ordered")


def common_lines(docs: DataFrame, share: float, least_docs: int) -> DataFrame:
    """(__host, line): digests of the lines that too many documents of a site have.

    Documents with the same text are one document. Pairs of line and document are reduced in each task
    before they are shuffled, and counts again before they are added up, so a site or line with a third
    of all rows is spread. A site has at most (mean lines per document) / share such lines.
    """
    pages = docs.select("__host", F.xxhash64("__text").alias("page"), F.split("__text", "\n").alias("lines"))
    digests = F.array_distinct(F.transform("lines", line_digest))
    lines = pages.select("__host", "page", F.explode(digests).alias("line")).filter("line IS NOT NULL")
    counts = lines.distinct().groupBy("__host", "line").agg(F.count("*").alias("found"))
    totals = pages.select("__host", "page").distinct().groupBy("__host").agg(F.count("*").alias("total"))
    frequent = counts.filter(F.col("found") >= least_docs).join(totals, "__host")
    return frequent.filter(F.col("found") > F.col("total") * share).select("__host", "line")


def judge_documents(
    docs: DataFrame, host: str = "source", share: float = SHARE, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """For every row of ``docs``: doc_id, the measures, base_failed, lines_removed, words_left, kept, clean_text.

    A document fails the base rules with fewer than 50 words, or with more than half of its words in
    three-word windows that it repeats. Otherwise the lines that more than ``share`` of the distinct texts
    of its site have (and at least ``least_docs`` of them; case and blanks ignored) are removed, and it is rejected if
    fewer than 50 words or less than half of its words are left. ``clean_text`` is the text without these lines.

    A null text counts as empty, and so does its clean_text. A null site is a site. Rows that repeat a
    doc_id, and null ids, are judged one by one; extra columns are ignored; an empty table gives an empty result.
    Texts are read whole; only digests of lines are shuffled while the common lines are few enough to broadcast.
    """
    rows = docs.select(
        F.col("doc_id").alias("__id"), null_safe_key(host).alias("__host"), whole_text().alias("__text")
    )
    found = settle(common_lines(rows, share, least_docs), "common-lines")
    sites = found.groupBy("__host").agg(F.collect_set("line").alias("__common"))
    if found.count() <= BROADCAST_LINES:
        sites = F.broadcast(sites)
    joined = with_measures(rows.join(sites, "__host", "left"))
    parts = F.transform(
        F.split("__text", "\n"), lambda x: F.struct(x.alias("text"), line_digest(x).alias("digest"))
    )
    split = joined.withColumn("__parts", F.when(F.col("__common").isNotNull(), parts))
    split = split.withColumn("__hits", F.array_intersect(F.col("__parts.digest"), F.col("__common")))
    kept = F.filter("__parts", lambda x: ~F.coalesce(F.array_contains("__hits", x["digest"]), F.lit(False)))
    cut = split.withColumn("__kept", F.when(F.size("__hits") > 0, kept))
    cut = cut.withColumn("__clean", F.array_join(F.col("__kept.text"), "\n"))
    left = F.when(F.col("__kept").isNotNull(), F.size(words_of(F.col("__clean")))).otherwise(F.col("n_words"))
    judged = cut.withColumn("words_left", left.cast("long"))
    depleted = (F.col("words_left") < LEAST_WORDS) | (100 * F.col("words_left") < LEAST_LEFT * F.col("n_words"))
    removed = F.when(F.col("__kept").isNotNull(), F.size("__parts") - F.size("__kept")).otherwise(0)
    return judged.select(
        F.col("__id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        removed.cast("long").alias("lines_removed"),
        "words_left",
        (~F.col("base_failed") & ~depleted).alias("kept"),
        F.coalesce("__clean", "__text").alias("clean_text"),
    )
