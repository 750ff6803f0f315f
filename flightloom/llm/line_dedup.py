"""Line deduplication by how frequent a line is on its own site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import null_safe_key, whole_text
from flightloom.session import settle

RATIO = 0.05  # a line on more than this share of a site's pages is boilerplate
LEAST_PAGES = 5  # and on at least so many of them
BROADCAST_LINES = 500_000  # 16-byte digests, so about 20 MB; beyond it the sites are joined


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_digest(line: Column) -> Column:
    """128 bits of the trimmed line; null for a blank one."""
    bare = F.trim(F.regexp_replace(line, r"[\t\r]", " "))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate(docs: DataFrame, host: str, ratio: float, least_pages: int) -> DataFrame:
    """One row per site that has boilerplate: __host and the digests of its lines.

    A line counts once per page, and pages with the same text count as one page, so that copies of a
    page don't turn its lines into boilerplate. The counts are combined in each task before
    they are shuffled. A site has at most (mean distinct lines per page) / ratio such lines.
    """
    pages = docs.select(null_safe_key(host).alias("__host"), whole_text().alias("text")).select(
        "__host", F.xxhash64("text").alias("page"), lines_of(F.col("text")).alias("lines")
    )
    lines = pages.select(
        "__host", "page", F.explode(F.array_distinct(F.transform("lines", line_digest))).alias("line")
    ).filter("line IS NOT NULL")
    counts = lines.distinct().groupBy("__host", "line").agg(F.count("*").alias("pages"))
    totals = pages.select("__host", "page").distinct().groupBy("__host").agg(F.count("*").alias("total"))
    frequent = counts.filter(F.col("pages") >= least_pages).join(totals, "__host")
    return frequent.filter(F.col("pages") > F.col("total") * ratio).select("__host", "line")


def dedup_lines(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``docs`` with text free of its site's boilerplate lines, plus the column lines_dropped.

    A line (between newlines, outer blanks ignored) goes if it stands on at least ``least_pages``
    and more than ``ratio`` of the site's distinct pages. Blank lines stay. Every row stays, also one
    whose text becomes empty; a null text stays null; a null site is a site. Rows that
    repeat are treated alike. A text without such lines is returned as it is. Other columns are kept as they are.
    """
    found = settle(boilerplate(docs, host, ratio, least_pages), "boilerplate")
    sites = found.groupBy("__host").agg(F.collect_set("line").alias("__lines"))
    if found.count() <= BROADCAST_LINES:
        sites = F.broadcast(sites)
    lines = F.transform("__split", lambda x: F.struct(x.alias("text"), line_digest(x).alias("digest")))
    hits = F.array_intersect(F.col("__parts.digest"), F.col("__lines"))
    kept = F.filter("__parts", lambda x: ~F.coalesce(F.array_contains("__hits", x.digest), F.lit(False)))
    joined = (
        docs.withColumn("__host", null_safe_key(host))
        .join(sites, "__host", "left")
        .withColumn("__split", F.when(F.col("__lines").isNotNull(), lines_of(F.col("text"))))
        .withColumn("__parts", lines)
        .withColumn("__hits", hits)
        .withColumn("__kept", kept)
    )
    changed = F.size("__hits") > 0
    result = {
        "text": F.when(changed, F.array_join(F.col("__kept.text"), "\n")).otherwise(F.col("text")),
        "lines_dropped": F.when(changed, F.size("__parts") - F.size("__kept")).otherwise(0),
    }
    return joined.select(
        *[
            result["text"].alias(c) if c == "text" else F.col(c)
            for c in docs.columns
            if c != "lines_dropped"  # an earlier count is replaced
        ],
        result["lines_dropped"].alias("lines_dropped"),
    )
