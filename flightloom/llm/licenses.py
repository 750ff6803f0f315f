"""License scan: word 2-grams joined to template positions, votes per diagonal, verified spans."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.common import ascii_lower, whole_text
from flightloom.session import settle

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2  # words per gram
SLACK = 2  # diagonals this close are one passage with words put in or left out
COVERAGE = 0.75  # of a template's grams, to call the passage by its label

# The phrases of the contract.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Further passages: their labels, and the words without which they are another licence's ("a+b": b right after a).
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions"
    " of the software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at":
        "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this work is dedicated to the public domain": "public-domain",
}
DECIDING = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache 2",
    "licensed under the gnu general public license version 2": "gnu+general 2",
    "licensed under the gnu general public license version 3": "gnu+general 3",
    "licensed under the gnu lesser general public license": "lesser",
    "licensed under cc by nc 4 0": "nc 4",
    "cc by sa 4 0": "sa",
    "creative commons attribution sharealike": "sharealike",
    "subject to the terms of the mozilla public license": "mozilla",
    "this work is dedicated to the public domain": "dedicated public domain",
}
# A passage after such a word, or after one and a filler, says the contrary.
NEGATIONS = ("not", "never", "no", "cannot", "isn", "neither", "nor", "without")
FILLERS = ("yet", "be", "been", "longer", "currently", "hereby", "t", "a")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def template_grams(spark, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """One row per gram of every template: a table as small as the parameters."""
    rows = []
    for is_base, phrases in ((True, base), (False, templates)):
        for phrase, label in phrases.items():
            words = phrase.split(" ")
            rows += [
                (phrase, label, is_base, len(words) - 1, i, a, b)
                for i, (a, b) in enumerate(zip(words, words[1:]))
            ]
    return spark.createDataFrame(
        rows, "phrase string, label string, base boolean, grams int, place int, first string, second string"
    ).withColumn("gram", F.xxhash64("first", "second"))


def votes(docs: DataFrame, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """Per document text, template and diagonal: which template grams stand there.

    Every gram of every text meets the broadcast template table, whose size the parameters fix.
    Only matches are shuffled. The words are compared as well as the hash. ``content``
    stands for the text, so rows that repeat count once.
    """
    grams = template_grams(docs.sparkSession, base, templates)
    rows = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("content"), words_of(F.col("text")).alias("words")
    )
    before = [F.concat(F.array([F.lit("")] * k), F.col("words")).alias(f"p{k}") for k in (1, 2)]
    following = F.slice("words", GRAM, F.greatest(F.size("words"), F.lit(1))).alias("b")
    pairs = rows.select(
        "doc_id",
        "content",
        F.posexplode(F.arrays_zip(F.col("words").alias("a"), following, *before)).alias("at", "pair"),
    ).select("doc_id", "content", "at", *[F.col(f"pair.{c}").alias(c) for c in ("a", "b", "p1", "p2")])
    found = pairs.withColumn("hash", F.xxhash64("a", "b")).join(
        F.broadcast(grams), F.expr("hash = gram AND a = first AND b = second")
    )
    denied = F.col("p1").isin(*NEGATIONS) | (F.col("p2").isin(*NEGATIONS) & F.col("p1").isin(*FILLERS))
    return found.groupBy(
        "doc_id", "content", "phrase", "label", "base", "grams", (F.col("at") - F.col("place")).alias("diagonal")
    ).agg(F.collect_set("place").alias("places"), F.max(denied).alias("denied"))


def deciding_grams(phrase: str, needed: str) -> list[tuple[int, ...]]:
    """For each deciding word the places of the template grams of which one has to be there."""
    words = phrase.split(" ")
    pairs = list(zip(words, words[1:]))
    return [
        (pairs.index(tuple(item.split("+"))),) if "+" in item else (words.index(item) - 1, words.index(item))
        for item in needed.split(" ")
    ]


def has_deciding_words(voted: Column, deciding: dict[str, str]) -> Column:
    """Whether each deciding word of a passage's template stands in the text, in one of its two grams."""
    out = F.lit(True)
    for phrase, needed in deciding.items():
        met = [
            reduce(or_, [F.array_contains(voted, place) for place in places])
            for places in deciding_grams(phrase, needed)
        ]
        out = F.when(F.col("phrase") == phrase, reduce(and_, met)).otherwise(out)
    return out


def can_be_denied(phrase: Column) -> Column:
    """A template with a negation of its own is not denied by one."""
    return ~F.arrays_overlap(F.split(phrase, " "), F.array(*map(F.lit, NEGATIONS)))


def merged(diagonals: DataFrame, deciding: dict[str, str]) -> DataFrame:
    """Neighbouring diagonals of a template as one passage, the share of the template it covers, and whether
    its span says what the template says: all deciding words stand there and no negation before any of it."""
    key = ["doc_id", "content", "phrase", "label", "base", "grams"]
    by_place = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_place) > SLACK
    passage = F.sum(F.when(apart, 1).otherwise(0)).over(by_place)
    return (
        diagonals.withColumn("passage", passage)
        .groupBy(*key, "passage")
        .agg(
            F.min("diagonal").alias("start"),
            F.max("diagonal").alias("last"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("voted"),
            F.max("denied").alias("denied"),
            F.sum(F.when(F.size("places") == F.col("grams"), 1).otherwise(0)).alias("exact"),
            F.min(F.when(F.size("places") == F.col("grams"), F.col("diagonal"))).alias("first_exact"),
            F.max(F.when(F.size("places") == F.col("grams"), F.col("diagonal"))).alias("last_exact"),
        )
        .withColumn("votes", F.size("voted"))
        .withColumn("coverage", F.col("votes") / F.col("grams"))
        .withColumn(
            "verified", has_deciding_words(F.col("voted"), deciding) & ~(F.col("denied") & can_be_denied(F.col("phrase")))
        )
        .drop("voted", "denied")
    )


def license_passages(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    templates: dict[str, str] = TEMPLATES,
    deciding: dict[str, str] = DECIDING,
) -> DataFrame:
    """The passages: doc_id, content, phrase, label, base, start, last (words), votes, coverage, exact, verified."""
    return merged(votes(docs, base, templates), deciding)


def scan_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    templates: dict[str, str] = TEMPLATES,
    deciding: dict[str, str] = DECIDING,
) -> DataFrame:
    """For every row of ``docs``: its words, the exact places of the base phrases, labels and a score.

    Words are the contract's, A-Z lowered. A base phrase counts wherever its words stand one after
    the other, which is where all its grams lie on one diagonal; places may overlap. A further
    label is given if a passage covers at least 75 % of the grams of one of its templates, has the template's
    deciding words (names, versions) and no negation before any part of it. The score is the best coverage of
    any template by a passage that holds these, or of a base phrase; 0 without any. A null or empty text has no
    words and score 0. Rows that repeat get the same result each. Extra columns are ignored.
    """
    passages = settle(license_passages(docs, base, templates, deciding), "license-passages")
    is_base = F.col("base") & (F.col("exact") > 0)
    is_other = ~F.col("base") & F.col("verified") & (F.col("coverage") >= COVERAGE)
    names = F.collect_set(F.when(is_base, F.col("label")))
    labels = F.collect_set(F.when(is_base | is_other, F.col("label")))
    found = passages.groupBy(F.col("doc_id").alias("id"), "content").agg(
        F.sum(F.when(is_base, F.col("exact")).otherwise(0)).alias("n_base"),
        F.min(F.when(is_base, F.col("first_exact"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("last_exact"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(names), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.max(F.when(F.col("base") | F.col("verified"), F.col("coverage"))).alias("score"),
    )
    rows = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.regexp_count(ascii_lower(F.col("text")), F.lit(WORD)).cast("long").alias("n_words"),
    )
    return rows.join(found, F.expr("doc_id <=> id AND text_hash = content"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
