import re

from pyspark.sql import functions as F

from flightloom.llm.licenses import BASE, DECIDING, TEMPLATES, deciding_grams, license_passages, scan_licenses

from edge_rows import EDGE  # noqa: I001


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base_of(text):
    words = words_of(text)
    found = [
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in found]
    return (
        len(words), len(found), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in found})),
    )


def check(rows, df):
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()]
    assert sorted(found, key=repr) == sorted(((d, *base_of(t)) for d, t, _ in rows), key=repr)


def test_edge_rows(edge):
    check(EDGE, scan_licenses(edge))


def test_whole_table(documents):
    check([(r.doc_id, r.text, None) for r in documents.collect()], scan_licenses(documents))


TEXTS = [
    (1, "ALL rights/reserved all all rights reserved rights reserved", "a"),
    (2, "cc by cc by cc", "a"),
    (3, "all rights are reserved", "a"),
    (4, "Released under the MIT License.", "a"),
    (5, "This is released under the very MIT license", "a"),  # a word put in
    (6, "Permission is hereby granted, free of charge, to any man obtaining a copy of this software and associated "
        "documentation files", "a"),  # a word changed
    (7, "released x x x x x x under the mit x x x license", "a"),
    (8, "under the gnu lesser general public license", "a"),
]


def test_passages(make_docs):
    df = make_docs(TEXTS)
    check(TEXTS, scan_licenses(df))
    labels = {r.doc_id: (r.labels, round(r.score, 3)) for r in scan_licenses(df).collect()}
    assert labels[4] == ("mit", 1.0) and labels[5] == ("mit", 0.75)
    assert labels[6][0] == "mit" and labels[7][0] == ""
    assert labels[8][0] == "gpl,lgpl" and labels[3][0] == "" and labels[1] == ("reserved", 1.0)
    spans = {(r.doc_id, r.label): (r.start, r["last"]) for r in license_passages(df).filter("coverage >= 0.75").collect()}
    assert spans[5, "mit"] == (2, 3)


SPANS = {
    "licensed under the GNU General Public License version 2": "gpl,gpl-2.0",
    "licensed under the GNU General Public License version 3": "gpl,gpl-3.0",
    "licensed under the GNU General Public License": "gpl",
    "licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",
    "this work is dedicated to the public domain": "public-domain",
    "this work is not dedicated to the public domain": "",
    "this work is hereby dedicated to the public domain": "public-domain",
    "It is not yet released under the MIT license": "",
    "It was never released under the MIT license": "",
    "It is released under the MIT license, not sold": "mit",
    "CC BY SA 4.0": "cc-by,cc-by-sa",
    "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0",
    "Licensed under CC BY-ND 4.0": "cc-by",
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at": "apache-2.0",
    "licensed under the Apache license version 1.1": "",
    "released under the BSD license": "",
}


def test_spans_are_verified(make_docs):
    """A passage that shares three quarters of a template's grams and yet says something else has no label."""
    texts = list(SPANS)
    rows = [(i, f"Some words first. {t} and more follows", "a") for i, t in enumerate(texts)]
    found = {r.doc_id: r.labels for r in scan_licenses(make_docs(rows)).collect()}
    assert {t: found[i] for i, t in enumerate(texts)} == SPANS


def test_deciding_words_are_in_their_templates():
    for phrase, needed in DECIDING.items():
        assert phrase in TEMPLATES and all(0 <= max(places) < len(phrase.split()) for places in deciding_grams(phrase, needed))


def test_only_matches_are_shuffled(make_docs):
    """The template table is broadcast below the first exchange of grams."""
    plan = license_passages(make_docs(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "CartesianProduct" not in plan


def test_empty_table(nothing):
    assert scan_licenses(nothing).count() == 0


def test_extra_columns_do_not_clash(edge):
    more = edge.select("*", F.lit(1).alias("n_words"), F.lit(2).alias("a"), F.lit(3).alias("phrase"))
    check(EDGE, scan_licenses(more))
