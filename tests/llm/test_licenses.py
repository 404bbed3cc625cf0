"""Licence places against a plain scan of the words, and odd rows."""

import re

import pytest
from oracle import compare, duck

from feedloom.llm import licenses as L

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    """(n_words, n_base, first, last, base labels) by looking at every place."""
    words = WORD.findall((text or "").translate(LOWER))
    found = [
        (i, label)
        for phrase, label in L.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    None, "", " \n", "GNU General Public License", "gnu, general-public (LICENSE)! mit license. CC BY cc by",
    "mit license mit license", "mit mit license license", "K mit license", "ünder the MIT License x", "mitlicense",
    "Licensed under the Apache License, Version 2.0.", "apache license", "!mit license!", "cc", "by cc",
    "licensed under the very own apache license version 2 0", "_mit_license_", "mit \U0001d518 license mit license 9",
    "permission is hereby granted free of charge to anyone at all obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction",
    "word " * 60_000 + "cc by",
]


def test_texts_against_a_plain_scan(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in L.scan_licenses(docs).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text), text
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert rows[10].labels == "apache,apache-2.0" and rows[10].score == 1
    assert [s.label for s in rows[18].spans] == ["mit-text"] and rows[18].spans[0].start == 0
    assert rows[19].first_word == 60_000
    assert rows[0].score == 0 and rows[0].labels == ""


def test_documents_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op1", L.licenses_of_documents, L.oracle(), SF)
    assert problem is None, problem


def test_odd_rows(spark):
    rows = [(1, "mit license", "a"), (1, "mit license", "a"), (None, "mit license", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, template string").selectExpr(
        "*", "1 AS words", "2 AS gram", "3 AS row", "4 AS key", "5 AS votes", "6 AS n_words"
    )
    got = sorted((str(r.doc_id), r.n_base) for r in L.scan_licenses(docs).collect())
    assert got == [("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert L.scan_licenses(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.licenses_of_documents(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("count", [1, 5])
def test_every_place_counts(spark, count):
    docs = spark.createDataFrame([(1, "cc by " * count)], "doc_id bigint, text string")
    r = L.scan_licenses(docs).first()
    assert (r.n_base, r.first_word, r.last_word) == (count, 0, 2 * (count - 1))
