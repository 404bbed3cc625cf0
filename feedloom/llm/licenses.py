"""Licence texts and phrases in documents, by votes of word k-grams for offset diagonals.

Every rolling k-gram hash of every whole text is joined to the places that the gram has in the
templates; a match's words are compared, so a hash never decides alone. A match votes for its
diagonal, the place in the text minus the place in the template. A phrase stands where a diagonal has
all its grams. For longer templates the votes of neighbouring diagonals (a few words added or left
out) are merged, and a span is verified if its grams cover enough of the template.

DataFrame functions only. The template table is small (its grams are counted before it is hinted as
broadcast); the texts are read once and never shuffled, only votes are.

Nulls: a null or blank text has no words and no place. A row without an id keeps its own result, and
repeated rows give repeated results: rows are told apart by their place in the input. A very long text is
read whole in its row. An empty table
gives no rows. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import table

PHRASE_GRAM = 2
TEXT_GRAM = 4
# Diagonals at most this far apart are votes for the same span.
NEIGHBOUR = 3
# Part of a template's grams that a verified span has.
COVERAGE = 0.6
# Above this many template grams the join decides by itself how to run.
BROADCAST_GRAMS = 200_000

# Fixed: the base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Fixed: sentences of well-known licences and notices, with the labels they add.
TEXTS = (
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
        "gpl-notice",
    ),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache-notice",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        "mit-text",
    ),
    ("released under the mit license", "mit-notice"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met",
        "bsd-text",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted",
        "isc-text",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mpl-2.0",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

# The characters between words: those of ASCII but letters and digits.
_BETWEEN = "[" + "".join(f"\\x{c:02x}" for c in range(128) if not chr(c).isalnum()) + "]+"
# Its lower-case form is the ASCII letter k, which lower-casing A-Z alone would not give.
_KELVIN = "K"


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    gram: int
    phrase: bool

    @property
    def grams(self) -> int:
        return len(self.words) - self.gram + 1


def templates(
    phrases: Sequence[tuple[str, str]] = PHRASES, texts: Sequence[tuple[str, str]] = TEXTS
) -> list[Template]:
    made = [(p, label, PHRASE_GRAM, True) for p, label in phrases]
    made += [(t, label, TEXT_GRAM, False) for t, label in texts]
    return [Template(i, label, tuple(t.split()), k, p) for i, (t, label, k, p) in enumerate(made, 1)]


def _constant_rows(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """The given structs as a table."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def _gram_rows(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(template, place, gram_words, gram): the grams of all templates, and one header gram.

    Every document has the header gram once, so that one without a match keeps a row after the join.
    """
    rows = [(t.number, i, t.words[i : i + t.gram]) for t in known for i in range(t.grams)]
    frame = _constant_rows(
        spark,
        [
            F.struct(
                F.lit(n).alias("template"),
                F.lit(i).alias("place"),
                F.array(*[F.lit(w) for w in words]).cast("array<string>").alias("gram_words"),
            )
            for n, i, words in [(0, 0, ()), *rows]
        ],
    )
    words = F.col("gram_words")
    hashed = F.when(F.size(words) == 0, F.lit(0).cast("long"))
    for k in {t.gram for t in known}:
        hashed = hashed.when(F.size(words) == k, F.xxhash64(*[words[i] for i in range(k)]))
    frame = frame.withColumn("gram", hashed)
    return F.broadcast(frame) if len(rows) <= BROADCAST_GRAMS else frame


def license_votes(docs: DataFrame, known: list[Template], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_words, template, diagonal, votes, first, last): votes of each document's diagonals."""
    lowered = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(_KELVIN), F.lit("é")))
    parts = docs.select(F.col(key).alias("key"), F.split(lowered, _BETWEEN).alias("words")).select(
        F.monotonically_increasing_id().alias("row"),
        "key",
        "words",
        (F.col("words")[0] == "").cast("int").alias("lead"),
        (F.element_at("words", -1) == "").cast("int").alias("trail"),
    )
    grams = sorted({t.gram for t in known})
    counts = {k: F.greatest(F.size("words") - (k - 1), F.lit(0)) for k in grams}

    def rolling(k: int):
        at = lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(k)])
        places = F.sequence(F.lit(0), counts[k] - 1)
        return F.when(counts[k] > 0, F.transform(places, at)).otherwise(F.expr("array()").cast("array<bigint>"))

    hashed = parts.select(
        "row",
        "key",
        "words",
        "lead",
        F.greatest(F.size("words") - F.col("lead") - F.col("trail"), F.lit(0)).cast("long").alias("n_words"),
        counts[grams[0]].alias("ahead"),
        F.concat(*[rolling(k) for k in grams], F.array(F.lit(0).cast("long"))).alias("grams"),
    )
    each = hashed.select("*", F.posexplode("grams").alias("at", "gram"))
    found = each.join(_gram_rows(docs.sparkSession, known), "gram")
    # the second kind of gram follows the first in the array
    start = F.when(F.col("at") >= F.col("ahead"), F.col("at") - F.col("ahead")).otherwise(F.col("at"))
    start = F.when(F.size("gram_words") == grams[0], F.col("at")).otherwise(start)
    same = F.slice("words", start + 1, F.size("gram_words")) == F.col("gram_words")
    return (
        found.where((F.col("template") == 0) | same)
        .select(
            "row",
            "key",
            "n_words",
            "template",
            "place",
            F.when(F.col("template") > 0, start - F.col("lead") - F.col("place")).otherwise(0).alias("diagonal"),
        )
        .groupBy("row", "key", "n_words", "template", "diagonal")
        .agg(
            F.count("*").alias("votes"),
            F.min("place").alias("first"),
            F.max("place").alias("last"),
        )
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    texts: Sequence[tuple[str, str]] = TEXTS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """For each row its words, base places and labels, and the verified spans of the longer templates.

    spans: array of (label, start, end, coverage) in words, for texts whose coverage reaches COVERAGE.
    """
    known = templates(phrases, texts)
    votes = license_votes(docs, known, key, text)
    facts = _constant_rows(
        docs.sparkSession,
        [
            F.struct(
                F.lit(t.number).alias("template"),
                F.lit(t.label).alias("label"),
                F.lit(t.gram).alias("gram_size"),
                F.lit(t.grams).alias("all_grams"),
                F.lit(t.phrase).alias("phrase"),
            )
            for t in known
        ],
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    told = votes.join(F.broadcast(facts), "template", "left")
    apart = (F.col("diagonal") - F.lag("diagonal").over(near)) > NEIGHBOUR
    # phrases stand on one diagonal; only diagonals of texts are merged
    step = F.when(apart | F.coalesce("phrase", F.lit(True)), 1).otherwise(0)
    grouped = told.withColumn("span", F.sum(step).over(near))
    spans = grouped.groupBy("row", "key", "n_words", "template", "span", "label", "phrase", "gram_size", "all_grams").agg(
        F.sum("votes").alias("votes"),
        F.min(F.col("diagonal") + F.col("first")).alias("start"),
        F.max(F.col("diagonal") + F.col("last") + F.col("gram_size")).alias("end"),
    )
    part = F.col("votes") / F.col("all_grams")  # null for the header, which is no template
    cover = F.when(part > 1, 1.0).otherwise(part)
    whole = F.col("phrase") & (F.col("votes") == F.col("all_grams"))
    text_span = ~F.col("phrase") & (cover >= COVERAGE)
    whole, text_span = F.coalesce(whole, F.lit(False)), F.coalesce(text_span, F.lit(False))
    found = F.struct("label", "start", "end", F.round(cover, 6).alias("coverage"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return (
        spans.groupBy("row", "key", "n_words")
        .agg(
            F.count(F.when(whole, 1)).alias("n_base"),
            F.min(F.when(whole, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(whole, F.col("start"))).cast("long").alias("last_word"),
            F.collect_set(F.when(whole, F.col("label"))).alias("base"),
            F.collect_set(F.when(whole | text_span, F.col("label"))).alias("every"),
            F.sort_array(F.collect_list(F.when(text_span, found))).alias("spans"),
            F.coalesce(F.max(F.round(cover, 6)), F.lit(0.0)).alias("score"),
        )
        .select(
            F.col("key").alias(key),
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            joined("base").alias("base_labels"),
            joined("every").alias("labels"),
            "score",
            "spans",
        )
    )


def licenses_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and texts of every document."""
    return scan_licenses(table(spark, sf_dir, "documents")).withColumn("n_spans", F.size("spans")).drop("spans")


def _sql_list(words: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle() -> str:
    """The same rows in SQL: words by expression, grams by position, votes by aggregates."""
    known = templates()
    grams = ", ".join(
        f"({t.number}, {i}, {_sql_list(t.words[i : i + t.gram])})" for t in known for i in range(t.grams)
    )
    facts = ", ".join(f"({t.number}, '{t.label}', {t.gram}, {t.grams}, {t.phrase})" for t in known)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
grams(template, place, words) AS (VALUES {grams}),
facts(template, label, gram, all_grams, phrase) AS (VALUES {facts}),
rolled AS (
  SELECT row, k, i, w[i + 1 : i + k] AS words
  FROM (SELECT row, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i
        FROM words, (VALUES ({PHRASE_GRAM}), ({TEXT_GRAM})) ks(k))),
votes AS (
  SELECT row, template, i - place AS diagonal, count(*) AS votes, min(place) AS first, max(place) AS last
  FROM rolled JOIN grams USING (words) GROUP BY ALL),
stepped AS (
  SELECT v.*, label, gram, all_grams, phrase,
         CASE WHEN phrase OR diagonal - lag(diagonal) OVER near > {NEIGHBOUR} THEN 1 ELSE 0 END AS step
  FROM votes v JOIN facts USING (template) WINDOW near AS (PARTITION BY row, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(step) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM stepped),
spans AS (
  SELECT row, label, phrase, all_grams, sum(votes) AS votes, min(diagonal + first) AS start,
         least(sum(votes) / all_grams, 1.0) AS cover
  FROM numbered GROUP BY row, template, span, label, phrase, all_grams),
marked AS (
  SELECT *, phrase AND votes = all_grams AS whole, NOT phrase AND cover >= {COVERAGE} AS fits FROM spans),
per AS (
  SELECT row, count(*) FILTER (whole) AS n_base, min(start) FILTER (whole) AS first_word,
         max(start) FILTER (whole) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole OR fits) AS labels,
         max(round(cover, 6)) AS score, count(*) FILTER (fits) AS n_spans
  FROM marked GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score, CAST(coalesce(n_spans, 0) AS INTEGER) AS n_spans
FROM words LEFT JOIN per USING (row)"""
