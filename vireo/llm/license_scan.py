"""License scans by diagonal voting, in DataFrame functions alone.

Every license phrase or notice is a template of words.  All rolling word pairs
of every text are joined by hash to the positions of the templates' pairs (and
compared as strings, so a collision casts no vote).  A vote at word p of a text
for position q of a template lies on the diagonal p - q; the votes of one text,
template and diagonal are one placement of the template.  Diagonals a few words
apart are merged, as a word put in or left out moves the rest of a notice to
the next diagonal, and the merged spans are verified: the words they share with
the template, in order, must be a large part of the template and of the span.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: words in a gram
K = 2
#: neighbouring diagonals are merged up to this many words apart
GAP = 3
#: share of the template's words, and of the span's, that must agree
MIN_COVERAGE, MIN_DENSITY = 0.8, 0.8
#: votes that a diagonal needs to be merged with others (all, for templates of fewer grams)
MIN_VOTES = 2
#: above this many words the table of templates is joined without a broadcast hint
BROADCAST_WORDS = 1_000_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: fixed values: phrases of which every place counts, and their labels
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: fixed values: names and opening notices of common public licenses
NOTICES = (
    ("mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met", "bsd"),
    ("bsd license", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
     "gpl"),
    ("mozilla public license", "mpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("creative commons attribution", "cc-by"),
    ("cc0 1 0 universal", "cc0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("eclipse public license", "epl"),
)

_KEY = ["id_missing", "id", "text_hash", "text_length"]


def template_rows(phrases=BASE_PHRASES, notices=NOTICES) -> list[tuple]:
    """(template, label, base, words, position, gram) of every gram of every template."""
    out = []
    for t, (text, label, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))
        if len(words) < K:
            raise ValueError(f"a template needs at least {K} words: {text!r}")
        out += [(t, label, base, len(words), i, " ".join(words[i:i + K])) for i in range(len(words) - K + 1)]
    return out


def _templates(spark, rows: list[tuple]) -> DataFrame:
    names = ("template", "label", "base", "words", "tpos", "tgram")
    cells = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in rows]
    table = spark.range(1).select(F.inline(F.array(*cells))).withColumn("tkey", F.xxhash64("tgram"))
    # a row per gram of the given templates, whatever the corpus
    return F.broadcast(table) if len(rows) <= BROADCAST_WORDS else table


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).isNull().alias("id_missing"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_length"), text.alias("text"))


def _apart(text: Column, at: int) -> Column:
    """1 where the character at a place (1 or -1) is a separator: the split then has an empty word at that end."""
    return _lowered(F.substring(text, at, 1)).rlike(SEPARATORS).cast("int")


def count_words(text: Column) -> Column:
    """Words in a text: pieces of the split less the empty ones at its ends."""
    pieces = F.size(F.split(_lowered(text), SEPARATORS)) - _apart(text, 1) - _apart(text, -1)
    return F.when(text == "", 0).otherwise(pieces).cast("long")


def _placements(prepared: DataFrame, templates: DataFrame) -> DataFrame:
    """Votes by text, template and diagonal: the template positions that agree."""
    words = prepared.select(*_KEY, _apart(F.col("text"), 1).alias("lead"), F.split(_lowered(F.col("text")), SEPARATORS).alias("w"))
    grams = F.zip_with("w", F.slice("w", F.lit(2), F.size("w")), lambda x, y: F.concat_ws(" ", x, y))
    rolling = words.select(*_KEY, "lead", F.posexplode(grams).alias("p", "gram"))
    votes = (rolling.withColumn("key", F.xxhash64("gram"))
             .join(templates, (F.col("key") == F.col("tkey")) & (F.col("gram") == F.col("tgram"))))
    diagonal = (F.col("p") - F.col("lead") - F.col("tpos")).cast("long").alias("diagonal")
    # a set, as equal rows of the table vote alike
    return (votes.groupBy(*_KEY, "template", "label", "base", "words", diagonal)
            .agg(F.collect_set("tpos").alias("at")))


def _covered(at: Column) -> Column:
    """Template words below a set of agreeing grams."""
    return F.size(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda k: F.transform(at, lambda x: x + k)))))


def _spans(placements: DataFrame) -> DataFrame:
    """Verified spans: every whole placement of a base phrase, and merged
    placements of the other templates."""
    grams = F.col("words") - (K - 1)
    strong = placements.where(F.size("at") >= F.when(F.col("base"), grams).otherwise(F.least(F.lit(MIN_VOTES), grams)))
    by = W.partitionBy(*_KEY, "template").orderBy("diagonal")
    merged = (strong.withColumn("near", ~F.col("base") & (F.col("diagonal") - F.lag("diagonal").over(by) <= GAP))
              .withColumn("span", F.sum(F.coalesce((~F.col("near")).cast("int"), F.lit(1))).over(by))
              .groupBy(*_KEY, "template", "label", "base", "words", "span")
              .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
                   F.min(F.col("diagonal") + F.array_min("at")).alias("start"), F.max(F.col("diagonal") + F.array_max("at") + K).alias("end"))
              .withColumn("covered", _covered(F.col("at"))).withColumn("length", F.col("end") - F.col("start")))
    coverage = F.col("covered") / F.col("words")
    return (merged.where((coverage >= MIN_COVERAGE) & (F.col("covered") / F.col("length") >= MIN_DENSITY))
            .select(*_KEY, "template", "label", "base", "start", "length", coverage.alias("coverage")))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=BASE_PHRASES, notices=NOTICES) -> DataFrame:
    """A row per license passage: ``doc_id``, ``text_hash`` (xxhash64 of the
    text, which tells rows with one id apart), ``label``, ``base`` (an exact
    place of one of the ``phrases``), ``start`` and ``length`` in words from 0,
    and ``coverage``, the share of the template's words found there in order.

    Null texts count as empty; ids may be null or repeat, and equal rows give
    their spans once; an empty table gives none; other columns are ignored."""
    spans = _spans(_placements(_prepared(docs, id_col, text_col), _templates(docs.sparkSession, template_rows(phrases, notices))))
    return spans.select(F.when(~F.col("id_missing"), F.col("id")).alias("doc_id"), "text_hash", "label", "base", "start", "length", "coverage")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=BASE_PHRASES, notices=NOTICES) -> DataFrame:
    """A row per row of the table: ``doc_id``, ``n_words``, ``n_base`` (places of
    the ``phrases``), ``first_word`` and ``last_word`` (their smallest and
    largest start; null without one), ``base_labels`` and ``labels`` (with those
    of verified notices; distinct, sorted, joined by comma) and ``score``, the
    largest coverage of a passage, 0 without any.

    Nulls and repeated rows as in ``license_spans``."""
    prepared = _prepared(docs, id_col, text_col)
    spans = _spans(_placements(prepared, _templates(docs.sparkSession, template_rows(phrases, notices))))
    found = spans.groupBy(*_KEY).agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("coverage").alias("score"))
    counted = prepared.select(*_KEY, count_words(F.col("text")).alias("n_words"))
    return counted.join(found, _KEY, "left").select(
        F.when(~F.col("id_missing"), F.col("id")).alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def scan_sql(phrases=BASE_PHRASES, notices=NOTICES) -> str:
    """The same scan in DuckDB SQL, for tables without repeated ids."""
    values = ", ".join(f"({t}, '{label}', {str(base).lower()}, {n}, {i}, '{gram}')" for t, label, base, n, i, gram in template_rows(phrases, notices))
    return rf"""
WITH t(template, label, base, words, tpos, gram) AS (VALUES {values}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(len(w) - 1)) AS p, unnest(list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1])) AS gram
      FROM w WHERE len(w) > 1),
v AS (SELECT doc_id, template, label, base, words, p - tpos AS diagonal, list(DISTINCT tpos) AS hits FROM g JOIN t USING (gram) GROUP BY ALL),
b AS (SELECT doc_id, label, base, diagonal AS start, 1.0::DOUBLE AS coverage FROM v WHERE base AND len(hits) = words - 1),
f AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER by_template <= {GAP} THEN 0 ELSE 1 END AS fresh FROM v
      WHERE NOT base AND len(hits) >= least({MIN_VOTES}, words - 1) WINDOW by_template AS (PARTITION BY doc_id, template ORDER BY diagonal)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM f),
m AS (SELECT doc_id, template, label, words, span, list_distinct(flatten(list(hits))) AS hits, min(diagonal + list_min(hits)) AS start,
             max(diagonal + list_max(hits) + 2) AS stop FROM s GROUP BY ALL),
c AS (SELECT *, len(list_distinct(list_concat(hits, list_transform(hits, lambda x : x + 1)))) AS covered FROM m),
spans AS (SELECT * FROM b UNION ALL
          SELECT doc_id, label, false, start, covered / words FROM c
          WHERE covered / words >= {MIN_COVERAGE} AND covered / (stop - start) >= {MIN_DENSITY}),
found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM spans GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN found USING (doc_id)"""
