"""Operator 9: license scan by an exact set-similarity join with templates.

A text block is a window of words, anywhere in the text and over line breaks,
``1 / CONTAINMENT`` times as long as the template. Its set are its distinct
words; a template's set are the template's. A window carries a template's label
when it holds at least ``CONTAINMENT`` of the template's words, with those that decide (``DECIDING``). The join is
exact: template words are ordered by their frequency in all documents, rarest
first; a window that meets the threshold must hold one of the ``|T| - need + 1``
first words of the template (prefix filter). Texts are cut into chunks that
overlap by a window; a chunk that holds such a word and ``need`` words of the
template is verified window by window. On texts with every notice on a line of
its own this gives what ``ORACLE_SQL`` gives, whose blocks are lines.

The base phrases are found beside it in the same pass. DataFrame functions
only; templates are a fixed table, so what is broadcast has a fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import ascii_lower, read

#: Fixed phrases and labels of the base.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Fixed notices of the method, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache", "Licensed under the Apache License Version 2"),
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY NC 4"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
CONTAINMENT = 0.8
#: Words that tell a notice from others of the same wording: a window must hold
#: those of its template.
DECIDING = frozenset(("mit", "apache", "gnu", "nc", "attribution", "mozilla"))
#: Windows that start in one chunk.
CHUNK = 512


#: What stands between words, before and after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A character of a word.
WORD = BETWEEN[:-1].replace("[", "[^", 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BETWEEN, -1), lambda w: w != "")


def template_list(templates) -> list[tuple]:
    """(t, label, distinct lower-case words, n, need, span, must) of each template."""
    out = []
    for t, (label, text) in enumerate(templates):
        words = sorted(set(text.lower().split()))
        out.append((t, label, words, len(words), max(1, math.ceil(CONTAINMENT * len(words) - 1e-9)),
                    math.ceil(len(text.split()) / CONTAINMENT - 1e-9), sorted(DECIDING.intersection(words))))
    return out


def template_rows(spark: SparkSession, templates) -> DataFrame:
    """One row per template: t, label, tokens (distinct, lower case), n, need,
    span (words of a window), must (its deciding words)."""
    return spark.createDataFrame(template_list(templates), "t int, label string, tokens array<string>, n int, need int, span int, must array<string>")


def prefix_index(docs: DataFrame, text: str, templates) -> list:
    """Rows (t, label, n, need, span, must, tokens, at, w): for each template its first
    ``n - need + 1`` words in the order of document frequency, rarest first.
    The frequencies count every document; there is a row per word of the fixed
    templates, so what comes to the driver has a fixed size."""
    table = template_rows(docs.sparkSession, templates)
    vocabulary = sorted({w for _, text_ in templates for w in text_.lower().split()})
    held = F.array_intersect(words_of(F.lower(F.col(text))), F.array(*[F.lit(w) for w in vocabulary]))
    counts = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    ranked = (table.select("t", F.explode("tokens").alias("w")).join(counts, "w", "left").na.fill(0, ["df"])
              .groupBy("t").agg(F.sort_array(F.collect_list(F.struct("df", "w"))).alias("x")))
    return (table.drop("tokens").join(ranked, "t").withColumn("tokens", F.expr("transform(x, y -> y.w)"))
            .select("t", "label", "n", "need", "span", "must", "tokens", F.posexplode(F.expr("slice(tokens, 1, n - need + 1)"))
                    .alias("at", "w")).collect())


def containments(docs: DataFrame, index: list, text: str) -> DataFrame:
    """``__id``, label, score of every chunk with a window that meets a
    template's threshold."""
    spark = docs.sparkSession
    schema = "t int, label string, n int, need int, span int, must array<string>, tokens array<string>, at int, w string"
    firsts = sorted({r.w for r in index})
    longest = max(r.span for r in index)
    chunks = (docs.filter(F.col(text).rlike(f"(?i)(?<!{WORD})(?:{'|'.join(firsts)})(?!{WORD})"))
              .withColumn("words", words_of(ascii_lower(F.col(text))))
              .select("__id", F.explode(F.expr(f"""transform(sequence(0, size(words) DIV {CHUNK}),
                  c -> slice(words, c * {CHUNK} + 1, {CHUNK + longest - 1}))""")).alias("words"))
              .withColumn("firsts", F.array_intersect("words", F.array(*[F.lit(w) for w in firsts])))
              .filter("size(firsts) > 0"))
    hits = (chunks.withColumn("w", F.explode("firsts"))
            .join(F.broadcast(spark.createDataFrame(index, schema)), "w")  # the fixed templates' prefixes
            .filter("size(array_intersect(words, tokens)) >= need AND size(array_except(must, words)) = 0")
            # Once per chunk and template: by the first prefix word it holds.
            .filter("NOT arrays_overlap(slice(tokens, 1, at), firsts)"))
    starts = "filter(sequence(1, size(words)), i -> array_contains(tokens, words[i - 1]))"
    held = f"filter(transform({starts}, i -> array_intersect(slice(words, i, span), tokens)), x -> size(array_except(must, x)) = 0)"
    most = f"array_max(transform({held}, x -> size(x)))"
    return (hits.withColumn("shared", F.expr(most).cast("double")).filter("shared >= need")
            .select("__id", "label", (F.col("shared") / F.col("n")).alias("score")))


def find_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score. Null texts count as empty; rows that repeat an
    id share the method's labels; an empty table gives no rows. The score is
    the largest containment found, 1 where a base phrase stands, else 0."""
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    found = containments(rows, prefix_index(rows, "__text", templates), "__text")
    method = found.groupBy("__id").agg(F.collect_set("label").alias("more"), F.max("score").alias("most"))
    with_words = rows.withColumn("words", words_of(F.col("__text"))).withColumn(
        "low", F.when(F.col("__text").rlike("(?i)license"), F.transform("words", ascii_lower)))
    for phrase, label in PHRASES.items():
        same = " AND ".join(f"low[i + {j}] = '{w}'" for j, w in enumerate(phrase.split()))
        last = len(phrase.split()) - 1
        with_words = with_words.withColumn(label, F.expr(f"""CASE WHEN size(low) > {last}
            THEN filter(sequence(0, size(low) - 1 - {last}), i -> {same}) ELSE cast(array() AS array<int>) END"""))
    labels = list(PHRASES.values())
    based = with_words.select(
        "__id", F.size("words").cast("long").alias("n_words"), F.concat(*labels).alias("places"),
        F.filter(F.array(*[F.when(F.size(x) > 0, F.lit(x)) for x in labels]), lambda x: x.isNotNull()).alias("base"))
    return (based.join(method.withColumnRenamed("__id", "__m"), F.col("__id").eqNullSafe(F.col("__m")), "left").select(
        F.col("__id").alias(id_col), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.expr("cast(array() AS array<string>)")))),
                     ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score")))


def op9_license_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(read(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Every window that starts at a template's word against that template."""
    split = r"list_filter(regexp_split_to_array({0}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    low = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    values = ", ".join(
        f"({t}, '{label}', {n}, {need}, {span}, {len(must)}, {words!r}, {must!r}::VARCHAR[])"
        for t, label, words, n, need, span, must in template_list(TEMPLATES))
    hits = []
    for phrase, label in PHRASES.items():
        w = phrase.split()
        same = " AND ".join(f"words[i + {j + 1}] = '{x}'" for j, x in enumerate(w))
        hits.append(f"list_transform(list_filter(range(0, len(words) - {len(w) - 1}), lambda i: {same}), "
                    f"lambda i: {{'i': i, 'label': '{label}'}})")
    return f"""
WITH d AS (SELECT doc_id, text, {split.format(low.format('text'))} AS words FROM documents),
t(t, label, n, need, span, musts, tokens, must) AS (VALUES {values}),
k AS (SELECT t, label, n, need, span, musts, w, list_contains(must, w) AS deciding
      FROM (SELECT * EXCLUDE (tokens), unnest(tokens) AS w FROM t)),
o AS (SELECT row_number() OVER () AS r, doc_id, words FROM d),
q AS (SELECT * FROM (SELECT r, doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM o) JOIN k USING (w)),
m AS (SELECT doc_id, label, shared / CAST(n AS DOUBLE) AS c FROM (
        SELECT x.r, x.doc_id, x.t, x.label, x.n, x.need, x.musts, x.i, count(DISTINCT y.w) AS shared,
               count(DISTINCT y.w) FILTER (WHERE y.deciding) AS decided
        FROM q x JOIN q y ON x.r = y.r AND x.t = y.t AND y.i >= x.i AND y.i < x.i + x.span GROUP BY ALL)
      WHERE shared >= need AND decided = musts),
g AS (SELECT doc_id, list(DISTINCT label) AS more, max(c) AS most FROM m GROUP BY doc_id),
b AS (SELECT doc_id, words, list_concat(list_concat({hits[0]}, {hits[1]}), {hits[2]}) AS p FROM d)
SELECT b.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(p, lambda x: x.i)) AS BIGINT) AS first_word,
  CAST(list_max(list_transform(p, lambda x: x.i)) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), coalesce(more, [])))), ',') AS labels,
  CAST(CASE WHEN len(p) > 0 THEN 1 ELSE coalesce(most, 0) END AS DOUBLE) AS score
FROM b LEFT JOIN g ON g.doc_id = b.doc_id
"""


ORACLE_SQL = _oracle()
