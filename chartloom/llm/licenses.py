"""License scans by diagonal voting.

All rolling hashes of three words of a text are joined to the places where the same three
words stand in a license template. A hit votes for the diagonal `place in text - place in
template`; a whole phrase is a diagonal with all its votes. Neighbouring diagonals, as words
left out or put in produce them, are merged, and the share of the template's places that
they hit gives a label and a score; a place that is hit again and again counts once, and
diagonals that drift further than the template is long are no wording of it. Where two
templates hit the same places, the one that is hit more completely gives its label. Hits are
verified by comparing the words, not only their hash. The templates are an argument, few
against the corpus, so hashes that occur in none of them are dropped before rows are made of
the rest. They may be whole license texts.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are
scanned one by one; a null id is kept; other columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.llm.common import documents, let

K = 3
MAX_SHIFT = 3  # diagonals this close belong together
MIN_COVER = 0.6
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that are labels by themselves.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Longer wordings of public licenses, in lower case without punctuation.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
)


def template_grams(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, base, number of grams, place, gram) for every three words of the base phrases and of every template."""
    out = []
    for t, (label, phrase) in enumerate(BASE_PHRASES + tuple(templates)):
        words = [w for w in re.split(WORD_BREAK, phrase.lower()) if w]
        for at in range(len(words) - K + 1):
            out.append((t, label, t < len(BASE_PHRASES), len(words) - K + 1, at, " ".join(words[at : at + K])))
    return out


def words_of(text: Column) -> Column:
    """Words after A-Z became a-z. The Kelvin sign, which `lower` would make a `k`, is put out of its way."""
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(folded, WORD_BREAK), "")


def _hits(hashes: list[int]):
    """Number of words, and of the places whose three words occur in a template: place, hash, words."""
    def found(w: Column) -> Column:
        def gram(i: Column) -> list[Column]:
            return [F.get(w, i + k) for k in range(K)]

        places = F.filter(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.xxhash64(*gram(i)).isin(hashes))
        hits = F.transform(places, lambda i: F.struct(
            i.alias("at"), F.xxhash64(*gram(i)).alias("hash"), F.concat_ws(" ", *gram(i)).alias("gram")))
        none = F.array().cast("array<struct<at:int,hash:bigint,gram:string>>")
        return F.struct(F.size(w).cast("long").alias("n_words"), F.when(F.size(w) >= K, hits).otherwise(none).alias("hits"))

    return found


def scan(df: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    `templates` are (label, wording) pairs, looked for besides the base phrases.
    """
    spark = df.sparkSession
    grams = spark.createDataFrame(
        template_grams(templates), "template int, label string, base boolean, grams int, t_at int, t_gram string"
    ).withColumn("t_hash", F.xxhash64(*[F.get(F.split("t_gram", " "), k) for k in range(K)]))
    hashes = sorted({r.t_hash for r in grams.select("t_hash").collect()})  # as many as the templates have
    rows = (
        df.select("doc_id", let(words_of(df[text]), _hits(hashes)).alias("_f"))
        .withColumn("_row", F.monotonically_increasing_id())
        .select("_row", "doc_id", F.col("_f.n_words").alias("n_words"), F.explode_outer("_f.hits").alias("hit"))
        # all that follows is keyed by the row, so this is the only shuffle; it carries hits, not texts
        .repartition("_row")
    )
    votes = rows.join(
        F.broadcast(grams), (F.col("hit.hash") == F.col("t_hash")) & (F.col("hit.gram") == F.col("t_gram")), "left"
    ).withColumn("diagonal", F.col("hit.at") - F.col("t_at"))
    key = ["_row", "doc_id", "n_words", "template", "label", "base", "grams"]
    # a diagonal and a place in the template make one place in the text, so no vote comes twice
    same = Window.partitionBy("_row", "template", "diagonal")
    along = Window.partitionBy("_row", "template").orderBy("diagonal", "t_at")
    runs = (
        votes.withColumn("votes", F.count("t_at").over(same))
        .withColumn("_new", F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= MAX_SHIFT, 0).otherwise(1))
        .withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    )
    of_run = Window.partitionBy("_row", "template", "_run")
    runs = runs.withColumn("cover", F.size(F.collect_set("t_at").over(of_run)) / F.col("grams")).withColumn(
        "drift", F.max("diagonal").over(of_run) - F.min("diagonal").over(of_run))
    worded = ~F.col("base") & (F.col("cover") >= MIN_COVER) & (F.col("drift") <= F.col("grams"))
    # wordings share words: where two hit the same places, the one that is hit more completely counts
    runs = runs.withColumn("_best", F.max(F.when(worded, F.col("cover"))).over(Window.partitionBy("_row", "hit.at")))
    whole = F.col("base") & (F.col("votes") == F.col("grams")) & (F.col("t_at") == 0)
    merged = runs.groupBy(*key, "_run").agg(
        F.first("cover").alias("cover"),
        F.bool_and(worded).alias("worded"),
        (2 * F.count_if(F.col("_best") > F.col("cover")) >= F.count("t_at")).alias("beaten"),
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
    )
    # part of a base phrase is no license: a base template counts only whole, the others from MIN_COVER on
    counts = F.when(F.col("base"), F.col("n_base") > 0).otherwise(F.col("worded") & ~F.col("beaten"))
    return merged.groupBy("_row", "doc_id", "n_words").agg(
        F.sum("n_base").alias("n_base"),
        F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("n_base") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(counts, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(counts, F.col("cover"))), F.lit(0.0)).alias("score"),
    ).drop("_row")


def _expected() -> str:
    grams = ", ".join(f"({t}, '{label}', {base}, {n}, {at}, '{gram}')" for t, label, base, n, at, gram in template_grams())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH g(template, label, base, grams, t_at, t_gram) AS (VALUES {grams}),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
  translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD_BREAK}'), lambda x: x <> '') AS w FROM documents),
h AS (SELECT r, unnest(list_transform(range(1, len(w) - {K} + 2), lambda x: w[x] || ' ' || w[x + 1] || ' ' || w[x + 2])) AS gram,
  unnest(range(0, len(w) - {K} + 1)) AS p FROM d WHERE len(w) >= {K}),
v AS (SELECT r, template, label, base, grams, p, t_at, p - t_at AS diagonal, count(*) OVER (PARTITION BY r, template, p - t_at) AS votes
  FROM h JOIN g ON gram = t_gram),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, t_at) <= {MAX_SHIFT} THEN 0 ELSE 1 END AS new FROM v),
c AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal, t_at ROWS UNBOUNDED PRECEDING) AS run FROM n),
e AS (SELECT *, count(DISTINCT t_at) OVER (PARTITION BY r, template, run) / grams AS cover,
  max(diagonal) OVER (PARTITION BY r, template, run) - min(diagonal) OVER (PARTITION BY r, template, run) AS drift FROM c),
w AS (SELECT *, NOT base AND cover >= {MIN_COVER} AND drift <= grams AS worded FROM e),
o AS (SELECT *, max(cover) FILTER (worded) OVER (PARTITION BY r, p) AS best FROM w),
m AS (SELECT r, template, label, base, run, any_value(cover) AS cover, any_value(worded) AS worded, 2 * count(*) FILTER (best > cover) >= count(*) AS beaten,
  count(*) FILTER (base AND votes = grams AND t_at = 0) AS n_base,
  min(diagonal) FILTER (base AND votes = grams) AS first_word, max(diagonal) FILTER (base AND votes = grams) AS last_word
  FROM o GROUP BY r, template, label, base, run),
j AS (SELECT *, CASE WHEN base THEN n_base > 0 ELSE worded AND NOT beaten END AS counts FROM m),
a AS (SELECT r, sum(n_base) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (n_base > 0) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (counts) AS labels, max(cover) FILTER (counts) AS score FROM j GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0.0), 6) AS score FROM d LEFT JOIN a USING (r)"""


@query("op7_license_scan", _expected())
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents(spark, folder))
