"""License scan by diagonal voting.

Every run of ``GRAM`` words of every text is hashed and joined to the runs of the
license templates. A hit at text position p and template position t votes for the
diagonal p - t; an unbroken copy puts all its votes on one diagonal. Phrases count
where all their votes fall on one diagonal. Longer notices tolerate edits: diagonals
at most ``DRIFT`` apart merge, and the span they cover is verified by the share of
the template's runs it holds and by its length.

The templates are a parameter of fixed size and the only thing broadcast. Nothing is
grouped but the votes of one text, template and diagonal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.llm.common import table, written
from crestline.llm.decontamination import GAP, count_words, plain, row_key

GRAM, DRIFT, COVERED, STRETCH = 3, 3, 0.6, 1.5

# Phrases that must stand word for word, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Opening words of public license notices; found with small edits as well.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the"
     " rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
     " the license you may obtain a copy of the license at", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the"
     " following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
     " license as published by the free software foundation", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def template_grams(phrases=PHRASES, notices=NOTICES, gram: int = GRAM) -> list[tuple]:
    """(template, label, base, tpos, its words, runs in the template, words in the template)."""
    rows = []
    for n, (text, label, base) in enumerate([(*p, True) for p in phrases] + [(*p, False) for p in notices]):
        parts = re.sub(GAP, " ", text.lower()).split(" ")
        if len(parts) < gram:
            raise ValueError(f"a template needs {gram} words: {text!r}")
        runs = len(parts) - gram + 1
        rows += [(n, label, base, i, " ".join(parts[i : i + gram]), runs, len(parts)) for i in range(runs)]
    return rows


def runs_of(text_words: Column, gram: int = GRAM) -> Column:
    """The text's word runs, in order; the last ones are cut short and hold nulls."""
    return F.arrays_zip(*[F.slice(text_words, i + 1, F.size(text_words)).alias(f"w{i}") for i in range(gram)])


def spans(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", phrases=PHRASES, notices=NOTICES,
    gram: int = GRAM, drift: int = DRIFT, covered: float = COVERED, stretch: float = STRETCH,
) -> DataFrame:
    """``row, label, base, first, last, coverage``: every place of a phrase, and every span close enough to a notice.

    ``row`` names the text (``row_key``); ``first`` and ``last`` are word positions from 0.
    ``coverage`` is the share of the template's runs inside the span, 1 for a phrase. Spans
    below ``covered`` or longer than ``stretch`` times the template do not come out. A notice may
    come out as several overlapping spans: its best diagonal, that one with its neighbours, and their island.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(
        template_grams(phrases, notices, gram),
        "template int, label string, base boolean, tpos int, gram string, runs int, size int",
    ).withColumn("key", F.xxhash64("gram"))
    texts = docs.select(row_key(id_col, text_col).alias("row"), F.split(plain(F.col(text_col)), " ").alias("words"))
    every = texts.where(F.size("words") >= gram).select("row", F.posexplode(runs_of(F.col("words"), gram)).alias("pos", "run"))
    run = F.concat_ws(" ", *[F.col(f"run.w{i}") for i in range(gram)])
    every = every.where(F.col(f"run.w{gram - 1}").isNotNull()).select("row", "pos", run.alias("found"), F.xxhash64(run).alias("key"))
    hits = every.join(F.broadcast(known), "key").where("found = gram")  # the words themselves decide, not the hash
    # small beside the texts, and read twice
    votes = written(
        hits.groupBy("row", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(
            F.first("label").alias("label"), F.first("base").alias("base"), F.first("runs").alias("runs"),
            F.first("size").alias("size"), F.collect_set("tpos").alias("voted"),
            F.min("pos").alias("first"), (F.max("pos") + gram - 1).alias("last"),
        ),
        "license-votes",
    )
    exact = votes.where(F.col("base") & (F.size("voted") == F.col("runs"))).select(
        "row", "label", "base", "first", "last", F.lit(1.0).alias("coverage")
    )
    order = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > drift
    merged = (
        votes.where("not base").withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("island", F.sum("apart").over(order))
        .groupBy("row", "template", "island")
        .agg(
            F.first("label").alias("label"), F.first("base").alias("base"), F.first("runs").alias("runs"),
            F.first("size").alias("size"), F.min("first").alias("first"), F.max("last").alias("last"),
            F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("votes"),
        )
    )
    # far-off repeats of a few words can chain an island out of shape: each diagonal also stands alone, and with
    # the neighbours within drift
    same = ["row", "template", "island", "label", "base", "runs", "size"]
    own = votes.where("not base").withColumn("island", F.lit(None).cast("bigint"))
    near = W.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-drift, drift)
    alone = own.select(*same, "first", "last", F.size("voted").alias("votes"))
    beside = own.select(
        *same, F.min("first").over(near).alias("first"), F.max("last").over(near).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("voted").over(near)))).alias("votes"),
    )
    merged = merged.select(*alone.columns).union(alone).union(beside)
    close = merged.withColumn("coverage", F.col("votes") / F.col("runs")).where(
        (F.col("coverage") >= covered) & (F.col("last") - F.col("first") + 1 <= stretch * F.col("size"))
    )
    return exact.union(close.select("row", "label", "base", "first", "last", "coverage").distinct())


def license_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Label columns are sorted arrays. ``score`` is the best coverage found, 1 with a phrase,
    0 with nothing. Null, empty and wordless texts have no words and no labels. Repeated
    rows and ids each get their own result, an empty table gives an empty one, and columns
    besides the two named are not read.
    """
    counted = docs.select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), plain(F.col(text_col)).alias("plain")
    ).select("doc_id", "row", count_words("plain").alias("n_words"))
    # copies of a row share a key: their equal spans count once
    places = spans(docs, text_col, id_col, **how).distinct()
    base = F.when(F.col("base"), F.col("first"))
    found = places.groupBy("row").agg(
        F.count(base).alias("n_base"), F.min(base).cast("bigint").alias("first_word"), F.max(base).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("coverage").alias("score"),
    )
    none = F.array().cast("array<string>")
    return counted.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_report(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def _sql() -> str:
    known = ",\n".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in template_grams()
    )
    return rf"""
WITH t(template, label, base, tpos, gram, runs, size) AS (VALUES {known}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT doc_id, i AS pos, array_to_string(w[i + 1:i + {GRAM}], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(0, len(w) - {GRAM - 1})) AS i FROM d WHERE len(w) >= {GRAM})),
v AS (SELECT doc_id, template, label, base, runs, size, pos - tpos AS dia, count(DISTINCT tpos) AS n, list(tpos) AS voted,
      min(pos) AS first, max(pos) + {GRAM - 1} AS last
      FROM g JOIN t USING (gram) GROUP BY ALL),
isl AS (SELECT *, sum(jump) OVER (PARTITION BY doc_id, template ORDER BY dia) AS island FROM (
      SELECT *, CASE WHEN dia - lag(dia) OVER (PARTITION BY doc_id, template ORDER BY dia) > {DRIFT} THEN 1 ELSE 0 END AS jump
      FROM v WHERE NOT base)),
m AS (SELECT doc_id, label, base, min(first) AS first, max(last) AS last,
      len(list_distinct(flatten(list(voted)))) / any_value(runs) AS coverage, any_value(size) AS size
      FROM isl GROUP BY doc_id, template, label, base, island
      UNION ALL SELECT doc_id, label, base, first, last, len(list_distinct(voted)) / runs, size FROM v WHERE NOT base
      UNION ALL SELECT doc_id, label, base, min(first) OVER near, max(last) OVER near,
             len(list_distinct(flatten(list(voted) OVER near))) / runs, size FROM v WHERE NOT base
             WINDOW near AS (PARTITION BY doc_id, template ORDER BY dia RANGE BETWEEN {DRIFT} PRECEDING AND {DRIFT} FOLLOWING)),
s AS (SELECT doc_id, label, base, first, last, 1.0::DOUBLE AS coverage FROM v WHERE base AND n = runs
      UNION SELECT doc_id, label, base, first, last, coverage FROM m
      WHERE coverage >= {COVERED} AND last - first + 1 <= {STRETCH} * size),
f AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (doc_id)
"""


OP9_SQL = _sql()
