"""License statements by diagonal voting, in DataFrame functions only.

Every run of three words of every document is joined, by hash and words, to the places it
has in the template sentences. Matches vote for the diagonal on which they lie (place in
the document less place in the template); neighbouring diagonals, which a left-out or
added word makes, are merged to one span, and a span counts if it holds enough of the
template and little else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wayside.storage import settle

# Sentences by which public licenses are stated, with their labels.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license"],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    ],
    "cc-by": ["licensed under cc by 4 0", "licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "licensed under a creative commons attribution sharealike 4 0 international license"],
    "gpl": [
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "reserved": ["all rights reserved"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
# Phrases that always count, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of a run; how far diagonals of one span may lie apart, and runs of one span.
K, DRIFT, REST = 3, 3, 12
#: Least share of a template's runs in a span, and of a span's runs that match.
COVER, DENSE = 0.6, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_runs(spark: SparkSession) -> DataFrame:
    """(w0, w1, w2, template, label, place, runs) of the sentences above: a few hundred rows, whatever the data."""
    rows, number = [], 0
    for label, sentences in TEMPLATES.items():
        for sentence in sentences:
            words = sentence.split()
            n = len(words) - K + 1
            rows += [(*words[i : i + K], number, label, i, n) for i in range(n)]
            number += 1
    return spark.createDataFrame(rows, "w0 string, w1 string, w2 string, template int, label string, place int, runs int")


def _words(text):
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _APART), "")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of lower-cased letters, digits and non-ASCII characters. n_base counts all
    places of the fixed phrases, first_word and last_word are the smallest and largest word
    at which one starts. labels also has those of verified spans; score is 1 with a phrase,
    else the largest share of a template that a verified span holds, else 0.

    A null or empty text has no words and empty label lists. Rows that repeat each give a
    row; a row without an id is scanned as any other. An empty table gives no rows. Other
    columns are left behind. Only the template table is broadcast; its size is fixed.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A row is known by its id and text, so that equal rows have equal results and none is lost.
    rows = rows.select("doc_id", F.xxhash64("text").alias("of"), F.length("text").alias("long"), _words(F.col("text")).alias("words"))
    key = ["doc_id", "of", "long"]
    n = F.size("words")
    # Runs at the end of a text have nulls where its words are used up.
    zipped = F.arrays_zip(F.col("words").alias("w0"), F.slice("words", 2, n).alias("w1"), F.slice("words", 3, n).alias("w2"))
    runs = rows.select(*key, F.posexplode(zipped).alias("at", "run")).select(*key, "at", "run.*")
    w0, w1, w2 = F.col("w0"), F.col("w1"), F.col("w2")
    base = F.lit(None).cast("string")
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        hit = (w0 == parts[0]) & (w1 == parts[1]) & (w2 == parts[2] if len(parts) > 2 else F.lit(True))
        base = F.when(hit, label).otherwise(base)
    templates = F.broadcast(template_runs(df.sparkSession).withColumn("gram", F.xxhash64("w0", "w1", "w2")))
    templates = templates.select("gram", *[F.col(f"w{i}").alias(f"t{i}") for i in range(K)], "template", "label", "place", "runs")
    same = (F.col("gram") == F.col("t_gram")) & (w0 == F.col("t0")) & (w1 == F.col("t1")) & (w2 == F.col("t2"))
    votes = runs.withColumn("base", base).withColumn("gram", F.xxhash64("w0", "w1", "w2"))
    votes = votes.join(templates.withColumnRenamed("gram", "t_gram"), same, "left")
    votes = votes.where("base is not null or template is not null").select(*key, "at", "base", "template", "label", "place", "runs")
    votes = settle(votes, "license-votes")
    phrases = votes.where("base is not null").select(*key, "at", "base").distinct()
    phrases = phrases.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_base"),
        F.min("at").cast("long").alias("first_word"),
        F.max("at").cast("long").alias("last_word"),
        F.array_sort(F.collect_set("base")).alias("base_set"),
    )
    # One diagonal's votes, then its runs of votes without a long rest.
    lines = votes.where("template is not null").select(*key, "template", "label", "runs", "at", "place").distinct()
    lines = lines.withColumn("diagonal", F.col("at") - F.col("place"))
    line = Window.partitionBy(*key, "template").orderBy("at", "diagonal")
    apart = (F.col("at") - F.lag("at").over(line) > REST) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(line)) > DRIFT)
    lines = lines.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(line))
    spans = lines.groupBy(*key, "template", "label", "runs", "span").agg(
        F.countDistinct("place").alias("places"), F.countDistinct("at").alias("hits"), (F.max("at") - F.min("at") + 1).alias("long_as")
    )
    spans = spans.withColumn("cover", F.col("places") / F.col("runs"))
    spans = spans.where((F.col("cover") >= COVER) & (F.col("hits") >= DENSE * F.col("long_as")))
    found = spans.groupBy(*key).agg(F.collect_set("label").alias("span_set"), F.max("cover").alias("cover"))
    out = rows.select(*key, n.cast("long").alias("n_words"))
    for part in (phrases, found):
        out = out.alias("l").join(part.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key], "left").select(
            "l.*", *[f"r.{c}" for c in part.columns if c not in key]
        )
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union(F.coalesce("base_set", none), F.coalesce("span_set", none)))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.coalesce("base_set", none), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )


def scan_sql() -> str:
    """The same in SQL over the table documents."""
    values, number = [], 0
    for label, sentences in TEMPLATES.items():
        for sentence in sentences:
            words = sentence.split()
            n = len(words) - K + 1
            values += [f"('{words[i]}','{words[i + 1]}','{words[i + 2]}',{number},'{label}',{i},{n})" for i in range(n)]
            number += 1
    base = " ".join(
        "WHEN " + " AND ".join(f"w[i + {j + 1}] = '{w}'" for j, w in enumerate(phrase.split())) + f" THEN '{label}'"
        for phrase, label in PHRASES.items()
    )
    return rf"""
    WITH templates(t0, t1, t2, template, label, place, runs) AS (VALUES {", ".join(values)}),
    words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    places AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM words),
    phrases AS (SELECT doc_id, i, CASE {base} END AS base FROM places),
    bases AS (
        SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT base) AS base_set
        FROM phrases WHERE base IS NOT NULL GROUP BY doc_id
    ),
    lines AS (
        SELECT doc_id, template, label, runs, i AS spot, place, i - place AS diagonal
        FROM places JOIN templates ON w[i + 1] = t0 AND w[i + 2] = t1 AND w[i + 3] = t2
    ),
    marked AS (
        SELECT *, CASE WHEN spot - lag(spot) OVER line <= {REST} AND abs(diagonal - lag(diagonal) OVER line) <= {DRIFT} THEN 0 ELSE 1 END AS new
        FROM lines WINDOW line AS (PARTITION BY doc_id, template ORDER BY spot, diagonal)
    ),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY spot, diagonal) AS span FROM marked),
    spans AS (
        SELECT doc_id, label, count(DISTINCT place) / any_value(runs)::DOUBLE AS cover, count(DISTINCT spot) AS hits, max(spot) - min(spot) + 1 AS long_as
        FROM numbered GROUP BY doc_id, template, label, span
    ),
    found AS (
        SELECT doc_id, list(DISTINCT label) AS span_set, max(cover) AS cover
        FROM spans WHERE cover >= {COVER} AND hits >= {DENSE} * long_as GROUP BY doc_id
    )
    SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
           last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base_set), ','), '') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base_set, []), coalesce(span_set, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0.0)::DOUBLE END AS score
    FROM words LEFT JOIN bases USING (doc_id) LEFT JOIN found USING (doc_id)
    """
