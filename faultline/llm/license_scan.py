"""License scans by diagonal voting: rolling word k-grams meet template positions, offsets vote, spans are verified.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
# Diagonals at most this far apart, with at most this many words between their hits, are one span.
NEIGHBOUR = 3
GAP = 12
# A span is a license text if this share of its template's words is found in it.
LEAST_SHARE = 0.7

# Phrases that name a license by themselves: (label, words).
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Opening words of license texts and notices: (label, words).
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def words_of(text: Column) -> Column:
    """Words of the whole text, lower-cased; null text is empty.

    Spark's lower() also folds letters beyond A-Z. That changes no place of a word, and equality with templates, which
    are ASCII, only for the Kelvin sign, which becomes another letter first.
    """
    text = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u2135")))
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def template_grams(spark, phrases: tuple, templates: tuple, k: int = GRAM) -> DataFrame:
    """(tid, label, base, total, template, tpos, thash, t0, t1, ..): the k-grams of all phrases and templates, a table of fixed size.

    One more row, of ``tid`` -1 and empty words, meets the empty word put before every text, so that each document
    leaves the join with its number of words.
    """
    entries = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in templates]
    rows = F.array(*[F.struct(F.lit(n).alias("tid"), F.lit(a).alias("label"), F.lit(t).alias("words"), F.lit(b).alias("base")) for n, (a, t, b) in enumerate(entries)])
    texts = spark.range(1).select(F.inline(rows)).withColumn("template", F.split("words", " "))
    parts = [F.get("template", F.col("tpos") + d).alias(f"t{d}") for d in range(k)]
    cut = texts.select("tid", "label", "base", F.size("template").alias("total"), "template", F.explode(F.sequence(F.lit(0), F.size("template") - k)).alias("tpos"))
    cut = cut.select("*", *parts)
    marker = ["-1 AS tid", "'' AS label", "false AS base", "0 AS total", "array('') AS template", "0 AS tpos", *[f"'' AS t{d}" for d in range(k)]]
    every = cut.unionByName(spark.range(1).selectExpr(*marker))
    return every.withColumn("thash", F.when(F.col("tid") >= 0, F.xxhash64(*[f"t{d}" for d in range(k)])).otherwise(F.lit(0)))


def license_scan(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, k: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    One pass over the texts: every rolling k-gram is joined by hash, and word by word, with the grams of the templates, a
    broadcast table of fixed size. Hits vote for their diagonal (place minus template place), which carries the document's words
    that lie along the template. A phrase is found where all words of a diagonal agree. Diagonals of a longer template
    whose hits follow each other in the text are merged if their offsets lie close together, which allows for inserted or
    missing words, whatever other diagonals are met between them. A merged span is verified word by word: it counts if
    enough of the template's words stand at their places on one of its diagonals, from its first hit to its last;
    ``score`` is the largest such share, below the limit too, and 1 for a phrase. Phrases and templates have at least
    ``k`` words and are ASCII. Only hits and one short row a document are shuffled, once, by row.

    Null text is empty and has no words; an empty table gives an empty result. Every row is scanned for itself, also where it
    repeats an id or a text. Other columns are ignored.
    """
    words = F.concat(F.array(F.lit("")), words_of(docs["text"]))
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    shifted = [F.slice("words", d + 1, F.size("words")).alias(f"w{d}") for d in range(k)]
    zipped = rows.select("doc_id", "row", "words", *shifted).select("doc_id", "row", "words", F.arrays_zip(*[f"w{d}" for d in range(k)]).alias("grams"))
    # place 0 is the empty word before the text, so no list is empty; the outer form only spares a second look at its size
    places = zipped.select("doc_id", "row", "words", F.posexplode_outer("grams").alias("pos", "gram"))
    gram = [F.col(f"gram.w{d}") for d in range(k)]
    template = template_grams(docs.sparkSession, phrases, templates, k)
    same = F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.xxhash64(*gram)) == F.col("thash")
    equal = F.lit(True)
    for d in range(k):
        equal = equal & (gram[d] == F.col(f"t{d}"))
    hits = places.join(F.broadcast(template), same & ((F.col("pos") == 0) | equal))
    offset = F.col("pos") - 1 - F.col("tpos")
    along = F.when(F.col("tid") >= 0, F.slice("words", F.greatest(offset, F.lit(0)) + 2, F.col("total") + F.least(offset, F.lit(0))))
    hits = hits.select(
        "doc_id", "row", "tid", "label", "base", "total", "template", "tpos", offset.alias("offset"), (F.size("words") - 1).alias("n_words"), along.alias("along")
    ).repartition("row")
    diagonals = hits.groupBy("row", "tid", "offset").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "base", "total", "template", "along")],
        F.min("tpos").alias("tmin"),
        (F.max("tpos") + (k - 1)).alias("tmax"),
    )
    # places of the template whose word stands on the diagonal, between its first and last hit
    agree = F.filter(
        F.sequence("tmin", "tmax"), lambda t: F.get("along", t + F.least(F.col("offset"), F.lit(0))) == F.get("template", t)
    )
    diagonals = diagonals.select(
        "row", "tid", "offset", "doc_id", "n_words", "label", "base", "total", agree.alias("agree"),
        (F.col("tmin") + F.col("offset")).alias("first"), (F.col("tmax") + F.col("offset")).alias("last"),
    )

    in_text = Window.partitionBy("row", "tid").orderBy("first", "offset")
    gap = F.col("first") - F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1)) > GAP
    islands = diagonals.withColumn("island", F.sum(F.coalesce(gap, F.lit(True)).cast("int")).over(in_text))
    by_offset = Window.partitionBy("row", "tid", "island").orderBy("offset")
    apart = F.col("offset") - F.lag("offset").over(by_offset) > NEIGHBOUR
    spans = islands.withColumn("span", F.sum((F.coalesce(apart, F.lit(True)) | F.col("base")).cast("int")).over(by_offset))
    spans = spans.groupBy("row", "tid", "island", "span").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "base", "total")],
        F.size(F.array_distinct(F.flatten(F.collect_list("agree")))).alias("n"),
        F.min("first").cast("long").alias("at"),
    )
    share = F.when(F.col("tid") < 0, 0.0).otherwise(F.col("n") / F.col("total"))
    spans = spans.withColumn("share", share)
    base = F.col("base") & (F.col("n") == F.col("total"))
    counts = base | (~F.col("base") & (F.col("share") >= LEAST_SHARE) & (F.col("tid") >= 0))
    # part of a phrase is no span of a template
    score = F.max(F.when(base | ~F.col("base"), F.col("share")).otherwise(0.0))
    found = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("at"))).alias("first_word"),
        F.max(F.when(base, F.col("at"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(counts, F.col("label")))), ",").alias("labels"),
        score.alias("score"),
    )
    return found.drop("row")


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
