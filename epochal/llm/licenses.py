"""License scans by diagonal voting.

All rolling word 3-grams of all texts are joined on their hash to the positions at which they stand
in the license templates. A hit votes for a diagonal: its place in the text less its place in the
template. A diagonal with a vote for every gram of a phrase is a place where the phrase stands.
Neighbouring diagonals of a template (words put in or left out move the diagonal) are merged into
one span, whose share of the template's grams is its score. Hits are verified by comparing the
words themselves, so a hash collision adds nothing.

The templates are a fixed parameter, a few dozen rows, and are broadcast; texts are never shuffled,
only hits and one slim row a document are.

Defined results: a null text has no words; texts shorter than a gram have no hits; rows that repeat
get equal results; a null doc_id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: The base phrases with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Templates of the method: passages of public licenses, scored by the share that a text has of them.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
)
#: Words in a gram; diagonals this near are merged; a span with this share of its template carries the label.
GRAM, NEAR, SHARE = 3, 2, 0.7
#: Only A-Z are lower-cased: a gram with other letters is none of a template's, whatever they fold to.
#: Fixed pattern: words once A-Z are lower-case, here on the text as it stands.
ASCII = r"^[\x00-\x7F]*$"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_grams(spark, base=BASE, templates=TEMPLATES) -> DataFrame:
    """template, label, is_base, grams, place, gram: a row for each gram of each template."""
    rows = []
    for k, (words, label, is_base) in enumerate([(*t, True) for t in base] + [(*t, False) for t in templates]):
        words = words.split()
        n = len(words) - GRAM + 1
        rows += [(k, label, is_base, n, i, " ".join(words[i : i + GRAM])) for i in range(n)]
    return spark.createDataFrame(rows, "template int, label string, is_base boolean, grams int, place int, gram string")


def hits(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """rid, template, label, is_base, grams, place, diagonal: the verified gram hits of all texts."""
    rid = common.row_key(F.col("doc_id"), F.col("text"))
    words = docs.filter("text is not null").select(rid.alias("rid"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    rolled = F.transform("words", lambda w, i: F.concat_ws(" ", w, *[F.get("words", i + k) for k in range(1, GRAM)]))
    grams = words.select("rid", F.posexplode(rolled).alias("at", "said")).withColumn("hash", F.xxhash64(F.lower("said")))
    known = template_grams(docs.sparkSession, base, templates).withColumn("hash", F.xxhash64("gram"))
    found = grams.join(F.broadcast(known), "hash")  # a fixed few dozen rows
    found = found.filter(F.lower("said") == F.col("gram")).filter(F.col("said").rlike(ASCII))
    return found.select("rid", "template", "label", "is_base", "grams", "place", (F.col("at") - F.col("place")).cast("long").alias("diagonal"))


def diagonals(found: DataFrame) -> DataFrame:
    """rid, template, label, is_base, grams, diagonal, places: the votes of each diagonal."""
    return found.groupBy("rid", "template", "label", "is_base", "grams", "diagonal").agg(F.collect_set("place").alias("places"))


def spans(votes: DataFrame) -> DataFrame:
    """rid, template, label, first, last, share: neighbouring diagonals merged, with their share of the template."""
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    starts = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= NEAR, 0).otherwise(1)
    votes = votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(order))
    merged = votes.groupBy("rid", "template", "label", "grams", "span").agg(F.min("diagonal").alias("first"), F.max("diagonal").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"))
    return merged.select("rid", "template", "label", "first", "last", (F.col("covered") / F.col("grams")).alias("share"))


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, share: float = SHARE) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    common.prepare(docs.sparkSession)
    votes = diagonals(hits(docs, base, templates)).checkpoint()  # only hits: a few rows for each text with a license
    places = votes.filter(F.col("is_base") & (F.size("places") == F.col("grams")))
    of_base = places.groupBy("rid").agg(F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"), F.collect_set("label").alias("base_set"))
    of_spans = spans(votes).groupBy("rid").agg(F.max("share").alias("score"), F.collect_set(F.when(F.col("share") >= share, F.col("label"))).alias("span_set"))
    rows = docs.select("doc_id", common.row_key(F.col("doc_id"), F.col("text")).alias("rid"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    joined = rows.join(of_spans.join(of_base, "rid", "left"), "rid", "left")
    none = F.array().cast("array<string>")
    listed = lambda *sets: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.coalesce(s, none) for s in sets]))), ",")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        listed(F.col("base_set")).alias("base_labels"),
        listed(F.col("base_set"), F.col("span_set")).alias("labels"),
        F.coalesce(F.round("score", 9), F.lit(0.0)).alias("score"),
    )
