"""License scan by diagonal voting, in DataFrame functions only.

Every word k-gram of every text is hashed and joined to the positions of the
same k-gram in the license templates.  A hit at word ``p`` of the text and word
``t`` of the template votes for the diagonal ``p - t``; votes are summed per
(document, template, diagonal), neighbouring diagonals (a few words inserted
or left out) are merged into spans, and a span is verified by the share of the
template's k-grams that it holds.  A diagonal that holds all k-grams of a
template is a place where the template stands word for word.

Words: A-Z lower-cased, then maximal runs of ASCII letters, digits and
non-ASCII characters.  Templates of two words use 2-grams, longer ones
3-grams; hits are compared word by word, so hash collisions do not count.

Defined cases: null and empty texts have no words and score 0; repeated
doc_ids are separate documents; an empty table gives an empty result; other
columns are ignored; a document's groups are bounded by its own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import documents

#: phrases whose every place counts, with their labels
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: opening sentences of common public licenses, matched approximately
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
    ("this work is dedicated to the public domain", "public-domain"),
)

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words as in the module's rule.  The Kelvin sign is the one character
    that ``lower`` would turn into a plain ASCII word character."""
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lower, NOT_WORD, -1), "")


def gram_length(n_words: int) -> int:
    return min(3, n_words)


def template_positions(spark, base, templates) -> DataFrame:
    """One row per template position; the templates are a parameter, so their
    size is known on the driver."""
    rows = []
    for number, (phrase, label) in enumerate([*base, *templates]):
        words = phrase.split()
        k = gram_length(len(words))
        for t in range(len(words) - k + 1):
            rows.append((number, label, number < len(base), len(words) - k + 1, t, k, words[t:t + k]))
    return spark.createDataFrame(
        rows, "template int, label string, base boolean, grams int, t int, k int, gram array<string>")


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, min_share: float = 0.75,
         drift: int = 3, max_broadcast_positions: int = 100_000) -> dict[str, DataFrame]:
    """``places`` (exact occurrences) with ``spans`` (verified approximate
    ones) per document row, and ``summary``, one row per document row."""
    spark = docs.sparkSession
    positions = template_positions(spark, base, templates)
    lengths = sorted({gram_length(len(p.split())) for p, _ in [*base, *templates]})
    known = positions.withColumn("hash", F.xxhash64("k", "gram"))
    n_positions = sum(len(p.split()) for p, _ in [*base, *templates])
    known = F.broadcast(known) if n_positions <= max_broadcast_positions else known

    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                        words_of(F.col("text")).alias("words"))
    # position -1 stands for the document itself, so one pass gives both
    at = texts.select("row", "doc_id", "words", F.size("words").alias("n_words"), F.explode(
        F.sequence(F.lit(-1), F.size("words") - 1)).alias("p"))
    grams = F.array(*[F.struct(F.lit(k).alias("k"), F.xxhash64(
        F.lit(k), F.array(*[F.get("words", F.col("p") + i) for i in range(k)])).alias("hash"))
        for k in lengths])
    probes = at.select("row", "doc_id", "words", "n_words", "p", F.explode(
        F.when(F.col("p") < 0, F.array(F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("hash"))))
        .otherwise(grams)).alias("g")).select("row", "doc_id", "words", "n_words", "p", "g.hash", "g.k")
    hits = probes.alias("d").join(known.alias("t"), (F.col("d.hash") == F.col("t.hash"))
                                  & (F.col("d.k") == F.col("t.k")), "left").filter(
        (F.col("p") < 0) | (F.col("gram") == F.slice("words", F.col("p") + 1, F.greatest(F.col("t.k"), F.lit(1)))))
    diagonals = hits.groupBy("row", "template", (F.col("p") - F.col("t.t")).alias("diagonal")).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.first("label").alias("label"), F.first("base").alias("base"), F.first("grams").alias("grams"),
        F.min("p").alias("first"), F.max("p").alias("last"), F.collect_set("t.t").alias("held"))
    order = Window.partitionBy("row", "template").orderBy("first", "diagonal")
    broken = ((F.col("first") - F.lag("last").over(order) > F.col("grams"))
              | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > drift))
    linked = (diagonals.withColumn("new", F.coalesce(broken, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("new").over(order)))
    spans = linked.groupBy("row", "template", "span").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.first("label").alias("label"), F.first("base").alias("base"), F.first("grams").alias("grams"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("covered"),
        F.count(F.when(F.size("held") == F.col("grams"), 1)).alias("places"),
        F.min(F.when(F.size("held") == F.col("grams"), F.col("diagonal"))).alias("first_place"),
        F.max(F.when(F.size("held") == F.col("grams"), F.col("diagonal"))).alias("last_place"))
    spans = spans.withColumn("share", F.col("covered") / F.col("grams"))
    found = F.when(F.col("base"), F.col("places") > 0).otherwise(F.col("share") >= min_share)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    of_base = F.col("base") & (F.col("places") > 0)
    summary = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.coalesce(F.sum(F.when(of_base, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(of_base, F.col("first_place"))).cast("long").alias("first_word"),
        F.max(F.when(of_base, F.col("last_place"))).cast("long").alias("last_word"),
        joined(F.when(of_base, F.col("label"))).alias("base_labels"),
        joined(F.when(found, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score"))
    return {"spans": spans.filter(F.col("template").isNotNull() & found), "summary": summary}


def op6(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))["summary"].drop("row")
