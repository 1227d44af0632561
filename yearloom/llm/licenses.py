"""Licence mentions by diagonal voting, with DataFrame functions only.

All pairs of neighbouring words of a text are joined, by their hash and then by the words
themselves, to the places of the pairs in a few fixed templates.  Each match votes for the
diagonal "place in the text minus place in the template".  A base phrase stands where a
diagonal has all its votes.  For longer templates neighbouring diagonals, between which
words were put in or left out, are merged to a span that drifts by a few words at most.  A span
is verified: each place of the template counts once, where it stands first, and
only if it comes after all earlier places.  It is found if enough of the template is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values: (label, whether it is a base phrase, words).
TEMPLATES = (
    ("mit", True, "mit license"),
    ("apache", True, "apache license"),
    ("gpl", True, "general public license"),
    ("mit", False, "released under the mit license"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of "
     "this software and associated documentation files"),
    ("apache", False, "licensed under the apache license version 2 0"),
    ("gpl", False, "this work is licensed under the gnu general public license version 3"),
    ("gpl", False, "under the terms of the gnu general public license as published by the free "
     "software foundation"),
    ("lgpl", False, "gnu lesser general public license"),
    ("agpl", False, "gnu affero general public license"),
    ("bsd", False, "redistribution and use in source and binary forms with or without "
     "modification are permitted provided that the following conditions are met"),
    ("cc", False, "licensed under cc by nc 4 0"),
    ("cc", False, "licensed under a creative commons attribution"),
    ("mpl", False, "subject to the terms of the mozilla public license"),
    ("isc", False, "permission to use copy modify and or distribute this software for any purpose "
     "with or without fee is hereby granted"),
    ("unlicense", False, "this is free and unencumbered software released into the public domain"),
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DRIFT = 4  # words by which the diagonals of a span differ at most
SHARE = 0.6  # of the word pairs of a template
VOTES = 3  # word pairs


def templates(spark: SparkSession) -> DataFrame:
    """One row per pair of words of each template; a fixed table of a few hundred rows."""
    rows = F.array(
        *(
            F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(words).alias("words"))
            for k, (label, base, words) in enumerate(TEMPLATES)
        )
    )
    split = spark.range(1).select(F.inline(rows)).withColumn("words", F.split("words", " "))
    return split.select(
        "template", "label", "base", (F.size("words") - 1).alias("pairs"), F.posexplode(_pairs("words"))
    ).select(
        "template", "label", "base", "pairs",
        F.col("pos").alias("at"), F.col("col.a").alias("ta"), F.col("col.b").alias("tb"),
        F.xxhash64("col.a", "col.b").alias("tgram"),
    ).where("tb is not null")


def _pairs(words: str) -> Column:
    """Each word with the next one, null after the last."""
    following = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.arrays_zip(F.col(words).alias("a"), following.alias("b"))


def _verified(span: str) -> Column:
    """How many places of the template follow each other in the diagonals of a span.

    ``span`` is an array of diagonals (``line``) and the template's places on them (``places``, a bit each),
    by rising diagonal.
    """
    zero = "named_struct('last', -1, 'count', 0)"
    # Of the diagonals with the place, the first has it first in the text.
    pos = f"i + filter({span}, d -> (d.places & shiftleft(1L, i)) != 0)[0].line"
    seen = f"exists({span}, d -> (d.places & shiftleft(1L, i)) != 0)"
    step = f"CASE WHEN {seen} AND {pos} > s.last THEN named_struct('last', {pos}, 'count', s.count + 1) ELSE s END"
    found = F.expr(f"aggregate(sequence(0, CAST(pairs AS INT) - 1), {zero}, (s, i) -> {step}).count")
    places = F.expr(f"bit_count(aggregate({span}, 0L, (s, d) -> s | d.places))")
    return F.when(places >= VOTES, found).otherwise(F.lit(0))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` and ``score``.

    Words are runs of a-z, 0-9 and non-ASCII characters of lower-cased text.  ``n_base``
    counts all places of base phrases; ``first_word`` and ``last_word`` are the smallest and
    largest word they start at, else null.  Labels are distinct, sorted and joined by
    commas, empty if there are none.  ``score`` is the largest share of a template found:
    1 with a base phrase, 0 without any span.  Null and empty texts have no words.  Rows
    that share a key, or have none, are told apart and each give a row.

    ``df`` has to give its rows in the same order if a task is run again, as files and stored tables
    do: rows are numbered where they are read.
    """
    docs = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").alias("key"),
        # Full lower-casing differs from that of A-Z in non-ASCII words alone, which no base
        # phrase holds, and never makes or ends a word.
        F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), F.lit(WORD), F.lit(0)).alias("words"),
    )
    words = docs.select(
        "row", "key", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(_pairs("words"))
    )
    pairs = words.select("row", "key", "n_words", "pos", F.col("col.a").alias("a"), F.col("col.b").alias("b"))
    grams = pairs.withColumn("gram", F.xxhash64("a", "b"))
    same = (F.col("gram") == F.col("tgram")) & (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb"))
    joined = grams.join(F.broadcast(templates(df.sparkSession)), same, "left")
    # The first pair of words stays for the row's sake, matched or not.
    votes = joined.where("template is not null or pos is null or pos = 0")
    template = ["template", "label", "base", "pairs"]
    lines = votes.groupBy("row", "key", "n_words", *template, (F.col("pos") - F.col("at")).alias("line")).agg(
        F.count("template").alias("votes"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("places")
    )
    near = Window.partitionBy("row", "template").orderBy("line").rangeBetween(0, DRIFT)
    merged = lines.withColumn("span", F.when(~F.col("base"), F.collect_list(F.struct("line", "places")).over(near)))
    spans = merged.withColumn("count", F.when(~F.col("base"), _verified("span")).otherwise(F.col("votes")))
    share = F.col("count") / F.col("pairs")
    base = F.col("base") & (F.col("count") == F.col("pairs"))
    other = ~F.col("base") & (F.col("count") >= VOTES) & (share >= SHARE)
    labels = lambda where: F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")
    result = spans.groupBy("row", "key", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("line"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("line"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(base | other).alias("labels"),
        F.coalesce(F.max(F.when(base | other, share)), F.lit(0.0)).alias("score"),
    )
    return result.select(F.col("key").alias(key), *result.columns[2:])
