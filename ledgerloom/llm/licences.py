"""Licence notices by diagonal voting over word k-grams, in native functions.

All rolling k-grams of a text's words meet the templates' k-grams by hash and words.  Each hit
votes for its diagonal, place in the text minus place in the template; neighbouring diagonals
(words added or left out) are merged; a span stands if enough of its template's k-grams are
found inside it and it isn't much longer than the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import numbered

GRAM = 3
#: diagonals this near belong to one notice
NEAR = 2
LEAST_SHARE = 0.6
LONGEST = 1.5

# fixed values: phrases of the contract, and notices in words
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lowered words; lowering more than A-Z changes neither their number nor what matches a phrase."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_WORD), F.lit(0))


def grams(df: DataFrame, words: str, *keep: str) -> DataFrame:
    """Every k-gram with its place (from 0) and hash."""
    parts = [F.slice(F.col(words), i + 1, F.greatest(F.size(words) - (GRAM - 1), F.lit(0))).alias(f"w{i}") for i in range(GRAM)]
    rows = df.select(*keep, F.posexplode(F.arrays_zip(*parts)).alias("place", "g"))
    rows = rows.select(*keep, "place", *[F.col(f"g.w{i}").alias(f"w{i}") for i in range(GRAM)])
    return rows.withColumn("h", F.xxhash64(*[f"w{i}" for i in range(GRAM)]))


def template_grams(spark, templates: list[tuple[str, str]]) -> DataFrame:
    rows = spark.createDataFrame([(n, label, text.split(" ")) for n, (label, text) in enumerate(templates)], "template int, label string, words array<string>")
    rows = rows.withColumn("length", F.size("words"))
    out = grams(rows, "words", "template", "label", "length")
    return out.select("template", "label", "length", F.col("place").alias("t_place"), F.col("h").alias("t_h"), *[F.col(f"w{i}").alias(f"t_w{i}") for i in range(GRAM)])


def notices(words: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Verified notices in ``words`` (row, words): row, label, template, start, end (words, exclusive), share."""
    t = template_grams(words.sparkSession, templates)
    same = F.col("h") == F.col("t_h")
    for i in range(GRAM):
        same = same & (F.col(f"w{i}") == F.col(f"t_w{i}"))
    # a few hundred rows, by the length of the templates; the texts' k-grams stay where they are
    hits = grams(words, "words", "row").join(F.broadcast(t), same).select("row", "template", "label", "length", "place", "t_place")
    votes = hits.groupBy("row", "template", "label", "length", (F.col("place") - F.col("t_place")).alias("diagonal")).agg(
        F.min("place").alias("start"), (F.max("place") + GRAM).alias("end"), F.collect_set("t_place").alias("found")
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int")
    merged = votes.withColumn("run", F.sum(F.coalesce(apart, F.lit(1))).over(order)).groupBy("row", "template", "label", "length", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n")
    )
    share = F.col("n") / (F.col("length") - (GRAM - 1))
    short = F.col("end") - F.col("start") <= F.col("length") * LONGEST + NEAR
    return merged.withColumn("share", share).where((F.col("share") >= LEAST_SHARE) & short).select("row", "label", "template", "start", "end", "share")


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts (from 0) of all places where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    here = lambda i: [F.get(words, i + j) == F.lit(p) for j, p in enumerate(parts)]

    def stands(i: Column) -> Column:
        out = None
        for c in here(i):
            out = c if out is None else out & c
        return out

    firsts = F.filter(F.transform(words, lambda w, i: F.when(w == F.lit(parts[0]), i)), lambda i: i.isNotNull())
    there = F.filter(firsts, stands)
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.when(joined.contains(f" {phrase} "), there).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): the contract's columns.

    ``score`` is 1 where a phrase of the contract stands, else the best share of a notice found,
    else 0.  Null and empty texts have no words and no labels; repeated rows give the same; other
    columns don't matter; an empty table gives no rows.
    """
    docs, row = numbered(docs.select("doc_id", "text"), "licences-rows")
    rows = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    found = notices(rows.select("row", "words"), templates)
    found = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share")).withColumnRenamed("row", "of")
    at = {p: phrase_places(F.col("words"), p) for p in PHRASES}
    per = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), *[at[p].alias(f"p{k}") for k, p in enumerate(PHRASES)])
    every = F.concat(*[f"p{k}" for k in range(len(PHRASES))])
    base = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]), lambda x: x.isNotNull())
    per = per.select("row", "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_sort(base).alias("base"))
    joined = per.join(found, F.col("row") == F.col("of"), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
