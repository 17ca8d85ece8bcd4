"""License scans by diagonal voting.

Base: places where the words of a fixed phrase stand one after another.  The method: the rolling
``K``-gram hashes of all words of every text are joined to the positions of the same grams in license
templates (a small fixed table, broadcast); equal words are checked, not only equal hashes.  A match
votes for its diagonal, text position minus template position.  Votes are counted per
(text, template, diagonal), diagonals at most ``DRIFT`` apart are merged (a word put in or left
out moves the rest of a template to the next diagonal), and each merged span is verified: the share
of the template's words that it holds, and the share of its own words that belong to the
template, reach ``MIN_SHARE`` and ``MIN_DENSITY``.  Verified spans give the template's label.

``score`` is the greatest share of a template found in a verified span, and at least 0.5 where a base
phrase stands; 0 for texts without a label.

Everything is DataFrame expressions.  Texts are read once and never shuffled; only
places that match are written.  A text's matches stay apart by diagonal until they are aggregated, so
neither a frequent gram nor a text full of licenses meets in one task beyond what the text
itself holds.

Defined results: null and empty texts have no words; words count from 0; a phrase across lines or punctuation
counts (only words matter); overlapping places all count; a span too short for a whole gram has no
vote; repeated rows each give a row; very long texts are taken whole; an empty table gives no
rows; extra columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import written
from .decontam import word_array

# --- fixed values: phrases of the contract, license notices ----------------------------
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

K = 3
DRIFT = 4
MIN_SHARE = 0.8
MIN_DENSITY = 0.7
BASE_SCORE = 0.5


def grams(words: Column) -> Column:
    """Array of (w0 .. w[K-1]): the words from every position on; null beyond the end."""
    return F.arrays_zip(*[F.slice(words, i + 1, F.size(words)).alias(f"w{i}") for i in range(K)])


def template_words(spark: SparkSession) -> DataFrame:
    """(template, label, words)."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"))
                     for i, (label, text) in enumerate(TEMPLATES)])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.template", "t.label", word_array(F.col("t.text")).alias("words"))


def template_index(spark: SparkSession) -> DataFrame:
    """(gram, places): every gram hash of the templates with its (words, template, at)."""
    t = (template_words(spark).select("template", F.posexplode(grams(F.col("words"))).alias("at", "g"))
         .where(F.col(f"g.w{K - 1}").isNotNull()))
    place = F.struct(F.array("g.*").alias("words"), "template", "at")
    return (t.select(F.xxhash64("g.*").alias("gram"), place.alias("p"))
            .groupBy("gram").agg(F.collect_list("p").alias("places")))


def phrase_label(gram: str) -> Column:
    """Label of the base phrase that a gram begins with, or null."""
    out = F.lit(None).cast("string")
    for phrase, label in PHRASES:
        here = F.lit(True)
        for i, w in enumerate(phrase.split()):
            here = here & F.coalesce(F.col(f"{gram}.w{i}") == w, F.lit(False))
        out = F.when(here, F.lit(label)).otherwise(out)
    return out


def license_places(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, pos, base, places): the positions of every text where a base phrase or a
    template gram begins; and one row per text at position -1 with its number of words."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), word_array(F.col(text)).alias("words"))
    # position 0 is an empty word that stands for the text itself
    d = d.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), grams(F.concat(F.array(F.lit("")), F.col("words"))).alias("grams"))
    own = F.col("at") == 0
    t = (d.select("row", "doc_id", "n_words", F.posexplode("grams").alias("at", "g"))
         .withColumn("gram", F.xxhash64("g.*")).withColumn("base", phrase_label("g"))
         .join(F.broadcast(template_index(docs.sparkSession)), "gram", "left")
         .where(F.col("places").isNotNull() | F.col("base").isNotNull() | own))
    same = F.filter("places", lambda p: p["words"] == F.array("g.*"))
    return t.select("row", F.when(own, F.col("doc_id")).alias("doc_id"), F.when(own, F.col("n_words")).alias("n_words"),
                    (F.col("at") - 1).cast("long").alias("pos"), "base",
                    F.transform(same, lambda p: F.struct(p["template"].alias("template"), p["at"].alias("at"))).alias("places"))


def diagonals(places: DataFrame) -> DataFrame:
    """(row, template, diagonal, ats, lo, hi): the votes of every diagonal, as the template positions
    that match on it and the text positions they span (hi exclusive)."""
    hit = places.where("pos >= 0").select("row", "pos", F.explode("places").alias("p")).select("row", "pos", "p.template", "p.at")
    return (hit.groupBy("row", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
            .agg(F.collect_set("at").alias("ats"), F.min("pos").alias("lo"), (F.max("pos") + K).alias("hi")))


def merged(votes: DataFrame) -> DataFrame:
    """(row, template, ats, lo, hi): spans of neighbouring diagonals."""
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True))
    return (votes.withColumn("new", new.cast("int"))
            .withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "template", "span")
            .agg(F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def verified(spans: DataFrame) -> DataFrame:
    """(row, label, share, start, end) of the spans that hold enough of a template and little else."""
    t = template_words(spans.sparkSession).select(F.col("template").alias("of"), "label", F.size("words").alias("whole"))
    held = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + K - 1)))))
    return (spans.withColumn("held", held).join(F.broadcast(t), F.col("template") == F.col("of"))
            .withColumn("share", F.col("held") / F.col("whole"))
            .where((F.col("share") >= MIN_SHARE) & (F.col("held") >= MIN_DENSITY * (F.col("hi") - F.col("lo"))))
            .select("row", "label", "share", F.col("lo").alias("start"), F.col("hi").alias("end")))


def find_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels and labels (sorted arrays), score."""
    places = written(license_places(docs, doc_id, text), "license-places")
    found = (verified(merged(diagonals(places))).groupBy("row")
             .agg(F.collect_set("label").alias("more"), F.max("share").alias("share")))
    at = F.when(F.col("base").isNotNull(), F.col("pos"))
    rows = places.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("base").alias("n_base"),
                                     F.min(at).alias("first_word"), F.max(at).alias("last_word"), F.sort_array(F.collect_set("base")).alias("base_labels"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)))
    return (rows.join(found, "row", "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score")))
