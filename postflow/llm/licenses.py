"""License scans by diagonal voting.

Word k-grams of documents are joined to the places where license templates hold the same k-gram.
A copy of a template puts many matches on one diagonal (document position less template
position); insertions and deletions move it to a neighbouring one. Votes are counted by
diagonal, neighbouring diagonals merge into spans, and a span is verified by how much of its
template it covers. Everything on the path is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.llm.common import keep_table
from postflow.llm.quality_rules import let

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
SLACK = 3
COVER = 0.6
LEAST_VOTES = 3

# The phrases and labels asked for.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notices that the licenses themselves ask to be used, and common forms of them.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Released under the MIT License",
        "Licensed under the MIT License",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
        "This work is licensed under the GNU General Public License, version 3",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under Creative Commons Attribution",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ),
    "proprietary": ("All rights reserved",),
}


def word_list(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def gram_hashes(words: Column, size: int) -> Column:
    """A hash for each place of ``size`` words, in order."""
    n = F.greatest(F.size(words) - (size - 1), F.lit(0))
    grams = F.arrays_zip(*[F.slice(words, F.lit(i + 1), n).alias(f"w{i}") for i in range(size)])
    return F.transform(grams, lambda g: F.xxhash64(g))


def template_grams(spark: SparkSession, templates=None, size: int = GRAM) -> DataFrame:
    """``(template, label, length, tpos, gram)``: a row for each k-gram of each template.

    Its size is that of the given templates, which are part of the program.
    """
    rows = [
        (f"{label} {i}", label, text)
        for label, texts in (templates or TEMPLATES).items()
        for i, text in enumerate(texts)
    ]
    words = spark.createDataFrame(rows, "template string, label string, text string").select(
        "template", "label", word_list(F.col("text")).alias("words")
    )
    # A template shorter than k words has no place to vote from.
    return words.select(
        "template",
        "label",
        F.size("words").alias("length"),
        F.posexplode(gram_hashes(F.col("words"), size)).alias("tpos", "gram"),
    )


def _places(words: Column, phrase: list[str], label: str) -> Column:
    def stands(i: Column) -> Column:
        found = F.lit(True)
        for j, word in enumerate(phrase):
            found = found & F.coalesce(F.get(words, i + j) == word, F.lit(False))
        return found

    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)
    return F.transform(found, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def phrase_places(words: Column, phrases) -> Column:
    """``array<struct<at, label>>``: the places where a phrase's words stand one after another."""
    parts = []
    for phrase, label in phrases.items():
        own = phrase.split()

        # Most texts lack the last word, and are done with one look.
        places = F.when(F.array_contains(words, own[-1]), _places(words, own, label))
        parts.append(F.coalesce(places, F.array().cast("array<struct<at:int,label:string>>")))
    return F.concat(*parts)


def scan(
    docs: DataFrame,
    templates=None,
    phrases=None,
    size: int = GRAM,
    slack: int = SLACK,
    cover: float = COVER,
    least_votes: int = LEAST_VOTES,
) -> DataFrame:
    """``(doc_id, n_words, places, spans)``, a row for each row of ``docs (doc_id, text)``.

    ``places`` are the exact places of ``phrases``; ``spans`` the verified copies of
    ``templates``: label, template, word range and the share of the template's k-grams found.
    Diagonals up to ``slack`` apart merge; a span counts from ``cover`` of its template and
    ``least_votes`` k-grams on (all of them for a shorter template). Null and empty texts have no
    words. A repeated row is a row of its own.
    """
    spark = docs.sparkSession
    grams = keep_table(template_grams(spark, templates, size), "templates")
    # In each row, only k-grams that some template holds are left for the join.
    known = [r["gram"] for r in grams.select("gram").distinct().collect()]
    phrases = PHRASES if phrases is None else phrases

    def of(words: Column) -> Column:
        hashes = gram_hashes(words, size)
        placed = F.transform(hashes, lambda h, i: F.struct(i.alias("pos"), h.alias("gram")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            phrase_places(words, phrases).alias("places"),
            F.filter(placed, lambda p: p["gram"].isin(known)).alias("grams"),
        )

    # The table fixes the row numbers: a task that runs again finds them as they are.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", let(word_list(F.col("text")), of).alias("s")
    )
    rows = keep_table(rows.select("row", "doc_id", "s.*"), "license_words")
    votes = (
        rows.select("row", F.explode("grams").alias("g"))
        .select("row", "g.pos", "g.gram")
        .join(F.broadcast(grams), "gram")
        .withColumn("diagonal", F.col("pos") - F.col("tpos"))
    )
    lines = votes.groupBy("row", "template", "label", "length", "diagonal").agg(
        F.count("*").alias("votes"),
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
        F.collect_set("tpos").alias("tset"),
    )
    # Neighbouring diagonals of one template in one document belong to one copy.
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    lines = lines.withColumn("new", F.when(gap <= slack, 0).otherwise(1))
    lines = lines.withColumn("copy", F.sum("new").over(order))
    # collect_set of a copy's places is bounded by the template's length times the diagonals.
    spans = lines.groupBy("row", "template", "label", "length", "copy").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("tset")))).alias("found"),
        F.min("low").alias("low"),
        (F.max("high") + size).alias("high"),
    )
    places = F.col("length") - (size - 1)
    spans = spans.withColumn("share", F.col("found") / places).filter(
        (F.col("share") >= cover) & (F.col("found") >= F.least(F.lit(least_votes), places))
    )
    spans = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "label", "template", "share"))).alias("spans")
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, "row", "left").select(
        "doc_id", "n_words", "places", F.coalesce("spans", none).alias("spans")
    )


def license_report(docs: DataFrame) -> DataFrame:
    """``scan`` as one row of counts and labels for each document.

    ``score`` is 1 where a phrase stands, else the largest share of a verified span, else 0.
    """
    found = scan(docs)
    at = F.transform("places", lambda p: p["at"].cast("long"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.array_distinct(F.transform("spans", lambda s: s["label"]))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
