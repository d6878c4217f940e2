"""License scans: sparse TF-IDF cosine to templates, then directory inheritance.

Units are the sentences of the whole text (line breaks, and white space behind
``.!?``, end one). A unit and a template are compared by the cosine of their
TF-IDF vectors over words ``[a-z0-9]+``; document frequencies of the templates'
words are counted over all files, other words weigh like a word never seen.
A unit scores with its best template if the cosine reaches ``cosine``.

Candidates without loss: of each template, its heaviest words are required
until what remains cannot reach the threshold by itself, so a unit with none of
the required words of any template cannot score. One regular expression finds
files and units that have one.

A file whose scoring units hold at least ``share`` of its words, or whose name
says so, is a licence file and speaks for its directory. Every file takes its
own header first, else the licence of the nearest directory at or above its
own that has one, found by joins on path prefixes of the distinct directories.

Everything is DataFrame expressions. Scale: document frequencies are a partial
aggregation over at most vocabulary-size rows a task; the template tables are
parameters (a few hundred rows); units without a required word never leave the
scan; ancestors are exploded for distinct directories, not files, and a large
directory meets its row by a join that Spark broadcasts by size or splits.

Defined results: null text or null path = no header of its own, no directory
(nothing inherited); ties take the template, then the path, that sorts first;
repeated rows are scanned one by one; a file in no directory has the root
directory ``''``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import stored

#: Usual header sentences of public licences.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
}


@dataclass(frozen=True)
class LicenceRules:
    templates: dict = field(default_factory=lambda: TEMPLATES)
    cosine: float = 0.75
    share_percent: int = 50
    file_names: str = r"(?i)^(licen[cs]e|copying|copyright|notice)([.\-_].*)?$"


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def vocabulary(rules: LicenceRules) -> list[str]:
    return sorted({w for texts in rules.templates.values() for t in texts for w in words_of(t)})


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def template_weights(rules: LicenceRules, idf: dict[str, float]) -> tuple[list[tuple], list[str]]:
    """((template, name, word, unit weight) rows, required words) for the given idf of the vocabulary."""
    rows, required = [], set()
    for name, texts in sorted(rules.templates.items()):
        for k, t in enumerate(texts):
            own = words_of(t)
            raw = {w: own.count(w) * idf[w] for w in set(own)}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            left = 1.0
            for w, x in sorted(raw.items(), key=lambda p: (-p[1], p[0])):
                rows.append((f"{name}#{k}", name, w, x / norm))
                if left >= rules.cosine ** 2 - 1e-9:  # what is left could still reach the threshold by itself
                    required.add(w)
                    left -= (x / norm) ** 2
    return rows, sorted(required)


def idf_of(count: int, df: int) -> float:
    return math.log((count + 1) / (df + 1)) + 1.0


def document_frequencies(files: DataFrame, words: list[str], text: str = "text") -> DataFrame:
    """(word, n): in how many files each of the words lies."""
    found = F.array_intersect(F.split(F.lower(F.col(text)), "[^a-z0-9]+"), F.array(*[F.lit(w) for w in words]))
    return files.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def units_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])[ \t]+", "$1\n"), "\n")


def license_scan(spark: SparkSession, files: DataFrame, rules: LicenceRules = LicenceRules(), file_id: str = "doc_id",
                 path: str = "path", text: str = "text") -> DataFrame:
    """(doc_id, path, own_license, own_cosine, is_license_file, license, origin, from_directory) per file."""
    given = files.select(F.col(file_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    words = vocabulary(rules)
    # at most vocabulary-size rows
    seen = {r["word"]: r["n"] for r in document_frequencies(given, words).collect()}
    total = given.count()
    idf = {w: idf_of(total, seen.get(w, 0)) for w in words}
    weights, required = template_weights(rules, idf)
    any_word = rf"(?i)(?<![A-Za-z0-9])(?:{'|'.join(required)})(?![A-Za-z0-9])"

    # one pass over the texts; from here on only units with a required word exist
    hit = F.filter(units_of(F.col("text")), lambda u: u.rlike(any_word))
    given = given.withColumn("hits", F.when(F.col("text").rlike(any_word), hit).otherwise(F.array().cast("array<string>")))
    rows = stored(spark, given.select("doc_id", "path", "hits", F.when(F.size("hits") > 0, F.size(_words(F.col("text")))).alias("n_words"),
                                      F.monotonically_increasing_id().alias("row"), _directory(F.col("path")).alias("dir")), "licence-files")
    units = rows.select("row", F.posexplode("hits").alias("unit", "sentence")).withColumn("words", _words(F.col("sentence")))
    terms = units.select("row", "unit", F.size("words").alias("n_unit"), "words", F.explode(F.array_distinct("words")).alias("word"))
    terms = terms.withColumn("tf", F.size(F.filter("words", lambda w: w == F.col("word")))).drop("words")
    weight = spark.createDataFrame(sorted(idf.items()), "word string, idf double")
    terms = terms.join(F.broadcast(weight), "word", "left")  # vocabulary rows
    terms = terms.withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(idf_of(total, 0))))
    exact = "decimal(30,12)"  # sums that do not depend on the order of rows
    norms = terms.groupBy("row", "unit", "n_unit").agg(F.sqrt(F.sum((F.col("x") * F.col("x")).cast(exact)).cast("double")).alias("norm"))
    table = spark.createDataFrame(weights, "template string, name string, word string, w double")
    dots = terms.join(F.broadcast(table), "word").groupBy("row", "unit", "template", "name").agg(  # template rows
        F.sum((F.col("x") * F.col("w")).cast(exact)).cast("double").alias("dot"))
    scored = norms.join(dots, ["row", "unit"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("cosine") >= rules.cosine)
    best = scored.groupBy("row", "unit", "n_unit").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "name")).alias("b"))
    own = best.groupBy("row").agg(F.min("b").alias("b"), F.sum("n_unit").alias("n_match"))

    named = F.coalesce(F.regexp_extract("path", "([^/]*)$", 1).rlike(rules.file_names), F.lit(False))
    files = (rows.join(own, "row", "left").select(
        "doc_id", "path", "dir", F.col("b.name").alias("own_license"), (-F.col("b.c")).alias("own_cosine"),
        (F.col("b").isNotNull() & (named | (100 * F.col("n_match") >= rules.share_percent * F.col("n_words")))).alias("is_license_file")))
    files = stored(spark, files, "licence-own")

    speaks = (files.filter("is_license_file and dir is not null").groupBy(F.col("dir").alias("ancestor"))
              .agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), F.col("own_license").alias("name"), "path")).alias("s")))
    dirs = files.select("dir").filter("dir is not null").distinct()
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = dirs.withColumn("parts", parts).withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("parts"))))
    above = above.select("dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("ancestor"))
    nearest = above.join(speaks, "ancestor").groupBy("dir").agg(F.max(F.struct("depth", F.col("s.name").alias("name"), "ancestor")).alias("n"))
    out = files.join(nearest, "dir", "left")
    return out.select("doc_id", "path", "own_license", "own_cosine", "is_license_file", F.coalesce("own_license", "n.name").alias("license"),
                      F.when(F.col("is_license_file"), "licence_file").when(F.col("own_license").isNotNull(), "header")
                      .when(F.col("n").isNotNull(), "inherited").otherwise("none").alias("origin"),
                      F.when(F.col("own_license").isNull(), F.col("n.ancestor")).alias("from_directory"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")
