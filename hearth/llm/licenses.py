"""Scan of texts for license templates, built from Spark functions only.

Words are runs of letters and digits, in lower case. A template of n shingles belongs to a
size class; a text is cut into overlapping windows of that class, long enough that any
place of the template lies in one of them whole. Each window and each template has one
MinHash value for each band (one row a band), and a window that agrees with a template
in any band retrieves it. The share of common shingles is at least 0.8 * n over the size of
the union, 0.38 or more in every class, so ``BANDS`` bands retrieve a match of containment 0.8
with a chance above 0.999, and a whole copy with one above 0.9999. A retrieved template
matches if at least ``MIN_CONTAINMENT`` of its shingles, compared as words, are in the window.

A text without any shingle of any template cannot match, so windows are made only of texts
that have one; this loses nothing. Templates with fewer words than a shingle are one
shingle of their own length and are scanned for with shingles of that length.

The templates are a short list, a parameter; they are held as literals and as a small table.
Texts are scanned row by row; what is shuffled are windows that retrieved a template, hashed
by all their columns, so no text or source is hot. Texts are read once for all templates of a whole
shingle or more, and once for each length below it.

Null and empty texts have no words and no matches, nor have rows of an empty table. Repeated rows and ids
are one document with its best match of each template; ties go to the first window. Very long texts are
cut into windows whole. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import text_or_empty

SHINGLE = 5
BANDS = 24
MIN_CONTAINMENT = 0.8

# Notices and the core paragraphs of public licenses, in their published wording.
TEMPLATES: dict[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met:"
    ),
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at"
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "no-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def _shingled(w: str, k: int) -> Column:
    """Hash of every k-word shingle of the array column ``w``."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(k)]))
    return F.when(F.size(w) >= k, hashes).otherwise(F.array().cast("array<bigint>"))


def _strings(w: Column, k: int) -> Column:
    """The k-word shingles of a short array of words, as strings."""
    made = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))
    return F.when(F.size(w) >= k, made).otherwise(F.array().cast("array<string>"))


def size_class(n: int) -> tuple[int, int]:
    """(window, stride) in shingles for a template of n: the window holds any place of the class's longest template."""
    longest = 1
    while longest < n:
        longest = max(longest + 1, longest * 3 // 2)
    stride = max(1, longest // 4)
    return longest + stride - 1, stride


def _minhashes(shingles: Column) -> list[Column]:
    return [F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(band)))) for band in range(BANDS)]  # noqa: B023


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
) -> DataFrame:
    """(id, license, word, containment): the best match of each template in each document, and its window's first word (from 0)."""
    spark = docs.sparkSession
    named = spark.createDataFrame(list(templates.items()), "license string, text string").withColumn("w", words(F.col("text")))
    sized = named.withColumn("k", F.least(F.lit(shingle), F.size("w"))).where("k > 0")
    by_size: dict[int, list] = {}
    for r in sized.select("license", "w", "k").collect():  # the list given as a parameter
        by_size.setdefault(r["k"], []).append((r["license"], list(dict.fromkeys(" ".join(r["w"][i : i + r["k"]]) for i in range(len(r["w"]) - r["k"] + 1))), r["w"]))
    found = [_scan(docs, k, rows, id_col, text_col) for k, rows in sorted(by_size.items())]
    if not found:
        return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.lit("").alias("license"), F.lit(0).cast("bigint").alias("word"), F.lit(0.0).alias("containment")).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    best = F.max(F.struct("containment", (-F.col("word")).alias("back"))).alias("best")
    return out.groupBy("id", "license").agg(best).select("id", "license", (-F.col("best.back")).alias("word"), "best.containment")


def _scan(docs: DataFrame, k: int, templates: list, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    table = spark.createDataFrame([(n, w, s, *size_class(len(s))) for n, s, w in templates], "license string, w array<string>, shingles array<string>, width int, stride int")
    table = table.withColumn("h", F.array_distinct(_shingled("w", k)))
    rows = table.select("license", "shingles", "width", "stride", "h", F.array(*_minhashes(F.col("h"))).alias("bands")).collect()
    banded = spark.createDataFrame(
        [(r["width"], band, value, r["license"], r["shingles"]) for r in rows for band, value in enumerate(r["bands"])],
        "width int, band int, value bigint, license string, shingles array<string>",
    )
    known = F.array(*[F.lit(h) for h in sorted({h for r in rows for h in r["h"]})])
    if all(len(s) == 1 for _, s, _ in templates):  # such a template matches only whole, so its longest word must be in the text
        low = F.lower(text_or_empty(F.col(f"`{text_col}`")))
        docs = docs.where(F.greatest(*[F.contains(low, F.lit(max(w, key=len))) for _, _, w in templates], F.lit(False)))
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), words(text_or_empty(F.col(f"`{text_col}`"))).alias("w"))
    d = d.select("id", "w", _shingled("w", k).alias("h"))
    # the partition number keeps the filter above the shingles, whose expressions it would repeat if it were pushed below
    d = d.select("id", "w", F.when(F.arrays_overlap("h", known) & (F.spark_partition_id() >= 0), F.col("h")).alias("h")).where("h is not null")
    cuts = []
    for width, stride in sorted({(r["width"], r["stride"]) for r in rows}):
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("h") - width + stride), F.lit(stride))
        cut = F.transform(starts, lambda p: F.struct(F.lit(width).alias("width"), (p - 1).cast("bigint").alias("word"), F.slice("w", p, width + k - 1).alias("part"), F.slice("h", p, width).alias("hs")))  # noqa: B023
        cuts.append(F.filter(cut, lambda x: F.arrays_overlap(x["hs"], known)))  # a window without a shingle of any template matches none
    windows = d.select("id", F.inline(F.concat(*cuts)))  # all widths from one pass over the text
    keyed = windows.select("id", "width", "word", "part", F.posexplode(F.array(*_minhashes(F.col("hs")))).alias("band", "value"))
    got = keyed.join(F.broadcast(banded), ["width", "band", "value"]).dropDuplicates(["id", "width", "word", "part", "license"])
    common = F.size(F.array_intersect(_strings(F.col("part"), k), F.col("shingles")))
    return got.select("id", "license", "word", (common / F.size("shingles")).alias("containment")).where(F.col("containment") >= MIN_CONTAINMENT)
