"""Licence scan: lines, whole texts and windows against licence templates by Dice over word bigrams.

A unit (a line, a whole text, or a window of words) and a template are sets of word bigrams a and b; they match when
2 * |a & b| / (|a| + |b|) reaches the threshold. Then |a| lies within fixed bounds of |b|, so units of
other sizes are dropped before their bigrams are made, and a template is no candidate for a
unit outside its own bounds. The templates are a fixed, small table and are broadcast.

Notices that are wrapped over lines or stand inside a line, and full licence bodies, are found by
windows as long as the template, laid where one of its anchors puts it. Anchors are so many of a
template's bigrams that no matching window is without one.
"""

from __future__ import annotations

import pkgutil
import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence names and the notices by which works are put under them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("proprietary", "All rights reserved."),
]
_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission. "
)
# Full licences, searched for by windows only.
BODIES = [
    (
        "MIT",
        TEMPLATES[4][1] + " The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _WARRANTY),
    *(
        (name, pkgutil.get_data("wattlake.llm", f"licence_texts/{name}.txt").decode())
        for name in ("Apache-2.0", "GPL-3.0", "MPL-2.0")
    ),
]
THRESHOLD_PERCENT = 80
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Normalised words: A-Z in lower case, parted by ASCII other than letters and digits."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, _GAPS), "")


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.size(w)
    pairs = F.zip_with(
        F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.when(n > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _once(value: Column) -> Column:
    """A value that later filters and columns do not compute again: a generator of one row."""
    return F.explode(F.array(value))


def templates(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """template, licence, bigrams, n for each template of two words or more."""
    numbered = [(i, licence, text) for i, (licence, text) in enumerate(rows)]
    table = spark.createDataFrame(numbered, "template int, licence string, text string")
    return (
        table.select("template", "licence", bigrams(words(F.col("text"))).alias("bigrams"))
        .withColumn("n", F.size("bigrams"))
        .where("n > 0")
    )


def anchors(text: str, percent: int) -> dict[str, list[int]]:
    """Bigrams of a template with their places in it, one more than a matching window can lack.

    Those of long words come first, since they are rare.
    """
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    places: dict[str, list[int]] = {}
    for i, pair in enumerate(zip(w, w[1:])):
        places.setdefault(" ".join(pair), []).append(i)
    # A window shares n * t / (2 - t) of n bigrams at least.
    lacking = len(places) + (-len(places) * percent // (200 - percent))
    rare = sorted(places, key=lambda b: (-min(map(len, b.split(" "))), -len(b), b))
    return {b: places[b] for b in rare[: lacking + 1]}


def _windows(spark: SparkSession, own: DataFrame, rows: list[tuple[str, str]], percent: int) -> DataFrame:
    """doc_id, key, template, licence, m, n, both of matching windows; own has doc_id, key, text."""
    places: dict[str, list[tuple[int, int]]] = {}
    for i, (_, text) in enumerate(rows):
        for bigram, at in anchors(text, percent).items():
            places.setdefault(bigram, []).extend((i, k) for k in at)
    firsts = sorted({b.split(" ")[0] for b in places})
    lookup = spark.createDataFrame(
        [(places,)], "places map<string, array<struct<template: int, at: int>>>"
    )
    numbered = [(i, licence, text) for i, (licence, text) in enumerate(rows)]
    table = (
        spark.createDataFrame(numbered, "template int, licence string, text string")
        .withColumn("w", words(F.col("text")))
        .select("template", "licence", F.size("w").alias("length"), bigrams(F.col("w")).alias("bigrams"))
        .withColumn("n", F.size("bigrams"))
        .where("n > 0")
    )
    pair = lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1))
    anchored = (
        own.select("doc_id", "key", _once(words(F.col("text"))).alias("w"))
        .where(F.size("w") > 1)
        .select(
            "doc_id",
            "key",
            "w",
            _once(
                F.filter(
                    F.sequence(F.lit(0), F.size("w") - 2),
                    lambda i: F.get("w", i).isin(firsts) & pair(i).isin(sorted(places)),
                )
            ).alias("at"),
        )
        .where(F.size("at") > 0)
    )
    # A window's place counts once, however many anchors put it there.
    begins = F.flatten(
        F.transform(
            "at",
            lambda i: F.transform(
                F.col("places")[pair(i)],
                lambda a: F.struct(a["template"].alias("template"), (i - a["at"]).alias("begin")),
            ),
        )
    )
    cut = F.slice("w", F.greatest("begin", F.lit(0)) + 1, F.col("length") + F.least("begin", F.lit(0)))
    return (
        anchored.crossJoin(F.broadcast(lookup))
        .select("doc_id", "key", "w", F.explode(F.array_distinct(begins)).alias("b"))
        .select("doc_id", "key", "w", "b.template", "b.begin")
        .join(F.broadcast(table), "template")
        .select("doc_id", "key", "template", "licence", "n", "bigrams", _once(bigrams(cut)).alias("own"))
        .select(
            "doc_id",
            "key",
            "template",
            "licence",
            F.size("own").alias("m"),
            "n",
            _once(F.size(F.array_intersect("own", "bigrams"))).alias("both"),
        )
        .where(2 * 100 * F.col("both") >= percent * (F.col("m") + F.col("n")))
    )


def scan(
    spark: SparkSession,
    docs: DataFrame,
    rows: list[tuple[str, str]] | None = None,
    percent: int = THRESHOLD_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_units, licences (sorted), best_dice (0 without a match) for each document.

    n_units counts matching lines, the whole text where it matches, and each template that only
    windows match. Windows are also compared with BODIES where rows are not given.

    A null or empty text matches nothing. Rows that repeat both id and text are one document. Equal
    units of a document count once; of several templates all that reach the threshold count. An
    empty table gives no rows; other columns are not read.
    """
    table = templates(spark, rows or TEMPLATES)
    # |a| >= t / (2 - t) * |b| and |a| <= (2 - t) / t * |b|, in hundredths.
    far = 200 - percent
    bounds = table.agg(F.min("n"), F.max("n")).first()
    least, most = (bounds[0] or 0) * percent // far, (bounds[1] or 0) * far // percent
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("key"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    lines = F.array_distinct(F.concat(F.split("text", "\n"), F.array("text")))
    units = own.select("doc_id", "key", F.explode(lines).alias("unit"))
    sized = (
        units.where(F.length("unit") > 0)
        .select("doc_id", "key", F.xxhash64("unit").alias("unit"), _once(words(F.col("unit"))).alias("w"))
        .where(F.size("w") > max(least, 1))
        .select("doc_id", "key", "unit", _once(bigrams(F.col("w"))).alias("own"))
        .where((F.size("own") >= least) & (F.size("own") <= most))
    )
    pieces = table.select("template", "licence", "n", F.explode("bigrams").alias("bigram"))
    found = (
        sized.select("doc_id", "key", "unit", F.size("own").alias("m"), F.explode("own").alias("bigram"))
        .join(F.broadcast(pieces), "bigram")
        .where((F.col("m") * far >= F.col("n") * percent) & (F.col("m") * percent <= F.col("n") * far))
        .groupBy("doc_id", "key", "unit", "template", "licence", "m", "n")
        .agg(F.count("*").alias("both"))
        .where(200 * F.col("both") >= percent * (F.col("m") + F.col("n")))
    )
    # Templates keep their number; those of BODIES follow.
    windows = _windows(spark, own, rows or [*TEMPLATES, *BODIES], percent)
    found = found.unionByName(windows, allowMissingColumns=True)
    of = lambda condition: F.collect_set(F.when(condition, F.col("template")))
    only_windows = F.array_except(of(F.col("unit").isNull()), of(F.col("unit").isNotNull()))
    best = found.groupBy("doc_id", "key").agg(
        (F.size(F.collect_set("unit")) + F.size(only_windows)).cast("long").alias("n_units"),
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
        F.max(2.0 * F.col("both") / (F.col("m") + F.col("n"))).alias("best_dice"),
    )
    keyed = own.select("doc_id", "key").distinct()
    same = (keyed["key"] == best["key"]) & keyed["doc_id"].eqNullSafe(best["doc_id"])
    return keyed.join(best, same, "left").select(
        keyed["doc_id"],
        F.coalesce("n_units", F.lit(0)).alias("n_units"),
        F.coalesce("licences", F.lit("")).alias("licences"),
        F.coalesce("best_dice", F.lit(0.0)).alias("best_dice"),
    )
