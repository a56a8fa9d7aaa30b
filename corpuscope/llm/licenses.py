"""License scans with MinHash bands over overlapping text windows, verified by exact containment.

Words are runs of ASCII letters and digits, in lower case; shingles are five words. A text's shingle hashes are cut into
blocks of ``BLOCK`` = 4, and two neighbouring blocks are a window. ``BANDS`` = 12 MinHash values are kept for a window, each a
band of its own; templates are cut into segments of up to five shingles, which some window always holds whole.

A text holds a template if at least ``CONTAINED`` = 0.8 of the template's shingles occur in it. Then at least four of
the five shingles of some segment do, so a window's similarity to that segment is at least 4/9, and the chance that no band
collides is at most (5/9)^12 < 0.001. A template of three shingles or fewer must occur whole: its shingles are looked up as
they are, and never missed. What is retrieved is then verified exactly, on the shingles' words.

All of it is native expressions over one row: no shuffle, no join, no Python.

Defined cases: a NULL or empty text, or one of fewer than five words, holds no license. Repeated rows each give their
matches. A template of fewer than five words raises ValueError.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The wording of common license notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0-text": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under "
        "the License."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
}

SHINGLE = 5
BLOCK = 4
SEGMENT = BLOCK + 1
BANDS = 12
CONTAINED = 0.8
SMALL = 3  # templates of so many shingles or fewer must occur whole: two of three are below CONTAINED

_random = random.Random(5)
MASKS = [_random.getrandbits(64) - (1 << 63) for _ in range(BANDS)]


def words_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0)), F.lower)


def _places(words: Column) -> Column:
    """0-based starts of the shingles."""
    n = F.size(words) - SHINGLE
    return F.when(n >= 0, F.sequence(F.lit(0), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column) -> Column:
    return F.transform(_places(words), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def shingles(words: Column) -> Column:
    return F.transform(_places(words), lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))


def min_hashes(hashes: Column) -> Column:
    """MinHash values of a set, one for each mask: the order of h XOR mask is a random order of the hashes."""
    def ordered_by(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask))))

    return F.array(*[ordered_by(mask) for mask in MASKS])


def block_hashes(hashes: Column) -> Column:
    """MinHash values of each block."""
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(hashes) - 1) / BLOCK).cast("int"), F.lit(0)))
    return F.transform(blocks, lambda b: min_hashes(F.slice(hashes, b * BLOCK + 1, BLOCK)))


def window_hashes(blocks: Column) -> Column:
    """All bands of all windows. A window is a block and the next; a text of one block has one window."""
    def window(block, i):
        after = F.coalesce(F.get(blocks, i + 1), block)
        return F.transform(block, lambda low, k: F.least(low, F.get(after, k)))

    return F.flatten(F.transform(blocks, window))


def templates(spark: SparkSession, notices: dict[str, str] = NOTICES) -> list[tuple[str, list[str], list[int], list[int]]]:
    """Of each notice: its name, distinct shingles, and what retrieves it: bands of segments, or (if small) shingle hashes."""
    table = spark.createDataFrame(list(notices.items()), "name string, text string")
    table = table.select("name", words_of(F.col("text")).alias("words"))
    table = table.select("name", F.array_distinct(shingles(F.col("words"))).alias("shingles"), shingle_hashes(F.col("words")).alias("hashes"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("hashes") - SEGMENT, F.lit(0)))
    bands = F.flatten(F.transform(starts, lambda s: min_hashes(F.slice("hashes", s + 1, SEGMENT))))
    small = F.size("shingles") <= SMALL
    none = F.array().cast("array<bigint>")
    rows = table.select(
        "name", "shingles", F.when(small, none).otherwise(F.array_distinct(bands)).alias("bands"),
        F.when(small, F.col("hashes")).otherwise(none).alias("whole"),
    ).collect()
    if any(not r.shingles for r in rows):
        raise ValueError(f"a template needs {SHINGLE} words at least")
    return [(r.name, r.shingles, r.bands, r.whole) for r in rows]


def scan(documents: DataFrame, *, text: str = "text", notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per document row and license held: ``row`` (the whole row), ``license``, ``matched`` (distinct template shingles
    found), ``containment`` and ``first_word`` (0-based place of the first of them).

    Each level of the expressions is a projection of its own, so none is computed twice, and rows without a candidate end at
    the generator, not at a filter that would be pushed below them.
    """
    known = templates(documents.sparkSession, notices)
    longs = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<bigint>")
    all_bands = longs(sorted({b for _, _, bands, _ in known for b in bands}))
    all_whole = longs(sorted({h for _, _, _, whole in known for h in whole}))
    table = F.array(*[
        F.struct(
            F.lit(name).alias("license"), F.array(*[F.lit(s) for s in own]).alias("shingles"), longs(bands + whole).alias("keys")
        ) for name, own, bands, whole in known
    ])
    rows = documents.select(F.struct("*").alias("row"), words_of(F.col(text)).alias("words"))
    rows = rows.select("row", "words", shingle_hashes(F.col("words")).alias("hashes"))
    rows = rows.select("row", "words", "hashes", block_hashes(F.col("hashes")).alias("blocks"))
    rows = rows.select("row", "words", F.concat(
        F.array_intersect(window_hashes(F.col("blocks")), all_bands), F.array_intersect(F.col("hashes"), all_whole)
    ).alias("keys"))
    found = F.when(F.size("keys") > 0, F.filter(table, lambda t: F.arrays_overlap(t.keys, F.col("keys"))))
    rows = rows.select("row", "words", F.explode_outer(found).alias("t")).filter("t is not null")
    rows = rows.select("row", F.col("t.license").alias("license"), F.col("t.shingles").alias("wanted"), shingles(F.col("words")).alias("shingles"))
    matched = F.size(F.array_intersect("wanted", "shingles"))
    held = F.exists(F.col("shingles"), lambda s: F.array_contains("wanted", s))
    first = F.array_position(F.transform("shingles", lambda s: F.array_contains("wanted", s)), True) - 1
    return rows.select(
        "row", "license", matched.cast("long").alias("matched"), F.round(matched / F.size("wanted"), 4).alias("containment"),
        F.when(held, first).alias("first_word"), (matched >= F.size("wanted") * CONTAINED).alias("holds"),
    ).filter("holds").drop("holds")
