"""License notices in texts by MinHash bands over overlapping windows, with SQL functions only.

Notices of similar length share a window size and a stride chosen so that a notice always
lies whole in a window that is little longer than it. A window's MinHash signature is cut into
bands of one value each; notices that agree in a band are candidates, and containment of the
notice's five-word shingles in the window decides. The number of bands follows from the least
similarity that a notice at the least containment has with the longest window of its class, so
that such a notice is missed with a chance of at most MISS; whole notices far more rarely.

The bands retrieve: a window can agree with a notice in a band only if it holds the shingle
whose hash is the notice's minimum there. So texts are looked up by the band values of the
notices, and the windows around what is found are hashed for all bands and joined by them.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS, MIN_CONTAINMENT = 5, 0.8
#: Chance to miss a notice of the least containment in a window.
MISS = 1e-6
#: Lengths in words at which a class of notices begins.
CLASS_STARTS = (5, 6, 7, 8, 10, 12, 15, 18, 22, 27, 33, 40, 50, 64)
#: License notices as their licenses word them.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
}


def notice_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def classes(notices: dict[str, tuple[str, ...]] = NOTICES) -> list[tuple[int, int, list[tuple[str, list[str]]]]]:
    """Window size, stride and notices (license, words) of each class of notice lengths."""
    by: dict[int, list[tuple[str, list[str]]]] = {}
    for license_, texts in sorted(notices.items()):
        for text in texts:
            words = notice_words(text)
            if len(words) < SHINGLE_WORDS:
                raise ValueError(f"a notice needs {SHINGLE_WORDS} words: {text}")
            by.setdefault(max(x for x in CLASS_STARTS if x <= len(words)), []).append((license_, words))
    out = []
    for least, group in sorted(by.items()):
        stride = max(1, least // 8)
        out.append((max(len(w) for _, w in group) + stride - 1, stride, group))
    return out


def shingles(words: Column) -> Column:
    """Distinct shingles of an array of words, as strings."""
    starts = F.sequence(F.lit(1), F.size(words) - (SHINGLE_WORDS - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE_WORDS)), " "))
    return F.array_distinct(F.when(F.size(words) >= SHINGLE_WORDS, joined).otherwise(F.array().cast("array<string>")))


def band_count(groups: list[tuple[int, int, list[tuple[str, list[str]]]]]) -> int:
    """Bands of one value that miss no notice with a chance over MISS: (1 - least similarity) ** bands <= MISS."""
    least = 1.0
    for size, _, group in groups:
        for _, words in group:
            grams = len({tuple(words[i : i + SHINGLE_WORDS]) for i in range(len(words) - SHINGLE_WORDS + 1)})
            shared = math.ceil(MIN_CONTAINMENT * grams)
            least = min(least, shared / (size - SHINGLE_WORDS + 1 + grams - shared))
    return math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1


def hashed(words: Column) -> Column:
    """Hashes of the shingles of an array of words, by place; null for fewer words."""
    gram = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE_WORDS)])
    return F.when(F.size(words) >= SHINGLE_WORDS, F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE_WORDS), gram))


def bound(value: Column, use) -> Column:
    """use(value) with the value made once, as a lambda's variable: a plain column would be made again at each use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bands(words: Column, n: int) -> Column:
    """For each band, the shingle hash of the words that is least in the band's order."""
    least = lambda hashes, b: F.array_min(F.transform(hashes, lambda h: F.struct(F.xxhash64(h, b).alias("order"), h.alias("hash"))))["hash"]
    return bound(hashed(words), lambda hashes: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.struct(b.alias("number"), least(hashes, b).alias("hash"))))


def looked_up(words: Column, values: Column) -> Column:
    """Places of an array of words, with their hashes, whose shingle hash is one of the values."""
    places = lambda hashes, own: F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(own, F.get(hashes, i)))
    some = lambda hashes, own: F.when(F.size(own) > 0, F.transform(places(hashes, own), lambda i: F.struct(i.alias("place"), F.get(hashes, i).alias("hash"))))
    return bound(hashed(words), lambda hashes: bound(F.array_intersect(hashes, values), lambda own: some(hashes, own)))


def _notice_table(spark: SparkSession, groups: list) -> DataFrame:
    rows = [(i, size, stride, f"{license_}/{k}", license_, words) for i, (size, stride, group) in enumerate(groups) for k, (license_, words) in enumerate(group)]
    table = spark.range(len(rows)).select(F.element_at(F.array(*[F.struct(*[F.lit(x) for x in r[:5]], F.split(F.lit(" ".join(r[5])), " ")) for r in rows]), F.col("id").cast("int") + 1).alias("x"))
    named = table.select(*[F.col(f"x.col{j + 1}").alias(n) for j, n in enumerate(("class", "size", "stride", "notice", "license", "words"))])
    return named.select("class", "size", "stride", "notice", "license", shingles(F.col("words")).alias("notice_grams"), F.explode(bands(F.col("words"), band_count(groups))).alias("band"))


def scan_licenses(docs: DataFrame, notices: dict[str, tuple[str, ...]] = NOTICES) -> DataFrame:
    """License notices that documents hold.

    Output, a row for each doc_id and license found: doc_id, license, n_places (distinct first
    words of matching windows, over notices), containment (the best). Words are runs of a-z and
    0-9 in lower case. Null and empty texts and texts of fewer than five words hold nothing, nor
    do rows with a null doc_id. Repeated rows count once; of rows with one doc_id and unlike texts
    each is scanned by itself, and their places count together. Other columns are ignored; an
    empty table gives an empty result. Whole texts are scanned.
    """
    groups = classes(notices)
    reach = max(size for size, _, _ in groups)
    # The table of notices and their bands: as many rows as notices times bands.
    keys = _notice_table(docs.sparkSession, groups)
    values = keys.agg(F.collect_set("band.hash")).scalar()
    # An empty first or last word stays: it only moves positions.
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("version"), F.split(F.lower("text"), "[^a-z0-9]+").alias("words"), values.alias("values"))
    begin = F.greatest(F.lit(0), F.col("place") - reach)
    # The context holds the words within ``reach`` on both sides, so the text isn't needed again.
    hits = texts.select("doc_id", "version", "words", F.explode(looked_up(F.col("words"), F.col("values"))).alias("hit")).select("doc_id", "version", "words", "hit.*").select("doc_id", "version", "place", "hash", begin.alias("begin"), F.slice("words", begin + 1, F.lit(2 * reach)).alias("context"))
    # Windows begin at multiples of the stride; those that hold the shingle at h begin from h + 5 - size to h.
    ruled = hits.join(F.broadcast(keys.select("class", "size", "stride", F.col("band.hash").alias("hash")).distinct()), "hash")
    first = F.greatest(F.lit(0), F.ceil((F.col("place") + SHINGLE_WORDS - F.col("size")) / F.col("stride"))).cast("int")
    last = F.floor(F.col("place") / F.col("stride")).cast("int")
    placed = ruled.where(first <= last).select("doc_id", "version", "class", "size", "stride", "begin", "context", F.explode(F.sequence(first, last)).alias("w"))
    window = F.slice("context", F.col("w") * F.col("stride") - F.col("begin") + 1, F.col("size"))
    windows = placed.select("doc_id", "version", "class", (F.col("w") * F.col("stride")).alias("place"), window.alias("window")).groupBy("doc_id", "version", "class", "place").agg(F.first("window").alias("window"))
    near = windows.select("*", F.explode(bands(F.col("window"), band_count(groups))).alias("band")).join(F.broadcast(keys.select("class", "license", "notice", "notice_grams", "band")), ["class", "band"])
    candidates = near.groupBy("doc_id", "version", "class", "place", "license", "notice").agg(F.first("window").alias("window"), F.first("notice_grams").alias("notice_grams"))
    share = F.size(F.array_intersect(shingles(F.col("window")), "notice_grams")) / F.size("notice_grams")
    matched = candidates.select("doc_id", "license", "place", share.alias("containment")).where(F.col("containment") >= MIN_CONTAINMENT)
    return matched.groupBy("doc_id", "license").agg(F.count_distinct("place").alias("n_places"), F.max("containment").alias("containment"))


def oracle(notices: dict[str, tuple[str, ...]] = NOTICES) -> str:
    """DuckDB SQL that tries all windows with a shingle of a notice, without bands."""
    rows, n = [], 0
    for i, (size, stride, group) in enumerate(classes(notices)):
        for license_, words in group:
            rows += [f"({n}, {i}, {size}, {stride}, '{license_}', '{g}')" for g in sorted({' '.join(words[k : k + SHINGLE_WORDS]) for k in range(len(words) - SHINGLE_WORDS + 1)})]
            n += 1
    return f"""
WITH notice(notice, class, size, stride, license, gram) AS (VALUES {', '.join(rows)}),
total AS (SELECT notice, count(*) AS n FROM notice GROUP BY notice),
word AS (SELECT doc_id, string_split_regex(lower(text), '[^a-z0-9]+') AS words FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
gram AS (
  SELECT doc_id, h, words[h + 1] || ' ' || words[h + 2] || ' ' || words[h + 3] || ' ' || words[h + 4] || ' ' || words[h + 5] AS gram
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 4)) AS h FROM word)
), hit AS (
  SELECT doc_id, h, notice, size, stride, license, gram FROM gram JOIN notice USING (gram)
), place AS (
  SELECT *, unnest(range(greatest(0, CAST(ceil((h + 5 - size) / stride) AS BIGINT)), h // stride + 1)) * stride AS place FROM hit
), held AS (
  SELECT doc_id, license, notice, place, count(DISTINCT gram) AS n FROM place GROUP BY ALL
), matched AS (
  SELECT doc_id, license, place, held.n / total.n AS containment FROM held JOIN total USING (notice) WHERE held.n / total.n >= {MIN_CONTAINMENT}
)
SELECT doc_id, license, count(DISTINCT place) AS n_places, max(containment) AS containment FROM matched GROUP BY doc_id, license
"""
