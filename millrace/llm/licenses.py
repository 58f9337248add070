"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Everything is DataFrame operations; there is no Python on the executors.

Words are runs of letters and digits (and of all characters beyond ASCII), with A-Z lower-cased; shingles are five words.
A template with S shingles belongs to the class of windows whose reach is the least power of two not below S: windows
begin at every multiple of the reach and are twice as long, so that every stretch as long as the template lies whole
in one of them. Only shingles that some template has are kept of a window: others can be in no match. The least value
of each of `bands` hash functions (times `rows`) makes the bands of a window; a template that shares a band is a
candidate. With J the overlap of a window's kept shingles and a template, it is missed with a chance of
(1 - J^rows)^bands, by default less than 1e-8 at J = 0.4. A candidate counts as found if the window holds at least
`threshold` of the template's distinct shingles.

Equal texts are looked at once each, by 96 bits that stand for a text. No list is longer than a window. The shingles
of the templates are counted; up to `SENT` they are broadcast to those of the texts, beyond that both are shuffled.

Defined results: null and empty texts have no words and no matches; a template of fewer than five words has no
shingle and is never found, unless `short` makes its words one shingle of their own length. Every row keeps its row, repeated ones too. Templates with one id are told apart by text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import content_key, prepare

SIZE, BANDS, ROWS, LEAST_REACH = 5, 40, 1, 4
SENT = 50_000  # template shingles up to which they are broadcast
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Notices to look for (fixed values, the public wording of each license).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "Apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
]


def shingle_hashes(text: Column, size: int = SIZE) -> Column:
    """Hashes of the word shingles of a text, in order."""
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), APART), lambda w: w != "")
    # The one-element array binds the list of word hashes, so that it is computed once.
    held = F.array(F.transform(words, lambda w: F.xxhash64(w)))

    def cut(a: Column) -> Column:
        places = F.when(F.size(a) >= size, F.sequence(F.lit(0), F.size(a) - size))
        return F.transform(places, lambda i: F.xxhash64(*(F.get(a, i + k) for k in range(size))))

    return F.get(F.transform(held, cut), F.lit(0))


def _least(shingles: str, order: int) -> Column:
    """MinHash value of a set of shingles under one hash function."""
    return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(order))))


def _bands(shingles: str, bands: int, rows: int) -> Column:
    """One hash for each band of a set of shingles."""
    return F.array(
        *(F.xxhash64(F.lit(b), *(_least(shingles, k) for k in range(b * rows, (b + 1) * rows))) for b in range(bands))
    )


def scan(
    docs: DataFrame,
    templates: DataFrame,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    template_id_col: str = "template_id",
    template_text_col: str = "text",
    size: int = SIZE,
    bands: int = BANDS,
    rows: int = ROWS,
    short: bool = False,
) -> DataFrame:
    """One row per document: id and `matches`, sorted: array<struct<template, containment, begin, end>>.

    `begin` and `end` are the word places that the template's shingles take up in the window that holds most of them
    (the first of such).
    """
    prepare(docs.sparkSession)
    body = F.col(template_text_col).cast("string")

    def cut(length: int) -> DataFrame:
        parts = F.array_distinct(shingle_hashes(body, length)).alias("parts")
        return templates.select(
            F.col(template_id_col).cast("string").alias("template"), parts, F.lit(length).alias("length"),
            F.size(shingle_hashes(body, 1)).alias("words"),
        ).where(F.size("parts") > 0)

    wanted, lengths = cut(size), [size]
    if short:
        # Templates with too few words for a shingle: as one shingle each, looked for by its length.
        for length in range(1, size):
            less = cut(length).where(F.col("words") == length)
            if not less.isEmpty():
                wanted, lengths = wanted.union(less), [*lengths, length]
    reach = F.greatest(F.lit(LEAST_REACH), F.pow(2, F.ceil(F.log2(F.size("parts")) - 1e-9)).cast("int"))
    wanted = wanted.distinct().select("template", "parts", "length", reach.alias("reach"))
    # Sent to the executors while it is small, which is counted first; joined by a shuffle beyond that.
    total = wanted.agg(F.sum(F.size("parts")).alias("n")).first().n or 0
    near = F.broadcast if total <= SENT else lambda table: table
    known = wanted.select(F.explode("parts").alias("shingle"), "reach").groupBy("shingle")
    known = known.agg(F.collect_set("reach").alias("reaches"))

    text = F.col(text_col).cast("string")

    def met(length: int) -> DataFrame:
        texts = docs.select(*content_key(text), shingle_hashes(text, length).alias("all"))
        hits = texts.select("key_a", "key_b", F.posexplode("all").alias("place", "shingle")).join(near(known), "shingle")
        return hits.dropDuplicates(["key_a", "key_b", "place"])

    hits = reduce(DataFrame.union, map(met, lengths))

    # The window that begins at the reach's multiple before a shingle, and the one before that.
    inside = hits.select("key_a", "key_b", "place", "shingle", F.explode("reaches").alias("reach"))
    at = F.floor(F.col("place") / F.col("reach"))
    inside = inside.withColumn("window", F.explode(F.array(at - 1, at))).where("window >= 0")
    windows = inside.groupBy("key_a", "key_b", "reach", "window").agg(
        F.collect_set("shingle").alias("kept"), F.collect_list(F.struct("place", "shingle")).alias("placed")
    )
    ours = windows.withColumn("band", F.explode(_bands("kept", bands, rows)))
    theirs = wanted.withColumn("band", F.explode(_bands("parts", bands, rows)))
    pairs = ours.join(near(theirs), ["reach", "band"])
    common = F.size(F.array_intersect("kept", "parts"))
    pairs = pairs.where(common >= F.lit(threshold - 1e-9) * F.size("parts"))
    places = F.transform(
        F.filter("placed", lambda p: F.array_contains("parts", p["shingle"])), lambda p: p["place"]
    )
    found = pairs.select(
        "key_a",
        "key_b",
        "template",
        "window",
        (common / F.size("parts")).alias("containment"),
        F.array_min(places).alias("begin"),
        (F.array_max(places) + F.col("length")).alias("end"),
    ).distinct()
    best = found.groupBy("key_a", "key_b", "template").agg(
        F.max("containment").alias("containment"),
        F.max_by(F.struct("begin", "end"), F.struct(F.col("containment"), -F.col("window"))).alias("where"),
    )
    match = F.struct("template", "containment", F.col("where.begin").alias("begin"), F.col("where.end").alias("end"))
    best = best.groupBy("key_a", "key_b").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    ids = docs.select(F.col(id_col).alias("id"), *content_key(text)).join(best, ["key_a", "key_b"], "left")
    none = F.array().cast("array<struct<template:string,containment:double,begin:int,end:int>>")
    return ids.select(F.col("id").alias(id_col), F.coalesce("matches", none).alias("matches"))


def notices(spark) -> DataFrame:
    """The built-in templates as a table."""
    return spark.createDataFrame(TEMPLATES, "template_id string, text string")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The same matches without bands: every template against every window of its class.
SQL = rf"""
WITH templates(template, body) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in TEMPLATES)}),
cut AS (
    SELECT template, regexp_extract_all(translate(body, '{UPPER}', '{LOWER}'), '{WORD}') AS w
    FROM templates
), parts AS (
    SELECT DISTINCT template, array_to_string(w[i : i + {SIZE - 1}], ' ') AS shingle
    FROM (SELECT template, w, unnest(range(1, len(w) - {SIZE - 2})) AS i FROM cut)
), sized AS (
    SELECT template, count(*) AS n, greatest({LEAST_REACH}, CAST(pow(2, ceil(log2(count(*)) - 1e-9)) AS INT)) AS reach
    FROM parts GROUP BY template
), words AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
    FROM documents
), places AS (
    SELECT r, i - 1 AS place, array_to_string(w[i : i + {SIZE - 1}], ' ') AS shingle
    FROM (SELECT r, w, unnest(range(1, len(w) - {SIZE - 2})) AS i FROM words)
), hits AS (
    SELECT r, template, n, place, shingle, unnest([place // reach - 1, place // reach]) AS win
    FROM places JOIN parts USING (shingle) JOIN sized USING (template)
), held AS (
    SELECT r, template, win, count(DISTINCT shingle) / n AS share
    FROM hits WHERE win >= 0 GROUP BY r, template, win, n
), found AS (
    SELECT r, template, max(share) AS share FROM held WHERE share >= 0.8 - 1e-9 GROUP BY r, template
)
SELECT doc_id, CAST(count(template) AS BIGINT) AS n_matches,
    coalesce(string_agg(template, ',' ORDER BY template), '') AS licenses,
    coalesce(round(max(share), 6), 0) AS best_containment
FROM words LEFT JOIN found USING (r) GROUP BY r, doc_id
"""
