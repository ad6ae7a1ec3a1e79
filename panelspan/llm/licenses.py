"""License scans: MinHash bands over text windows retrieve templates, containment verifies.

Templates are grouped by size. For each group, documents are cut into overlapping windows
of three half group sizes, so that every place where a template may stand is whole inside
one of them. Only the shingles that some template of the group has are kept: others can
not add to containment, and without them the Jaccard similarity of a window with a
template that it holds stays high. Equal windows are looked up once, however many
documents share them.

A window of 1.5 c words with a template of over c / 2 words (8 at least for c) has a
similarity of at least 1/8 with it when it holds 0.8 of its shingles. With one hash to a
band, 128 bands miss that with a probability of (7/8) ** 128, or 4 in 10 ** 8.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import pick
from panelspan.llm.wording import grams, words
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

SHINGLE = 5
BANDS = 128
CONTAINMENT = 0.8
SMALLEST_GROUP = 8
#: Every task holds the shingles of all templates, which are parameters; more is an error.
MOST_SHINGLES = 200_000

# Notices of licenses, by their SPDX names.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 "
    "International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "ISC notice": "Permission to use, copy, modify, and/or distribute this software for any "
    "purpose with or without fee is hereby granted, provided that the above copyright notice "
    "and this permission notice appear in all copies.",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a "
    "copy of this software and associated documentation files, to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software.",
    "BSD notice": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.",
}


def find_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    text: str = "text",
    key: str = "doc_id",
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """One row per document and license found: ``key``, ``text_hash``, ``license``,
    ``containment`` (the best of its windows), ``windows`` (how many hold it) and ``word``
    (where the first of them begins).

    A window holds a license when it has at least ``containment`` of the template's
    distinct 5-word shingles. A null or empty text holds none; a null key is a key like
    others. Rows that repeat key and text count once, rows that repeat the key alone once
    for each text. A template of fewer than five words is an error.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame(
        list((TEMPLATES if templates is None else templates).items()),
        "license string, text string",
    )
    known = staged(_template_shingles(given))
    if known.filter("n_words < 5").count():
        raise ValueError("A template needs at least five words")
    shingles = known.select("c", F.explode("shingles").alias("shingle")).distinct()
    windows = staged(_windows(docs, shingles, text, key))
    sets = windows.groupBy("set_id", "c").agg(F.first("held").alias("held"))
    matches = staged(_matches(sets, known, containment, bands))
    found = lookup(
        windows.select("key", "text_hash", "begins", "set_id"),
        matches, "set_id", "inner", fits_broadcast(matches), spread_by=["key", "begins"],
    )
    return found.groupBy("key", "text_hash", "license").agg(
        F.max("containment").alias("containment"),
        F.count(F.lit(1)).alias("windows"),
        F.min("begins").alias("word"),
    )


def _template_shingles(templates: DataFrame) -> DataFrame:
    """``license``, ``n_words``, ``c`` (size group) and the distinct ``shingles``."""
    size = f"greatest({SMALLEST_GROUP}, n_words)"
    return (
        templates.select("license", words(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .withColumn("c", F.expr(f"CAST(pow(2, ceil(log2({size}))) AS INT)"))
        .withColumn(
            "shingles",
            F.expr(
                f"IF(n_words < {SHINGLE}, CAST(array() AS ARRAY<STRING>), array_distinct("
                f"transform(sequence(0, n_words - {SHINGLE}), i ->"
                f" array_join(slice(words, i + 1, {SHINGLE}), ' '))))"
            ),
        )
        .select("license", "n_words", "c", "shingles")
    )


def _universe(shingles: DataFrame) -> tuple[str, int]:
    """The hashes of the templates' shingles as JSON lists, by their last bits."""
    hashed = F.transform(F.split("shingle", " "), lambda w: F.xxhash64(w))
    items = [f"h[{i}]" for i in range(SHINGLE)]
    rows = (
        shingles.select(hashed.alias("h"))
        .select(F.expr(f"xxhash64({', '.join(items)})").alias("mark"))
        .distinct()
        .limit(MOST_SHINGLES + 1)
        .collect()
    )
    if len(rows) > MOST_SHINGLES:
        raise ValueError(f"The templates have more than {MOST_SHINGLES} shingles")
    size = 1 << max(8, math.ceil(math.log2(len(rows) + 1)) + 2)
    slots: list[list[int]] = [[] for _ in range(size)]
    for row in rows:
        slots[row["mark"] & (size - 1)].append(row["mark"])
    return json.dumps(slots, separators=(",", ":")), size


def _windows(docs: DataFrame, shingles: DataFrame, text: str, key: str) -> DataFrame:
    """The windows with a template's shingle: where each begins, and the set it holds."""
    slots, size = _universe(shingles)
    known = f"from_json('{slots}', 'array<array<bigint>>')"
    listed = (
        pick(docs, key=key, text=text)
        .select(
            "key",
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
            words(F.col("text")).alias("words"),
        )
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("grams", F.expr(grams("hashes", SHINGLE)))
        .withColumn(
            "at",
            F.expr(
                "filter(transform(grams, (g, i) ->"
                f" IF(array_contains({known}[CAST(g & {size - 1} AS INT)], g), i, -1)),"
                " i -> i >= 0)"
            ),
        )
        .select(
            "key",
            "text_hash",
            F.expr(
                "explode(transform(at, i -> struct(i AS place,"
                f" array_join(slice(words, i + 1, {SHINGLE}), ' ') AS shingle)))"
            ).alias("x"),
        )
        .select("key", "text_hash", "x.place", "x.shingle")
    )
    placed = listed.join(F.broadcast(shingles), "shingle").withColumn(
        "k",
        F.expr(
            f"explode(sequence(greatest(0, CAST(ceil((place + {SHINGLE} - 1.5D * c) / (c / 2))"
            " AS INT)), CAST(floor(place / (c / 2)) AS INT)))"
        ),
    )
    return (
        placed.groupBy("key", "text_hash", "c", "k")
        .agg(F.sort_array(F.collect_set("shingle")).alias("held"))
        .select(
            "key",
            "text_hash",
            "c",
            F.expr("k * (c div 2)").alias("begins"),
            "held",
            F.sha2(F.concat_ws(",", F.col("c").cast("string"), "held"), 256).alias("set_id"),
        )
    )


def _matches(
    sets: DataFrame, known: DataFrame, containment: float, bands: int
) -> DataFrame:
    """The licenses in each distinct set of shingles: candidates by bands, then verified."""

    def banded(frame: DataFrame, values: str) -> DataFrame:
        least = (
            f"transform(sequence(0, {bands - 1}), b ->"
            f" array_min(transform({values}, x -> xxhash64(b, x))))"
        )
        return frame.select("*", F.posexplode(F.expr(least)).alias("band", "least"))

    templates = banded(known.select("license", "c", "shingles"), "shingles")
    pairs = (
        banded(sets.select("set_id", "c", "held"), "held")
        .select("set_id", "c", "band", "least")
        .join(F.broadcast(templates.select("license", "c", "band", "least")),
              ["c", "band", "least"])
        .select("set_id", "c", "license")
        .distinct()
    )
    share = F.expr("size(array_intersect(held, shingles)) / size(shingles)")
    return (
        pairs.join(sets, ["set_id", "c"])
        .join(F.broadcast(known.select("license", "c", "shingles")), ["license", "c"])
        .withColumn("containment", share)
        .filter(F.col("containment") >= containment)
        .select("set_id", "license", "containment")
    )


def license_oracle(templates: dict[str, str] = TEMPLATES) -> str:
    values = ", ".join(
        "('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in templates.items()
    )
    split = (
        "list_filter(regexp_split_to_array(translate(coalesce(text, ''),"
        " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    return f"""
WITH t AS (SELECT license, {split} AS w FROM (VALUES {values}) AS v(license, text)),
s AS (
  SELECT DISTINCT license, c, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i,
               pow(2, ceil(log2(greatest(8, len(w)))))::INT AS c FROM t)
),
n AS (SELECT license, count(*) AS n FROM s GROUP BY license),
d AS (
  SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i
        FROM (SELECT doc_id, {split} AS w FROM documents))
),
hit AS (
  SELECT doc_id, license, shingle, c,
         unnest(range(greatest(0, ceil((p + 5 - 1.5 * c) / (c / 2)))::BIGINT,
                      floor(p / (c / 2))::BIGINT + 1)) AS k
  FROM d JOIN s USING (shingle)
),
held AS (
  SELECT doc_id, license, k, count(DISTINCT shingle) / any_value(n) AS containment
  FROM hit JOIN n USING (license) GROUP BY doc_id, license, k
)
SELECT doc_id, license, max(containment) AS containment, count(*) AS windows
FROM held WHERE containment >= 0.8 GROUP BY doc_id, license
"""
