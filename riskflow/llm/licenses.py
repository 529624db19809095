"""License scan with DataFrame functions only: MinHash bands over text windows retrieve templates, containment verifies.

A text's words (A-Z in lower case, without punctuation at either end) are cut into overlapping windows, one length for each
length class of templates: a window is ``step - 1`` words longer than the longest template of its class and windows start
every ``step`` words, so each place of a template lies in one window. Words of ``SHINGLE`` make a shingle; a shorter
template is one shingle. A window is retrieved for a template when the least value of one of ``BANDS`` hash functions agrees
(bands of one row). With containment of 0.8 or more, the Jaccard similarity of window and template is at least 0.48 for the
classes below, so a band setting of 14 misses at most (1 - 0.48) ** 14, about one in 9,000 of the least similar; windows that
hold nothing but the template agree surely.

Texts without any of the templates' telling words are left out before windows are built. Telling words are chosen so that
the shingles of a template that hold none of them are too few for a match; this loses nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import store

SHINGLE = 5
CONTAINMENT = 80
BANDS = 14

#: License notices and their identifiers, whether redistribution is free of conditions on derived works.
TEMPLATES: dict[str, tuple[str, bool]] = {
    "MIT/notice": ("Released under the MIT License.", True),
    "Apache-2.0/notice": ("Licensed under the Apache License, Version 2.0.", True),
    "CC-BY-NC-4.0/notice": ("Licensed under CC BY-NC 4.0.", False),
    "CC-BY-4.0/notice": ("Licensed under CC BY 4.0.", True),
    "CC-BY-SA-4.0/notice": ("Licensed under CC BY-SA 4.0.", False),
    "GPL-3.0/notice": ("This work is licensed under the GNU General Public License, version 3.", False),
    "GPL-2.0/notice": ("This work is licensed under the GNU General Public License, version 2.", False),
    "BSD-3-Clause/notice": ("Released under the BSD 3-Clause License.", True),
    "MPL-2.0/notice": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", False),
    "Proprietary/notice": ("All rights reserved. No part of this work may be reproduced without permission.", False),
    "Apache-2.0/header": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', True),
    "MIT/grant": ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction', True),
    "GPL/header": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", False),
}

_EDGE = r"^[^a-z0-9]+|[^a-z0-9]+$"


def template_words(text: str) -> list[str]:
    return [w for w in (re.sub(_EDGE, "", x.lower()) for x in re.findall(r"[^\x20\x09-\x0D]+", text)) if w]


def _pieces(words: list[str]) -> list[tuple[str, ...]]:
    if len(words) < SHINGLE:
        return [tuple(words)]
    return [tuple(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)]


def telling_words(words: list[str]) -> list[str]:
    """Few, long words of a template such that shingles without any of them are less than the containment needs."""
    left, out = set(_pieces(words)), []
    whole = len(left)
    while 100 * len(left) >= CONTAINMENT * whole:
        best = max(sorted({w for p in left for w in p}), key=lambda w: (len(w) >= 3, len(w), sum(w in p for p in left)))
        out.append(best)
        left = {p for p in left if best not in p}
    return out


def length_classes(templates: dict[str, tuple[str, bool]]) -> list[tuple[int, int, dict[str, list[str]]]]:
    """(window words, step, templates) for each length class: equal lengths below ten words, a quarter apart above."""
    by: dict[int, dict[str, list[str]]] = {}
    for name, (text, _) in templates.items():
        words = template_words(text)
        n, top = len(words), 10
        if n >= 10:
            while top < n:
                top = top * 5 // 4
        by.setdefault(n if n < 10 else top, {})[name] = words
    out = []
    for _, members in sorted(by.items()):
        longest = max(map(len, members.values()))
        step = max(1, longest // 8) if longest >= 10 else 1
        out.append((longest + step - 1, step, members))
    return out


def _shingles(words: Column, size: int) -> Column:
    """Distinct shingle hashes of an array of words; all words as one shingle if they are fewer than ``size``."""
    many = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda k: F.xxhash64(F.array_join(F.slice(words, k + 1, size), " ")))
    return F.array_distinct(F.when(F.size(words) >= size, many).otherwise(F.array(F.xxhash64(F.array_join(words, " ")))))


def _bands(shingles: Column) -> Column:
    least = lambda j: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(j))))
    return F.array(*map(least, range(BANDS)))


def _words(text: str) -> Column:
    # Only A-Z change: lower() of the whole text would also change other letters.
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bare = F.transform(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: F.regexp_replace(w, _EDGE, ""))
    return F.filter(bare, lambda w: w != "")


def scan(docs: DataFrame, templates: dict[str, tuple[str, bool]] = TEMPLATES) -> DataFrame:
    """One row per document and template found: containment (percent, best window) and the first word of the best window.

    A template is found where a window holds ``CONTAINMENT`` percent or more of its shingles. Whole texts are scanned. Null and
    empty texts hold none; a document without a license gives no row; repeated rows give one row for each template, with the
    number of times the notice's windows matched not counted. Rows with a null id are one document for each text. Extra columns
    are not read. The template table is fixed and small, so it is broadcast.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).filter("text IS NOT NULL")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    telling = sorted({w for text, _ in templates.values() for w in telling_words(template_words(text))})
    some = own.filter(_any(F.contains, lower, telling))
    # Read once for every length class: texts are searched and split once, and the classes read only what has a telling word.
    parsed = store.keep(some.select("doc_id", F.xxhash64("text").alias("tie"), _words("text").alias("words")).filter(F.size("words") > 0), "license-words")
    found = None
    for number, (window, step, members) in enumerate(length_classes(templates)):
        local = sorted({w for words in members.values() for w in telling_words(words)})
        last = F.greatest(F.size("words") - window, F.lit(0))
        starts = F.array_union(F.sequence(F.lit(0), last, F.lit(step)), F.array(last))
        cut = parsed.filter(F.arrays_overlap("words", F.array(*map(F.lit, local)))).select("doc_id", "tie", "words", F.explode(starts).alias("at"))
        cut = cut.select("doc_id", "tie", "at", F.slice("words", F.col("at") + 1, window).alias("w")).filter(F.arrays_overlap("w", F.array(*map(F.lit, local))))
        size = min(SHINGLE, min(map(len, members.values())))
        cut = cut.select("doc_id", "tie", "at", _shingles(F.col("w"), size).alias("have"))
        bands = cut.select("doc_id", "tie", "at", "have", F.posexplode(_bands(F.col("have"))).alias("band", "least"))
        known = _template_table(spark, members, size).select("template", "want", F.posexplode(_bands(F.col("want"))).alias("band", "least"))
        hits = bands.join(F.broadcast(known), ["band", "least"]).select("doc_id", "tie", "at", "template", (F.size(F.array_intersect("have", "want")) * 100 / F.size("want")).cast("int").alias("containment"))
        hits = hits.filter(F.col("containment") >= CONTAINMENT)
        found = hits if found is None else found.unionByName(hits)
    best = F.max(F.struct("containment", (-F.col("at")).alias("before"))).alias("best")
    out = found.groupBy("doc_id", "tie", "template").agg(best)
    free = [name for name, (_, is_free) in templates.items() if is_free]
    return out.select("doc_id", "template", F.split("template", "/")[0].alias("license"), F.col("template").isin(free).alias("permissive"), F.col("best.containment").alias("containment"), (-F.col("best.before")).alias("first_word"))


def _any(test, text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | test(text, F.lit(w))
    return out


def _template_table(spark: SparkSession, members: dict[str, list[str]], size: int) -> DataFrame:
    rows = spark.createDataFrame(sorted(members.items()), "template string, words array<string>")
    return rows.select("template", _shingles(F.col("words"), size).alias("want"))
