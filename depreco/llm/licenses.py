"""License scan: MinHash bands over overlapping text windows, in DataFrame operations only.

Texts are lower-cased words (runs of letters and digits). A template of n words has its distinct shingles
of five words; one of fewer words has its whole sequence as its only shingle. Texts are cut into windows
of n + s words that begin every s = max(1, n // 2) words, so any run of n words lies whole in one window.

Each window keeps, for BANDS hash functions, its smallest hash: bands of one row. A window that holds a
template whole has a similarity of at least 1/3 with it, so the two meet in some band but once in 10^11;
at 75 % of the shingles it is about 0.4. Windows that hold no shingle of any template can meet none and
are left out before hashing. A pair of window and template that meet is then verified: the window must
hold at least PERCENT of the template's shingles, compared as words.

The result has a row for each document and license found: the best containment and the word where the
first window that reaches it begins. Documents without findings have no row. A null or empty text has no
words; a text of any length is scanned whole; a repeated row is reported once; a null id is reported as null. Empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import once
from .store import Scratch

SHINGLE = 5
PERCENT = 75
BANDS = 64

#: Notices as their licenses word them.
TEMPLATES = (
    ("All-Rights-Reserved", "All rights reserved"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(listed: Column, k: int) -> Column:
    """All k-word shingles of an array of words, in order, as arrays of words."""
    last = F.size(listed) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(listed, i + 1, k))).otherwise(F.array())


def hashes(listed: Column, k: int) -> Column:
    last = F.size(listed) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(listed, i + 1, k)))).otherwise(F.array().cast("array<bigint>"))


def bands(codes: Column) -> Column:
    """The smallest of the codes under each of BANDS hash functions."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.array_min(F.transform(codes, lambda c: F.xxhash64(c, b))))


def templates(spark: SparkSession, given: tuple = TEMPLATES) -> DataFrame:
    """(license, template, n, k, codes): a row for each template."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in given])).alias("t")
    listed = spark.range(1).select(rows).select("t.license", words(F.col("t.text")).alias("listed"))
    return listed.filter(F.size("listed") > 0).select("license", "listed", F.size("listed").alias("n"), F.least(F.size("listed"), F.lit(SHINGLE)).alias("k"))


def licenses(docs: DataFrame, given: tuple = TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, n_shingles, n_found, at_word) of each document and license found."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = scratch.keep(templates(spark, given))
    kinds = sorted({(r.n, r.k) for r in known.select("n", "k").distinct().collect()})  # bounded by the templates given
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    rows = once(rows, listed=words(F.col("text"))).drop("text")

    # Texts with a shingle of any template, by the templates' shingle hashes for each shingle size.
    own = {}
    for k in sorted({k for _, k in kinds}):
        codes = known.filter(F.col("k") == k).select(F.explode(hashes(F.col("listed"), k)).alias("c")).distinct().collect()
        own[k] = F.array(*[F.lit(r.c) for r in sorted(codes, key=lambda r: r.c)])
    holds = [F.arrays_overlap(hashes(F.col("listed"), k), codes) for k, codes in own.items()]
    some = holds[0]
    for h in holds[1:]:
        some = some | h
    near = scratch.keep(rows.filter(some))

    found = None
    for n, k in kinds:
        step = max(1, n // 2)
        starts = F.sequence(F.lit(0), F.greatest(F.size("listed") - 1, F.lit(0)), F.lit(step))
        cut = near.select("doc_id", "text_key", "listed", F.explode(starts).alias("at_word"))
        cut = once(cut, part=F.expr(f"slice(listed, at_word + 1, {n + step})")).drop("listed")
        cut = once(cut, codes=hashes(F.col("part"), k)).filter(F.arrays_overlap("codes", own[k]))
        met = cut.select("doc_id", "text_key", "at_word", "part", F.posexplode(bands(F.col("codes"))).alias("band", "low"))
        mine = known.filter((F.col("n") == n) & (F.col("k") == k)).select("license", F.array_distinct(shingles(F.col("listed"), k)).alias("want"), hashes(F.col("listed"), k).alias("codes"))
        mine = mine.select("license", "want", F.posexplode(bands(F.col("codes"))).alias("band", "low"))
        met = met.join(mine, ["band", "low"]).select("doc_id", "text_key", "at_word", "part", "license", "want").distinct()
        held = met.select("doc_id", "text_key", "at_word", "license", F.size("want").alias("n_shingles"), F.size(F.array_intersect("want", shingles(F.col("part"), k))).alias("n_found"))
        held = held.filter(F.col("n_found") * 100 >= F.col("n_shingles") * percent)
        found = held if found is None else found.unionByName(held)
    order = F.struct(-F.col("n_found") / F.col("n_shingles"), "at_word", -F.col("n_shingles"))
    best = found.groupBy("doc_id", "text_key", "license").agg(F.min_by(F.struct("n_shingles", "n_found", "at_word"), order).alias("best"))
    return scratch.finish(best.select("doc_id", "license", "best.n_shingles", "best.n_found", "best.at_word"))
