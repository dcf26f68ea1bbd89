"""License scans: MinHash bands over text windows, then exact containment.

A template's shingles (5 words) are compared with every window of as many
shingles, window by window (stride 1). Band j of a window is the smallest value
of hash function j over its shingles; a window is retrieved if a band
equals the template's. A window that holds 80 % of a template has Jaccard
similarity 2/3 or more, so with ``BANDS`` bands of one row it is missed with a
probability of 3**-8 at most; ``collision_probability`` gives other settings.

A band can only be equal where the window holds the template's smallest shingle of
that band. So bands are evaluated only for windows around such shingles, which
are few; the result is that of evaluating all windows.

A retrieved window (and a quarter more on both sides) is verified: the share of the
template's distinct shingles in it must reach ``CONTAINMENT``. Notices of related
licenses share most of their words, so of two licenses found in the same words (one has
half of the other's or more) the one with the larger containment stays. Everything is DataFrame
functions on arrays within a row, cut to a few template lengths around a hit; only the
matches are grouped.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh

SHINGLE = 5
BANDS = 8
CONTAINMENT = 0.8

# Public wordings of license notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def collision_probability(jaccard: float, bands: int = BANDS, rows: int = 1) -> float:
    """That a window of this similarity to a template is retrieved."""
    return 1 - (1 - jaccard**rows) ** bands


def _shingled(df: DataFrame, text: Column, words: str, hashes: str) -> DataFrame:
    """``df`` with the text's words (letters and digits, lower-cased) and the
    hashes of its shingles in order; fewer words than a shingle have none.
    Intermediate columns are used more than once, so they aren't folded into inner loops."""
    (w,) = fresh(df, ["_word_hashes"])
    split = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    x = df.withColumn(words, split)
    x = x.withColumn(w, F.transform(words, lambda one: F.xxhash64(one)))
    at = F.sequence(F.lit(0), F.size(w) - SHINGLE)
    many = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    return x.withColumn(hashes, F.when(F.size(w) >= SHINGLE, many).otherwise(F.array().cast("array<bigint>"))).drop(w)


def _band(hashes: Column, band: Column) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))


def _keys(spark: SparkSession, templates: Sequence[tuple[str, str]], bands: int) -> DataFrame:
    """A row for each template and band: ``key``, the template's smallest shingle in the band,
    the band's value, and the template's shingles. Templates x bands rows."""
    rows = json.dumps([{"license": a, "wording": b} for a, b in templates])
    listed = spark.range(1).select(
        F.posexplode(F.from_json(F.lit(rows), "array<struct<license:string,wording:string>>")).alias("template", "t")
    )
    x = _shingled(listed.select("template", "t.license", "t.wording"), F.col("wording"), "w", "shingles")
    x = x.where(F.size("shingles") > 0).select("template", "license", "shingles", F.explode(F.sequence(F.lit(1), F.lit(bands))).alias("band"))
    x = x.withColumn("value", _band(F.col("shingles"), F.col("band")))
    key = F.filter("shingles", lambda h: F.xxhash64(h, F.col("band")) == F.col("value"))[0]
    return x.select("template", "license", "shingles", "band", "value", key.alias("key"))


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    bands: int = BANDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row for each place of a row's text where a license's wording stands:
    ``doc_id``, ``license``, ``template`` (its number in ``templates``),
    ``begin_word`` and ``end_word`` (exclusive; words are runs of letters and digits,
    from 0), ``containment`` (the largest there) and ``matched``, the words.

    Of rival licenses in the same words the best one is given.

    Null, empty and short texts have none; every row is scanned for itself, so
    repeated rows give repeated matches. Templates need 5 words or more;
    others are never found. ``templates`` is meant to be a hand-kept list: it is broadcast.
    """
    spark = df.sparkSession
    keys = _keys(spark, templates, bands)
    # Templates x bands values at most.
    wanted = [r["key"] for r in keys.select("key").distinct().collect()]
    x = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    x = _shingled(x, F.col("text"), "words", "hashes").select("row", "doc_id", "words", "hashes")
    # What a hit may need of a long text: two template lengths on both sides.
    reach = 2 * (keys.agg(F.max(F.size("shingles"))).first()[0] or 1)
    first = lambda i: F.greatest(i - reach, F.lit(0))
    hit = F.transform("hashes", lambda h, i: F.when(h.isin(wanted), F.struct(
        (i - first(i)).alias("at"), h.alias("key"), first(i).alias("first"), F.size("hashes").alias("total"),
        F.slice("hashes", first(i) + 1, F.lit(2 * reach)).alias("hashes"), F.slice("words", first(i) + 1, F.lit(2 * reach + SHINGLE)).alias("words"),
    )))
    hits = F.array_compact(hit) if wanted else F.array().cast("array<struct<at:int,key:bigint,first:int,total:int,hashes:array<bigint>,words:array<string>>>")
    # explode_outer: a plain explode lets the optimizer compute ``hits`` twice.
    x = x.withColumn("hit", F.explode_outer(hits)).where("hit is not null").select("row", "doc_id", "hit.*")
    x = x.join(F.broadcast(keys), "key")

    # Places are counted from the piece's first shingle up to ``matched``, then in the text.
    n = F.size("shingles")
    last = F.greatest(F.col("total") - n - F.col("first"), F.lit(0))
    low, high = F.greatest(F.col("at") - n + 1, F.lit(0)), F.least(F.col("at"), last)
    starts = F.filter(F.sequence(low, high), lambda s: _band(F.slice("hashes", s + 1, n), F.col("band")) == F.col("value"))
    slack = F.ceil(n / 4).cast("int")
    distinct = F.size(F.array_distinct("shingles"))

    def verified(s: Column) -> Column:
        begin = F.greatest(s - slack, F.lit(0))
        around = F.slice("hashes", begin + 1, s - begin + n + slack)
        own = F.array_compact(F.transform(around, lambda h, i: F.when(F.array_contains("shingles", h), i)))
        return F.struct(
            (F.size(F.array_intersect(around, F.col("shingles"))) / distinct).alias("containment"),
            (-(begin + F.array_min(own))).alias("minus_begin"),
            (begin + F.array_max(own) + SHINGLE).alias("end_word"),
        )

    x = x.withColumn("starts", F.when(low <= high, starts))
    x = x.withColumn("best", F.array_max(F.transform("starts", verified))).where(F.col("best.containment") >= containment)
    begin, end = -F.col("best.minus_begin"), F.col("best.end_word")
    found = x.select(
        "row", "doc_id", "license", "template", (F.col("first") + begin).alias("begin_word"), (F.col("first") + end).alias("end_word"),
        "best.containment", F.array_join(F.slice("words", begin + 1, end - begin), " ").alias("matched"),
    )
    # Hits of one place (one for each band, and near windows) become one match.
    line = Window.partitionBy("row", "license").orderBy("begin_word", F.desc("end_word"), "template")
    before = F.max("end_word").over(line.rowsBetween(Window.unboundedPreceding, -1))
    placed = found.withColumn("new", (F.coalesce(before, F.lit(-1)) <= F.col("begin_word")).cast("int"))
    placed = placed.withColumn("place", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    # The most complete wording names the place; of equals the longest, then the first.
    rank = F.struct("containment", F.col("end_word") - F.col("begin_word"), -F.col("begin_word"), -F.col("template"))
    row = F.struct("doc_id", "template", "begin_word", "end_word", "containment", "matched")
    best = placed.groupBy("row", "license", "place").agg(F.max_by(row, rank).alias("b")).select("row", "license", "b.*")
    return _without_rivals(best, 2 * reach).select(
        "doc_id", "license", "template", "begin_word", "end_word", "containment", "matched"
    )


def _without_rivals(found: DataFrame, longest: int) -> DataFrame:
    """The matches without those of which half or more lies in a better one of another license:
    a larger containment, or the longer, or the first template of equals. Matches are at most ``longest``
    words long, so only those in the same stretch of a text are compared."""
    stored = materialize(found.withColumn("match", F.monotonically_increasing_id()), "licenses")
    first, last = F.floor(F.col("begin_word") / longest), F.floor((F.col("end_word") - 1) / longest)
    size = F.col("end_word") - F.col("begin_word")
    rank = F.struct("containment", size.alias("size"), (-F.col("template")).alias("order"))
    spread = stored.select("row", "license", "match", "begin_word", "end_word", rank.alias("rank"), F.explode(F.sequence(first, last)).alias("stretch"))
    other = spread.select("row", "stretch", *[F.col(c).alias(f"o_{c}") for c in ("license", "begin_word", "end_word", "rank")])
    shared = F.least("end_word", "o_end_word") - F.greatest("begin_word", "o_begin_word")
    beaten = spread.join(other, ["row", "stretch"]).where(
        (F.col("license") != F.col("o_license")) & (F.col("o_rank") > F.col("rank")) & (2 * shared >= F.col("end_word") - F.col("begin_word"))
    )
    return stored.join(beaten.select("match").distinct(), "match", "left_anti")
