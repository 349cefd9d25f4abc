"""License scan: MinHash bands over overlapping windows find templates, shingles verify them.

All built-in functions. Texts and templates are read as words of ASCII letters and digits in lower
case, in shingles of three. A window of a text holds ``WINDOW`` shingles, one begins every
``STRIDE``; its minimum under each of ``BANDS`` hash orders is a band of one row. Templates have a
window at every shingle. Where window and template window share a share J of their shingles, a
band agrees with probability J, and, the orders being hashes of their own, all bands miss with
(1 - J)**BANDS. Windows overlap so far that a run of up to 4 shingles lies whole in one of them, so
J is 1/2 at least for a template of 5 words or more that is there word for word: a miss of 0.1 %
at most. Passages of more words are hit by several windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, WINDOW, STRIDE, BANDS = 3, 6, 3, 10
#: Least share of a template's different shingles that a text must have near the place found.
CONTAINMENT = 0.8
#: Words of all templates: their bands are listed in the plan, and their shingles are broadcast.
MOST_TEMPLATE_WORDS = 20_000

#: Names and wordings of the templates, notices first, then openings of licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-2.0": "licensed under the GNU General Public License, version 2",
    "LGPL-2.1": "licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "licensed under the Mozilla Public License, version 2.0",
    "BSD-3-Clause": "Released under the BSD 3-Clause License",
    "BSD-2-Clause": "Released under the BSD 2-Clause License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC0-1.0": "Released under the CC0 1.0 Universal Public Domain Dedication",
    "Apache-2.0-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software"
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/"
    ),
    "Unlicense-text": "This is free and unencumbered software released into the public domain",
}


def license_words(text: Column) -> Column:
    """Words of ASCII letters and digits in lower case; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(words: Column) -> Column:
    """A hash of each run of three words, in order; none with fewer words."""
    n = F.size(words) - (SHINGLE - 1)
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def windows(shingle_col: str, stride: int) -> Column:
    """The place and the shingles of each window."""
    last = F.greatest(F.lit(1), F.size(shingle_col) - (WINDOW - 1))
    starts = F.array_union(F.sequence(F.lit(1), last, F.lit(stride)), F.array(last))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(shingle_col, s, WINDOW).alias("window")))


def bands(window: Column) -> list[Column]:
    """For each band its number and the smallest value of a window under a hash order of its own,
    mixed into one number. Plain expressions on one window: they are compiled, lambdas are not."""

    def smallest(band: int) -> Column:
        own = [F.get(window, F.lit(k)) for k in range(WINDOW)]
        return F.xxhash64(F.lit(band), F.least(*(F.when(s.isNotNull(), F.xxhash64(s, F.lit(band))) for s in own)))

    return [smallest(band) for band in range(BANDS)]


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once for each row. A generator keeps the optimizer from
    putting the expression in each place that uses it, in lambdas once for each element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in templates.items()])
    named = computed(spark.range(1).select(F.inline(rows)), "words", license_words(F.col("text")))
    return computed(named, "template", shingles(F.col("words"))).select("license", "template")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """doc_id, license, first_word, containment: the templates found in each row's text.

    ``first_word`` counts from 0 the words of ``license_words`` and is the first place where the
    template is; ``containment`` is the largest share of the template's shingles at one place, of
    at least ``CONTAINMENT``. Rows are compared by themselves and keep together by a row number,
    so repeated rows and ids are reported each; a null id stays null. Null, empty and short texts
    match nothing; whole texts are read, however long. Templates of fewer than three words, and
    more than ``MOST_TEMPLATE_WORDS`` words of templates in all, are refused. Other columns are not
    read; an empty table gives no rows.

    The templates are bounded, so their bands are a list in the plan and their shingles are
    broadcast. Texts are not shuffled: those without a band in common are dropped where they are read.
    """
    spark = docs.sparkSession
    known = _templates(spark, TEMPLATES if templates is None else templates)
    shortest, total = known.agg(F.min(F.size("template")), F.sum(F.size("template"))).first()
    if not shortest:
        raise ValueError("a template needs three words at least")
    if total > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates have {total} words; they are sent to all tasks")
    pieces = known.select("license", "template", F.explode(windows("template", 1)).alias("w"))
    lookup = pieces.select(
        "license", "template", F.col("w.start").alias("template_start"), F.explode(F.array(*bands(F.col("w.window")))).alias("key")
    ).distinct()
    listed = [r.key for r in lookup.select("key").distinct().collect()]  # a few for each template word
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.explode(F.array(license_words(F.col(text_col).cast("string")))).alias("words"),
    )
    rows = computed(rows, "text_shingles", shingles(F.col("words"))).drop("words")
    rows = rows.where(F.size("text_shingles") > 0)
    rows = computed(rows, "windows", windows("text_shingles", STRIDE)).withColumn("row", F.monotonically_increasing_id())
    keys = bands(F.col("w.window"))
    # Windows without a band in common go first; the few that stay are taken apart by band.
    found = (
        rows.select("row", "doc_id", "text_shingles", F.explode("windows").alias("w"))
        .where(reduce(Column.__or__, (key.isin(listed) for key in keys)))
        .select("row", "doc_id", "text_shingles", F.col("w.start").alias("start"), F.explode(F.array(*keys)).alias("key"))
    )
    size = F.size("template")
    # The template would begin here; the slack is for words put in or left out before this window.
    slack = F.lit(WINDOW)
    begin = F.greatest(F.lit(1), F.col("start") - F.col("template_start") + 1 - slack)
    place = F.slice("text_shingles", F.col("begin"), size + 2 * slack)
    shared = F.size(F.array_intersect("place", "template"))
    first = F.col("begin") + F.array_position(
        F.transform("place", lambda s: F.array_contains("template", s)), True
    ) - 2
    return (
        found.join(F.broadcast(lookup), "key")
        .withColumn("begin", begin)
        .withColumn("place", place)
        .withColumn("containment", shared / F.size(F.array_distinct("template")))
        .where(F.col("containment") >= CONTAINMENT)
        .withColumn("first_word", first.cast("bigint"))
        .groupBy("row", "doc_id", "license")
        .agg(F.min("first_word").alias("first_word"), F.max("containment").alias("containment"))
        .drop("row")
    )
