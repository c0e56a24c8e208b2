"""License scan: find short license texts inside whole documents.

DataFrame functions only. Overlapping windows of a document's words get
MinHash values; a window that shares a band with a window of a template is a
candidate, and the share of the template's shingles found around the window
decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.llm.license_texts import TEXTS

#: Short notices as authors write them in files (fixed values).
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

SHINGLE, STEP = 3, 3
#: Words of a window: with this step every run of SHINGLE words lies whole in a window.
WINDOW = SHINGLE + STEP
PER_WINDOW = WINDOW - SHINGLE + 1


def bands_for(miss: float, jaccard: float = 1 / PER_WINDOW, rows: int = 1) -> int:
    """Bands of ``rows`` MinHash values so that sets of the given likeness
    share none with a probability of ``miss`` at most:
    (1 - jaccard**rows)**bands <= miss. The least likeness that matters is
    one shingle in common out of a window's, a template of one shingle."""
    return math.ceil(math.log(miss) / math.log(1 - jaccard ** rows))


def _words(text: Column) -> Column:
    """Lower-cased runs without ASCII white space or punctuation."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")


def _shingles(words: Column) -> Column:
    """Hash of each run of SHINGLE words; of the whole, if it has fewer."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))
    return F.slice(each, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))


def _windows(shingles: Column, step: int) -> Column:
    """(start, s0..s3): shingles at each ``step``; a short last window repeats its first."""
    at = F.when(F.size(shingles) > 0, F.sequence(F.lit(0), F.greatest(F.size(shingles) - 1, F.lit(0)), F.lit(step)))
    return F.transform(at, lambda i: F.struct(
        i.alias("start"), *[F.coalesce(F.get(shingles, i + k), F.get(shingles, i)).alias(f"s{k}") for k in range(PER_WINDOW)]))


def _banded(df: DataFrame, bands: int) -> DataFrame:
    """A row for each band of each window ``_win``, with its MinHash value.
    The band is a row and not one of many columns, which keeps the generated
    code small enough to be compiled."""
    df = df.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    return df.withColumn("_band", F.least(*[F.xxhash64(F.col(f"_win.s{k}"), F.col("_b")) for k in range(PER_WINDOW)])).drop("_b")


def notices(spark: SparkSession) -> DataFrame:
    """(template, text) of the short notices."""
    return spark.createDataFrame(sorted(NOTICES.items()), "template string, text string")


def all_templates(spark: SparkSession) -> DataFrame:
    """(template, text) of the short notices, and of whole license texts and headers."""
    return spark.createDataFrame(sorted({**NOTICES, **TEXTS}.items()), "template string, text string")


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan_licenses(docs: DataFrame, templates: DataFrame, containment: float = 0.8, miss: float = 0.005,
                  max_template_words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, template, n_words, start, containment, n_places) for every template
    found in a document: the place that holds most of the template's distinct
    word shingles (the first of equals; ``start`` counts words from 0), the
    share it holds, at least ``containment``, and the number of windows that
    led to such a place.

    ``templates`` (template, text) is a given list, small enough to be
    broadcast. Its texts may have any length; with ``max_template_words``,
    longer ones raise. Words are lower-cased runs without ASCII white space
    and punctuation. Texts and templates that are null or without words match
    nothing. Repeated rows with the same id count as one document, several
    texts of one id (also of the null id) as one document whose best place
    counts. Extra columns are not read.

    1. Windows go through the bands without their text: a row is an id, a
       hash of the text and a position. The windows of the templates are the
       broadcast side (their number is bounded by the list).
    2. What a text hits is one row a template, with its positions; these are
       joined to the texts, so only texts with a hit are looked at again. All
       places of a text are compared in its own row, so nothing is copied by
       position and the work grows with the length of a text, not its square.
    """
    bands = bands_for(miss)
    t = templates.select(F.col("template").alias("_template"), _words(F.col("text")).alias("_w")).where(F.size("_w") > 0)
    if max_template_words is not None:
        longest = t.agg(F.max(F.size("_w"))).first()[0] or 0
        if longest > max_template_words:
            raise ValueError(f"a template has {longest} words; the limit is {max_template_words}")
    t = t.distinct().withColumn("_tid", F.xxhash64("_template", "_w")).withColumn("_all", _shingles(F.col("_w")))
    # a template's windows start at every word, so that those of a document need not line up
    marks = _banded(t.select("_tid", F.explode(_windows(F.col("_all"), 1)).alias("_win")), bands)
    per_band = marks.groupBy("_band").agg(F.collect_set("_tid").alias("_tids"))

    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_h")).where(F.col(text_col).isNotNull())
    words = d.select("_id", "_h", _words(F.col("_text")).alias("_w")).select("_id", "_h", _shingles(F.col("_w")).alias("_all"))
    wins = _banded(words.select("_id", "_h", F.explode(_windows(F.col("_all"), STEP)).alias("_win")), bands)
    hits = wins.join(F.broadcast(per_band), "_band") \
               .select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), F.col("_win.start").alias("_start"), F.explode("_tids").alias("_tid"))
    hits = written(hits.groupBy("_i", "_g", "_tid").agg(F.collect_set("_start").alias("_starts")), "license-hits")

    # one plan at every size: texts and hits meet by shuffle, whether or not the hits would fit a broadcast
    seen = d.join(hits.hint("merge"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g"))) \
            .select("_id", "_tid", "_starts", _words(F.col("_text")).alias("_w"))
    looked = t.select("_tid", "_template", F.size("_w").alias("_n"), F.array_distinct("_all").alias("_sh"))
    seen = seen.select("_id", "_tid", "_starts", _shingles(F.col("_w")).alias("_all")).join(F.broadcast(looked), "_tid")
    n, sh = F.col("_n"), F.col("_sh")

    def place(start: Column) -> Column:
        # a template that meets this window starts at most its own length before it
        first = F.greatest(start - n, F.lit(0))
        return _let(F.slice("_all", first + 1, n * 2 + WINDOW), lambda around: _let(F.array_intersect(around, sh), lambda held: F.struct(
            start.alias("start"), (first + F.array_position(around, F.get(held, F.lit(0))).cast("int") - 1).alias("at"),
            (F.size(held) / F.size(sh)).alias("share"))))

    places = F.filter(F.transform("_starts", place), lambda p: p.share >= containment)
    found = seen.select("_id", "_template", "_n", F.explode(places).alias("_p"))
    best = F.max(F.struct(F.col("_p.share").alias("share"), (-F.col("_p.at")).alias("at")))
    return found.groupBy(F.col("_id").alias(id_col), F.col("_template").alias("template"), F.col("_n").alias("n_words")) \
        .agg(best.alias("_b"), F.countDistinct("_p.start").alias("n_places")) \
        .select(id_col, "template", F.col("n_words").cast("long").alias("n_words"),
                (-F.col("_b.at")).cast("long").alias("start"), F.col("_b.share").alias("containment"),
                F.col("n_places").cast("long").alias("n_places"))
