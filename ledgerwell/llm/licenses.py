"""License notices in documents: MinHash bands over overlapping windows, then exact containment.

For a template of n words the windows have n words and room for a fifth or quarter more, and begin at any shared run, so a
notice with so many inserted words lies whole in one of them. A window that holds 0.8 of a template's runs is at
least 0.5 similar to it: 40 bands of 2 rows then meet with a probability above 0.9999.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed
from ledgerwell.llm.windows import contents, keyed, references, stretches

RUN, BANDS, ROWS = 5, 40, 2

#: Public license notices. Fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Proprietary", "All rights reserved"),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """The templates above as ``template`` (a number), ``license``, ``notice``."""
    rows = [F.struct(F.lit(k).alias("template"), F.lit(a).alias("license"), F.lit(b).alias("notice")) for k, (a, b) in enumerate(TEMPLATES)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def bands(hashes: Column) -> Column:
    """Numbered bands of the MinHash signature."""

    def least(number: Column) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, number)))

    def band(k: Column) -> Column:
        return F.struct(k.alias("band"), F.xxhash64(*(least(k * ROWS + r) for r in range(ROWS))).alias("value"))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)


def scan(
    docs: DataFrame,
    templates: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    template: str = "template",
    notice: str = "notice",
    least: float = 0.8,
) -> DataFrame:
    """Notices in documents: one row per document id and template with the best window.

    Columns: ``key``, ``template``, ``containment`` (share of the template's distinct five-word runs in the window,
    ``least`` or more), ``start_word`` (where the first such window that begins with a shared run begins, counted
    in whole quarters of the template's words). Case and signs between words do not count. A template of fewer than five words
    is one run; templates and documents without words never match. Rows with equal ids are one document; a NULL
    id is an id of its own.
    """
    rows = keyed(docs, key, text)
    known = references(templates, template, notice, RUN)
    stride = F.greatest(F.lit(1), F.floor(F.col("n") / 4).cast("int"))
    found = []
    for size in sorted(r["run"] for r in known.select("run").distinct().collect()):
        own = known.filter(F.col("run") == size)
        needed = own.groupBy("n").agg(F.min(F.size(F.array_distinct("hashes"))).alias("least"))
        needed = needed.select("n", F.ceil(F.col("least") * least - 1e-6).cast("int").alias("needed"))
        places = stretches(rows, known, size).join(F.broadcast(needed), "n")
        # A window that begins between two shared runs holds no more than the one that begins at the second.
        length = F.col("n") + F.greatest(stride - 1, F.ceil(F.col("n") * 0.2).cast("int"))
        final = F.transform("places", lambda p, k: F.get("places", k + F.greatest(F.lit(1), F.col("needed")) - 1) - p)
        start = F.filter("places", lambda p, k: F.get(F.col("spans"), k) <= F.col("length") - size)
        windows = places.withColumns({"length": length, "spans": final})
        windows = windows.select("row", "n", F.explode(start).alias("start"), "length")
        made = checkpointed(contents(rows, checkpointed(windows), size))
        made = made.withColumn("hashes", F.array_distinct("hashes")).filter(F.size("hashes") > 0)
        marked = made.withColumns({"a": F.xxhash64("hashes"), "b": F.xxhash64(F.lit(1), "hashes")})
        distinct = checkpointed(marked.groupBy("n", "a", "b").agg(F.first("hashes").alias("hashes")))
        wanted = known.filter(F.col("run") == size).select("name", "n", F.array_distinct("hashes").alias("wanted"))
        left = distinct.select("n", "a", "b", F.explode(bands(F.col("hashes"))).alias("k")).select("n", "a", "b", "k.*")
        right = wanted.select("name", "n", F.explode(bands(F.col("wanted"))).alias("k")).select("name", "n", "k.*")
        near = left.join(right, ["n", "band", "value"]).select("n", "a", "b", "name").distinct()
        pairs = near.join(distinct, ["n", "a", "b"]).join(wanted, ["name", "n"])
        share = F.size(F.array_intersect("hashes", "wanted")) / F.size("wanted")
        alike = checkpointed(pairs.select("n", "a", "b", "name", share.alias("containment")).filter(F.col("containment") >= least))
        begin = (F.col("start") - F.pmod("start", stride)).alias("start")
        found.append(marked.select("id", "n", begin, "a", "b").join(alike, ["n", "a", "b"]).select("id", "name", "start", "containment"))
    if not found:
        name = F.lit(None).cast(templates.schema[template].dataType).alias("name")
        empty = docs.limit(0).select(F.col(key).alias("id"), name)
        found = [empty.selectExpr("id", "name", "0 AS start", "0D AS containment")]
    best = F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("best")
    return reduce(DataFrame.unionByName, found).groupBy("id", "name").agg(best).select(
        F.col("id").alias(key),
        F.col("name").alias(template),
        F.round("best.containment", 6).alias("containment"),
        (-F.col("best.back")).cast("long").alias("start_word"),
    )
