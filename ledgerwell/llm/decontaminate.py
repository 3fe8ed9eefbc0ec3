"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact weighted similarity.

A document window has as many words as a benchmark item. All windows are formed that hold enough runs of the
benchmark to reach the similarity, wherever they begin. A window's fingerprint and the item's differ in few bits if
they are similar; cut into one block more than the radius, two fingerprints within the radius agree in a block at
least. Windows that agree are compared by their runs of five words, each weighing as often as it occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed, fresh
from ledgerwell.llm.windows import bounded, contents, keyed, once, overlap, references, stretches

RUN = 5
BITS = 64
#: At similarity 0.8 a bit differs with probability 0.152; more than 20 of 64 do so once in 4,000.
RADIUS = 20


def fingerprint(hashes: Column) -> Column:
    """SimHash: bit by bit, whether it is set in more than half of the hashes."""
    size = F.size(hashes)

    def vote(bit: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        ones = F.size(F.filter(hashes, lambda h: h.bitwiseAND(mask) != 0))
        return F.when(ones * 2 > size, mask).otherwise(F.lit(0).cast("long"))

    votes = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), vote)
    return F.aggregate(votes, F.lit(0).cast("long"), lambda whole, v: whole.bitwiseOR(v))


def blocks(print_: Column, radius: int = RADIUS) -> Column:
    """Numbered blocks of a fingerprint, one more than the radius."""
    count = radius + 1
    edges = [BITS * k // count for k in range(count + 1)]
    parts = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
        for k, (a, b) in enumerate(zip(edges, edges[1:]))
    ]
    return F.array(*parts)


def starts(places: Column, n: Column, count: Column, run: int, least: float) -> Column:
    """Where windows of ``n`` words begin that hold as many of the sorted ``places`` as ``least`` asks for.

    Of m runs on both sides, S common ones are S / (2 m - S) alike. A window whose first place is number k ends
    with place k + S - 1 or later, so it begins between that end and place k, behind place k - 1.
    """
    runs_ = n - run + 1
    wanted = F.greatest(F.lit(1), F.ceil(runs_ * (2 * least / (1 + least)) - 1e-6).cast("int"))

    def of(place: Column, k: Column) -> Column:
        final = F.get(places, k + wanted - 1)
        low = F.greatest(F.lit(0), final - runs_ + 1, F.when(k > 0, F.get(places, k - 1) + 1).otherwise(F.lit(0)))
        high = F.least(place, count - n)
        return F.when(final.isNotNull() & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    # A document shorter than the item is one window; its runs are fewer, those of the item are not.
    whole = F.when(F.size(places) >= F.ceil(runs_ * least - 1e-6), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.when(count >= n, F.flatten(F.transform(places, of))).otherwise(whole)


def matches(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, least: float) -> DataFrame:
    """Windows similar to an item: ``row`` (of ``keyed``), ``id``, ``name``, ``n``, ``start``, ``similarity``."""
    rows = keyed(docs, key, text)
    known = references(benchmark, item, item_text, RUN)
    found = []
    for size in sorted(r["run"] for r in known.select("run").distinct().collect()):
        places = stretches(rows, known, size)
        begins = starts(F.col("places"), F.col("n"), F.col("count"), size, least)
        windows = places.select("row", "n", F.explode(begins).alias("start"), F.least("n", "count").alias("length"))
        made = checkpointed(contents(rows, checkpointed(windows), size))
        # Equal windows of many documents are looked up once.
        content = [F.xxhash64("hashes"), F.xxhash64(F.lit(1), "hashes")]
        marked = made.withColumns({"a": content[0], "b": content[1]})
        distinct = marked.groupBy("n", "a", "b").agg(F.first("hashes").alias("hashes"))
        windows_ = checkpointed(once(distinct, "print", fingerprint(F.col("hashes"))))
        items = once(known.filter(F.col("run") == size), "print", fingerprint(F.col("hashes")))
        items = checkpointed(items.select("name", "n", F.col("hashes").alias("wanted"), F.col("print").alias("other")))
        left = windows_.select("n", "a", "b", "print", F.explode(blocks(F.col("print"))).alias("k"))
        right = items.select("n", "name", "other", F.explode(blocks(F.col("other"))).alias("k"))
        near = left.select("n", "a", "b", "print", "k.*").join(right.select("n", "name", "other", "k.*"), ["n", "block", "bits"])
        near = near.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= RADIUS).select("n", "a", "b", "name").distinct()
        pairs = near.join(windows_.select("n", "a", "b", "hashes"), ["n", "a", "b"]).join(items.select("name", "n", "wanted"), ["name", "n"])
        pairs = once(pairs, "shared", overlap(F.col("hashes"), F.col("wanted")))
        union = F.size("hashes") + F.size("wanted") - F.col("shared")
        alike = pairs.select("n", "a", "b", "name", (F.col("shared") / union).alias("similarity")).filter(F.col("similarity") >= least)
        found.append(marked.select("row", "id", "n", "start", "a", "b").join(checkpointed(alike), ["n", "a", "b"]))
    if not found:
        name = F.lit(None).cast(benchmark.schema[item].dataType).alias("name")
        empty = rows.limit(0).select("row", "id", name)
        found = [empty.selectExpr("row", "id", "name", "0 AS n", "0 AS start", "0D AS similarity")]
    columns = ["row", "id", "name", "n", "start", "similarity"]
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in found])


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least: float = 0.8,
) -> DataFrame:
    """Benchmark items in documents: one row per document id and item with the best window.

    Columns: ``key``, ``item``, ``similarity`` (weighted Jaccard of five-word runs, ``least`` or more), ``start_word``,
    ``n_words``. Windows begin at any word and stay within the document; a shorter document is one window. Case and signs between words do not count. An item of fewer
    than five words is one run; items and documents without words never match. Rows with equal ids are one
    document; a NULL id is an id of its own.
    """
    found = matches(docs, benchmark, key, text, item, item_text, least)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best")
    return found.groupBy("id", "name").agg(best).select(
        F.col("id").alias(key),
        F.col("name").alias(item),
        F.round("best.similarity", 6).alias("similarity"),
        (-F.col("best.back")).cast("long").alias("start_word"),
        F.col("best.n").cast("long").alias("n_words"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """Rows without a benchmark passage, each judged by its own text whatever its key; all columns stay."""
    mark = fresh("row")
    found = matches(docs, benchmark, key, text, "item_id", "text", least).select(F.col("row").alias(mark)).distinct()
    return docs.withColumn(mark, F.xxhash64(key, text)).join(bounded(found), mark, "left_anti").drop(mark)
