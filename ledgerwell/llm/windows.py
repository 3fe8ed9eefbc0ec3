"""Windows of documents around the word runs that they share with short reference texts.

A window that is similar enough to a reference shares a run of words with it, so only the places of shared runs
are looked at. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed

#: Tables of at most this many short rows (some 64 MB) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later expressions refer to; it is not computed again inside them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; NULL has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def runs(found: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; none if there are fewer words."""

    def hashed(place: Column) -> Column:
        return F.xxhash64(*(found[place + k] for k in range(size)))

    starts = F.sequence(F.lit(0), F.size(found) - size)
    return F.when(F.size(found) >= size, F.transform(starts, hashed)).otherwise(F.array().cast("array<bigint>"))


def bounded(df: DataFrame) -> DataFrame:
    """A table for a join: kept in the checkpoint folder, broadcast if it is small by count."""
    kept = checkpointed(df)
    return F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept


def references(df: DataFrame, key: str, text: str, run: int) -> DataFrame:
    """Short texts with their runs: ``name``, ``run`` (words per run), ``n`` (words), ``hashes``.

    A text with fewer words than ``run`` is one run of all its words; one without words is left out.
    """
    split = once(df.select(F.col(key).alias("name"), F.col(text).alias("text")), "words", words(F.col("text")))
    out = None
    for size in range(1, run + 1):
        own = split.filter(F.size("words") >= size if size == run else F.size("words") == size)
        part = own.select("name", F.lit(size).alias("run"), F.size("words").alias("n"), runs(F.col("words"), size).alias("hashes"))
        out = part if out is None else out.unionByName(part)
    return checkpointed(out)


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents as ``row`` (a hash of key and text), ``id``, ``text``."""
    return docs.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))


def stretches(docs: DataFrame, known: DataFrame, run: int) -> DataFrame:
    """Where documents (``keyed``) share a run of ``run`` words with a reference of ``references``.

    Rows (``row``, ``n``, ``places``, ``count``): the references' words, the places of runs that any reference of so many
    words has, in order, and the document's words.
    """
    occurrences = known.filter(F.col("run") == run).select("n", F.explode("hashes").alias("hash")).distinct()
    split = once(docs.select("row", "text"), "words", words(F.col("text"))).select("row", "words")
    placed = split.select("row", F.size("words").alias("count"), F.posexplode(runs(F.col("words"), run)).alias("place", "hash"))
    met = placed.join(bounded(occurrences), "hash")
    lists = met.groupBy("row", "n").agg(F.sort_array(F.collect_set("place")).alias("places"), F.first("count").alias("count"))
    return lists.select("row", "n", "places", "count")


def contents(docs: DataFrame, windows: DataFrame, run: int) -> DataFrame:
    """Runs of words of windows (``row``, ``n``, ``start``, ``length``), with ``id``, as ``hashes``; texts are read once more."""
    lists = windows.groupBy("row").agg(F.collect_set(F.struct("n", "start", "length")).alias("windows"))
    chosen = docs.join(bounded(lists), "row")
    split = once(chosen.select("row", "id", "windows", "text"), "words", words(F.col("text")))
    hashed = once(split.select("row", "id", "windows", "words"), "all", runs(F.col("words"), run))

    def cut(window: Column) -> Column:
        size = F.greatest(window["length"] - run + 1, F.lit(0))
        return F.struct(
            window["n"].alias("n"), window["start"].alias("start"), F.slice(F.col("all"), window["start"] + 1, size).alias("hashes")
        )

    made = hashed.select("row", "id", F.explode(F.transform("windows", cut)).alias("w"))
    return made.select("row", "id", "w.n", "w.start", "w.hashes")


def overlap(one: Column, other: Column) -> Column:
    """Size of the intersection of two lists of runs, with multiplicities."""

    def times(values: Column, value: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == value))

    shared = F.array_intersect(one, other)
    return F.aggregate(
        F.transform(shared, lambda x: F.least(times(one, x), times(other, x))), F.lit(0), lambda total, x: total + x
    )
