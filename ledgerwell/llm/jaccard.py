"""N-gram Jaccard join: prefixes under several global orders of the shingles, then exact verification.

If two sets are similar enough, they share a shingle among the first few of each under any order of all shingles. The
first order puts shingles that many documents hold last, so the lists of documents that share a prefix shingle stay
short; pairs from it must also share prefix shingles under two other orders before their sets are compared. Equal
sets are one node. Only components are asked for, so documents that share a shingle are first linked through a few
pivots, and after that only pairs from different components are looked at; each once, at its first shared shingle, and
only if a parity sketch of both sets allows the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwell.llm.common import checkpointed, components, fresh, release
from ledgerwell.llm.filters import filter_of
from ledgerwell.llm.texts import flat, groups, mixed, shingles, slices, word_hashes

SKETCH = 512
WORDS = SKETCH // 64
#: Tables of at most this many short rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Join:
    """``size`` words per shingle; linked from ``percent`` of the union on.

    ``frequent`` bounds the shingles whose counts order the first prefix, ``pivots`` the documents of each list that all
    others are compared with in a round, ``rounds`` those rounds. None of them changes the result.
    """

    size: int = 4
    percent: int = 85
    frequent: int = 1_000_000
    pivots: int = 3
    rounds: int = 2


def _distinct(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts, sorted by text, and where each text's begin."""
    found, places = shingles(*word_hashes(data, starts), size)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(places))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(starts)))


def _sets(batch: pa.RecordBatch, text: str, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Distinct shingles of some texts at a time: first row, last row, shingles sorted by text, where each begins."""
    data, starts = flat(batch.column(text))
    for first, last in groups(starts):
        yield first, last, *_distinct(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], size)


def frequent_shingles(docs: DataFrame, text: str, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and how many documents hold them, at most ``join.frequent``.

    Each task counts its shingles in portions of bounded size and passes on those that it met twice; a shingle of many
    documents is met twice in most portions. The counts only order the shingles.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0

        def flush() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times > 1
            columns = [pa.array(values[often].view(np.int64)), pa.array(times[often].astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["shingle", "times"])

        for batch in batches:
            for _, _, found, _ in _sets(batch, text, join.size):
                held.append(found)
                number += len(found)
                if number >= 1 << 22:
                    yield flush()
                    held, number = [], 0
        if number:
            yield flush()

    counted = docs.select(text).mapInArrow(count, "shingle long, times long")
    totals = checkpointed(counted.groupBy("shingle").agg(F.sum("times").alias("times")))
    powers = F.floor(F.log2("times")).cast("int").alias("power")
    ladder = dict(totals.groupBy(powers).count().collect())
    least, room = 64, join.frequent
    while least > 0 and ladder.get(least - 1, 0) <= room:
        least -= 1
        room -= ladder.get(least, 0)
    chosen = totals.filter(F.col("times") >= F.lit(2.0) ** least).toArrow()
    values = chosen.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], chosen.column("times").to_numpy()[order].astype(np.float64)


def _ranks(found: np.ndarray, values: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each shingle occurs, 0 if it is not among the frequent ones."""
    if not len(values):
        return np.zeros(len(found))
    at = np.minimum(np.searchsorted(values, found), len(values) - 1)
    return np.where(values[at] == found, times[at], 0.0)


def _prefixes(found: np.ndarray, places: np.ndarray, keys: tuple[np.ndarray, ...], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set under an order (the last key counts most), and where each prefix begins."""
    sizes = np.diff(places)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((*keys, owner))
    lengths = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
    position = np.arange(len(found)) - np.repeat(places[:-1], sizes)
    chosen = position < np.repeat(lengths, sizes)
    out = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return found[order][chosen], out


def _salted(found: np.ndarray, salt: int) -> np.ndarray:
    return mixed(found ^ mixed(np.array([salt], dtype=np.uint64))[0])


def _lists(values: np.ndarray, places: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values.view(np.int64)))


def _described(docs: DataFrame, frequent, join: Join) -> DataFrame:
    """For each document (``row``, ``id``, ``text``): size ``n`` of its set, its hash ``node``, ``sketch`` and first ``prefix``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, times = frequent.value
        for batch in batches:
            for first, last, found, places in _sets(batch, "text", join.size):
                count, sizes = last - first, np.diff(places)
                owner = np.repeat(np.arange(count), sizes)
                sums = np.zeros(len(found) + 1, dtype=np.uint64)
                np.cumsum(_salted(found, 1), out=sums[1:])
                node = mixed((sums[places[1:]] - sums[places[:-1]]) ^ mixed(sizes.astype(np.uint64)))
                bits = np.bincount(owner * SKETCH + (found & np.uint64(SKETCH - 1)).astype(np.int64), minlength=count * SKETCH)
                packed = np.packbits((bits & 1).astype(np.uint8)).view(np.uint64)
                ranks = _ranks(found, values, times)
                prefix, starts = _prefixes(found, places, (_salted(found, 2), ranks), join.percent)
                columns = [
                    batch.column("row").slice(first, count),
                    batch.column("id").slice(first, count),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(node.view(np.int64), mask=sizes == 0),
                    _lists(packed, np.arange(count + 1) * WORDS),
                    _lists(prefix, starts),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n", "node", "sketch", "prefix"])

    schema = T.StructType([docs.schema["row"], docs.schema["id"]])
    longs = T.ArrayType(T.LongType())
    schema = schema.add("n", T.LongType()).add("node", T.LongType()).add("sketch", longs).add("prefix", longs)
    return docs.select("row", "id", "text").mapInArrow(run, schema)


def _similar(pairs: DataFrame, frequent, join: Join) -> DataFrame:
    """The pairs (``a``, ``b``) that share prefixes under two more orders, rarity classes and none, and are similar enough.

    Both texts are turned into sets where they meet: they take less room on the way than their sets.
    """

    def overlap(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], k: int) -> int:
        own = [values[places[k] : places[k + 1]] for values, places in (one, two)]
        return len(np.intersect1d(*own, assume_unique=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, times = frequent.value
        for part in (p for batch in batches for p in slices(batch, "text_a")):
            sets, seconds, thirds = [], [], []
            for side in ("text_a", "text_b"):
                found, places = _distinct(*flat(part.column(side)), join.size)
                classes = np.floor(np.log2(_ranks(found, values, times) + 1))
                sets.append((found, places))
                seconds.append(_prefixes(found, places, (_salted(found, 3), classes), join.percent))
                thirds.append(_prefixes(found, places, (_salted(found, 4),), join.percent))
            sizes = np.diff(sets[0][1]) + np.diff(sets[1][1])
            good = np.zeros(part.num_rows, dtype=bool)
            for k in range(part.num_rows):
                if overlap(*seconds, k) and overlap(*thirds, k):
                    common = overlap(*sets, k)
                    good[k] = 100 * common >= join.percent * (sizes[k] - common)
            yield part.select(["a", "b"]).filter(pa.array(good))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _sizes_allow(join: Join) -> Column:
    return F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * join.percent


def _sketches_allow(join: Join, x: str = "x.", y: str = "y.") -> Column:
    """At most (100 - p) / (100 + p) of both sizes together can differ, and each differing shingle flips one bit."""
    p = join.percent
    flips = sum((F.bit_count(F.col(f"{x}sketch")[k].bitwiseXOR(F.col(f"{y}sketch")[k])) for k in range(WORDS)), F.lit(0))
    return flips * (100 + p) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (100 - p)


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table of short rows, broadcast if they are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _narrowed(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The nodes whose lists (``mine``) hold a wanted ``shingle``, with those shingles and few others.

    The wanted ones travel as a filter of fixed size, so the lists stay where they are.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(filter_of(wanted, "shingle"))
    others = [c for c in nodes.columns if c != "mine"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("mine")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            met = shared.value.holds(values.view(np.uint64))
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(met)])[np.concatenate([[0], np.cumsum(lengths)])]
            kept = _lists(values[met].view(np.uint64), before)
            rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), kept], names=[*others, "mine"])
            yield rows.filter(pa.array(np.diff(before) > 0))

    schema = T.StructType([nodes.schema[c] for c in (*others, "mine")])
    return nodes.mapInArrow(run, schema)


def _described_and_linked(docs: DataFrame, key: str, text: str, join: Join) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Documents (``row``, ``id``, ``n``, ``node``), the distinct nodes, and those that link with their component, if any."""
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows, "text", join))
    described = checkpointed(_described(rows, frequent, join))
    documents = checkpointed(described.select("row", "id", "n", "node"))
    nodes = checkpointed(documents.filter("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row"), F.min("id").alias("id")))
    described = described.filter("node IS NOT NULL").select("node", "n", "sketch", F.col("prefix").alias("mine"))
    postings = described.select("node", F.explode("mine").alias("shingle"))
    several = postings.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    # A node's shingles that other nodes have among their first ones too; equal sets keep the same.
    shared = _narrowed(described, several)
    one = shared.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("mine").alias("mine"))
    one = checkpointed(one)
    del described, postings, several, shared
    release(spark)
    linked = None if one.isEmpty() else _linked(rows, nodes, one, frequent, join)
    return documents, nodes, linked


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id``.

    A document's set holds the runs of ``join.size`` words; a shorter text is one run. Words are what stands between
    spaces and the characters 9 to 13, A-Z in lower case. NULL texts and texts without words have no shingles and link
    with nothing. ``component_id`` is the smallest key reachable by links; documents of equal sets are linked.
    Repeated rows stay. A NULL key never names a component that has another key. Other columns do not matter.
    """
    documents, nodes, linked = _described_and_linked(docs, key, text, join)
    out = documents if linked is None else documents.join(linked.withColumnRenamed("component", "c"), "node", "left")
    named = F.col("node") if linked is None else F.coalesce("c", "node")
    least = nodes if linked is None else nodes.join(linked.withColumnRenamed("component", "c"), "node", "left")
    least = checkpointed(least.select(named.alias("of"), "id").groupBy("of").agg(F.min("id").alias("least")))
    out = out.select("id", "n", named.alias("of")).join(least, "of", "left")
    component = F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _linked(rows: DataFrame, nodes: DataFrame, one: DataFrame, frequent, join: Join) -> DataFrame | None:
    """(``node``, ``component``) of all nodes that link with another; None without candidates."""
    spark = rows.sparkSession
    labels = one.select("node", F.col("node").alias("label"))
    links = joined = None
    for number in range(join.rounds + 1):
        one = _undecided(one, labels)
        if one.isEmpty():
            break
        release(spark)
        pairs = _pairs(one, labels, number, join)
        release(spark)
        found = _verified(rows, nodes, pairs, frequent, join)
        links = found if links is None else links.unionByName(found)
        del pairs
        release(spark)
        joined = checkpointed(components(links, "a", "b"))
        labels = one.select("node").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
        labels = checkpointed(labels)
        release(spark)
    return joined


def _undecided(one: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes without the shingles whose holders are all in one component: those have nothing more to tell."""
    posts = one.join(_small(labels), "node").select("label", F.explode("mine").alias("shingle"))
    spread = posts.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return checkpointed(_narrowed(one, spread))


def _pairs(one: DataFrame, labels: DataFrame, number: int, join: Join) -> DataFrame:
    """Pairs of nodes (``a``, ``b``) of different components to be compared in a round.

    At first each node with the one pivot of its shingles that it shares most of them with; in the last round all
    that are left.
    """
    labelled = one.join(_small(labels), "node")
    same, apart = F.col("x.shingle") == F.col("y.shingle"), F.col("x.label") != F.col("y.label")
    if number == join.rounds:
        full = labelled.select("node", "n", "label", "sketch", F.explode("mine").alias("shingle"))
        fits = (F.col("x.node") < F.col("y.node")) & apart & _sizes_allow(join) & _sketches_allow(join)
        pairs = full.alias("x").join(full.alias("y"), same & fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        return checkpointed(pairs.distinct())
    # Pivots: the holders whose hashes are least once some bits are turned over, others in each round. Only these
    # numbers are counted for each shingle; the rest of a pivot is looked up afterwards.
    posts = labelled.select("node", "n", "label", F.explode("mine").alias("shingle"))
    turned = [F.xxhash64(F.lit(number * join.pivots + k)) for k in range(join.pivots)]
    pivots = posts.groupBy("shingle").agg(*(F.min(F.col("node").bitwiseXOR(t)).alias(f"p{k}") for k, t in enumerate(turned)))
    back = F.array_distinct(F.array(*(F.col(f"p{k}").bitwiseXOR(t) for k, t in enumerate(turned))))
    pivots = pivots.select("shingle", F.explode(back).alias("node")).join(_small(labelled.select("node", "n", "label")), "node")
    met = posts.alias("x").join(pivots.alias("y"), same & apart & _sizes_allow(join))
    shared = met.groupBy(F.col("x.node").alias("own"), F.col("y.node").alias("pivot")).agg(F.count(F.lit(1)).alias("shared"))
    sketches = one.select("node", "n", "sketch")
    both = shared.join(sketches.alias("x"), F.col("own") == F.col("x.node")).join(sketches.alias("y"), F.col("pivot") == F.col("y.node"))
    best = F.max(F.struct("shared", "pivot"))["pivot"].alias("pivot")
    chosen = both.filter(_sketches_allow(join)).select("own", "pivot", "shared").groupBy("own").agg(best)
    return checkpointed(chosen.select(F.least("own", "pivot").alias("a"), F.greatest("own", "pivot").alias("b")).distinct())


def _verified(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, frequent, join: Join) -> DataFrame:
    """The pairs of nodes (``a``, ``b``) that also share prefixes under the other orders and are similar enough."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = checkpointed(asked.join(nodes, "node").select("node", "row"))
    # Equal rows are reduced to one text for each node.
    texts = rows.select("row", "text").join(_small(wanted), "row").dropDuplicates(["node"]).select("node", "text")
    both = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    both = both.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    return checkpointed(_similar(both, frequent, join))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """One row of each linked group, that of the smallest key, a NULL key last; all columns stay.

    Rows count by key and text: a clean row that shares its key with a copy stays. Of equal keys the smallest row hash
    stays, and of rows that repeat key and text one does. Rows without words stay.
    """
    documents, _, linked = _described_and_linked(docs, key, text, join)
    documents = documents.filter("node IS NOT NULL").select("row", "id", "node")
    if linked is None:
        documents = documents.withColumn("of", F.col("node"))
    else:
        joined = documents.join(linked.withColumnRenamed("component", "c"), "node", "left")
        documents = joined.withColumn("of", F.coalesce("c", "node"))
    documents = checkpointed(documents.select("row", "id", "of"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    kept = documents.groupBy("of").agg(F.min(order)["row"].alias("kept"))
    mark, twice = fresh("row"), fresh("twice")
    gone = documents.join(kept, "of").filter("row <> kept").select(F.col("row").alias(mark)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(key, text))
    left = marked.join(_small(checkpointed(gone)), mark, "left_anti")
    times = documents.groupBy("row").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    repeated = _small(checkpointed(times.select(F.col("row").alias(mark), F.lit(True).alias(twice))))
    # Few rows are repeated; only they are reduced, before any shuffle of their texts.
    split = left.join(repeated, mark, "left")
    once = split.filter(F.col(twice)).dropDuplicates([mark])
    return split.filter(F.col(twice).isNull()).unionByName(once).select(*docs.columns)
