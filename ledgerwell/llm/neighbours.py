"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits its nodes along random projections, some levels in each Spark round, at the sparsest place between the
quartiles; vectors within a margin of it go to both sides. A node is a leaf when it is small, or when several
directions leave nearly all of it on both sides: then it is one tight cluster. Vectors are compared within leaves in
double precision; large leaves are compared block by block. A pair that meets in several leaves counts in the first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed, components


@dataclass(frozen=True)
class Forest:
    """``trees`` and their ``leaf`` size; ``margin`` in standard deviations of a projected random unit vector.

    A node is split no further after ``tries`` directions that each leave more than ``same`` of it on a side. Splits are
    fitted on about ``sample`` vectors of a node, ``depth`` levels at a time; every vector goes down them.
    Leaves above ``block`` vectors are compared in blocks of that size.
    """

    trees: int = 4
    leaf: int = 192
    margin: float = 0.16
    same: float = 0.85
    tries: int = 3
    block: int = 256
    depth: int = 5
    sample: int = 2000
    salts: int = 32
    seed: int = 5


def _usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=kind).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _direction(forest: Forest, node: int, split: int, attempt: int, size: int) -> np.ndarray:
    """A random direction on which unit vectors have a standard deviation of about one."""
    seed = xxhash.xxh3_64_intdigest(f"{forest.seed}/{node}/{split}/{attempt}")
    drawn = np.random.default_rng(seed).normal(size=size)
    return drawn * (np.sqrt(size) / np.linalg.norm(drawn))


def _place(values: np.ndarray, forest: Forest) -> tuple[float, int, int]:
    """The place between the quartiles with the fewest values around it, and how many fall to each side."""
    ordered = np.sort(values)
    steps = ordered[np.linspace(len(ordered) // 4, 3 * len(ordered) // 4, 41).astype(int)]
    low = np.searchsorted(ordered, steps + forest.margin, side="right")
    high = len(ordered) - np.searchsorted(ordered, steps - forest.margin, side="left")
    k = min(range(len(steps)), key=lambda k: (low[k] + high[k], abs(k - 20)))
    return float(steps[k]), int(low[k]), int(high[k])


def _grow(vectors: np.ndarray, number: int, node: int, forest: Forest) -> str:
    """Several levels of splits for a node of ``number`` vectors, from a sample of them.

    JSON: ``splits`` of (attempt, place, below, above) and ``tight`` leaves; a reference below zero is a leaf.
    """
    unit, splits, tight = _unit(vectors), [], []
    leaves_, todo = 0, [(np.arange(len(unit)), None, 0)]
    while todo:
        rows, parent, depth = todo.pop()
        found = None
        if len(rows) * number > forest.leaf * len(unit) and len(rows) >= 24 and depth < forest.depth:
            for k in range(forest.tries):
                values = unit[rows] @ _direction(forest, node, len(splits), k, unit.shape[1])
                place, low, high = _place(values, forest)
                if max(low, high) <= forest.same * len(rows):
                    found = (k, round(place, 4), values)
                    break
            else:
                tight.append(leaves_)
        if found is None:
            reference, leaves_ = -1 - leaves_, leaves_ + 1
        else:
            reference = len(splits)
            splits.append([found[0], found[1], None, None])
            todo.append((rows[found[2] <= found[1] + forest.margin], (reference, 2), depth + 1))
            todo.append((rows[found[2] >= found[1] - forest.margin], (reference, 3), depth + 1))
        if parent is not None:
            splits[parent[0]][parent[1]] = reference
    return json.dumps({"splits": splits, "tight": tight}, separators=(",", ":"))


def _descend(vectors: np.ndarray, node: int, plan: dict, forest: Forest) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves of a plan with the rows that reach them."""
    unit = _unit(vectors)
    todo = [(0 if plan["splits"] else -1, np.arange(len(unit)))]
    while todo:
        reference, rows = todo.pop()
        if not len(rows):
            continue
        if reference < 0:
            yield -1 - reference, rows
            continue
        attempt, place, below, above = plan["splits"][reference]
        values = unit[rows] @ _direction(forest, node, reference, attempt, unit.shape[1])
        todo.append((below, rows[values <= place + forest.margin]))
        todo.append((above, rows[values >= place - forest.margin]))


def leaves(points: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Leaves (``rep``, ``leaf``) of distinct vectors (``rep``, ``part``, ``vector``); parts are never mixed.

    In each round every node with more than ``forest.leaf`` vectors is split over several levels, fitted on about
    ``forest.sample`` of its vectors, and all its vectors go down. A round divides a node by up to 2 ** ``depth``.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")
    active = points.select("rep", "part", "vector", trees)
    active = checkpointed(active.select("rep", F.xxhash64("tree", "part").alias("node"), "vector"))
    salt = F.pmod(F.xxhash64("rep"), F.lit(forest.salts)).cast("int").alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(forest.salts - 1))).alias("salt")
    done = []

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep", kind="stable")
        node, number = int(group["node"].iloc[0]), int(group["n"].iloc[0])
        plan = _grow(np.stack(group["vector"].to_numpy()).astype(np.float64), number, node, forest)
        return pd.DataFrame({"node": [node], "plan": [plan]})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for node in np.unique(nodes):
                own = batch.take(pa.array(np.flatnonzero(nodes == node)))
                plan = json.loads(own.column("plan")[0].as_py())
                for leaf, rows in _descend(_matrix(own.column("vector")), int(node), plan, forest):
                    part = own.take(pa.array(rows))
                    child = xxhash.xxh3_64_intdigest(f"{node}/{leaf}") - (1 << 63)
                    columns = [
                        part.column("rep"),
                        pa.array(np.full(len(rows), child, dtype=np.int64)),
                        part.column("vector"),
                        pa.array(np.full(len(rows), leaf in plan["tight"])),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["rep", "node", "vector", "final"])

    while True:
        sizes = active.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        large = checkpointed(sizes.filter(F.col("n") > forest.leaf))
        marked = active.select("*", salt).join(large.select("*", every), ["node", "salt"], "left")
        done.append(marked.filter("n IS NULL").select("rep", F.col("node").alias("leaf")))
        if large.isEmpty():
            break
        sampled = marked.filter(F.pmod(F.xxhash64("node", "rep"), F.col("n")) < forest.sample)
        plans = checkpointed(sampled.groupBy("node").applyInPandas(grow, "node long, plan string"))
        planned = active.select("*", salt).join(plans.select("*", every), ["node", "salt"]).drop("salt")
        routed = checkpointed(planned.mapInArrow(route, "rep long, node long, vector array<double>, final boolean"))
        done.append(routed.filter("final").select("rep", F.col("node").alias("leaf")))
        active = routed.filter("NOT final").drop("final")
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return checkpointed(out)


def near(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    part: str = "label",
    least: float = 0.98,
    forest: Forest = Forest(),
) -> DataFrame:
    """One row per input row: ``key``, ``n_links``, ``component_id``, ``kept``.

    Rows with equal, non-NULL ``part`` link when the cosine of their vectors is ``least`` or more. Vectors that are NULL
    or zero or hold NULL or non-finite components link with nothing, and vectors of different lengths never link.
    Equal vectors are one point with a count, so copies cost nothing more; each copy links with the others.
    ``n_links`` counts rows, ``component_id`` is the smallest key reachable. A row with a NULL key is never kept.
    An empty table gives no rows; columns other than these three do not matter.
    """
    rows = df.select(
        F.col(key).alias("id"),
        F.col(part).alias("of"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    good = F.col("of").isNotNull() & _usable(F.col("v"))
    rows = rows.withColumn("v", F.when(good, F.transform("v", lambda x: x + F.lit(0.0))))
    marked = rows.withColumns(
        {"a": F.when(good, F.xxhash64("of", "v")), "b": F.when(good, F.xxhash64(F.lit(1), "of", "v"))}
    )
    classes = marked.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("of").alias("of"), F.first("v").alias("vector")
    )
    # A class without any key still needs a number of its own.
    classes = checkpointed(classes.withColumn("name", F.col("rep")).withColumn("rep", F.coalesce("rep", "a")))
    points = classes.select("rep", "size", "vector", F.xxhash64("of", F.size("vector")).alias("part"))
    placed = leaves(points.select("rep", "part", "vector"), forest)
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    sizes = checkpointed(sizes.filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / forest.block).cast("int")))
    number = F.pmod(F.xxhash64("rep", "leaf"), F.lit(1 << 20)).cast("int")
    member = placed.join(sizes.select("leaf", "blocks"), "leaf").withColumn("block", F.pmod(number, F.col("blocks")))
    # Each member goes to every pair of blocks that holds its own.
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = member.select("rep", "leaf", "block", others)
    spread = spread.select("rep", "leaf", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    homes = placed.groupBy("rep").agg(F.sort_array(F.collect_list("leaf")).alias("homes"))
    full = spread.join(points.select("rep", "size", "vector").join(homes, "rep"), "rep")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep", kind="stable")
        unit = _unit(np.stack(group["vector"].to_numpy()).astype(np.float64))
        ids, sizes_, blocks = (group[c].to_numpy() for c in ("rep", "size", "block"))
        leaf, i, j = (int(group[c].iloc[0]) for c in ("leaf", "i", "j"))
        first, second = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        met = unit[first] @ unit[second].T >= least
        met &= ids[first][:, None] != ids[second][None, :]
        if i == j:
            met = np.triu(met)
        a, b = np.nonzero(met)
        a, b = first[a], second[b]
        homes_ = group["homes"].to_numpy()
        if len(a):
            # Where several leaves hold both, only the first counts the pair.
            sets = [frozenset(h.tolist()) for h in homes_]
            own = np.fromiter((min(sets[x] & sets[y]) == leaf for x, y in zip(a, b)), dtype=bool, count=len(a))
            a, b = a[own], b[own]
        links = np.bincount(a, sizes_[b], len(ids)) + np.bincount(b, sizes_[a], len(ids))
        root = np.arange(len(ids))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        linked = np.flatnonzero(links)
        to = [find(x) for x in linked.tolist()]
        return pd.DataFrame({"rep": ids[linked], "links": links[linked].astype(np.int64), "root": ids[to]})

    found = checkpointed(full.groupBy("leaf", "i", "j").applyInPandas(compare, "rep long, links long, root long"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "root")
    per_class = (
        classes.join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .join(classes.select(F.col("rep").alias("component"), F.col("name").alias("named")), "component", "left")
    )
    per_class = per_class.select(
        "a",
        "b",
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("named", "name").alias("component_id"),
    )
    out = marked.select("id", "a", "b").join(checkpointed(per_class), ["a", "b"], "left")
    own = F.when(F.col("a").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"),
    )
