"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

The cosine features approximate a Gaussian kernel, so a linear fit on them bends around the ways in which texts
go wrong. The normal equations are sums over rows: each task adds up its own and Spark adds up the tasks.
Calibration pools counts of bounded score bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwell.llm.common import checkpointed
from ledgerwell.llm.texts import BLOCK, flat, groups, word_hashes

KINDS = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t\r",
    "line": "\n",
    "stop": ".,;:?",
    "shout": "!",
    "bar": "|",
    "sign": "#$%&*@+=<>~^_/\\`",
    "bracket": "()[]{}'\"-",
}
NAMES = ("other", *KINDS)
CLASS = np.zeros(256, dtype=np.uint8)
for _number, _letters in enumerate(KINDS.values(), start=1):
    CLASS[[ord(c) for c in _letters]] = _number

#: Shares of the kinds of bytes, then shape of words and lines.
STATISTICS = (
    *NAMES,
    "log_bytes",
    "word_length",
    "words_again",
    "words_distinct",
    "lines_per_word",
    "capital_words",
    "words_with_signs",
)


def _of_block(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Statistics of some texts; none of them may be NULL."""
    count, sizes = len(starts) - 1, np.diff(starts)
    out = np.zeros((count, len(STATISTICS)))
    kinds = CLASS[data]
    filled = np.flatnonzero(sizes)
    if len(filled):
        for k in range(len(NAMES)):
            out[filled, k] = np.add.reduceat((kinds == k).astype(np.int32), starts[filled], dtype=np.int64)
    hashes, places = word_hashes(data, starts)
    words = np.diff(places)
    again = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes):
        same = np.zeros(len(hashes), dtype=np.int64)
        same[1:] = hashes[1:] == hashes[:-1]
        same[places[:-1][words > 0]] = 0
        np.cumsum(same, out=again[1:])
    owner = np.repeat(np.arange(count, dtype=np.uint64), words)
    distinct = np.zeros(count)
    if len(hashes):
        order = np.lexsort((hashes, owner))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][first].astype(np.int64), minlength=count).astype(float)
    # Letters after a separator begin a word; signs count once where a run of them begins.
    blank = (kinds == 4) | (kinds == 5)
    begins = ~blank
    begins[1:] &= blank[:-1]
    signs = (kinds == 7) | (kinds == 8) | (kinds == 9)
    signs[1:] &= ~signs[:-1]
    for k, flags in (("capital_words", begins & (kinds == 2)), ("words_with_signs", signs)):
        if len(filled):
            at = STATISTICS.index(k)
            out[filled, at] = np.add.reduceat(flags.astype(np.int32), starts[filled], dtype=np.int64)
    many, size = np.maximum(words, 1), np.maximum(sizes, 1)
    lines = out[:, NAMES.index("line")] + 1
    out[:, -2:] /= many[:, None]
    out[:, : len(NAMES)] /= size[:, None]
    at = len(NAMES)
    out[:, at] = np.log1p(sizes)
    out[:, at + 1] = np.log1p(sizes / many)
    out[:, at + 2] = (again[places[1:]] - again[places[:-1]]) / many
    out[:, at + 3] = distinct / np.sqrt(many)
    out[:, at + 4] = np.log1p(many / lines)
    return out


def statistics(df: DataFrame, text: str = "text", out: str = "statistics", keep: list[str] | None = None) -> DataFrame:
    """Add statistics of the whole text as an array of doubles; NULL counts as empty."""
    kept = [c for c in (df.columns if keep is None else keep) if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column(text))
            parts = [np.zeros((0, len(STATISTICS)))]
            for first, last in groups(starts, BLOCK):
                own = data[starts[first] : starts[last]]
                parts.append(_of_block(own, starts[first : last + 1] - starts[first]))
            values = np.concatenate(parts)
            offsets = np.arange(0, values.size + 1, len(STATISTICS), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, out])

    schema = T.StructType([df.schema[c] for c in kept]).add(out, T.ArrayType(T.DoubleType()))
    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


@dataclass(frozen=True)
class Settings:
    """``features`` random cosines, kernel ``width`` in standard deviations, ridge ``penalty``, ``bins`` of scores."""

    features: int = 192
    width: float = 3.0
    penalty: float = 1.0
    bins: int = 400
    rows_per_task: int = 50_000
    seed: int = 11


@dataclass(frozen=True)
class Model:
    middle: np.ndarray
    spread: np.ndarray
    turns: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def cosines(self, values: np.ndarray) -> np.ndarray:
        scaled = np.clip((values - self.middle) / self.spread, -8, 8)
        waves = np.sqrt(2.0 / len(self.shift)) * np.cos(scaled @ self.turns + self.shift)
        return np.hstack([waves, scaled, np.ones((len(values), 1))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.cosines(values) @ self.weight

    def score(self, values: np.ndarray) -> np.ndarray:
        if not len(self.weight):
            return np.zeros(len(values))
        return np.clip(np.interp(self.raw(values), self.edges, self.levels), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(STATISTICS))


def fit(labelled: DataFrame, key: str, label: str, values: str = "statistics", settings: Settings = Settings()) -> Model:
    """Fit on all labelled rows; three quarters of them (by a hash of ``key``) set the weights, the rest calibrates.

    Labels are 0 or 1; rows without a label or statistics are left out. Without labelled rows every score is 0.
    """
    rows = labelled.select(
        F.col(values).alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(F.col(key)).alias("h")
    ).filter("x IS NOT NULL AND y IS NOT NULL")
    # Few statistics per row: dealt anew into few tasks, so that few sums are added up.
    total = rows.count()
    if total == 0:
        empty = np.zeros(0)
        return Model(empty, empty, np.zeros((0, 0)), empty, empty, empty, empty)
    rows = rows.repartition(max(1, -(-total // settings.rows_per_task)), "h")
    width = len(STATISTICS)
    sums = rows.agg(*(f(F.col("x")[k]).alias(f"{f.__name__}{k}") for k in range(width) for f in (F.avg, F.stddev_pop)))
    found = np.array(sums.first(), dtype=float)
    rng = np.random.default_rng(settings.seed)
    model = Model(
        found[0::2],
        np.maximum(found[1::2], 1e-6),
        rng.normal(0, 1 / settings.width, (width, settings.features)),
        rng.uniform(0, 2 * np.pi, settings.features),
        np.zeros(0),
        np.zeros(0),
        np.zeros(0),
    )
    size = settings.features + width + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((size, size + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                waves = model.cosines(_matrix(part.column("x")))
                whole[:, :size] += waves.T @ waves
                whole[:, size] += waves.T @ np.asarray(part.column("y"))
        i, j = np.indices(whole.shape)
        columns = [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(whole.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    part = F.pmod("h", F.lit(4))
    added = rows.filter(part != 0).select("x", "y").mapInArrow(equations, "i int, j int, v double")
    cells = added.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    whole = np.zeros((size, size + 1))
    whole[cells["i"], cells["j"]] = cells["v"]
    penalty = np.full(size, settings.penalty)
    penalty[-1] = 1e-6
    weight = np.linalg.solve(whole[:, :size] + np.diag(penalty), whole[:, size])
    model = Model(model.middle, model.spread, model.turns, model.shift, weight, np.zeros(0), np.zeros(0))

    low, high = -0.5, 1.5

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column("x"))), low, high)
            at = np.minimum((raw - low) / (high - low) * settings.bins, settings.bins - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y"), pa.array(raw)], names=["b", "y", "r"])

    held = rows.filter(part == 0) if total >= 200 else rows
    counted = held.select("x", "y").mapInArrow(binned, "b int, y double, r double").groupBy("b")
    pooled = counted.agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.avg("r").alias("r")).toPandas()
    if not len(pooled):
        return Model(model.middle, model.spread, model.turns, model.shift, weight, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    edges, levels = isotonic(*(pooled.sort_values("b")[c].to_numpy(dtype=float) for c in ("r", "n", "s")))
    return Model(model.middle, model.spread, model.turns, model.shift, weight, edges, levels)


def isotonic(place: np.ndarray, number: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours until their means rise: centres of the pools and their means, drawn in a little from 0 and 1."""
    pools: list[list[float]] = []
    for x, n, s in zip(place, number, total):
        pools.append([x * n, n, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    edges = np.array([p[0] / p[1] for p in pools])
    levels = np.array([(p[2] + 0.01) / (p[1] + 0.02) for p in pools])
    return edges, np.maximum.accumulate(levels)


def score(df: DataFrame, model: Model, values: str = "statistics", out: str = "score") -> DataFrame:
    """Add the calibrated score of each row's statistics; all rows stay."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (values, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(shared.value.score(_matrix(batch.column(values))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, out])

    schema = T.StructType([df.schema[c] for c in kept]).add(out, T.DoubleType())
    return df.select(*kept, values).mapInArrow(run, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    cut: float = 0.3,
) -> DataFrame:
    """Score every row of ``docs``: ``key``, ``learn``, ``score``, ``predicted`` (1 from ``cut`` on).

    ``labels`` has ``key`` and ``label``; labels of rows for which ``learn`` (an expression over ``key``) holds are
    learned. NULL and empty texts are scored by their statistics like others. Repeated rows stay; a key
    that is NULL is scored and never learned. The statistics of each row are kept in the checkpoint folder, so
    texts are read once.
    """
    found = checkpointed(statistics(docs, text, "statistics", [key]))
    known = labels.select(key, label).filter(F.col(key).isNotNull() & F.col(label).isNotNull()).filter(learn)
    model = fit(found.join(known, key), key, label)
    scored = score(found, model).withColumn("learn", F.coalesce(learn, F.lit(False)))
    return scored.select(key, "learn", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
