"""Language identification: averaged hashed subword embeddings, a linear softmax, and rejection of doubtful texts.

Subwords are runs of two, three and four UTF-8 bytes in lower case, with everything but letters as one
separator. They share a fixed number of buckets. Training is stochastic gradient descent in numpy over a
bounded sample of labelled rows; prediction folds embeddings and softmax into one table of bucket scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwell.llm.texts import BLOCK, flat, fresh_rows, groups, slices

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (2, 3, 4)


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit. ``rows`` bounds the labelled rows used, in expectation."""

    rows: int = 4000
    size: int = 16
    epochs: int = 12
    rate: float = 2.0
    seed: int = 7
    precision: float = 0.999
    least: float = 0.5


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray
    offset: np.ndarray
    threshold: float
    doubt: float = 0.0


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-case bytes, 32 for all but letters. Accented Latin letters are lowered too."""
    out = data.copy()
    ascii_letter = ((out | 32) >= ord("a")) & ((out | 32) <= ord("z"))
    out[ascii_letter] |= 32
    out[(out < 128) & ~ascii_letter] = 32
    if len(out) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 32
    return out


def _buckets(data: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the subword that begins at each byte; 0 where neither of its first two bytes is a letter."""
    wide = np.zeros(len(data) + order, dtype=np.uint32)
    wide[: len(data)] = data
    wide[len(data) :] = 32
    packed = wide[: len(data)].copy()
    for k in range(1, order):
        packed |= wide[k : k + len(data)] << np.uint32(8 * k)
    found = ((packed + np.uint32(order)) * np.uint32(2654435761)) >> np.uint32(32 - 15)
    found = np.maximum(found, 1)
    found[(wide[: len(data)] == 32) & (wide[1 : len(data) + 1] == 32)] = 0
    return found


def _spans(data: np.ndarray) -> Iterator[np.ndarray]:
    """Subword buckets of one text in blocks, so that memory does not grow with the text.

    A separator stands before the text, so that its first letter begins a subword like any other word's.
    """
    if len(data):
        data = np.concatenate([np.array([32], dtype=np.uint8), data])
    for low in range(0, len(data), BLOCK):
        block = _letters(data[max(0, low - 1) : low + BLOCK + max(ORDERS)])[min(low, 1) :]
        for order in ORDERS:
            yield _buckets(block, order)[: min(BLOCK, len(data) - low)]


def counts(data: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in one text."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for found in _spans(data):
        out += np.bincount(found, minlength=BUCKETS)
    out[0] = 0
    return out


def features(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Sparse subword counts of whole texts: ``_at`` buckets and ``_n`` counts; at most one entry per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column(text))
            for row in range(batch.num_rows):
                dense = counts(data[starts[row] : starts[row + 1]])
                at = np.flatnonzero(dense)
                own = [batch.column(c).slice(row, 1) for c in keep]
                lists = [pa.array([at.astype(np.int32)]), pa.array([dense[at].astype(np.int64)])]
                yield pa.RecordBatch.from_arrays([*own, *lists], names=[*keep, "_at", "_n"])

    schema = T.StructType([*(df.schema[c] for c in keep)])
    schema = schema.add("_at", T.ArrayType(T.IntegerType())).add("_n", T.ArrayType(T.LongType()))
    return df.select(*dict.fromkeys([text, *keep])).mapInArrow(run, schema)


def fit(labelled: DataFrame, text: str, label: str, key: str, settings: Training = Training()) -> Model:
    """Train on rows with a label, taken by a hash of ``key`` so that about ``settings.rows`` remain.

    A fifth of them is kept from training, whole and thinned to a few subwords, and sets the temperature of the
    softmax and how much the scores of short texts shrink. The whole ones set the threshold below which a
    prediction is rejected: the lowest one at which the accepted reach ``precision``, and ``least`` at least.
    Without labelled rows the model knows no language.
    """
    usable = labelled.select(F.col(text).alias("t"), F.col(label).alias("y"), F.xxhash64(key).alias("h"))
    usable = usable.filter("t IS NOT NULL AND y IS NOT NULL")
    total = usable.select("y").count()
    share = min(1.0, settings.rows / max(1, total))
    chosen = usable.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = features(chosen, "t", ["y", "h"])
    # The sample is bounded, so one task can hold it; the driver gets the finished model.
    made = sample.repartition(1).mapInArrow(lambda batches: _train(batches, settings), _MODEL).first()
    if made is None:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), settings.least)
    size = len(made["languages"])
    table_ = np.frombuffer(made["table"], np.float32).reshape(BUCKETS, size)
    return Model(tuple(made["languages"]), table_, np.frombuffer(made["offset"], np.float32), made["threshold"], made["doubt"])


_MODEL = "languages array<string>, table binary, offset binary, threshold double, doubt double"


def _train(batches: Iterator[pa.RecordBatch], settings: Training) -> Iterator[pa.RecordBatch]:
    """The model of a bounded sample of subword counts as one row; none without rows that have subwords."""
    rows = sorted(
        (
            (h, y, np.asarray(at), np.asarray(n, dtype=np.float64))
            for batch in batches
            for h, y, at, n in zip(
                batch.column("h").to_pylist(), batch.column("y").to_pylist(), batch.column("_at"), batch.column("_n")
            )
            for at, n in [(at.values, n.values)]
            if len(at)
        ),
        key=lambda r: r[:2],
    )
    if not rows:
        return
    languages = sorted({r[1] for r in rows})
    classes = np.array([languages.index(r[1]) for r in rows])
    places, weights, totals = [r[2] for r in rows], [r[3] / r[3].sum() for r in rows], np.array([r[3].sum() for r in rows])
    held = (np.arange(len(rows)) % 5 == 4) & (len(rows) >= 50)
    rng = np.random.default_rng(settings.seed)
    embed = rng.uniform(-0.5, 0.5, (BUCKETS, settings.size)) / settings.size
    weight = np.zeros((settings.size, len(languages)))
    offset = np.zeros(len(languages))
    train = np.flatnonzero(~held)
    steps, done = settings.epochs * len(train), 0
    for _ in range(settings.epochs):
        for row in rng.permutation(train):
            rate = settings.rate * (1 - done / steps)
            done += 1
            at, share_of = places[row], weights[row]
            mean = share_of @ embed[at]
            scores = mean @ weight + offset
            chance = np.exp(scores - scores.max())
            chance /= chance.sum()
            chance[classes[row]] -= 1
            back = weight @ chance
            weight -= rate * np.outer(mean, chance)
            offset -= 0.1 * rate * chance
            # Rare subwords of a long text would hardly move under their mean weight alone.
            embed[at] -= rate * len(at) * share_of[:, None] * back[None, :] / max(1.0, np.sqrt(len(at)))
    folded = embed @ weight
    tuned = np.flatnonzero(held) if held.any() else train
    whole = np.stack([weights[r] @ folded[places[r]] for r in tuned])
    many = totals[tuned]
    few = rng.integers(4, 60, len(tuned))
    thinned = np.stack([rng.multinomial(k, weights[r]) / k @ folded[places[r]] for r, k in zip(tuned, few)])
    both, number, answers = np.vstack([whole, thinned]), np.concatenate([many, few]), np.tile(classes[tuned], 2)
    choices = [(t, k) for t in np.geomspace(0.05, 20, 40) for k in (0, 4, 8, 16, 32, 64)]
    losses = [_loss(_shrunk(both, number, k) / t + offset / t, answers) for t, k in choices]
    temperature, doubt = choices[int(np.argmin(losses))]
    chance = _softmax((_shrunk(whole, many, doubt) + offset) / temperature)
    best, right = chance.max(axis=1), chance.argmax(axis=1) == classes[tuned]
    order = np.argsort(-best)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= settings.precision
    lowest = 0.0 if good[-1] else (best[order][np.flatnonzero(good)[-1]] if good.any() else 1.0)
    folded[0] = 0
    threshold = max(settings.least, min(float(lowest), 0.9))
    arrays = [(folded / temperature).astype(np.float32).tobytes(), (offset / temperature).astype(np.float32).tobytes()]
    values = [[languages], [arrays[0]], [arrays[1]], [threshold], [float(doubt)]]
    columns = [pa.array(v) for v in values]
    yield pa.RecordBatch.from_arrays(columns, names=["languages", "table", "offset", "threshold", "doubt"])


def _shrunk(scores: np.ndarray, number: np.ndarray, doubt: float) -> np.ndarray:
    """Mean scores weigh less the fewer subwords they come from."""
    return scores * (number / (number + doubt + 1e-9))[:, None]


def _softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def _loss(scores: np.ndarray, classes: np.ndarray) -> float:
    return float(-np.log(_softmax(scores)[np.arange(len(classes)), classes] + 1e-12).mean())


def _scores(data: np.ndarray, starts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Mean bucket scores per text, and the number of subwords."""
    sums = np.zeros((len(starts) - 1, len(model.languages)))
    number = np.zeros(len(starts) - 1)
    for first, last in groups(starts):
        if last - first == 1:
            for found in _spans(data[starts[first] : starts[last]]):
                sums[first] += model.table[found].sum(axis=0, dtype=np.float64)
                number[first] += np.count_nonzero(found)
            continue
        # Texts stand between separators, so that no subword runs into the next one.
        own, places = fresh_rows(data, starts, first, last)
        filled = np.flatnonzero(np.diff(places))
        if not len(filled):
            continue
        letters = _letters(own)
        for order in ORDERS:
            found = _buckets(letters, order)
            sums[first + filled] += np.add.reduceat(model.table[found], places[filled], axis=0)
            number[first + filled] += np.add.reduceat((found > 0).astype(np.int64), places[filled])
    return sums, number


def predict(
    df: DataFrame,
    model: Model,
    text: str = "text",
    language: str = "lang_pred",
    score: str = "score",
    rejected: str = "rejected",
) -> DataFrame:
    """Add the likeliest language, its calibrated probability and whether the prediction is rejected.

    NULL texts and texts without a letter get ``und``, score 0 and are rejected. All rows and other columns
    stay; columns named like an output are replaced. Only ``text`` is looked at.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    added = (language, score, rejected)
    kept = [c for c in df.columns if c not in added]
    has_letter = fresh_flag(df)
    marked = df.select(*kept).withColumn(has_letter, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (part for whole in batches for part in slices(whole, text)):
            data, starts = flat(batch.column(text))
            lettered = batch.column(has_letter).to_numpy(zero_copy_only=False)
            if known.languages:
                sums, number = _scores(data, starts, known)
                means = sums / np.maximum(number, 1)[:, None]
                chance = _softmax(_shrunk(means, number, known.doubt) + known.offset)
                best, top = chance.max(axis=1), chance.argmax(axis=1)
                names = np.array([*known.languages, UNKNOWN], dtype=object)
                names = names[np.where(lettered, top, len(known.languages))]
                best = np.where(lettered, best, 0.0)
            else:
                names, best = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            outputs = [pa.array(names, pa.string()), pa.array(best), pa.array(best < known.threshold)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *outputs], names=[*kept, *added])

    schema = T.StructType([df.schema[c] for c in kept])
    schema = schema.add(language, T.StringType()).add(score, T.DoubleType()).add(rejected, T.BooleanType())
    return marked.mapInArrow(run, schema)


def fresh_flag(df: DataFrame) -> str:
    """A name for a helper column that the input does not have."""
    name = "_has_letter"
    while name in df.columns:
        name += "_"
    return name


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL keys have none."""
    return F.crc32(key.cast("string").cast("binary")) % parts
