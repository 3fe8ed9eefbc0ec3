"""Collocations: phrases whose words stand together more often than their parts would suggest.

Every run of words gets a Rabin-Karp fingerprint from prefix polynomials. A shuffle adds up the occurrences of each
fingerprint; a run can be frequent only if the two shorter runs in it are, so lengths are counted one after the other.
With the occurrences a second, independent print is added up; of frequent fingerprints a pointer to the first
occurrence is gathered. Sums that are no multiple of its print tell a collision, and those phrases are counted again by
their texts. Only frequent phrases are ever materialised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed, lower_ascii
from ledgerwell.llm.filters import Filter, filter_of, paired
from ledgerwell.llm.texts import LOWER, flat, groups, mixed

BREAKS = np.zeros(256, dtype=bool)
BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAPS = BREAKS.copy()
GAPS[[0x20, 0x09]] = True
#: Runs that a task holds before it adds them up.
PORTION = 1 << 22
#: Tables of at most this many short rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``words`` words that occur ``least`` times, without those that stand in a longer one in ``inside``
    percent of their occurrences, and the best ``top`` of each language. ``mask`` shortens fingerprints, for tests."""

    words: int = 4
    least: int = 30
    inside: int = 80
    top: int = 2000
    mask: int = (1 << 64) - 1


class Prints:
    """One family of fingerprints: letters to numbers, and the base of the polynomials."""

    def __init__(self, seed: int):
        salt = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        self.letters = mixed(salt + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64)))[LOWER]
        self.base = (0x9E3779B97F4A7C15 + 2 * seed * 0x2545F4914F6CDD1D) % (1 << 64) | 1
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base modulo 2**64 and of its inverse."""
        if len(self.up) < size:
            size = 1 << size.bit_length()
            steps = [np.full(size, x, dtype=np.uint64) for x in (self.base, pow(self.base, -1, 1 << 64))]
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.cumprod(step, dtype=np.uint64) for step in steps)
        return self.up, self.down

    def spans(self, values: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        """Polynomial of each range of values, whatever its place, from prefix polynomials."""
        up, down = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return (sums[lasts] - sums[firsts]) * down[firsts]

    def words(self, data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        return mixed(self.spans(self.letters[data], firsts, lasts) + (lasts - firsts).astype(np.uint64))


FIRST, SECOND = Prints(0), Prints(1)


@dataclass
class Words:
    """Words of some texts in order."""

    data: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray
    piece: np.ndarray  # number of the piece of each word; pieces of different texts differ
    text: np.ndarray  # number of the text of each word

    def runs(self, size: int) -> np.ndarray:
        """Where runs of ``size`` words begin that lie in one piece."""
        count = max(0, len(self.firsts) - size + 1)
        return np.flatnonzero(self.piece[:count] == self.piece[size - 1 : size - 1 + count])


def find_words(data: np.ndarray, starts: np.ndarray) -> Words:
    inside = ~GAPS[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:] | begins[1:]
    firsts, lasts = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(starts, firsts, side="right") - 1
    breaks = np.cumsum(BREAKS[data]) if len(data) else np.zeros(0, dtype=np.int64)
    return Words(data, firsts, lasts, breaks[firsts] + text, text)


def keys_of(words: Words, size: int, at: np.ndarray, prints: Prints, hashes: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs that begin at ``at``, with their length and language mixed in."""
    runs = prints.spans(hashes, at, at + size)
    return mixed(runs ^ mixed(languages[words.text[at]] + np.uint64(size)))


def _language_hash(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, list[str], list[int], np.ndarray]]:
    """Words of some texts at a time, hashes and names of the texts' languages, their row prints and where they begin."""
    for batch in batches:
        data, starts = flat(batch.column("text"))
        names = batch.column("lang").to_pylist()
        hashes = np.array([_language_hash(n) for n in names], dtype=np.uint64)
        rows = batch.column("row").to_numpy()
        for first, last in groups(starts):
            own = starts[first : last + 1] - starts[first]
            words = find_words(data[starts[first] : starts[last]], own)
            yield words, hashes[first:last], names[first:last], rows[first:last], own


def _joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(parts) for parts in zip(*held)]


def _survivors(words: Words, size: int, hashes, languages, shorter: Filter | None, mining: Mining):
    """Places and fingerprints of the runs of ``size`` words of which both shorter runs may be frequent."""
    at = words.runs(size)
    if size > 1:
        ok = np.zeros(len(words.firsts), dtype=bool)
        places = words.runs(size - 1)
        ok[places] = shorter.holds(keys_of(words, size - 1, places, FIRST, hashes, languages) & np.uint64(mining.mask))
        at = at[ok[at] & ok[at + 1]]
    return at, keys_of(words, size, at, FIRST, hashes, languages) & np.uint64(mining.mask)


def _counted(docs: DataFrame, size: int, shorter, mining: Mining) -> DataFrame:
    """Fingerprints (``key``) of runs of ``size`` words that occur often enough.

    ``a`` occurrences, the sum ``s`` of their second prints, and the least ``bucket`` of a text that holds one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shorter.value if shorter else None
        held, number = [], 0

        def portion() -> pa.RecordBatch:
            keys, checks, buckets = _joined(held)
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(first, len(keys)))
            sums, least = np.add.reduceat(checks[order].astype(np.int64), first), np.minimum.reduceat(buckets[order], first)
            columns = [pa.array(x) for x in (keys[first].view(np.int64), counts, sums, least)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "a", "s", "bucket"])

        for words, languages, _, rows, _ in _read(batches):
            hashes = FIRST.words(words.data, words.firsts, words.lasts)
            at, keys = _survivors(words, size, hashes, languages, known, mining)
            if not len(at):
                continue
            held.append([keys, _checks(words, size, at, languages), (rows[words.text[at]] >> 56).astype(np.int8)])
            number += len(keys)
            if number >= PORTION:
                yield portion()
                held, number = [], 0
        if number:
            yield portion()

    found = docs.mapInArrow(run, "key long, a long, s long, bucket byte")
    counts = found.groupBy("key").agg(F.sum("a").alias("a"), F.sum("s").alias("s"), F.min("bucket").alias("bucket"))
    return checkpointed(counts.filter(F.col("a") >= mining.least))


def _checks(words: Words, size: int, at: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """16 bits of the second print of each run."""
    seconds = SECOND.words(words.data, words.firsts, words.lasts)
    return (keys_of(words, size, at, SECOND, seconds, languages) >> np.uint64(48)).astype(np.uint16)


_POINTER = "key long, row long, place long, width long, check long, lang string"


def _pointers(docs: DataFrame, size: int, counts: DataFrame, shorter, mining: Mining) -> DataFrame:
    """The first occurrence of each counted run: the one in the text with the least print.

    Only texts of a run's least bucket are asked for it, so few tasks report the same one.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(filter_of(counts, "key", "bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shorter.value if shorter else None
        held, number, names = [], 0, {}

        def portion() -> pa.RecordBatch:
            keys, rows, places, widths, checks, langs = _joined(held)
            order = np.lexsort((places, rows, keys))
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            columns = [pa.array(x[order][first]) for x in (rows, places, widths, checks.astype(np.int64))]
            of = pa.array([names[x] for x in langs[order][first].tolist()], pa.string())
            fields = [f.split()[0] for f in _POINTER.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), *columns, of], names=fields)

        for words, languages, own, rows, starts in _read(batches):
            hashes = FIRST.words(words.data, words.firsts, words.lasts)
            at, keys = _survivors(words, size, hashes, languages, known, mining)
            met = wanted.value.holds(paired(keys, rows[words.text[at]] >> 56))
            at, keys = at[met], keys[met]
            if not len(at):
                continue
            names |= dict(zip(languages.tolist(), own))
            of = words.text[at]
            places, widths = words.firsts[at] - starts[of], words.lasts[at + size - 1] - words.firsts[at]
            held.append([keys, rows[of], places, widths, _checks(words, size, at, languages), languages[of]])
            number += len(at)
            if number >= PORTION:
                yield portion()
                held, number = [], 0
        if number:
            yield portion()

    first = F.min(F.struct("row", "place", "width", "check", "lang")).alias("first")
    found = docs.mapInArrow(run, _POINTER).groupBy("key").agg(first)
    return counts.drop("bucket").join(found, "key").select("key", "a", "s", "first.*", F.lit(size).alias("size"))


def _texts_of(docs: DataFrame, size: int, wanted, mining: Mining) -> DataFrame:
    """Every run of ``size`` words that ``wanted`` lets through as text, with its count: for fingerprints that collide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, languages, names, *_ in _read(batches):
            hashes = FIRST.words(words.data, words.firsts, words.lasts)
            at = words.runs(size)
            keys = keys_of(words, size, at, FIRST, hashes, languages) & np.uint64(mining.mask)
            met = wanted.value.holds(keys)
            counts: dict[tuple[str, int, bytes], int] = {}
            lower = LOWER[words.data].tobytes()
            for k, key in zip(at[met].tolist(), keys[met].view(np.int64).tolist()):
                phrase = b" ".join([lower[x:y] for x, y in zip(words.firsts[k : k + size], words.lasts[k : k + size])])
                named = (names[words.text[k]], key, phrase)
                counts[named] = counts.get(named, 0) + 1
            langs, keys, texts = zip(*counts) if counts else ((), (), ())
            columns = [pa.array(langs, pa.string()), pa.array(keys, pa.int64()), pa.array([t.decode() for t in texts], pa.string())]
            columns.append(pa.array(list(counts.values()), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "key", "phrase", "a"])

    found = docs.mapInArrow(run, "lang string, key long, phrase string, a long")
    return found.groupBy("lang", "key", "phrase").agg(F.sum("a").alias("a")).withColumn("size", F.lit(size))


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table of short rows, broadcast if they are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()) -> DataFrame:
    """Phrases of 1 to ``mining.words`` words that occur often enough: ``lang``, ``size``, ``phrase``, ``a``."""
    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).alias("text")).filter("text <> ''")
    rows = rows.withColumn("row", F.xxhash64("text"))
    context = docs.sparkSession.sparkContext
    shorter, details = None, None
    for size in range(1, mining.words + 1):
        counts = _counted(rows, size, shorter, mining)
        found = checkpointed(_pointers(rows, size, counts, shorter, mining))
        details = found if details is None else details.unionByName(found)
        shorter = context.broadcast(filter_of(counts, "key"))
    clean = details.filter("s = a * check")
    # The smallest pointers stand in few texts, which are read once each.
    asked = checkpointed(clean.select("lang", "size", "a", "row", "place", "width"))
    sources = rows.select("row", "text").join(_small(checkpointed(asked.select("row").distinct())), "row", "left_semi")
    sources = sources.groupBy("row").agg(F.first("text").alias("text"))
    held = asked.join(sources, "row")
    piece = F.expr("cast(substring(cast(text as binary), cast(place as int) + 1, cast(width as int)) as string)")
    phrase = F.regexp_replace(lower_ascii(piece), "[ \t]+", " ")
    found = held.select("lang", "size", phrase.alias("phrase"), "a")
    collided = checkpointed(details.filter("s <> a * check").select("key", "size"))
    for (size,) in sorted(collided.select("size").distinct().collect()):
        own = collided.filter(F.col("size") == size)
        again = _texts_of(rows, size, context.broadcast(filter_of(own, "key")), mining)
        again = again.join(own, ["key", "size"], "left_semi").filter(F.col("a") >= mining.least)
        found = found.unionByName(again.select("lang", "size", "phrase", "a"))
    return checkpointed(found)


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Number of words of each language: ``lang``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for words, _, names, *_ in _read(batches):
            for name, n in zip(names, np.bincount(words.text, minlength=len(names)).tolist()):
                totals[name] = totals.get(name, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["lang", "n"])

    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).alias("text"), F.lit(0).cast("long").alias("row"))
    return rows.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def _big(column: str) -> Column:
    return F.col(column).cast("decimal(28,0)")


def _part(first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z count as lower case. Texts are cut into pieces at ``.,;:!?`` and line breaks (0x0A to 0x0D), pieces into words at
    spaces and tabs; phrases lie in one piece. ``a`` counts all occurrences, those that overlap too. A phrase cut after a
    word has the counts ``l`` and ``r`` of its parts and the score floor(2000000 a / (l + r)); the cut with the lowest
    score counts, the earliest of several. Phrases that stand in a longer frequent one for most of their occurrences
    are left out. Order: score, ``a``, then the phrase's bytes. NULL texts count as empty, a NULL language as ``und``.
    Other columns do not matter. A language without frequent phrases has no rows.
    """
    phrases = frequent(docs, text, lang, mining)
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("times"))
    candidates = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    size = F.col("size")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "size", "a", "k", _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, size - F.col("k")).alias("right"))
    with_left = sides.join(counts.withColumnsRenamed({"part": "left", "times": "l"}), ["lang", "left"])
    both = with_left.join(counts.withColumnsRenamed({"part": "right", "times": "r"}), ["lang", "right"])
    score = F.expr("cast((cast(a as decimal(28,0)) * 2000000) div (cast(l as decimal(28,0)) + cast(r as decimal(28,0))) as long)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("size").alias("size"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # Shorter phrases within each phrase, with its count.
    inner = candidates.select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2)))).alias("m"))
    inner = inner.filter("m < size").withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    longer = inner.select("lang", "a", _part(F.col("first"), F.col("m")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    joined = scored.join(longer, ["lang", "phrase"], "left")
    within = _big("longer") * 100 >= _big("a") * mining.inside
    left = joined.filter(~F.coalesce(within, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= mining.top)
    best = best.join(word_counts(docs, text, lang), "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
