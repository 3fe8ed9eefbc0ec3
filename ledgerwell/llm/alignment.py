"""How the tokens of two tokenizers overlap, counted over a corpus.

Both tokenizers cut the same bytes. Where both end a token, a group of tokens ends; every stretch between two ends of
either lies in one token of each, which are linked there. A first pass counts how often each pair of ids is linked:
a minimal perfect hash of the distinct pairs gives each a place in a dense vector of counts, and the vectors of all tasks
are added up as a tree. A second pass aligns the documents again and looks their links up.

The pairs are dealt into shards by the second id. The vocabularies bound a shard, whatever the corpus; the lookup
takes as many shards at a time as a fixed number of pairs allows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwell.llm.common import checkpointed
from ledgerwell.llm.texts import mixed, slices

SPACE = "▁"
SHARDS = 64
#: Bytes of text aligned at a time, and distinct pairs that a task keeps before it passes them on.
SLICE = 8 << 20
PORTION = 1 << 22
#: Two ids as one number.
BASE = 1 << 20


@dataclass(frozen=True)
class Tokenizers:
    """Contents of a byte-level BPE file with its word pattern (A), and of a BPE piece model (B)."""

    bytes_file: bytes
    pattern: str
    pieces_file: bytes


def _alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one past 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Aligned:
    """Texts cut into chunks, each distinct chunk aligned once."""

    chunk_of: np.ndarray  # distinct chunk of each chunk of all texts, in order
    starts: np.ndarray  # where each text's chunks begin
    valid: np.ndarray  # whether both tokenizers give back the text
    n_a: np.ndarray  # of each distinct chunk
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray  # of all links, chunk by chunk
    spelled: list[bytes]  # the groups of each distinct chunk

    def times(self) -> np.ndarray:
        """How often each distinct chunk stands in valid texts."""
        own = self.chunk_of[np.repeat(self.valid, np.diff(self.starts))]
        return np.bincount(own, minlength=len(self.n_links))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.chunk_of) + 1, dtype=np.int64)
        np.cumsum(values[self.chunk_of], out=sums[1:])
        return np.where(self.valid, sums[self.starts[1:]] - sums[self.starts[:-1]], 0)

    def per_chunk(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each distinct chunk."""
        sums = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum(values, out=sums[1:])
        ends = np.cumsum(self.n_links)
        return sums[ends] - sums[ends - self.n_links]


class Aligner:
    """Both tokenizers over chunks of text; built once in each Python worker.

    A chunk begins at white space that follows another character and whose first character is a space or a line
    break. Neither tokenizer has a token that continues over such a place, which is checked for the pieces.
    """

    CHUNK = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")

    def __init__(self, files: Tokenizers):
        vocabulary = json.loads(files.bytes_file)
        alphabet = _alphabet()
        special = {t["content"] for t in vocabulary["added_tokens"]}
        plain = {t: i for t, i in vocabulary["model"]["vocab"].items() if t not in special}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in plain.items()}
        self.a = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(plain.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces_file)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace(SPACE, " ").encode())
                if piece.strip(SPACE) and (SPACE in piece[1:].lstrip(SPACE) or piece.startswith(SPACE * 2) or "\n" in piece[1:]):
                    raise ValueError("pieces of this vocabulary continue over spaces or lines")
        self.space = self.b.piece_to_id(SPACE)
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        size = max(len(self.bytes_a), len(self.bytes_b))
        self.width = len(str(size - 1))
        numbers = [str(i).rjust(self.width, "\0") + "," for i in range(size)]
        self.digits = np.frombuffer("".join(numbers).encode(), dtype=np.uint8).reshape(size, self.width + 1)

    def tokens_b(self, chunks: list[str]) -> list[list[int]]:
        """Piece ids of chunks. The library puts a space before each text, in place of the chunk's own."""
        found = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        for k, chunk in enumerate(chunks):
            if chunk == " ":
                found[k] = [self.space]
            elif chunk[0] != " ":
                found[k] = found[k][1:]
        return found

    def align(self, texts: list[str | None]) -> Aligned:
        known: dict[str, int] = {}
        chunk_of: list[int] = []
        starts = np.zeros(len(texts) + 1, dtype=np.int64)
        put, find = known.setdefault, self.CHUNK.findall
        for k, text in enumerate(texts):
            if text:
                chunk_of += [put(c, len(known)) for c in find(" " + text)]
            starts[k + 1] = len(chunk_of)
        chunks, places = list(known), np.array(chunk_of, dtype=np.int64)
        encode = self.a.encode_ordinary
        lists_a, lists_b = [encode(c) for c in chunks], self.tokens_b(chunks) if chunks else []
        whole = np.ones(len(chunks), dtype=bool)
        joined = "".join(chunks).encode()
        parts_a = [b"".join([self.bytes_a[i] for i in x]) for x in lists_a]
        parts_b = [b"".join([self.bytes_b[i] for i in x]) for x in lists_b]
        if b"".join(parts_a) != joined or b"".join(parts_b) != joined:
            whole = np.array([c.encode() == a == b for c, a, b in zip(chunks, parts_a, parts_b)], dtype=bool)
            lists_a = [x if ok else [] for x, ok in zip(lists_a, whole)]
            lists_b = [x if ok else [] for x, ok in zip(lists_b, whole)]
        broken = np.zeros(len(places) + 1, dtype=np.int64)
        np.cumsum(~whole[places], out=broken[1:])
        valid = broken[starts[1:]] == broken[starts[:-1]]
        return self._linked(lists_a, lists_b, places, starts, valid)

    def _linked(self, lists_a, lists_b, places, starts, valid) -> Aligned:
        n_a = np.array([len(x) for x in lists_a], dtype=np.int64)
        n_b = np.array([len(x) for x in lists_b], dtype=np.int64)
        a = np.fromiter((i for x in lists_a for i in x), dtype=np.int64, count=n_a.sum())
        b = np.fromiter((i for x in lists_b for i in x), dtype=np.int64, count=n_b.sum())
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # Ends of chunks are ends of both, so chunks stay apart in what follows.
        cuts, groups = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        bounds = np.concatenate([[0], ends_a])[np.cumsum(n_a)] if len(n_a) else np.zeros(0, dtype=np.int64)
        pairs = a[np.searchsorted(ends_a, cuts)] * BASE + b[np.searchsorted(ends_b, cuts)]
        n_links = np.diff(np.searchsorted(cuts, bounds, side="right"), prepend=0)
        n_groups = np.diff(np.searchsorted(groups, bounds, side="right"), prepend=0)
        # All ids in the order in which they are spelled: the first tokens of a group, then its second ones.
        of_a, of_b = np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)
        in_a, in_b = np.bincount(of_a, minlength=len(groups)), np.bincount(of_b, minlength=len(groups))
        at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a]
        at_b = np.arange(len(b)) + np.cumsum(in_a)[of_b]
        letters = np.empty((len(a) + len(b), self.width + 1), dtype=np.uint8)
        letters[at_a], letters[at_b] = self.digits[a], self.digits[b]
        letters[at_a[ends_a == groups[of_a]], -1] = ord("|")
        letters[at_b[ends_b == groups[of_b]], -1] = ord(";")
        sizes = np.zeros(len(letters) + 1, dtype=np.int64)
        np.cumsum((letters != 0).sum(axis=1), out=sizes[1:])
        flat = letters.ravel()
        flat = flat[flat != 0].tobytes()
        edges = [0, *sizes[np.cumsum(n_a + n_b)].tolist()]
        spelled = [flat[x:y] for x, y in zip(edges, edges[1:])]
        return Aligned(places, starts, valid, n_a, n_b, n_groups, n_links, pairs, spelled)


@lru_cache(maxsize=1)
def aligner_of(files: Tokenizers) -> Aligner:
    return Aligner(files)


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sums of their counts."""
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, dtype=np.int64)
    return pairs[new], np.add.reduceat(counts, new) if len(new) else counts


# Minimal perfect hash: a key belongs to the first level on which no other key left shares its bit; its number is the
# count of bits before it.


def _bit(keys: np.ndarray, level: int, sizes: np.ndarray | int) -> np.ndarray:
    salt = mixed(np.array([level + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
    return (mixed(keys.view(np.uint64) ^ salt) % np.asarray(sizes, dtype=np.uint64)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bits, as words of 64, for distinct keys."""
    levels = []
    while len(keys):
        size = -(-2 * len(keys) // 64) * 64
        at = _bit(keys, len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, dtype=np.uint8)
        bits[at[alone]] = 1
        levels.append(np.packbits(bits, bitorder="little").view(np.uint64))
        keys = keys[~alone]
    return levels


class Places:
    """The places of keys under the hashes of one or more shards, which follow one another."""

    def __init__(self, shards: dict[int, list[np.ndarray]]):
        depth = max((len(levels) for levels in shards.values()), default=0)
        self.first = np.zeros((SHARDS, depth), dtype=np.int64)
        self.sizes = np.zeros((SHARDS, depth), dtype=np.int64)
        words, at = [np.zeros(0, dtype=np.uint64)], 0
        for shard, levels in shards.items():
            for k, level in enumerate(levels):
                self.first[shard, k], self.sizes[shard, k] = at, 64 * len(level)
                at += 64 * len(level)
                words.append(level)
        self.words = np.concatenate(words)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; -1 for keys of other shards and some that are in none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        shard = keys % BASE % SHARDS
        for level in range(self.first.shape[1]):
            sizes = self.sizes[shard[left], level]
            left, sizes = left[sizes > 0], sizes[sizes > 0]
            at = self.first[shard[left], level] + _bit(keys[left], level, sizes)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            set_ = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[set_]] = (self.before[at >> 6] + below)[set_]
            left = left[~set_]
        return out


def _packed(levels: list[np.ndarray]) -> dict[str, object]:
    return {"depths": [len(x) for x in levels], "bits": np.concatenate([np.zeros(0, np.uint64), *levels]).tobytes()}


def _unpacked(depths, bits: bytes) -> list[np.ndarray]:
    return np.split(np.frombuffer(bits, np.uint64), np.cumsum(list(depths))[:-1]) if len(depths) else []


_PORTION = "shard int, branch int, pairs binary, counts binary"
_HASHED = "shard int, n long, depths array<int>, bits binary, pairs binary"
_COUNTED = _HASHED + ", counts binary, best binary"


def _longs(values) -> np.ndarray:
    return np.frombuffer(values, dtype=np.int64)


def pair_counts(docs: DataFrame, files: Tokenizers, text: str = "text") -> DataFrame:
    """Linked pairs of the corpus by shard: their hash, and at each place the pair, its count and whether it is a best.

    A best pair has the highest count among those with its second id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)
    branches = ceil(sqrt(docs.rdd.getNumPartitions() or 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, branch = aligner_of(shared.value), TaskContext.get().partitionId() % branches
        pairs, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def portion() -> pa.RecordBatch:
            shard = pairs % BASE % SHARDS
            parts = [(s, shard == s) for s in np.unique(shard).tolist()]
            columns = [pa.array([s for s, _ in parts], pa.int32()), pa.array([branch] * len(parts), pa.int32())]
            columns += [pa.array([values[own].tobytes() for _, own in parts], pa.binary()) for values in (pairs, counts)]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "branch", "pairs", "counts"])

        for batch in batches:
            for part in slices(batch, text, SLICE):
                found = aligner.align(part.column(text).to_pylist())
                weights = np.repeat(found.times(), found.n_links)
                met = weights > 0
                pairs, counts = _summed(np.concatenate([pairs, found.pairs[met]]), np.concatenate([counts, weights[met]]))
                if len(pairs) >= PORTION:
                    yield portion()
                    pairs, counts = pairs[:0], counts[:0]
        if len(pairs):
            yield portion()

    portions = checkpointed(docs.select(text).mapInArrow(count, _PORTION))

    def distinct(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        held = np.unique(np.concatenate([_longs(x) for x in rows["pairs"]]))
        return pd.DataFrame({"shard": [key[0]], "pairs": [held.tobytes()]})

    def hashed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        held = np.unique(np.concatenate([_longs(x) for x in rows["pairs"]]))
        levels = perfect_hash(held)
        keys = np.empty_like(held)
        keys[Places({key[0]: levels})(held)] = held
        return pd.DataFrame([{"shard": key[0], "n": len(held), **_packed(levels), "pairs": keys.tobytes()}])

    branch_keys = portions.select("shard", "branch", "pairs").groupBy("shard", "branch").applyInPandas(distinct, "shard int, pairs binary")
    hashes = checkpointed(branch_keys.groupBy("shard").applyInPandas(hashed, _HASHED))

    def dense(key: tuple, rows: pd.DataFrame, hash_: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"shard": [], "counts": []})
        own = hash_.iloc[0]
        vector, place = np.zeros(own["n"], dtype=np.int64), Places({key[0]: _unpacked(own["depths"], own["bits"])})
        for pairs, counts in zip(rows["pairs"], rows["counts"]):
            vector[place(_longs(pairs))] += _longs(counts)
        return pd.DataFrame({"shard": [key[0]], "counts": [vector.tobytes()]})

    def total(key: tuple, rows: pd.DataFrame, hash_: pd.DataFrame) -> pd.DataFrame:
        own = hash_.iloc[0]
        vector = np.sum([_longs(x) for x in rows["counts"]], axis=0, dtype=np.int64)
        of = _longs(own["pairs"]) % BASE // SHARDS
        highest = np.zeros(of.max() + 1, dtype=np.int64)
        np.maximum.at(highest, of, vector)
        return pd.DataFrame([{**own.to_dict(), "counts": vector.tobytes(), "best": (vector == highest[of]).tobytes()}])

    per_branch = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))))
    vectors = portions.groupBy("shard", "branch").cogroup(per_branch.groupBy("shard", "branch")).applyInPandas(dense, "shard int, counts binary")
    summed = vectors.groupBy("shard").cogroup(hashes.groupBy("shard")).applyInPandas(total, _COUNTED)
    return checkpointed(summed)


class Lookup:
    """Counts of the pairs of some shards; every key is verified."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.places = Places({r["shard"]: _unpacked(r["depths"], r["bits"]) for r in rows})
        self.here = np.zeros(SHARDS, dtype=bool)
        self.here[[r["shard"] for r in rows]] = True

        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[name], kind) for r in rows)])

        self.pairs, self.counts, self.best = joined("pairs", np.int64), joined("counts", np.int64), joined("best", bool)

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair and whether it is a best; zeros for pairs of other shards."""
        at = self.places(pairs)
        mine = np.flatnonzero(self.here[pairs % BASE % SHARDS])
        if len(mine) and ((at[mine] < 0).any() or (self.pairs[at[mine]] != pairs[mine]).any()):
            raise ValueError("a pair of the second pass was not counted in the first")
        counts, best = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        counts[mine], best[mine] = self.counts[at[mine]], self.best[at[mine]]
        return counts, best


def _rounds(table: DataFrame, most: int) -> list[list[int]]:
    """Shards in groups of at most ``most`` pairs, or one larger shard."""
    rounds, held = [[]], 0
    for shard, n in sorted((r["shard"], r["n"]) for r in table.select("shard", "n").collect()):
        if rounds[-1] and held + n > most:
            rounds.append([])
            held = 0
        rounds[-1].append(shard)
        held += n
    return rounds


_ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(
    docs: DataFrame,
    files: Tokenizers,
    text: str = "text",
    most: int = 4_000_000,
    spell: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """All rows and columns with the alignment of ``text``, which itself goes without ``keep_text``.

    ``n_a``, ``n_b`` tokens, ``n_groups`` of them, ``n_links`` overlapping occurrences, ``n_best`` links whose pair has
    the highest count of its second id, ``count_sum`` over all links, and ``groups_sha256`` of the groups spelled as
    ``a1,a2|b1;a3|b2``; ``spell`` names a column for that text itself. The first tokenizer sees a space before the
    text, as the second adds one. Texts that are NULL, empty, or not given back by the tokens have zeros and empty
    strings. Columns named like an output are replaced. Repeated rows count as often as they stand. ``most`` pairs
    (17 bytes each) are sent to the tasks at a time; a corpus with more is aligned once per such part.
    """
    table = pair_counts(docs, files, text)
    shared = docs.sparkSession.sparkContext.broadcast(files)
    texts = [spell] if spell else []
    added = [*_ADDED, "groups_sha256", *texts]
    kept = [c for c in docs.columns if c not in added]

    def looked_up(rows: DataFrame, shards: list[int], first: bool, last: bool) -> DataFrame:
        put = [c for c in kept if c != text or keep_text or not last]
        schema = T.StructType([docs.schema[c] for c in put])
        for name in _ADDED:
            schema = schema.add(name, T.LongType())
        for name in ["groups_sha256", *texts]:
            schema = schema.add(name, T.StringType())
        names = schema.names
        lookup = rows.sparkSession.sparkContext.broadcast(Lookup(table.filter(F.col("shard").isin(shards)).collect()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = aligner_of(shared.value)
            for batch in batches:
                for part in slices(batch, text, SLICE):
                    found = aligner.align(part.column(text).to_pylist())
                    met = np.repeat(found.times() > 0, found.n_links)
                    counts, best = np.zeros(len(met), np.int64), np.zeros(len(met), np.int64)
                    counts[met], best[met] = lookup.value(found.pairs[met])
                    sums = [found.per_text(found.per_chunk(values)) for values in (best, counts)]
                    own = [part.column(c) for c in put]
                    if first:
                        numbers = [found.per_text(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                        wholes = [
                            b"".join([found.spelled[c] for c in found.chunk_of[x:y]])[:-1] if ok else b""
                            for x, y, ok in zip(found.starts, found.starts[1:], found.valid)
                        ]
                        digests = [hashlib.sha256(w).hexdigest() if w else "" for w in wholes]
                        strings = [pa.array(digests, pa.string())]
                        strings += [pa.array([w.decode() for w in wholes], pa.string()) for _ in texts]
                    else:
                        numbers = [part.column(c) for c in _ADDED[:4]]
                        sums = [x + part.column(c).to_numpy() for x, c in zip(sums, _ADDED[4:])]
                        strings = [part.column(c) for c in ("groups_sha256", *texts)]
                    numbers = [x if isinstance(x, pa.Array) else pa.array(x) for x in (*numbers, *sums)]
                    yield pa.RecordBatch.from_arrays([*own, *numbers, *strings], names=names)

        return rows.mapInArrow(run, schema)

    rows = docs.select(*kept)
    rounds = _rounds(table, most)
    for number, shards in enumerate(rounds):
        # One lookup in memory at a time.
        rows = looked_up(rows if number == 0 else checkpointed(rows), shards, number == 0, number == len(rounds) - 1)
    return rows
