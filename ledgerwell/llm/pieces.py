"""SentencePiece BPE encoding and decoding with a prefix table.

An encoding by merges is unique for every prefix of a text, so it is enough to know the last token of each
prefix. A token that ends a prefix is its last one exactly if merging leaves it apart from the last token of
the prefix before it. An automaton finds the tokens that end at each place; ids are read backwards from the end.

Some boundaries bound the work: no vocabulary entry continues over one between other characters and a following
space, or between a closing letter and a following sign. So a text is encoded word by word, with a bounded
memory of words seen by the Python worker.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"


class Vocabulary:
    """The pieces of a model file and the words met so far; built once in each Python worker.

    ``remembered`` bounds the words and the pairs kept.
    """

    def __init__(self, model: bytes, remembered: int = 600_000):
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = reader.get_piece_size()
        self.text = [reader.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size) if not (reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i))
        ]
        self.ids = {self.text[i]: i for i in plain}
        self.score = {i: reader.get_score(i) for i in plain}
        self.length = [len(t) for t in self.text]
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(size) if reader.is_byte(i)}
        self.unknown = reader.unk_id()
        # Runs of spaces merge after everything else and all at one score, so they are kept out of the table.
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if not (len(piece) > 1 and piece.strip(SPACE) == "") and self.merged(piece) == [i]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.words_of = self.boundaries()
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def boundaries(self) -> Callable[[str], list[str]]:
        """Cuts a text where no piece can continue: before spaces, around line breaks, after closing letters.

        Closing letters are followed within pieces by closing letters only.
        """
        if any("\n" in p and len(p) > 1 or SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids):
            raise ValueError("pieces of this vocabulary continue over spaces or lines")
        pairs = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        closing = {c for pair in pairs for c in pair if c.isalpha()}
        while open_ones := {a for a, b in pairs if a in closing and b not in closing}:
            closing -= open_ones
        letters = "".join(sorted(closing)) or "\n"
        return re.compile(f"{SPACE}*(?:[^{letters}{SPACE}\n]+[{letters}]*|[{letters}]+)|{SPACE}+|\n").findall

    def merged(self, text: str) -> list[int]:
        """Ids by plain merging: the best-scored neighbours first, then the leftmost. For short strings."""
        parts: list[str | None] = list(text)
        following = [*range(1, len(parts)), -1] if parts else []
        previous = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            whole = parts[a] + parts[b]
            if (i := self.ids.get(whole)) is not None:
                heapq.heappush(heap, (-self.score[i], a, b, whole))

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, whole = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or following[a] != b or parts[a] + parts[b] != whole:
                continue
            parts[a], parts[b] = whole, None
            following[a] = following[b]
            if following[b] >= 0:
                previous[following[b]] = a
                offer(a, following[b])
            if previous[a] >= 0:
                offer(previous[a], a)
        return [i for part in parts if part is not None for i in self.as_ids(part)]

    def as_ids(self, part: str) -> list[int]:
        known = self.ids.get(part)
        if known is not None:
            return [known]
        return [self.bytes.get(value, self.unknown) for value in part.encode()]

    def apart(self, first: int, second: int) -> bool:
        """Whether merging leaves these two tokens side by side."""
        if len(self.pairs) >= self.remembered:
            self.pairs.clear()
        answer = self.merged(self.text[first] + self.text[second]) == [first, second]
        self.pairs[first * len(self.text) + second] = answer
        return answer

    def table(self, word: str) -> list[int]:
        """For each prefix the id of its last token; -1 stands for a character outside the vocabulary."""
        last = [-1] * (len(word) + 1)
        size, pairs, done = len(self.text), self.pairs, -1
        for end, (length, i) in self.automaton.iter(word):
            if end == done:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                fits = pairs.get(before * size + i)
                if fits is None:
                    fits = self.apart(before, i)
                if not fits:
                    continue
            last[end + 1] = i
            done = end
        return last

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word: any number of spaces, then other characters."""
        body = word.lstrip(SPACE)
        spaces = len(word) - len(body)
        if not body:
            return self.merged(word)
        tail = (SPACE if spaces else "") + body
        last = self.table(tail)
        place, parts = len(tail), []
        while place:
            i = last[place]
            parts.append([i] if i >= 0 else self.as_ids(tail[place - 1]))
            place -= self.length[i] if i >= 0 else 1
        parts.reverse()
        if spaces > 1:
            # A first space that joined nothing in the word belongs to the run before it.
            alone = parts[0] == [self.ids.get(SPACE)]
            parts = [self.merged(SPACE * (spaces if alone else spaces - 1)), *parts[alone:]]
        return [i for part in parts for i in part]

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers."""
        if not text:
            return b""
        found = []
        words = self.words
        for word in self.words_of(SPACE + text.replace(" ", SPACE)):
            ids = words.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    ids = array("i", self.word_ids(word)).tobytes()
                if len(word) <= 64:
                    words[word] = ids
                    if len(words) >= self.remembered // 2:
                        # Words not met again in this half of the memory are forgotten.
                        self.older, words = words, {}
                        self.words = words
            found.append(ids)
        return b"".join(found)


class Outputs:
    """The bytes that each id stands for."""

    def __init__(self, model: bytes):
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.output = [reader.id_to_piece(i).replace(SPACE, " ").encode() for i in range(reader.get_piece_size())]
        for i in range(len(self.output)):
            if reader.is_byte(i):
                self.output[i] = bytes([int(reader.id_to_piece(i)[3:5], 16)])
            elif reader.is_control(i):
                self.output[i] = b""
            elif reader.is_unknown(i):
                self.output[i] = " \u2047 ".encode()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space put before the text goes, and bytes that form no character become U+FFFD."""
        output = self.output
        whole = b"".join([output[i] for i in ids])
        return whole.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=1)
def vocabulary_of(model: bytes, remembered: int) -> Vocabulary:
    return Vocabulary(model, remembered)


@lru_cache(maxsize=1)
def outputs_of(model: bytes) -> Outputs:
    return Outputs(model)


def encode(
    df: DataFrame,
    model: bytes,
    text: str = "text",
    ids: str = "ids",
    keep_text: bool = True,
    remembered: int = 600_000,
    decoded: str | None = None,
) -> DataFrame:
    """Add the ids of the whole ``text`` as an array of integers, without begin or end ids.

    NULL and empty texts get an empty array. A column named like ``ids`` is replaced; all others stay. Repeated
    rows stay. ``decoded`` names a column for the text of the ids, read back in the same pass. A worker remembers
    ``remembered`` words and pairs of tokens, of which a hundred thousand take about 30 MB. The model file's content goes to the tasks as a broadcast of its fixed size.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (ids, decoded)]
    put = [c for c in kept if keep_text or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value, remembered)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [vocabulary.encode(t or "") for t in part.column(text).to_pylist()]
                offsets = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(f) // 4 for f in found], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                columns, names = [*(part.column(c) for c in put), lists], [*put, ids]
                if decoded:
                    read = outputs_of(shared.value).decode
                    columns.append(pa.array([read(np.frombuffer(f, dtype=np.int32).tolist()) for f in found], pa.string()))
                    names.append(decoded)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [df.schema[c] for c in put]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())
    return df.select(*kept).mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; NULL gives an empty text. A column named like ``text`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = outputs_of(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [vocabulary.decode(x or []) for x in part.column(ids).to_pylist()]
                columns = [*(part.column(c) for c in kept), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, text])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text, T.StringType())])
    return df.select(*kept).mapInArrow(run, schema)
