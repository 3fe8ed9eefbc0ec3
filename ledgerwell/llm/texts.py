"""Texts of an Arrow batch as bytes, for numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more than texts). NULL is empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0 or starts[-1] == starts[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def groups(starts: np.ndarray, budget: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``budget`` bytes together, or one longer text."""
    first, count = 0, len(starts) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + budget, side="right")) - 1)
        yield first, min(last, count)
        first = min(last, count)


def slices(batch: pa.RecordBatch, text: str, budget: int = 4 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``budget`` bytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > first and held + size > budget:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += size
    if batch.num_rows > first:
        yield batch.slice(first)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up = np.full(size, base, dtype=np.uint64)
    down = np.full(size, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[LOWER]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words begin (one more than texts).

    A word is a longest run of bytes other than space and 0x09 to 0x0D; A-Z count as lower case.
    """
    hashes, counts = [], np.zeros(len(starts), dtype=np.int64)
    inside = ~SEPARATORS[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inside[edges]
    firsts = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    lasts = np.flatnonzero(ends) + 1
    counts = np.searchsorted(firsts, starts)
    place = 0
    while place < len(firsts):
        # A block of whole words, so that the running sums stay small however long a text is.
        stop = max(place + 1, int(np.searchsorted(lasts, firsts[place] + BLOCK, side="right")))
        low, high = firsts[place], lasts[stop - 1]
        size = 1 << int(max(BLOCK, high - low)).bit_length()
        up, down = _powers(size)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(LETTERS[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = firsts[place:stop] - low, lasts[place:stop] - low
        hashes.append(mixed((sums[b] - sums[a]) * down[a]))
        place = stop
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), counts


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text in order, and where each text's begin.

    A text with fewer words, but at least one, has its whole sequence as one.
    """
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    lengths = np.diff(counts)
    number = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    places = np.zeros(len(number) + 1, dtype=np.int64)
    np.cumsum(number, out=places[1:])
    out = np.zeros(places[-1], dtype=np.uint64)
    if len(words) >= size:
        runs = np.zeros(len(words) - size + 1, dtype=np.uint64)
        for k in range(size):
            runs += words[k : len(words) - size + 1 + k] * factors[k]
        full = lengths >= size
        at = np.repeat(counts[:-1][full], number[full]) + _steps(number[full])
        out[np.repeat(places[:-1][full], number[full]) + _steps(number[full])] = mixed(runs[at])
    for row in np.flatnonzero((lengths > 0) & (lengths < size)):
        own = words[counts[row] : counts[row + 1]]
        short = np.uint64(len(own)) + np.sum(own * factors[: len(own)], dtype=np.uint64)
        out[places[row]] = mixed(np.array([short], dtype=np.uint64))[0]
    return out, places


def _steps(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each group."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def fresh_rows(data: np.ndarray, starts: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """A copy of some texts with a space before and three after each, and where each begins."""
    lengths = np.diff(starts[first : last + 1])
    places = np.zeros(last - first + 1, dtype=np.int64)
    np.cumsum(lengths + 4, out=places[1:])
    out = np.full(places[-1], 32, dtype=np.uint8)
    source = data[starts[first] : starts[last]]
    out[1 + np.arange(len(source)) + 4 * np.repeat(np.arange(last - first), lengths)] = source
    return out, places
