"""Sets of 64-bit numbers as bits of a fixed size, put together by the tasks and sent to them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.texts import mixed

#: A full filter only lets more numbers through; what it lets through is judged again.
BITS = 1 << 26


def paired(keys: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """Numbers that stand for pairs of a key and a small number."""
    return keys ^ mixed(seconds.astype(np.int64).view(np.uint64))


class Filter:
    """Says yes for all numbers of a set and for few others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = (keys % np.uint64(BITS)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def filter_of(rows: DataFrame, key: str, second: str | None = None) -> Filter:
    """The filter of a column of numbers, or of its pairs with another one. NULLs are left out."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(key).to_numpy().view(np.uint64)
            if second:
                values = paired(values, batch.column(second).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array((values % np.uint64(BITS)).astype(np.int64))], names=["p"])

    known = rows.filter(F.col(key).isNotNull()).select(key, *([second] if second else []))
    parts = known.mapInArrow(put, "p long").groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("bucket"))
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for row in parts.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits")).collect():
        own = np.frombuffer(row["bits"], dtype=np.uint8)
        bits[(row["bucket"] - 1) * 4096 : (row["bucket"] - 1) * 4096 + len(own)] = own
    return Filter(bits)
