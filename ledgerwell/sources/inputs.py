"""Raw statements and reference tables as DataFrames of declared columns."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerwell.schemas import RAW_TABLES, REFERENCE_TABLES

TABLES: Mapping[str, T.StructType] = {**RAW_TABLES, **REFERENCE_TABLES}


@dataclass(frozen=True)
class Inputs:
    """The seven raw statement tables and the five reference tables, looked up when a plan needs them."""

    load: Callable[[str], DataFrame]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise KeyError(f"unknown table: {table}")
        return self.load(table)


def from_frames(frames: Mapping[str, DataFrame]) -> Inputs:
    return Inputs(lambda table: declared(frames[table], table))


def declared(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a table, in order; staging casts them. A missing one is an error at once."""
    missing = [c for c in TABLES[table].names if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {', '.join(missing)}")
    return df if df.columns == TABLES[table].names else df.select(*TABLES[table].names)


def from_files(spark: SparkSession, root: str, fmt: str = "parquet", **options: str) -> Inputs:
    """One file set per table below ``root``; text formats are read with the declared schema, others
    must have its columns."""

    def load(table: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        if fmt in ("csv", "json"):
            reader = reader.schema(TABLES[table])
        return declared(reader.load(os.path.join(root, table)), table)

    return Inputs(load)


def from_catalog(spark: SparkSession, raw: str = "raw", reference: str = "stg") -> Inputs:
    """Tables of the session catalog, raw and reference ones in their own schemas."""
    return Inputs(lambda table: declared(spark.table(f"{raw if table in RAW_TABLES else reference}.{table}"), table))


def jdbc_options(
    url: str, table: str, schema: str, partitions: int, rows: tuple[int, int], **extra: str
) -> dict[str, str]:
    """Options of a parallel database read, sliced by row number; small reference tables need one slice."""
    options = {"url": url, "dbtable": f"{schema}.{table}" if schema else table, "fetchsize": "10000", **extra}
    if partitions > 1 and table in RAW_TABLES:
        low, high = rows
        options |= {
            "partitionColumn": "source_row_id",
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def from_jdbc(
    spark: SparkSession,
    url: str,
    raw: str = "raw",
    reference: str = "stg",
    partitions: int = 1,
    rows: Mapping[str, tuple[int, int]] | None = None,
    **extra: str,
) -> Inputs:
    """Tables of a database, raw ones read in ``partitions`` slices of row numbers.

    ``rows`` gives their ranges; the range of any other raw table is asked of the database.
    """

    def read(options: Mapping[str, str]) -> DataFrame:
        return spark.read.format("jdbc").options(**options).load()

    return sliced(read, url, raw, reference, partitions, rows, **extra)


def sliced(
    read: Callable[[Mapping[str, str]], DataFrame],
    url: str,
    raw: str,
    reference: str,
    partitions: int,
    rows: Mapping[str, tuple[int, int]] | None = None,
    **extra: str,
) -> Inputs:
    """Tables by ``read``, which gets the options of a database read."""

    def span(table: str) -> tuple[int, int] | None:
        if partitions < 2 or table not in RAW_TABLES:
            return None
        if rows and table in rows:
            return rows[table]
        low, high = read(jdbc_options(url, span_query(table, raw), "", 1, (0, 0), **extra)).first()
        return None if low is None else (low, high)

    def load(table: str) -> DataFrame:
        schema, found = raw if table in RAW_TABLES else reference, span(table)
        options = jdbc_options(url, table, schema, partitions if found else 1, found or (0, 0), **extra)
        return declared(read(options), table)

    return Inputs(load)


def span_query(table: str, schema: str) -> str:
    """The least and greatest row number of a raw table, as a table of one row."""
    return f"(SELECT min(source_row_id) AS low, max(source_row_id) AS high FROM {schema}.{table}) span"
