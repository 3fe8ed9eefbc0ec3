"""Typed statements: one function per statement shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.functions.money import money
from ledgerwell.functions.text import varchar

DONE = "COMPLETADO"


def _date(column: str, name: str) -> Column:
    return F.col(column).cast("date").alias(name)


def _money(column: str, name: str) -> Column:
    return money(F.col(column)).alias(name)


def _audit() -> Sequence[Column]:
    return (
        F.col("source_row_id").cast("bigint").alias("source_row_id"),
        varchar(F.col("source_hash"), 64).alias("source_hash"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )


def _account_id(value: str) -> Column:
    return varchar(F.lit(value), 50).alias("account_id")


def _description() -> Column:
    return F.trim(F.col("descripcion").cast("string")).alias("description")


def account_statement(raw: DataFrame, account_id: str) -> DataFrame:
    return raw.select(
        _account_id(account_id),
        _date("fecha_contable", "booking_date"),
        _date("fecha_valor", "value_date"),
        _description(),
        _money("importe", "amount"),
        _money("saldo", "balance"),
        *_audit(),
    )


def card_statement(raw: DataFrame, account_id: str) -> DataFrame:
    return raw.select(
        _account_id(account_id),
        _date("fecha", "value_date"),
        _date("fecha_cargo", "billing_date"),
        _description(),
        _money("importe", "amount"),
        *_audit(),
    )


def cash_book(raw: DataFrame, account_id: str) -> DataFrame:
    return raw.select(
        _account_id(account_id),
        _date("fecha", "value_date"),
        _description(),
        _money("importe", "amount"),
        _money("saldo", "balance"),
        *_audit(),
    )


def wallet_statement(raw: DataFrame, account_id: str) -> DataFrame:
    """Completed wallet lines. Currencies are kept apart in no later step: amounts add up as they are."""
    state = F.upper(F.trim(F.col("state").cast("string")))
    return raw.filter(state == DONE).select(
        _account_id(account_id),
        _date("fecha_inicio", "value_date"),
        _date("fecha_fin", "booking_date"),
        _description(),
        _money("importe", "amount"),
        _money("saldo", "balance"),
        money(F.coalesce(F.col("comision"), F.lit(0))).alias("fee"),
        varchar(F.upper(F.trim("divisa")), 3).alias("currency"),
        varchar(F.col("tipo"), 50).alias("raw_transaction_type"),
        varchar(state, 20).alias("status"),
        *_audit(),
    )
