"""Staging and source-level classification, one case per rule."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerwell import rulebook as book
from ledgerwell.config import Limits
from ledgerwell.operators.classify import classify, with_account
from ledgerwell.operators.joins import Dimension
from ledgerwell.plans import staging
from ledgerwell.schemas import RAW_WALLET, REFERENCE_TABLES, UNIFIED_COLUMNS

LINE = (
    "account_id string, value_date date, booking_date date, description string, amount decimal(18,2), "
    "balance decimal(18,2), source_row_id bigint, source_hash string, loaded_at timestamp, bank string, "
    "account_type string, account_ownership string, raw_transaction_type string, fee decimal(18,2)"
)


def lines(spark, rows, ownership="personal"):
    day = dt.date(2024, 1, 5)
    full = [
        ("A", day, day, text, amount, None, i, str(i), None, "B", "x", ownership, kind, fee)
        for i, (text, amount, kind, fee) in enumerate(rows)
    ]
    return spark.createDataFrame(full, LINE)


def natures(spark, profile, rows, ownership="personal", **kinds):
    padded = [(*row, *(None, "0")[len(row) - 2 :]) for row in rows]
    full = [(text, None if amount is None else D(amount), kind, D(fee)) for text, amount, kind, fee in padded]
    df = classify(lines(spark, full, ownership), profile, **kinds).orderBy("source_row_id")
    return [(r.transaction_nature, r.movement_type, r.is_pnl) for r in df.collect()]


def test_personal_account_rules(spark, cfg):
    rows = [
        ("recibo platinum bizum", "-1"),
        ("BIZUM DE ALEX VEGA", "1"),
        ("CAJA  12 ALEX VEGA", "-1"),
        ("X CAJERO ALEX VEGA", "-1"),
        ("cuenta tú y yo", "1"),
        ("RECARGA WALLETPAY", "-1"),
        ("TRASPASO INTERNO", "1"),
        ("TRANSF NOMI/ACME", "10"),
        ("Prestaciones Seguridad Social", "10"),
        ("ANULACION X", "1"),
        ("ANULACION X", "-1"),
        ("MANUAL", "1"),
        (None, "0"),
        ("X", None),
    ]
    assert natures(spark, book.personal_account(cfg), [(t, a) for t, a in rows]) == [
        ("CARD_SETTLEMENT", "TRANSFER", False),
        ("BIZUM", "INCOME", True),
        ("REGULAR", "EXPENSE", True),
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("SALARY", "INCOME", True),
        ("SALARY", "INCOME", True),
        ("EXPENSE_REFUND", "EXPENSE", True),
        ("REGULAR", "EXPENSE", True),
        ("REGULAR", "INCOME", True),
        ("REGULAR", "NEUTRAL", True),
        ("REGULAR", "NEUTRAL", True),
    ]


def test_common_account_rules(spark, cfg):
    rows = [
        ("RECIBO VISA CLASICA", "-1"),
        ("noa siérra", "5"),
        ("ALEX VEGA", "-5"),
        ("IMP INIC PT 1", "5"),
        ("tasadora sur", "-5"),
        ("PROVISION FO", "-5"),
        ("LIQUID. CUOTA PTMO", "-5"),
        ("LIQUIDX CUOTA PTMO", "-5"),
        ("BIZUM", "0"),
        ("ANUL", "5"),
    ]
    assert natures(spark, book.common_account(cfg), rows, "common") == [
        ("CARD_SETTLEMENT", "TRANSFER", False),
        ("PARTNER_CONTRIBUTION", "TRANSFER", False),
        ("PARTNER_CONTRIBUTION", "TRANSFER", False),
        ("LOAN_DISBURSEMENT", "TRANSFER", False),
        ("CAPEX", "EXPENSE", False),
        ("CAPEX", "EXPENSE", False),
        ("MORTGAGE_PAYMENT", "EXPENSE", True),
        ("REGULAR", "EXPENSE", True),
        ("BIZUM", "NEUTRAL", True),
        ("EXPENSE_REFUND", "EXPENSE", True),
    ]


def test_card_rules_and_half_share(spark, cfg):
    rows = [("WALLETPAY", "3"), ("ABONO", "-3"), ("SHOP", "3"), ("SHOP", "-3"), ("SHOP", "0")]
    assert natures(spark, book.cards(cfg), rows) == [
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("EXPENSE_REFUND", "EXPENSE", True),
        ("EXPENSE_REFUND", "EXPENSE", True),
        ("REGULAR", "EXPENSE", True),
        ("REGULAR", "NEUTRAL", True),
    ]
    row = [("SHOP", D("-0.05"), "", D(0))]
    for ownership, share in (("common", D("-0.03")), ("personal", D("-0.05")), (None, D("-0.05"))):
        assert classify(lines(spark, row, ownership), book.cards(cfg)).first().personal_amount == share
    assert classify(lines(spark, row), book.common_account(cfg)).first().personal_amount == D("-0.03")


def test_wallet_types_and_gross_sign(spark, cfg):
    rows = [
        ("x", "5", "Recargas", "0"),
        ("Balance Migration", "5", "Transferir", "0"),
        ("Pepe", "5", "Transferir", "0"),
        ("x", "5", "CASHBACK", "0"),
        ("x", "5", "cashback", "0"),
        ("x", "5", "Reembolso de tarjeta", "0"),
        ("x", "0", "Pago", "2"),
        ("x", "1", "Pago", "2"),
    ]
    kinds = {"kind": "raw_transaction_type", "fee": "fee"}
    assert natures(spark, book.wallet(cfg), rows, **kinds) == [
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("INTERNAL_TRANSFER", "TRANSFER", False),
        ("REGULAR", "INCOME", True),
        ("REWARD", "INCOME", True),
        ("REGULAR", "INCOME", True),
        ("EXPENSE_REFUND", "EXPENSE", True),
        ("REGULAR", "NEUTRAL", True),
        ("REGULAR", "INCOME", True),
    ]
    net = classify(lines(spark, [("x", D(0), "Pago", D(2))]), book.wallet(cfg), **kinds).first()
    assert (net.amount, net.personal_amount, net.movement_type) == (D("-2.00"), D("-2.00"), "NEUTRAL")


def test_wallet_staging_keeps_completed_only(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        (day, day, " a ", D(1), D(1), None, " eurx", "T", state, i, "h" * 70, None, None)
        for i, state in enumerate([" completado ", "PENDIENTE", None, "Completado"])
    ]
    out = staging.wallet_statement(spark.createDataFrame(rows, RAW_WALLET), "W" * 60).orderBy("source_row_id").collect()
    assert [r.source_row_id for r in out] == [0, 3]
    first = out[0]
    assert (first.description, first.fee, first.currency, first.status) == ("a", D("0.00"), "EUR", "COMPLETADO")
    assert (len(first.account_id), len(first.source_hash)) == (50, 64)


def accounts(spark, rows):
    return Dimension(spark.createDataFrame(rows, REFERENCE_TABLES["dim_account"]))


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, hot_key_rows=2)])
def test_account_join_keeps_unknown_and_fans_out_duplicates(spark, limits):
    rows = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)] + [("H", 9)] * 20, "account_id string, n int")
    dim = accounts(spark, [("A", "x", "b1", "t", "personal"), ("A", "y", "b2", "t", "common"), ("H", "z", "b3", "t", "o")])
    out = with_account(rows, dim, limits)
    got = sorted((r.n, r.bank or "") for r in out.collect())
    assert got == sorted([(1, "b1"), (1, "b2"), (2, ""), (3, "")] + [(9, "b3")] * 20)


def test_union_counts_and_columns(warehouse):
    union = warehouse.int_transactions_unioned()
    assert union.columns == UNIFIED_COLUMNS
    parts = [
        warehouse.int_account_personal(),
        warehouse.int_account_common(),
        warehouse.int_cards(),
        warehouse.int_cash(),
        warehouse.int_wallet(),
    ]
    assert union.count() == sum(p.count() for p in parts)


def test_configured_firms_are_optional(spark, cfg):
    bare = replace(cfg, capex_patterns=())
    assert natures(spark, book.common_account(bare), [("TASADORA SUR", "-1")], "common")[0][0] == "REGULAR"


def test_card_dates(warehouse):
    row = warehouse.int_cards().filter(F.col("value_date").isNotNull()).first()
    assert row.booking_date >= row.value_date and row.balance is None
    cash = warehouse.int_cash().first()
    assert cash.booking_date == cash.value_date
