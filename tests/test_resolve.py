"""Cascades: one case per branch, in order, with the overlaps between branches."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerwell.config import Limits
from ledgerwell.operators import resolve as rs
from ledgerwell.operators.joins import Dimension
from ledgerwell.schemas import REFERENCE_TABLES, RESOLVED_COLUMNS

COLUMNS = {
    "source_hash": "string",
    "account_id": "string",
    "bank": "string",
    "account_type": "string",
    "account_ownership": "string",
    "value_date": "date",
    "booking_date": "date",
    "description": "string",
    "amount": "decimal(18,2)",
    "balance": "decimal(18,2)",
    "transaction_nature": "string",
    "movement_type": "string",
    "participant_name": "string",
    "rule_category_id": "string",
    "rule_merchant": "string",
    "category_id_override": "string",
    "merchant_override": "string",
    "adjustment_type": "string",
    "adjustment_amount": "decimal(18,2)",
    "adjustment_reason": "string",
    "source_row_id": "bigint",
    "loaded_at": "timestamp",
    # Set only where the steps after resolution are tested on their own.
    "category_id": "string",
    "merchant": "string",
    "category_is_pnl": "boolean",
    "category_movement_type": "string",
    "group_name": "string",
    "category_name": "string",
    "subcategory_name": "string",
}
BASE = {
    "account_ownership": "personal",
    "description": "X",
    "amount": D("-10.01"),
    "transaction_nature": "REGULAR",
    "movement_type": "EXPENSE",
    "category_id": "VAR_OTROS",
    "category_is_pnl": True,
    "value_date": dt.date(2024, 3, 31),
}
SELF, PARTNER = "Alex Vega", "Noa Sierra"


def frame(spark, cases, drop=()):
    names = [c for c in COLUMNS if c not in drop]
    rows = []
    for i, case in enumerate(cases):
        row = {**BASE, "source_row_id": i, **case}
        rows.append(tuple(row.get(c) for c in names))
    return spark.createDataFrame(rows, ", ".join(f"{c} {COLUMNS[c]}" for c in names))


def case(**fields):
    if "amount" in fields and fields["amount"] is not None:
        fields["amount"] = D(str(fields["amount"]))
    return fields


def resolved(spark, cfg, cases, column):
    out = rs.resolve(frame(spark, cases, drop=("category_id", "merchant")), cfg).orderBy("source_row_id")
    return [r[column] for r in out.collect()]


CATEGORY_CASES = [
    (case(category_id_override="O", description="CAJERO", participant_name=PARTNER), "O"),
    (case(category_id_override="", rule_category_id="R"), ""),
    (case(description="CAJA 1", participant_name=PARTNER, rule_category_id="R"), "VAR_CAJERO"),
    (case(description="CAJA 1", amount=5, participant_name=PARTNER, rule_category_id="R"), "PAREJA_COMPENSA"),
    (case(participant_name=PARTNER, account_ownership="common", amount=5, rule_category_id="R"), "MOV_FONDEO_COMUN"),
    (case(participant_name=PARTNER, account_ownership="common", rule_category_id="R"), "MOV_TRASPASO"),
    (case(participant_name=PARTNER, account_ownership="common", amount=0, rule_category_id="R"), "R"),
    (case(participant_name=PARTNER, account_ownership=None, rule_category_id="R"), "R"),
    (case(participant_name=SELF, account_ownership="common", amount=5), "MOV_FONDEO_COMUN"),
    (case(participant_name=SELF, account_ownership="common", amount=0), "MOV_TRASPASO"),
    (case(participant_name=SELF, rule_category_id="R"), "MOV_TRASPASO"),
    (case(participant_name="Other", rule_category_id="R"), "R"),
    (case(transaction_nature="PARTNER_CONTRIBUTION", amount=1), "MOV_FONDEO_COMUN"),
    (case(transaction_nature="PARTNER_CONTRIBUTION", amount=-1), "MOV_TRASPASO"),
    (case(transaction_nature="PARTNER_CONTRIBUTION", amount=0), "VAR_OTROS"),
    (case(transaction_nature="INTERNAL_TRANSFER"), "MOV_TRASPASO"),
    (case(transaction_nature="CARD_SETTLEMENT"), "MOV_LIQ_TARJETA"),
    (case(transaction_nature="MORTGAGE_PAYMENT"), "FIX_HIPOTECA"),
    (case(transaction_nature="LOAN_DISBURSEMENT", amount=5), "CPX_DISPOSICION"),
    (case(transaction_nature="SALARY", amount=5), "ING_NOMINA"),
    (case(transaction_nature="EXPENSE_REFUND", amount=5), "VAR_DEVOLUCION"),
    (case(transaction_nature="REWARD", amount=5), "ING_RENDIMIENTOS"),
    (case(transaction_nature="BIZUM", amount=5), "ING_BIZUM"),
    (case(transaction_nature="BIZUM", amount=-5), "VAR_BIZUM"),
    (case(transaction_nature="BIZUM", amount=0), "VAR_OTROS"),
    (case(transaction_nature="CAPEX", amount=5), "ING_TRANSFERENCIAS"),
    (case(transaction_nature="CAPEX"), "VAR_OTROS"),
    (case(amount=None), "VAR_OTROS"),
]
MERCHANT_CASES = [
    (case(merchant_override=" Manual ", rule_merchant="R"), "Manual"),
    (case(merchant_override="  ", rule_merchant="R", description="CAJERO"), "R"),
    (case(description="CAJERO", participant_name=PARTNER), "Cajero"),
    (case(participant_name=SELF, description="BIZUM DE ANA"), "-"),
    (case(participant_name=" Ana ", description="BIZUM DE EVA"), "Ana"),
    (case(participant_name="  ", description="BIZUM DE EVA"), "Eva"),
    (case(description="BIZUM DE "), ""),
    (case(description="TRANSFERENCIA DE JUAN"), "Juan"),
    (case(account_type="card", description="CAFE, CITY"), "CAFE"),
    (case(account_type="card", description="cafe-bar"), "Cafe-Bar"),
    (case(account_type="card", description=" "), "No Identificado"),
    (case(account_type="checking", description="RECIBO / AGUA"), "AGUA"),
    (case(account_type="checking", description="OTHER"), "No Identificado"),
    (case(description=None), "No Identificado"),
]


def test_category_cascade(spark, cfg):
    cases, want = zip(*CATEGORY_CASES)
    assert resolved(spark, cfg, cases, "category_id") == list(want)


def test_merchant_cascade(spark, cfg):
    cases, want = zip(*MERCHANT_CASES)
    assert resolved(spark, cfg, cases, "merchant") == list(want)


def test_participant_is_dropped_on_withdrawals(spark, cfg):
    cases = [case(description="CAJA", participant_name="Ana"), case(description="X", participant_name="Ana"), case(description=None, participant_name="Ana")]
    assert resolved(spark, cfg, cases, "participant_name") == [None, "Ana", "Ana"]


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)])
def test_category_join(spark, limits):
    rows = [("K", "g", "n", "s", "EXPENSE", True), ("N", "g", "n", "s", "INCOME", None), ("D", "1", "", "", "", True), ("D", "2", "", "", "", True)]
    dim = Dimension(spark.createDataFrame(rows, REFERENCE_TABLES["dim_categories"]).select(*REFERENCE_TABLES["dim_categories"].names))
    late = ("category_is_pnl", "category_movement_type", "group_name", "category_name", "subcategory_name")
    df = frame(spark, [case(category_id=c) for c in ("K", "N", "?", "D")], drop=late)
    got = sorted((r.category_id, r.group_name or "", r.category_is_pnl) for r in rs.with_category(df, dim, limits).collect())
    assert got == [("?", "", False), ("D", "1", True), ("D", "2", True), ("K", "g", True), ("N", "g", False)]


def finished(spark, cfg, cases, *columns):
    out = rs.finish(frame(spark, cases), cfg).orderBy("source_row_id").collect()
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in out]


def test_movement_type(spark, cfg):
    cases = [
        case(category_id="PAREJA_COMPENSA", amount=1, category_movement_type="TRANSFER"),
        case(category_id="PAREJA_COMPENSA", amount=-1, category_movement_type="TRANSFER"),
        case(category_id="PAREJA_COMPENSA", amount=0, category_movement_type="TRANSFER"),
        case(amount=1, category_movement_type="EXPENSE"),
        case(amount=-1, category_movement_type="EXPENSE"),
        case(amount=-1, category_movement_type="INCOME"),
        case(amount=-1, movement_type="NEUTRAL"),
    ]
    want = ["INCOME", "EXPENSE", "TRANSFER", "EXPENSE_REFUND", "EXPENSE", "INCOME", "NEUTRAL"]
    assert finished(spark, cfg, cases, "movement_type") == want


def test_split_amount_and_share(spark, cfg):
    table = [
        (case(adjustment_type="PARTNER_EXPENSE"), "0", "0"),
        (case(adjustment_type="MY_EXPENSE", account_ownership="common"), "-10.01", "1"),
        (case(adjustment_type="PARTIAL_EXPENSE", adjustment_amount=D("-2.00")), "-4.01", "1"),
        (case(adjustment_type="PARTIAL_EXPENSE", account_ownership="common", amount="10.01"), "-5.01", "0.5"),
        (case(adjustment_type="PARTIAL_EXPENSE", adjustment_amount=D(20), account_ownership=None), "5.00", "0"),
        (case(), "-10.01", "1"),
        # A personal funding row counts in full in the amount and not at all in the share.
        (case(category_id="MOV_FONDEO_COMUN"), "-10.01", "0"),
        (case(category_id="MOV_FONDEO_COMUN", participant_name=SELF), "-10.01", "1"),
        (case(category_id="MOV_FONDEO_COMUN", participant_name=SELF, account_ownership="common"), "-10.01", "1"),
        (case(category_id="MOV_FONDEO_COMUN", participant_name=PARTNER, account_ownership="common"), "0", "0"),
        (case(account_ownership="common"), "-5.01", "0.5"),
        (case(account_ownership="common", movement_type="TRANSFER"), "0", "0"),
        (case(account_ownership="common", movement_type="TRANSFER", category_id="CPX_X"), "-5.01", "0.5"),
        (case(account_ownership="common", movement_type="TRANSFER", category_id="CPXA"), "-5.01", "0.5"),
        (case(account_ownership="common", movement_type="TRANSFER", category_id="CPX"), "0", "0"),
        (case(account_ownership="common", movement_type="TRANSFER", transaction_nature="CARD_SETTLEMENT"), "-5.01", "0.5"),
        (case(account_ownership=None), "0", "0"),
    ]
    got = finished(spark, cfg, [c for c, _, _ in table], "personal_amount", "personal_share_pct")
    assert got == [(D(a).quantize(D("0.01")), D(s).quantize(D("0.01"))) for _, a, s in table]


def test_pnl_and_shared_flags(spark, cfg):
    common = {"account_ownership": "common"}
    table = [
        (case(adjustment_type="PARTNER_EXPENSE", **common), False, False),
        (case(category_is_pnl=False, adjustment_type="PARTIAL_EXPENSE"), False, False),
        (case(movement_type="TRANSFER", **common), False, False),
        (case(transaction_nature="INTERNAL_TRANSFER", **common), False, True),
        (case(transaction_nature="PARTNER_CONTRIBUTION"), False, False),
        (case(transaction_nature="CARD_SETTLEMENT", **common), False, False),
        (case(transaction_nature="CARD_SETTLEMENT", category_id_override="X", **common), True, True),
        (case(adjustment_type="MY_EXPENSE", **common), True, False),
        (case(adjustment_type="PARTIAL_EXPENSE"), True, True),
        (case(**common), True, True),
        (case(category_id="PAREJA_COMPENSA"), True, True),
        (case(), True, False),
        (case(account_ownership=None), True, False),
    ]
    assert finished(spark, cfg, [c for c, _, _ in table], "is_pnl", "is_shared") == [(p, s) for _, p, s in table]


def test_final_shape(spark, cfg):
    out = rs.finish(frame(spark, [case()]), cfg)
    assert out.columns == RESOLVED_COLUMNS
    row = out.first()
    assert (row.year_month, row.year, row.month) == (dt.date(2024, 3, 1), 2024, 3)
