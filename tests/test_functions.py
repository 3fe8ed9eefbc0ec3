"""Text, money and date semantics that a plain translation gets wrong."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerwell.functions import text as tx
from ledgerwell.functions.dates import accrual_month
from ledgerwell.functions.money import exact_ratio, half, money


def values(spark, rows, expression, schema="v string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(expression.alias("out")).collect()]


def test_title_case_breaks_words_at_every_non_alphanumeric(spark):
    got = values(spark, ["O'BRIEN AMAZON.ES 3M-CO ñANDÚ", "--a_b (c) ", "", None], tx.title_case(F.col("v")))
    assert got == ["O'Brien Amazon.Es 3m-Co Ñandú", "--A_B (C) ", "", None]


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("TRANSFERENCIA DE JUAN", "Juan"),
        ("TRANS INTERNA /PEPE", "Pepe"),
        ("TRANSF OTRAS ENTID/ X", "X"),
        ("TRA NS F NOMINA ACME", "Acme"),
        ("TRANSF IVAN", "Van"),
        ("TRANSFERENCIA FAVOR DE ANA_LUZ", "Ana Luz"),
        ("transferencia a favor de ana", "Favor De Ana"),
        ("RECIBO LUZ", None),
        (None, None),
    ],
)
def test_transfer_counterparty(spark, text, name):
    assert values(spark, [text], tx.transfer_counterparty(F.col("v"))) == [name]


def test_transfer_prefix_fix_is_opt_in(spark):
    got = values(spark, ["TRANSF IVAN", "TRANSF I / EVA"], tx.transfer_counterparty(F.col("v"), True))
    assert got == ["Ivan", "Eva"]


def test_instant_payment_counterparty(spark):
    texts = ["DEV PAGO BIZUM A ana-luz;1", "Bizum para  PEPE", "BIZUM DE ", "OTRO"]
    assert values(spark, texts, tx.instant_payment_counterparty(F.col("v"))) == ["Ana Luz 1", "Pepe", "", None]


def test_card_merchant_and_direct_debit(spark):
    rows = [("CAFE, CITY 1", "card"), ("cafe-bar", "card"), ("  ", "card"), ("CAFE", "cash"), (", X", "card")]
    got = values(spark, rows, tx.card_merchant(F.col("v"), F.col("t")), "v string, t string")
    assert got == ["CAFE", "Cafe-Bar", None, None, ""]
    texts = ["RECIBO / AGUAS", "recib luz", "RECIBOS", "PAGO"]
    assert values(spark, texts, tx.direct_debit_creditor(F.col("v"))) == ["AGUAS", "luz", "S", None]


def test_withdrawal_needs_whole_word_and_negative_amount(spark):
    rows = [
        ("TRANSF A CAJERO 12", D(-1)),
        ("CAJAMAR", D(-1)),
        ("ñCAJA", D(-1)),
        ("caja", D(-1)),
        ("CAJA_1", D(-1)),
        ("CAJERO", D(1)),
        ("CAJERO", None),
        (None, D(-1)),
    ]
    got = values(spark, rows, tx.is_withdrawal(F.col("v"), F.col("a")), "v string, a decimal(18,2)")
    assert got == [True, False, False, True, False, False, False, False]


def test_normalisation(spark):
    texts = ["PAGO Bodó*X#1", "NOA SIERRA", "", "  ", "***", None]
    assert values(spark, texts, tx.normalise(F.col("v"))) == ["pago bod x 1", "noa sierra", "", " ", " ", None]
    assert values(spark, ["Bodó"], tx.normalise(F.col("v"), True)) == ["bodo"]


def test_case_folding_covers_accents(spark):
    assert values(spark, ["CUENTA TÚ Y YO", "cuenta tú y yo"], tx.matches(F.col("v"), "CUENTA T[UÚ] Y YO")) == [True, True]


def test_bounded_strings_are_cut(spark):
    assert values(spark, ["abcdef", "a", None], tx.varchar(F.col("v"), 3)) == ["abc", "a", None]


def test_money_rounds_half_away_from_zero(spark):
    assert values(spark, ["2.675", "-0.005", "0.004"], money(F.col("v").cast("decimal(18,3)"))) == [D("2.68"), D("-0.01"), D("0.00")]
    assert values(spark, [D("0.01"), D("-0.01"), D("3.33")], half(F.col("v")), "v decimal(18,2)") == [D("0.01"), D("-0.01"), D("1.67")]


def test_exact_ratio(spark):
    rows = [
        (D("1.00"), D("3.00")),
        (D("-1.00"), D("8.00")),
        (D("0.00005"), D("1.00")),
        (D("1.00"), D("20000.00")),
        (D("-1.00"), D("20000.00")),
        (D("1.00"), D("-20000.00")),
        (D("5.00"), D("0.00")),
        (None, D("1.00")),
        (D("99999999999999999999999999.99"), D("99999999999999999999999999.98")),
    ]
    got = values(spark, rows, exact_ratio(F.col("n"), F.col("d")), "n decimal(28,2), d decimal(28,2)")
    want = ["0.3333", "-0.1250", "0.0000", "0.0001", "-0.0001", "-0.0001", None, None, "1.0000"]
    assert got == [None if w is None else D(w) for w in want]


def test_accrual_month(spark):
    rows = [(dt.date(2024, 3, 16), "P"), (dt.date(2024, 3, 17), "P"), (dt.date(2024, 1, 1), "P"), (dt.date(2024, 3, 1), "Q")]
    got = values(spark, rows, accrual_month(F.col("d"), F.col("c"), ("P",)), "d date, c string")
    assert got == [dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2023, 12, 1), dt.date(2024, 3, 1)]


def test_wide_ratios_are_right_or_raise(spark):
    kinds = "n decimal(28,2), d decimal(28,2)"
    rows = [("18446744073709.57", "0.01"), ("100000000000000.00", "-0.01"), ("-99999999999999999999999.99", "1.00")]
    got = values(spark, [(D(n), D(d)) for n, d in rows], exact_ratio(F.col("n"), F.col("d")), kinds)
    assert got == [D("1844674407370957"), D("-10000000000000000"), D("-99999999999999999999999.99")]
    widest = [(D("9" * 26 + ".99"), D("0.01"))]
    assert values(spark, widest, exact_ratio(F.col("n"), F.col("d")), kinds) == [D("9" * 28)]
