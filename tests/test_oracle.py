"""Registered queries against their SQL twins on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, compare
from conftest import ROOT
from ledgerwell import queries as registry
from ledgerwell.fixtures import oracle

# The others are columns of these, or are compared by ``compare.py`` over the whole registry.
CHECKED = [
    "cash_running_balance",
    "stg_accounts",
    "stg_cards",
    "stg_wallet",
    "transactions_unioned",
    "text_normalise",
    "rule_match_shuffled",
    "adjustment_join",
    "int_transactions",
    "month_spines",
    "fct_salaries_monthly",
    "fct_monthly_balances",
    "fct_capex_summary",
    "fct_monthly_pnl",
]


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for table in TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, ROOT).startswith("ok")


def test_every_query_has_its_twin():
    assert set(registry.MODELS) == set(oracle.QUESTIONS)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "year_month" and df.limit(1).count() == 1
