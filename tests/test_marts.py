"""Calendar, facts and monthly marts."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerwell.config import Limits
from ledgerwell.operators import aggregate as ag
from ledgerwell.operators import timeline as tl
from ledgerwell.plans.warehouse import Warehouse
from ledgerwell.schemas import FACT_COLUMNS

FACT = (
    "accrual_month date, value_date date, category_id string, group_name string, movement_type string, merchant string, "
    "amount decimal(18,2), personal_amount decimal(18,2), is_pnl boolean, is_shared boolean"
)


def month(m, y=2024):
    return dt.date(y, m, 1)


def test_calendar(spark):
    cal = tl.calendar_attributes(tl.days_between(spark, dt.date(2020, 1, 1), dt.date(2030, 12, 31)))
    assert cal.count() == 4018
    row = cal.filter(F.col("date_key") == dt.date(2024, 2, 4)).first()
    assert row.asDict() == {
        "date_key": dt.date(2024, 2, 4),
        "year": 2024,
        "month": 2,
        "day": 4,
        "quarter": 1,
        "day_of_week": 7,
        "start_of_month": month(2),
        "end_of_month": dt.date(2024, 2, 29),
        "year_month": "2024-02",
        "month_year": "Feb 2024",
        "month_name": "February",
        "day_name": "Sunday",
        "quarter_name": "Q1",
        "is_weekend": True,
    }


def test_month_spines(spark):
    cal = tl.calendar_attributes(tl.days_between(spark, month(1), dt.date(2024, 12, 31)))
    salaries = [r.start_of_month for r in tl.salary_months(cal, month(2), dt.date(2024, 5, 31)).collect()]
    assert sorted(salaries) == [month(2), month(3), month(4)]
    # One month before 30 March is 29 February, so February has begun by then and March has not.
    assert tl.salary_months(cal, month(1), dt.date(2024, 3, 30)).count() == 2
    balances = {r.start_of_month: r.month_end_date for r in tl.with_balance_months(spark.range(1), month(1), month(3)).collect()}
    assert balances[month(3)] == dt.date(2024, 3, 31) and len(balances) == 3


def test_days_covering(spark):
    df = spark.createDataFrame([(dt.date(2023, 5, 5),), (dt.date(2024, 1, 2),), (None,)], "d date")
    days = tl.days_covering(df, "d").agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(days) == (dt.date(2023, 1, 1), dt.date(2024, 12, 31), 731)
    assert tl.days_covering(df.limit(0), "d").count() == 0


def test_salaries(spark):
    day = lambda m, d: dt.date(2024, m, d)
    rows = [
        (None, day(3, 16), "ING_NOMINA", None, None, "Acme", None, D(10), True, False),
        (None, day(2, 17), "ING_NOMINA", None, None, "Zeta", None, D(5), True, False),
        (None, day(4, 20), "ING_PRESTACIONES", None, None, "Ignored", None, D(7), True, False),
        (None, day(4, 20), "VAR_OTROS", None, None, "Ignored", None, D(99), True, False),
    ]
    totals = ag.salary_totals(spark.createDataFrame(rows, FACT))
    cal = tl.calendar_attributes(tl.days_between(spark, month(1), dt.date(2024, 12, 31)))
    out = ag.newest_first(ag.salaries_by_month(tl.salary_months(cal, month(2), dt.date(2024, 5, 1)), totals), "fecha")
    got = [(r.periodo, r.empresa, r.importe_nomina, r.importe_prestacion, r.importe_total) for r in out.collect()]
    zero = D("0.00")
    assert got == [
        ("2024-04", "INSS", zero, D("7.00"), D("7.00")),
        ("2024-03", "-", zero, zero, zero),
        ("2024-02", "Zeta", D("15.00"), zero, D("15.00")),
    ]


def test_salary_totals_leave_other_rows_and_their_months_out(spark):
    day = lambda m, d: dt.date(2024, m, d)
    rows = [
        (None, day(5, 20), "ING_NOMINA", None, None, "Acme", None, None, True, False),
        (None, day(6, 20), "ING_NOMINA", None, None, None, None, D(3), True, False),
        (None, day(6, 20), "ING_NOMINA", None, None, "Acme", None, D(4), True, False),
        (None, day(7, 1), "ING_PRESTACIONES", None, None, "Ignored", None, D(2), True, False),
        (None, day(6, 20), None, None, None, "Zeta", None, D(9), True, False),
        (None, day(8, 20), "VAR_OTROS", None, None, "Zeta", None, D(9), True, False),
        (None, None, "VAR_OTROS", None, None, "Zeta", None, D(9), True, False),
    ]
    got = {tuple(r) for r in ag.salary_totals(spark.createDataFrame(rows, FACT)).collect()}
    assert got == {(month(5), "Acme", None, D("0.00"), None), (month(6), "Acme", D("7.00"), D("2.00"), D("9.00"))}


@pytest.mark.parametrize("mart", ["totals", "monthly"])
def test_salaries_do_not_repeat_the_category_chain_in_every_statement(spark, warehouse, cfg, mart):
    # As many adjustments as are joined by a shuffle; the rules are still tried in order.
    large = Warehouse(spark, warehouse.inputs, replace(cfg, limits=Limits(broadcast_rows=100)))
    found = ag.salary_totals(large.fct_transactions()) if mart == "totals" else large.fct_salaries_monthly()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert max(len(line) for line in plan.splitlines() if "Filter " in line) < 2_000


def test_balances(spark):
    accounts = spark.createDataFrame(
        [("A", "one", "t"), ("A", "two", "t"), ("A", "two", "t"), ("B", "b", "t")],
        "account_id string, account_name string, account_type string",
    )
    tx = spark.createDataFrame(
        [("A", month(1), D(5)), ("A", month(3), D(-2)), ("A", month(12, 2023), D(100)), ("?", month(1), D(9)), ("A", month(1), None)],
        "account_id string, year_month date, amount decimal(18,2)",
    )
    grid = ag.account_months(accounts, dt.date(2024, 1, 15), dt.date(2024, 3, 10))
    assert grid.count() == 9
    out = ag.by_account_and_month(ag.running_balances(grid, ag.monthly_flow(tx))).collect()
    got = [(r.account_id, r.account_name, r.year_month, r.net_monthly_flow, r.ending_balance) for r in out]
    one = [g[2:] for g in got if g[1] == "two"]
    assert one == [("2024-01", D("5.00"), D("10.00")), ("2024-02", D("0.00"), D("10.00")), ("2024-03", D("-2.00"), D("6.00"))]
    assert [g[4] for g in got if g[0] == "B"] == [D("0.00")] * 3
    assert ag.account_months(accounts, month(5), month(4)).count() == 0


def test_capex(spark):
    def row(m, category, group, amount):
        return (m, None, category, group, None, None, D(amount), None, False, False)

    rows = [
        row(month(1), "CPX_CONSTRUCTORA", "CAPEX", -10),
        row(month(1), "CPX_DISPOSICION", None, 30),
        row(month(1), "OTHER", "CAPEX", -99),
        row(month(2), "OTHER", "CAPEX", -99),
        row(month(3), "OTHER", None, -99),
        row(None, "CPX_TECNICOS", None, -1),
    ]
    out = ag.newest_first(ag.capex_by_month(spark.createDataFrame(rows, FACT)), "year_month").collect()
    assert [r.year_month for r in out] == [None, month(2), month(1)]
    assert tuple(out[2])[1:] == tuple(D(v).quantize(D("0.01")) for v in (-10, 0, 0, -10, 30, 20))
    assert set(tuple(out[1])[1:]) == {D("0.00")}


def test_pnl_measures_and_changes(spark):
    def row(m, kind, group, amount, own, pnl=True, shared=False, category="X"):
        return (m, None, category, group, kind, None, D(amount), D(own), pnl, shared)

    rows = [
        row(month(1), "INCOME", None, 100, 100),
        row(month(1), "EXPENSE", "Gastos Fijos", -40, -20, shared=True, category="FIX_HIPOTECA"),
        row(month(1), "EXPENSE_REFUND", "Gastos Variables", 10, 5, shared=True),
        row(month(1), "EXPENSE", "Gastos Fijos", -7, -7, pnl=False),
        row(month(3), "INCOME", None, 150, 150),
        row(month(4), "EXPENSE", "Gastos Financieros", -3, -3),
        row(month(5), "INCOME", None, 1, 1),
    ]
    got = ag.monthly_pnl(spark.createDataFrame(rows, FACT)).orderBy("year_month").collect()
    jan, mar, apr, may = got
    assert (jan.personal_income, jan.personal_expense, jan.personal_fixed_expenses) == (D(100), D(15), D(20))
    assert (jan.personal_variable_expenses, jan.personal_net_savings, jan.savings_rate_pct) == (D(-5), D(85), D("0.85"))
    assert (jan.household_total_cost, jan.mortgage_household_amount) == (D(30), D(40))
    assert jan.prev_personal_income is None and jan.personal_income_mom_pct is None
    # February has no rows, so March is compared with January.
    assert (mar.prev_personal_income, mar.personal_income_mom_pct) == (D(100), D("0.5"))
    assert (mar.personal_expense_mom_pct, apr.savings_rate_pct) == (D(-1), D(0))
    assert apr.personal_expense_mom_pct is None and may.personal_income_mom_pct is None


def test_missing_month_sorts_last_ascending_and_first_descending(spark):
    rows = [(m, None, "X", None, "INCOME", None, D(1), D(v), True, False) for m, v in ((month(1), 1), (None, 2), (month(2), 3))]
    pnl = ag.monthly_pnl(spark.createDataFrame(rows, FACT))
    out = ag.newest_first(pnl, "year_month").collect()
    assert [r.year_month for r in out] == [None, month(2), month(1)]
    assert out[0].prev_personal_income == D(3)


def test_facts_and_properties(warehouse, resolved):
    facts = ag.fact(resolved)
    assert facts.columns == FACT_COLUMNS
    assert facts.count() == resolved.count()
    # Net savings are income less expense where every P&L row is one of the three known kinds.
    known = facts.filter(F.col("movement_type").isin("INCOME", "EXPENSE", "EXPENSE_REFUND"))
    wrong = ag.pnl_measures(known).filter("personal_net_savings <> personal_income - personal_expense")
    assert wrong.count() == 0
    # The last balance is the sum of the flows inside the calendar.
    flows = ag.monthly_flow(resolved)
    balances = ag.running_balances(warehouse.account_months(), flows)
    last = {r.account_id: r.ending_balance for r in balances.filter("year_month = '2024-01'").collect()}
    sums = {r[0]: r[1] for r in flows.groupBy("account_id").agg(F.sum("net_monthly_flow")).collect()}
    assert all(value == sums.get(account, D("0.00")) for account, value in last.items())
