"""Monthly measures: salaries, balances, capital expenditure, profit and loss.

Transactions are reduced to months (or account months) by partial aggregation before anything is ordered,
so the ordered windows run over calendar-sized data.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell import rulebook as book
from ledgerwell.functions.dates import accrual_month
from ledgerwell.functions.money import exact_ratio, total, zero
from ledgerwell.operators.timeline import with_balance_months
from ledgerwell.schemas import FACT_COLUMNS, RATIO, TOTAL

SPENT = ("EXPENSE", "EXPENSE_REFUND")
EARLY_PAY = (book.PAYROLL, book.BENEFIT, book.SEVERANCE)
SALARY_PAY = (book.PAYROLL, book.BENEFIT)


def fact(resolved: DataFrame) -> DataFrame:
    """Resolved transactions with bank month and accrual month."""
    accrued = accrual_month(F.col("value_date"), F.col("category_id"), EARLY_PAY)
    named = resolved.withColumnRenamed("year_month", "bank_year_month").withColumn("accrual_month", accrued)
    return named.select(*FACT_COLUMNS)


def salary_totals(facts: DataFrame) -> DataFrame:
    """Payroll and benefits by the month they were earned in.

    Other rows add nothing, and what holds no others goes after the sums. A filter before them would be repeated into
    every statement with the whole chain that finds a category, which is more than Spark compiles. Sums by payer come
    first, as the greatest text of a group needs its rows sorted.
    """
    payroll = F.col("category_id") == book.PAYROLL
    benefit = F.col("category_id") == book.BENEFIT
    amount = F.col("personal_amount")

    def earned(of_payroll: Column, of_benefit: Column) -> Column:
        return F.sum(F.when(payroll, of_payroll).when(benefit, of_benefit)).cast(TOTAL)

    by_payer = (
        facts.groupBy(
            accrual_month(F.col("value_date"), F.col("category_id"), SALARY_PAY).alias("_month"),
            F.when(payroll, F.col("merchant")).alias("_payer"),
        )
        .agg(
            earned(amount, zero()).alias("importe_nomina"),
            earned(zero(), amount).alias("importe_prestacion"),
            earned(amount, amount).alias("importe_total"),
            F.count(F.when(payroll | benefit, True)).alias("_paid"),
        )
        .filter("_paid > 0")
    )
    # As an aggregate the month keeps what a join infers about it above the sums as well.
    by_month = by_payer.groupBy("_month").agg(
        F.max("_month").alias("accrual_date"),
        F.coalesce(F.max("_payer"), F.lit(book.BENEFIT_PAYER)).alias("empresa"),
        *(total(F.col(c)).alias(c) for c in ("importe_nomina", "importe_prestacion", "importe_total")),
    )
    return by_month.drop("_month")


def salaries_by_month(months: DataFrame, totals: DataFrame) -> DataFrame:
    """Every month of the spine, with defaults where nothing was earned."""
    # One row per month on both sides.
    filled = months.join(totals, months["start_of_month"] == totals["accrual_date"], "left")
    amounts = ("importe_nomina", "importe_prestacion", "importe_total")
    return filled.select(
        F.col("start_of_month").alias("fecha"),
        F.col("year_month").alias("periodo"),
        "year",
        "month",
        F.coalesce("empresa", F.lit("-")).alias("empresa"),
        *(F.coalesce(F.col(c), zero()).cast(TOTAL).alias(c) for c in amounts),
    )


def monthly_flow(resolved: DataFrame) -> DataFrame:
    """Whole amounts by account and value month."""
    return resolved.groupBy("year_month", "account_id").agg(total(F.col("amount")).alias("net_monthly_flow"))


def account_months(accounts: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Every account in every month that has begun; months are generated per account, not joined."""
    known = accounts.select("account_id", "account_name", "account_type").distinct()
    spine = ("start_of_month", "month_end_date", "year_month")
    return with_balance_months(known, start, as_of).select(*spine, *known.columns)


def filled_grid(grid: DataFrame, flows: DataFrame) -> DataFrame:
    """Flow of every cell of the dense grid, zero where there is none; flows outside the grid are left out."""
    flows = flows.withColumnRenamed("year_month", "start_of_month")
    joined = grid.join(flows, ["start_of_month", "account_id"], "left")
    return joined.withColumn("net_monthly_flow", F.coalesce("net_monthly_flow", zero()).cast(TOTAL))


def running_balances(grid: DataFrame, flows: DataFrame) -> DataFrame:
    """Flow and running balance of every account at every month end."""
    filled = filled_grid(grid, flows)
    so_far = (
        Window.partitionBy("account_id")
        .orderBy(
            "month_end_date", F.col("account_name").asc_nulls_last(), F.col("account_type").asc_nulls_last()
        )
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return filled.select(
        "year_month",
        "month_end_date",
        "account_id",
        "account_name",
        "account_type",
        "net_monthly_flow",
        F.sum("net_monthly_flow").over(so_far).cast(TOTAL).alias("ending_balance"),
    )


def capex_rows(facts: DataFrame) -> DataFrame:
    wanted = F.col("category_id").isin(book.LOAN_DRAWDOWN, *book.BUILDING_COSTS)
    return facts.filter((F.col("group_name") == book.CAPEX_GROUP) | wanted)


def capex_by_month(facts: DataFrame) -> DataFrame:
    """Building costs against loan drawdowns by accrual month."""

    def of(*categories: str) -> Column:
        return total(F.col("amount"), F.col("category_id").isin(*categories))

    return (
        capex_rows(facts)
        .groupBy(F.col("accrual_month").alias("year_month"))
        .agg(
            of(book.BUILDER).alias("cost_constructora"),
            of(book.TECHNICAL).alias("cost_tecnicos_arquitecto"),
            of(book.PAPERWORK).alias("cost_tramites_notaria"),
            of(*book.BUILDING_COSTS).alias("total_project_investment"),
            of(book.LOAN_DRAWDOWN).alias("loan_disbursements"),
            of(book.LOAN_DRAWDOWN, *book.BUILDING_COSTS).alias("net_capex_cash_flow"),
        )
    )


def pnl_measures(facts: DataFrame) -> DataFrame:
    """Personal and household totals by accrual month; spending is shown positive."""
    counted, kind, group = F.col("is_pnl"), F.col("movement_type"), F.col("group_name")
    own, whole = F.col("personal_amount"), F.col("amount")

    def spent(amount: Column, when: Column) -> Column:
        return (-total(amount, when)).cast(TOTAL)

    return (
        facts.groupBy(F.col("accrual_month").alias("year_month"))
        .agg(
            total(own, counted & (kind == "INCOME")).alias("personal_income"),
            spent(own, counted & kind.isin(*SPENT)).alias("personal_expense"),
            spent(own, counted & group.isin(*book.FIXED_GROUPS)).alias("personal_fixed_expenses"),
            spent(own, counted & group.isin(*book.VARIABLE_GROUPS)).alias("personal_variable_expenses"),
            total(own, counted).alias("personal_net_savings"),
            spent(whole, F.col("is_shared") & kind.isin(*SPENT)).alias("household_total_cost"),
            spent(whole, F.col("category_id") == book.MORTGAGE).alias("mortgage_household_amount"),
        )
        .select(
            "year_month",
            F.year("year_month").alias("year"),
            F.month("year_month").alias("month"),
            "personal_income",
            "personal_expense",
            "personal_fixed_expenses",
            "personal_variable_expenses",
            "personal_net_savings",
            "household_total_cost",
            "mortgage_household_amount",
        )
    )


def with_savings_rate(measures: DataFrame) -> DataFrame:
    rate = F.when(
        F.col("personal_income") > 0, exact_ratio(F.col("personal_net_savings"), F.col("personal_income"))
    ).otherwise(F.lit(Decimal("0.0000")).cast(RATIO))
    return measures.withColumn("savings_rate_pct", rate)


# Ordered by month over all months: a calendar's worth of rows.
_MONTHS = ("personal_income", "personal_expense", "personal_net_savings", "savings_rate_pct", "household_total_cost")
_CHANGES = {
    "personal_income_mom_pct": "personal_income",
    "personal_expense_mom_pct": "personal_expense",
    "household_cost_mom_pct": "household_total_cost",
}


def with_previous_month(measures: DataFrame) -> DataFrame:
    """Values of the previous month that has transactions, which need not be the month before."""
    in_order = Window.orderBy(F.col("year_month").asc_nulls_last())
    return measures.withColumns({f"prev_{c}": F.lag(c).over(in_order) for c in _MONTHS})


def with_month_over_month(measures: DataFrame) -> DataFrame:
    """Relative change to that previous month; NULL for the first month and after a zero."""
    changes = {}
    for name, column in _CHANGES.items():
        now, before = F.col(column), F.col(f"prev_{column}")
        changes[name] = exact_ratio((now - before).cast(TOTAL), before)
    return measures.withColumns(changes)


def monthly_pnl(facts: DataFrame) -> DataFrame:
    full = with_month_over_month(with_previous_month(with_savings_rate(pnl_measures(facts))))
    order = [
        *("year_month", "year", "month", "personal_income", "personal_expense", "personal_fixed_expenses"),
        *("personal_variable_expenses", "personal_net_savings", "savings_rate_pct", "household_total_cost"),
        "mortgage_household_amount",
        *(f"prev_{c}" for c in _MONTHS),
        *_CHANGES,
    ]
    return full.select(*order)


def newest_first(df: DataFrame, month: str) -> DataFrame:
    return df.orderBy(F.col(month).desc_nulls_first())


def by_account_and_month(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("account_id").asc_nulls_last(), F.col("month_end_date").asc_nulls_last())
