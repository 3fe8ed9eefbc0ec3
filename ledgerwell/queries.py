"""Registered queries: one per operator, over whole testdata tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwell.config import Limits
from ledgerwell.fixtures.testdata import CONFIG, TestData
from ledgerwell.functions.text import normalise
from ledgerwell.operators import aggregate, resolve, timeline
from ledgerwell.operators.classify import union_all, with_account
from ledgerwell.operators.resolve import resolved_movement_type
from ledgerwell.plans.run import run_layers
from ledgerwell.plans.warehouse import Warehouse
from ledgerwell.schemas import TOTAL
from ledgerwell.session import shared_folder
from ledgerwell.sources.sinks import drop_tables

KEY = ("source_hash", "source_row_id", "account_id")
ADJUSTED = (*KEY, "adjustment_reason")
#: Tables beyond any broadcast, and keys that are hot from few rows on.
SHUFFLED = Limits(broadcast_rows=0, hot_key_rows=10_000)


@lru_cache(maxsize=8)
def _warehouse(application: str, session: SparkSession, root: str) -> Warehouse:
    return Warehouse(session, TestData(session, root).inputs(), CONFIG)


def warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Models over one folder: plans and table sizes are found once per application."""
    return _warehouse(spark.sparkContext.applicationId, spark, root)


def _stamped(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare across engines and time zones."""
    stamps = [c for c in ("loaded_at", "updated_at") if c in df.columns]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps}) if stamps else df


def _accounts(w: Warehouse) -> DataFrame:
    return union_all([w.stg_account_personal(), w.stg_account_common()])


def account_enrich(w: Warehouse) -> DataFrame:
    rows = with_account(_accounts(w), w.dimension("dim_account"), w.cfg.limits)
    return rows.select(
        "account_id", "source_row_id", "source_hash", "amount", "bank", "account_type", "account_ownership"
    )


def cards_union(w: Warehouse) -> DataFrame:
    """What each card contributes to the union of the card statements."""
    return w.cards_staged().groupBy("account_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("source_hash").alias("hashes"),
        F.sum("amount").cast(TOTAL).alias("amount"),
    )


def text_normalise(w: Warehouse) -> DataFrame:
    text = F.col("description")
    texts = w.int_transactions_unioned().select(text).distinct()
    return texts.select(text, normalise(text).alias("normalised"), normalise(text, True).alias("folded"))


def rules(way: str | None) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.matched(way).select(*KEY, "rule_category_id", "rule_merchant", "rule_priority")


def _data_years(w: Warehouse) -> tuple[dt.date, dt.date]:
    """First and last day of the years that the transactions cover."""
    first, last = w.int_transactions_unioned().agg(F.year(F.min("value_date")), F.year(F.max("value_date"))).first()
    return dt.date(first, 1, 1), dt.date(last, 12, 31)


def _data_calendar(w: Warehouse) -> DataFrame:
    return timeline.calendar_attributes(timeline.days_between(w.spark, *_data_years(w)))


def month_spines(w: Warehouse) -> DataFrame:
    first, last = _data_years(w)
    calendar = timeline.calendar_attributes(timeline.days_between(w.spark, first, last))
    salaries = timeline.salary_months(calendar, w.cfg.salary_start, w.cfg.today()).select(
        F.lit("salaries").alias("spine"),
        "start_of_month",
        F.last_day("start_of_month").alias("month_end_date"),
        "year_month",
    )
    one = w.spark.range(1).select(F.lit("balances").alias("spine"))
    return salaries.unionByName(timeline.with_balance_months(one, first, min(last, w.cfg.today())))


def mart_order(w: Warehouse) -> DataFrame:
    """At which place each row of an ordered mart stands: months in the whole mart, balances among their account's."""
    place = F.monotonically_increasing_id().alias("_place")

    def placed(df: DataFrame, mart: str, month: str, account: Column) -> DataFrame:
        rows = df.select(F.lit(mart).alias("mart"), account.alias("account_id"), F.col(month).alias("month"), place)
        order = Window.partitionBy("account_id").orderBy("_place")
        return rows.withColumn("position", F.row_number().over(order).cast("long")).drop("_place")

    none = F.lit("")
    marts = [
        placed(w.fct_salaries_monthly(), "fct_salaries_monthly", "fecha", none),
        placed(w.fct_monthly_balances(), "fct_monthly_balances", "month_end_date", F.col("account_id")),
        placed(w.fct_capex_summary(), "fct_capex_summary", "year_month", none),
        placed(w.fct_monthly_pnl(), "fct_monthly_pnl", "year_month", none),
    ]
    return reduce(DataFrame.unionByName, (m.withColumn("month", F.col("month").cast("string")) for m in marts))


def account_month_grid(w: Warehouse) -> DataFrame:
    return aggregate.filled_grid(w.account_months(), aggregate.monthly_flow(w.int_transactions()))


def _rated(w: Warehouse) -> DataFrame:
    return aggregate.with_savings_rate(aggregate.pnl_measures(w.fct_transactions()))


def _lagged(w: Warehouse) -> DataFrame:
    return aggregate.with_previous_month(_rated(w))


def layer_run_report(w: Warehouse) -> DataFrame:
    """Everything built once into a new shared folder, reported model by model; the tables are removed then."""
    out = shared_folder(w.spark, "ledger-run")
    try:
        return run_layers(w.spark, w.inputs, w.cfg, out, "*").models(w.spark)
    finally:
        drop_tables(w.spark, out)


MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "cash_running_balance": lambda w: w.fct_monthly_balances().filter(F.col("account_id") == w.cfg.accounts.cash),
    "stg_accounts": _accounts,
    "stg_cards": lambda w: w.cards_staged(),
    "stg_cash": lambda w: w.stg_cash(),
    "stg_wallet": lambda w: w.stg_wallet(),
    "account_enrich": account_enrich,
    "nature_personal": lambda w: w.int_account_personal(),
    "nature_common": lambda w: w.int_account_common(),
    "nature_cards": lambda w: w.int_cards(),
    "nature_cash": lambda w: w.int_cash(),
    "nature_wallet": lambda w: w.int_wallet(),
    "cards_union": cards_union,
    "transactions_unioned": lambda w: w.int_transactions_unioned(),
    "text_normalise": text_normalise,
    "participant_match": lambda w: w.with_participant().select(*KEY, "description", "participant_name"),
    "rule_match": rules(None),
    "rule_match_nested": rules("nested"),
    "rule_match_gram": rules("grams"),
    "rule_match_coded": rules("coded"),
    "rule_match_shuffled": rules("shuffled"),
    "adjustment_join": lambda w: w.adjusted().select(
        *ADJUSTED, "category_id_override", "merchant_override", "adjustment_type", "adjustment_amount"
    ),
    "adjustment_join_shuffled": lambda w: resolve.with_adjustments(
        w.with_rule(), w.dimension("master_adjustments"), SHUFFLED
    ).select(*ADJUSTED, "category_id_override", "merchant_override", "adjustment_type", "adjustment_amount"),
    "category_resolve": lambda w: w.resolved().select(*ADJUSTED, "category_id"),
    "participant_resolve": lambda w: w.resolved().select(*ADJUSTED, "participant_name"),
    "merchant_resolve": lambda w: w.resolved().select(*ADJUSTED, "merchant"),
    "category_join": lambda w: w.categorised().select(
        *ADJUSTED, "category_id", "group_name", "category_name", "subcategory_name", "category_is_pnl"
    ),
    "category_join_shuffled": lambda w: resolve.with_category(
        w.resolved(), w.dimension("dim_categories"), SHUFFLED
    ).select(*ADJUSTED, "category_id", "group_name", "category_name", "subcategory_name", "category_is_pnl"),
    "movement_resolve": lambda w: w.categorised().select(
        *ADJUSTED, "category_id", "amount", resolved_movement_type().alias("movement_type")
    ),
    "personal_split": lambda w: w.int_transactions().select(
        *ADJUSTED, "amount", "personal_amount", "personal_share_pct"
    ),
    "pnl_flags": lambda w: w.int_transactions().select(
        *ADJUSTED, "year_month", "year", "month", "is_pnl", "is_shared"
    ),
    "int_transactions": lambda w: w.int_transactions(),
    "fct_transactions": lambda w: w.fct_transactions(),
    "dim_calendar": _data_calendar,
    "month_spines": month_spines,
    "salary_totals": lambda w: aggregate.salary_totals(w.fct_transactions()),
    "fct_salaries_monthly": lambda w: w.fct_salaries_monthly(),
    "monthly_flow": lambda w: aggregate.monthly_flow(w.int_transactions()),
    "account_month_grid": account_month_grid,
    "fct_monthly_balances": lambda w: w.fct_monthly_balances(),
    "capex_rows": lambda w: aggregate.capex_rows(w.fct_transactions()).select(
        "source_hash", "account_id", "accrual_month", "category_id", "group_name", "amount", "adjustment_reason"
    ),
    "fct_capex_summary": lambda w: w.fct_capex_summary(),
    "pnl_measures": lambda w: aggregate.pnl_measures(w.fct_transactions()),
    "pnl_savings_rate": _rated,
    "pnl_lag": _lagged,
    "pnl_mom": lambda w: aggregate.with_month_over_month(_lagged(w)).select(
        "year_month", "personal_income_mom_pct", "personal_expense_mom_pct", "household_cost_mom_pct"
    ),
    "fct_monthly_pnl": lambda w: w.fct_monthly_pnl(),
    "mart_order": mart_order,
    "layer_run_report": layer_run_report,
}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, root: _stamped(MODELS[name](warehouse(spark, root)))
