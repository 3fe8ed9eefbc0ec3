"""The models of the warehouse as methods that build plans from one another."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell import rulebook as book
from ledgerwell.config import LedgerConfig
from ledgerwell.operators import aggregate, resolve, timeline
from ledgerwell.operators.classify import classify, union_all, with_account, with_own_account
from ledgerwell.operators.joins import Dimension
from ledgerwell.operators.matching import Texts, attach_participant, attach_rule
from ledgerwell.plans import staging
from ledgerwell.schemas import MONEY
from ledgerwell.sources.inputs import Inputs


def model(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """A model whose plan is built once, or read where it has been stored already."""
    name = build.__name__

    @wraps(build)
    def plan(self: Warehouse) -> DataFrame:
        found = self.stored(name)
        if found is not None:
            return found
        if name not in self._plans:
            self._plans[name] = build(self)
        return self._plans[name]

    return plan


@dataclass(frozen=True)
class Warehouse:
    """Lazy models over one set of inputs.

    ``stored`` returns an already written table instead of its plan, so that models with several readers
    are computed once per run.
    """

    spark: SparkSession
    inputs: Inputs
    cfg: LedgerConfig
    stored: Callable[[str], DataFrame | None] = lambda model: None
    _dimensions: dict[str, tuple[tuple[str, ...], Dimension]] = field(default_factory=dict, repr=False)
    _plans: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _texts: dict[str, Texts] = field(default_factory=dict, repr=False)

    def reading(self, stored: Callable[[str], DataFrame | None]) -> Warehouse:
        return replace(self, stored=stored, _plans={}, _texts={})

    def dimension(self, table: str) -> Dimension:
        """Reference table whose size is measured once for each state of its files."""
        df = self.inputs[table]
        files = tuple(sorted(df.inputFiles()))
        known = self._dimensions.get(table)
        if known is None or not files or known[0] != files:
            known = self._dimensions[table] = (files, Dimension(df))
        return known[1]

    # Staging

    @model
    def stg_account_personal(self) -> DataFrame:
        return staging.account_statement(self.inputs["account_personal"], self.cfg.accounts.personal)

    @model
    def stg_account_common(self) -> DataFrame:
        return staging.account_statement(self.inputs["account_common"], self.cfg.accounts.common)

    @model
    def stg_card_personal(self) -> DataFrame:
        return staging.card_statement(self.inputs["card_personal"], self.cfg.accounts.card_personal)

    @model
    def stg_card_common(self) -> DataFrame:
        return staging.card_statement(self.inputs["card_common"], self.cfg.accounts.card_common)

    @model
    def stg_card_common_2(self) -> DataFrame:
        return staging.card_statement(self.inputs["card_common_2"], self.cfg.accounts.card_common_2)

    @model
    def stg_cash(self) -> DataFrame:
        return staging.cash_book(self.inputs["cash"], self.cfg.accounts.cash)

    @model
    def stg_wallet(self) -> DataFrame:
        return staging.wallet_statement(self.inputs["wallet"], self.cfg.accounts.wallet)

    # Intermediate

    def _enriched(self, rows: DataFrame) -> DataFrame:
        return with_account(rows, self.dimension("dim_account"), self.cfg.limits)

    def _own(self, rows: DataFrame, account_id: str) -> DataFrame:
        return with_own_account(rows, self.dimension("dim_account"), account_id, self.cfg.limits)

    @model
    def int_account_personal(self) -> DataFrame:
        return classify(self._own(self.stg_account_personal(), self.cfg.accounts.personal), book.personal_account(self.cfg))

    @model
    def int_account_common(self) -> DataFrame:
        return classify(self._own(self.stg_account_common(), self.cfg.accounts.common), book.common_account(self.cfg))

    @model
    def cards_staged(self) -> DataFrame:
        return union_all([self.stg_card_personal(), self.stg_card_common(), self.stg_card_common_2()])

    @model
    def int_cards(self) -> DataFrame:
        rows = self.cards_staged().withColumnRenamed("billing_date", "booking_date")
        return classify(self._enriched(rows.withColumn("balance", F.lit(None).cast(MONEY))), book.cards(self.cfg))

    @model
    def int_cash(self) -> DataFrame:
        rows = self.stg_cash().withColumn("booking_date", F.col("value_date"))
        return classify(self._own(rows, self.cfg.accounts.cash), book.cash(self.cfg))

    @model
    def int_wallet(self) -> DataFrame:
        rows = self._own(self.stg_wallet(), self.cfg.accounts.wallet)
        return classify(rows, book.wallet(self.cfg), kind="raw_transaction_type", fee="fee")

    @model
    def int_transactions_unioned(self) -> DataFrame:
        return union_all(
            [
                self.int_account_personal(),
                self.int_account_common(),
                self.int_cards(),
                self.int_cash(),
                self.int_wallet(),
            ]
        )

    def descriptions(self) -> Texts:
        """The distinct statement texts, read apart from the other columns."""
        if "descriptions" not in self._texts:
            self._texts["descriptions"] = Texts(self.int_transactions_unioned(), "description")
        return self._texts["descriptions"]

    @model
    def with_participant(self) -> DataFrame:
        people = self.inputs["master_participants"]
        return attach_participant(self.int_transactions_unioned(), people, self.cfg, texts=self.descriptions())

    def matched(self, way: str | None) -> DataFrame:
        rules = self.inputs["rules_mapping"]
        return attach_rule(self.with_participant(), rules, self.cfg, way, self.descriptions())

    @model
    def with_rule(self) -> DataFrame:
        return self.matched(None)

    @model
    def adjusted(self) -> DataFrame:
        return resolve.with_adjustments(self.with_rule(), self.dimension("master_adjustments"), self.cfg.limits)

    @model
    def resolved(self) -> DataFrame:
        return resolve.resolve(self.adjusted(), self.cfg)

    @model
    def categorised(self) -> DataFrame:
        return resolve.with_category(self.resolved(), self.dimension("dim_categories"), self.cfg.limits)

    @model
    def int_transactions(self) -> DataFrame:
        return resolve.finish(self.categorised(), self.cfg)

    # Marts

    @model
    def dim_calendar(self) -> DataFrame:
        days = timeline.days_between(self.spark, self.cfg.calendar_start, self.cfg.calendar_end)
        return timeline.calendar_attributes(days)

    @model
    def fct_transactions(self) -> DataFrame:
        return aggregate.fact(self.int_transactions())

    @model
    def fct_salaries_monthly(self) -> DataFrame:
        months = timeline.salary_months(self.dim_calendar(), self.cfg.salary_start, self.cfg.today())
        totals = aggregate.salary_totals(self.fct_transactions())
        return aggregate.newest_first(aggregate.salaries_by_month(months, totals), "fecha")

    @model
    def account_months(self) -> DataFrame:
        last = min(self.cfg.today(), self.cfg.calendar_end)
        return aggregate.account_months(self.inputs["dim_account"], self.cfg.calendar_start, last)

    @model
    def fct_monthly_balances(self) -> DataFrame:
        flows = aggregate.monthly_flow(self.int_transactions())
        return aggregate.by_account_and_month(aggregate.running_balances(self.account_months(), flows))

    @model
    def fct_capex_summary(self) -> DataFrame:
        return aggregate.newest_first(aggregate.capex_by_month(self.fct_transactions()), "year_month")

    @model
    def fct_monthly_pnl(self) -> DataFrame:
        return aggregate.newest_first(aggregate.monthly_pnl(self.fct_transactions()), "year_month")
