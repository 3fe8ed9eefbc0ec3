"""Category, merchant and participant by priority; ownership split and flags."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell import rulebook as book
from ledgerwell.config import LedgerConfig, Limits
from ledgerwell.functions import text as tx
from ledgerwell.functions.dates import month_start
from ledgerwell.functions.money import half, money, zero
from ledgerwell.functions.rules import cascade, category_chain
from ledgerwell.operators.joins import Dimension, fan_out, lookup
from ledgerwell.schemas import RESOLVED_COLUMNS, SHARE


def with_adjustments(rows: DataFrame, adjustments: Dimension, limits: Limits) -> DataFrame:
    """Manual corrections by ``source_hash``; several corrections repeat the transaction."""
    manual = adjustments.select(
        "source_hash",
        "category_id_override",
        "merchant_override",
        "adjustment_type",
        "adjustment_amount",
        F.col("reason").alias("adjustment_reason"),
    )
    return fan_out(rows, manual, "source_hash", limits)


def category(cfg: LedgerConfig) -> Column:
    """Manual override, withdrawal, owner, keyword rule, nature, sign: the first that applies."""
    return F.coalesce(
        F.col("category_id_override"),
        F.when(F.col("is_withdrawal"), book.WITHDRAWAL_CATEGORY),
        category_chain(book.owner_categories(cfg)),
        F.col("rule_category_id"),
        category_chain(book.NATURE_CATEGORIES, F.lit(book.OTHER_CATEGORY)),
    )


def participant() -> Column:
    """Nobody takes part in a withdrawal, whatever name its text holds."""
    return F.when(~F.col("is_withdrawal"), F.col("participant_name"))


def merchant(cfg: LedgerConfig) -> Column:
    """First non-NULL of the ten ways to name the other side; extractors may yield an empty name."""
    text = F.col("description")
    owners = F.col("participant_name").isin(cfg.partner_name, cfg.self_name)
    return F.coalesce(
        tx.blank_to_null(F.col("merchant_override")),
        F.col("rule_merchant"),
        F.when(F.col("is_withdrawal"), book.WITHDRAWAL_MERCHANT),
        F.when(owners, book.NEUTRAL_MERCHANT),
        tx.blank_to_null(F.col("participant_name")),
        tx.instant_payment_counterparty(text),
        tx.transfer_counterparty(text, cfg.whole_transfer_prefix),
        tx.card_merchant(text, F.col("account_type")),
        tx.direct_debit_creditor(text),
        F.lit(book.UNIDENTIFIED),
    )


def resolve(rows: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Final category, merchant and participant of each adjusted transaction."""
    rows = rows.withColumn("is_withdrawal", tx.is_withdrawal(F.col("description"), F.col("amount")))
    rows = rows.withColumns({"category_id": category(cfg), "merchant": merchant(cfg)})
    return rows.withColumn("participant_name", participant()).drop("is_withdrawal")


def with_category(rows: DataFrame, categories: Dimension, limits: Limits) -> DataFrame:
    """Names and P&L membership of the category; a category without entry is outside the P&L."""
    names = categories.select(
        "category_id",
        "group_name",
        "category_name",
        "subcategory_name",
        F.col("is_pnl").alias("category_is_pnl"),
        F.col("movement_type").alias("category_movement_type"),
    )
    found = lookup(rows, names, "category_id", limits)
    return found.withColumn("category_is_pnl", F.coalesce("category_is_pnl", F.lit(False)))


def resolved_movement_type() -> Column:
    settlement = F.col("category_id") == book.COUPLE_SETTLEMENT
    incoming, outgoing = F.col("amount") > 0, F.col("amount") < 0
    return cascade(
        [
            (settlement & incoming, F.lit("INCOME")),
            (settlement & outgoing, F.lit("EXPENSE")),
            (incoming & (F.col("category_movement_type") == "EXPENSE"), F.lit("EXPENSE_REFUND")),
        ],
        F.coalesce("category_movement_type", "movement_type"),
    )


def _adjusted(kind: str) -> Column:
    return F.col("adjustment_type") == kind


def _settled() -> Column:
    return F.col("transaction_nature") == book.CARD_SETTLEMENT


def _shared_half() -> Column:
    """Lines of a common account of which the owner bears one half."""
    counted = F.col("movement_type").isin("EXPENSE", "INCOME", "EXPENSE_REFUND")
    # "_" stands for any one character here, as in LIKE generally.
    return (F.col("account_ownership") == "common") & (counted | F.col("category_id").like("CPX_%") | _settled())


def _own_funding(cfg: LedgerConfig) -> tuple[Column, Column]:
    funding = F.col("category_id") == book.COMMON_FUNDING
    return funding & (F.col("participant_name") == cfg.self_name), funding


def personal_amount(cfg: LedgerConfig) -> Column:
    amount = F.col("amount")
    own, funding = _own_funding(cfg)
    kept = F.abs(amount) - F.abs(F.coalesce(F.col("adjustment_amount"), zero()))
    return money(
        cascade(
            [
                (_adjusted("PARTNER_EXPENSE"), zero()),
                (_adjusted("MY_EXPENSE"), amount),
                (_adjusted("PARTIAL_EXPENSE"), -half(kept)),
                (F.col("account_ownership") == "personal", amount),
                (own, amount),
                (funding, zero()),
                (_shared_half(), half(amount)),
            ],
            zero(),
        )
    )


def personal_share(cfg: LedgerConfig) -> Column:
    """Share in per one. Funding stands before personal ownership here, unlike in the amount."""
    none, part, all_ = (F.lit(Decimal(v)).cast(SHARE) for v in ("0.00", "0.50", "1.00"))
    own, funding = _own_funding(cfg)
    return cascade(
        [
            (_adjusted("PARTNER_EXPENSE"), none),
            (_adjusted("MY_EXPENSE"), all_),
            (own, all_),
            (funding, none),
            (F.col("account_ownership") == "personal", all_),
            (_shared_half(), part),
        ],
        none,
    )


def in_pnl() -> Column:
    never = F.col("transaction_nature").isin(book.INTERNAL_TRANSFER, book.PARTNER_CONTRIBUTION)
    outside = [
        _adjusted("PARTNER_EXPENSE"),
        ~F.col("category_is_pnl"),
        F.col("movement_type") == "TRANSFER",
        never,
        _settled() & F.col("category_id_override").isNull(),
    ]
    return cascade(((condition, F.lit(False)) for condition in outside), F.lit(True))


def shared() -> Column:
    common = F.col("account_ownership") == "common"
    yes, no = F.lit(True), F.lit(False)
    return cascade(
        [
            (~F.col("category_is_pnl"), no),
            (F.col("movement_type") == "TRANSFER", no),
            (_adjusted("PARTNER_EXPENSE"), no),
            (_adjusted("MY_EXPENSE"), no),
            (_adjusted("PARTIAL_EXPENSE"), yes),
            (common & (~_settled() | F.col("category_id_override").isNotNull()), yes),
            (F.col("category_id") == book.COUPLE_SETTLEMENT, yes),
        ],
        no,
    )


def finish(rows: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Resolved transactions in their final shape."""
    rows = rows.withColumn("movement_type", resolved_movement_type())
    rows = rows.withColumns(
        {
            "year_month": month_start(F.col("value_date")),
            "year": F.year("value_date"),
            "month": F.month("value_date"),
            "personal_amount": personal_amount(cfg),
            "personal_share_pct": personal_share(cfg),
            "is_pnl": in_pnl(),
            "is_shared": shared(),
        }
    )
    return rows.select(*RESOLVED_COLUMNS)
