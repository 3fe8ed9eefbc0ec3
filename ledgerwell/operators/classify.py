"""Classification of one statement source into the unified transaction shape."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.config import Limits
from ledgerwell.functions.money import half, money
from ledgerwell.functions.rules import cascade
from ledgerwell.operators.joins import Dimension, lookup
from ledgerwell.rulebook import REGULAR, SourceProfile
from ledgerwell.schemas import UNIFIED_COLUMNS


ACCOUNT_COPIES = 100


def with_account(rows: DataFrame, accounts: Dimension, limits: Limits) -> DataFrame:
    """Bank, account type and ownership of each line; unknown accounts keep NULLs."""
    owners = accounts.select("account_id", "bank", "account_type", F.col("owner").alias("account_ownership"))
    return lookup(rows, owners, "account_id", limits)


def with_own_account(rows: DataFrame, accounts: Dimension, account_id: str, limits: Limits) -> DataFrame:
    """The same for lines that all belong to one account: its few rows are looked up once and attached as constants.

    An account that is listed several times repeats each line; beyond ``ACCOUNT_COPIES`` the general join is used.
    """
    names = ["bank", "account_type", "owner"]
    own = accounts.df.filter(F.col("account_id") == account_id).select(*names).limit(ACCOUNT_COPIES + 1).collect()
    if len(own) > ACCOUNT_COPIES:
        return with_account(rows, accounts, limits)
    kinds = {c: accounts.df.schema[c].dataType for c in names}
    found = [F.struct(*(F.lit(row[c]).cast(kinds[c]).alias(c) for c in names)) for row in own or [dict.fromkeys(names)]]
    known = found[0] if len(found) == 1 else F.explode(F.array(*found))
    joined = rows.withColumn("_own", known)
    return joined.withColumns(
        {"bank": F.col("_own.bank"), "account_type": F.col("_own.account_type"), "account_ownership": F.col("_own.owner")}
    ).drop("_own")


def nature(profile: SourceProfile, kind: Column | None = None) -> Column:
    """First rule that holds names the nature of the line."""
    if not profile.rules:
        return F.lit(REGULAR)
    text, amount = F.col("description"), F.col("amount")
    return cascade(((r.condition(text, amount, kind), F.lit(r.nature)) for r in profile.rules), F.lit(REGULAR))


def movement_type(profile: SourceProfile, amount: Column) -> Column:
    """Transfer or expense by nature, otherwise by sign; zero and NULL amounts are neutral."""
    kind = F.col("transaction_nature")
    branches = [
        *([(kind.isin(*profile.transfers), F.lit("TRANSFER"))] if profile.transfers else []),
        *([(kind.isin(*profile.expenses), F.lit("EXPENSE"))] if profile.expenses else []),
        (amount > 0, F.lit("INCOME")),
        (amount < 0, F.lit("EXPENSE")),
    ]
    return cascade(branches, F.lit("NEUTRAL"))


def base_share(profile: SourceProfile, amount: Column) -> Column:
    if profile.share == "half":
        return half(amount)
    if profile.share == "half_if_common":
        return F.when(F.col("account_ownership") == "common", half(amount)).otherwise(amount)
    return amount


def classify(rows: DataFrame, profile: SourceProfile, kind: str | None = None, fee: str | None = None) -> DataFrame:
    """Unified transactions of one source.

    Sign tests look at the amount on the statement; the amount passed on is net of the fee. Both stand in
    one ``select`` so that the net amount cannot replace the gross one first.
    """
    gross = F.col("amount")
    net = money(gross - F.col(fee)) if fee else gross
    known = rows.withColumn("transaction_nature", nature(profile, F.col(kind) if kind else None))
    derived = {
        "amount": net,
        "personal_amount": base_share(profile, net),
        "movement_type": movement_type(profile, gross),
        "is_pnl": ~F.col("transaction_nature").isin(*profile.outside_pnl) if profile.outside_pnl else F.lit(True),
    }
    return known.select(*(derived[c].alias(c) if c in derived else F.col(c) for c in UNIFIED_COLUMNS))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
