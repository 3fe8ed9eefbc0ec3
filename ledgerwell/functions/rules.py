"""Ordered rules held as data and turned into one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwell.functions.text import matches


def cascade(branches: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """First branch whose condition is true; a NULL condition counts as false."""
    branches = list(branches)
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_sign(amount: Column, sign: int) -> Column:
    return amount > 0 if sign > 0 else amount < 0


@dataclass(frozen=True)
class NatureRule:
    """Nature of a statement line; every given field has to hold, cheap ones are tested first."""

    nature: str
    pattern: str | None = None
    sign: int | None = None
    types: tuple[str, ...] = ()

    def condition(self, text: Column, amount: Column, kind: Column | None) -> Column:
        parts = []
        if self.types:
            parts.append(kind.isin(*self.types))
        if self.sign is not None:
            parts.append(has_sign(amount, self.sign))
        if self.pattern is not None:
            parts.append(matches(text, self.pattern))
        return all_of(parts)


@dataclass(frozen=True)
class CategoryRule:
    """Category of a resolved transaction; every given field has to hold."""

    category: str
    participant: str | None = None
    ownership: str | None = None
    nature: str | None = None
    sign: int | None = None

    def condition(self) -> Column:
        parts = []
        if self.participant is not None:
            parts.append(F.col("participant_name") == self.participant)
        if self.ownership is not None:
            parts.append(F.col("account_ownership") == self.ownership)
        if self.nature is not None:
            parts.append(F.col("transaction_nature") == self.nature)
        if self.sign is not None:
            parts.append(has_sign(F.col("amount"), self.sign))
        return all_of(parts)


def category_chain(rules: Iterable[CategoryRule], otherwise: Column | None = None) -> Column:
    return cascade(((rule.condition(), F.lit(rule.category)) for rule in rules), otherwise)
