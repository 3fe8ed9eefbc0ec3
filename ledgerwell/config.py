"""Everything an installation may change: owners, accounts, dates and physical limits."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class AccountIds:
    """Identifier that staging stamps on each raw statement table."""

    personal: str = "ACCOUNT_PERSONAL"
    common: str = "ACCOUNT_COMMON"
    card_personal: str = "CARD_PERSONAL"
    card_common: str = "CARD_COMMON"
    card_common_2: str = "CARD_COMMON_2"
    cash: str = "CASH"
    wallet: str = "WALLET"


@dataclass(frozen=True)
class Limits:
    """Physical bounds. They choose a strategy; they never change a result."""

    # A side is broadcast only when its measured size is within both bounds.
    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 * 1024 * 1024
    # Up to this many keywords a nested loop beats looking up every gram (at 74: 10.1 s against 11.6 s).
    nested_loop_keywords: int = 96
    # Keys (or grams) with more rows than this are spread over several tasks.
    hot_key_rows: int = 2_000_000
    # Buckets in which hot keys are listed; keys of a bucket are spread alike.
    hot_keys: int = 100_000


@dataclass(frozen=True)
class LedgerConfig:
    # Display names as they appear in master_participants.person_name.
    self_name: str
    partner_name: str
    # Regular expressions that find the two owners in statement text (case-insensitive).
    self_pattern: str
    partner_pattern: str
    # Wallet product as named on card statements and in top-ups, e.g. "WALLETPAY".
    wallet_pattern: str
    # Firms whose lines on the common account are construction spending.
    capex_patterns: tuple[str, ...] = ()
    # Card products whose monthly settlement stands on the personal and on the common account.
    personal_card_pattern: str | None = None
    common_card_pattern: str | None = None
    # Joint products to which the owner moves own money.
    joint_pattern: str | None = None
    # Rows (source, nature, pattern, sign of the amount or None) tried before the rules of a source, in order;
    # sources are personal, common, cards, cash and wallet.
    nature_rules: tuple[tuple[str, str, str, int | None], ...] = ()

    accounts: AccountIds = field(default_factory=AccountIds)

    calendar_start: dt.date = dt.date(2020, 1, 1)
    calendar_end: dt.date = dt.date(2030, 12, 31)
    salary_start: dt.date = dt.date(2021, 12, 1)
    # "Today" of the run. None means the date on which the plan is built.
    as_of: dt.date | None = None

    # Opt-in departures from the default matching behaviour.
    fold_accents: bool = False
    whole_transfer_prefix: bool = False

    limits: Limits = field(default_factory=Limits)

    def today(self) -> dt.date:
        return self.as_of or dt.date.today()
