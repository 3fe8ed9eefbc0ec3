"""Ledgerwell: transaction-ledger analytics as PySpark DataFrame plans."""

from ledgerwell.config import LedgerConfig

__all__ = ["LedgerConfig"]
