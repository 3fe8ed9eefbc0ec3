"""Fixed values of the ledger: ordered rules, nature sets and category identifiers.

Names of people, firms and products are never listed here; they come from the configuration, and so do further
rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from ledgerwell.config import LedgerConfig
from ledgerwell.functions.rules import CategoryRule, NatureRule

REGULAR = "REGULAR"
CARD_SETTLEMENT = "CARD_SETTLEMENT"
INTERNAL_TRANSFER = "INTERNAL_TRANSFER"
PARTNER_CONTRIBUTION = "PARTNER_CONTRIBUTION"
LOAN_DISBURSEMENT = "LOAN_DISBURSEMENT"
MORTGAGE_PAYMENT = "MORTGAGE_PAYMENT"
EXPENSE_REFUND = "EXPENSE_REFUND"
CAPEX = "CAPEX"
SALARY = "SALARY"
REWARD = "REWARD"
BIZUM = "BIZUM"

# A word that starts with ANUL, wherever it stands.
CANCELLED = r"ANUL(?<![\p{L}\p{N}_]ANUL)"


@dataclass(frozen=True)
class SourceProfile:
    """How one kind of statement is classified."""

    rules: tuple[NatureRule, ...] = ()
    transfers: tuple[str, ...] = ()
    expenses: tuple[str, ...] = (EXPENSE_REFUND,)
    outside_pnl: tuple[str, ...] = ()
    # Share of the owner before resolution: "all", "half" or "half_if_common".
    share: str = "all"


def configured(cfg: LedgerConfig, source: str) -> tuple[NatureRule, ...]:
    """The installation's own rules for a source."""
    return tuple(NatureRule(nature, pattern, sign=sign) for own, nature, pattern, sign in cfg.nature_rules if own == source)


def _settlement(pattern: str | None) -> tuple[NatureRule, ...]:
    return (NatureRule(CARD_SETTLEMENT, rf"RECIBO ({pattern})"),) if pattern else ()


def personal_account(cfg: LedgerConfig) -> SourceProfile:
    own = [rf"RECARGA ({cfg.wallet_pattern})", "TRASPASO INTERNO", f"({cfg.self_pattern})"]
    if cfg.joint_pattern:
        own.insert(0, f"({cfg.joint_pattern})")
    return SourceProfile(
        rules=(
            *configured(cfg, "personal"),
            *_settlement(cfg.personal_card_pattern),
            NatureRule(BIZUM, r"BIZUM"),
            NatureRule(REGULAR, r"^(CAJA\s+[0-9]+|CAJERO|TRANSF\s+A\s+CAJERO)"),
            NatureRule(INTERNAL_TRANSFER, "|".join(own)),
            NatureRule(SALARY, r"TRANSF NOMI|PRESTACIONES SEGURIDAD SOCIAL"),
            NatureRule(EXPENSE_REFUND, CANCELLED, sign=1),
        ),
        transfers=(CARD_SETTLEMENT, INTERNAL_TRANSFER),
        outside_pnl=(CARD_SETTLEMENT, INTERNAL_TRANSFER),
    )


def common_account(cfg: LedgerConfig) -> SourceProfile:
    building = "|".join((*cfg.capex_patterns, "PROVISION FO"))
    moved = (CARD_SETTLEMENT, PARTNER_CONTRIBUTION, LOAN_DISBURSEMENT)
    return SourceProfile(
        rules=(
            *configured(cfg, "common"),
            *_settlement(cfg.common_card_pattern),
            NatureRule(PARTNER_CONTRIBUTION, rf"({cfg.self_pattern})|({cfg.partner_pattern})"),
            NatureRule(LOAN_DISBURSEMENT, r"IMP INIC PT|IMP DISP PT"),
            NatureRule(CAPEX, building),
            NatureRule(MORTGAGE_PAYMENT, r"LIQUID\. CUOTA PTMO"),
            NatureRule(BIZUM, r"BIZUM"),
            NatureRule(EXPENSE_REFUND, CANCELLED, sign=1),
        ),
        transfers=moved,
        expenses=(CAPEX, EXPENSE_REFUND),
        outside_pnl=(*moved, CAPEX),
        share="half",
    )


def cards(cfg: LedgerConfig) -> SourceProfile:
    return SourceProfile(
        rules=(
            *configured(cfg, "cards"),
            NatureRule(INTERNAL_TRANSFER, cfg.wallet_pattern),
            NatureRule(EXPENSE_REFUND, r"ANUL|ABONO|DEVOLUC|REEMB"),
            NatureRule(EXPENSE_REFUND, sign=1),
        ),
        transfers=(INTERNAL_TRANSFER,),
        outside_pnl=(INTERNAL_TRANSFER,),
        share="half_if_common",
    )


def cash(cfg: LedgerConfig) -> SourceProfile:
    return SourceProfile(rules=configured(cfg, "cash"))


def wallet(cfg: LedgerConfig) -> SourceProfile:
    return SourceProfile(
        rules=(
            *configured(cfg, "wallet"),
            NatureRule(INTERNAL_TRANSFER, types=("Recargas",)),
            NatureRule(INTERNAL_TRANSFER, rf"balance migration|({cfg.self_pattern})", types=("Transferir",)),
            NatureRule(REWARD, types=("Recompensa", "CASHBACK")),
            NatureRule(EXPENSE_REFUND, types=("Reembolso de tarjeta",)),
        ),
        transfers=(INTERNAL_TRANSFER,),
        outside_pnl=(INTERNAL_TRANSFER,),
    )


# Categories that rules and marts name.
COUPLE_SETTLEMENT = "PAREJA_COMPENSA"
COMMON_FUNDING = "MOV_FONDEO_COMUN"
OWN_TRANSFER = "MOV_TRASPASO"
WITHDRAWAL_CATEGORY = "VAR_CAJERO"
MORTGAGE = "FIX_HIPOTECA"
PAYROLL = "ING_NOMINA"
BENEFIT = "ING_PRESTACIONES"
SEVERANCE = "ING_INDEMNIZACION"
LOAN_DRAWDOWN = "CPX_DISPOSICION"
BUILDER = "CPX_CONSTRUCTORA"
TECHNICAL = "CPX_TECNICOS"
PAPERWORK = "CPX_TRAMITES"
BUILDING_COSTS = (BUILDER, TECHNICAL, PAPERWORK)
CAPEX_GROUP = "CAPEX"
FIXED_GROUPS = ("Gastos Fijos", "Gastos Compartidos")
VARIABLE_GROUPS = ("Gastos Variables", "Gastos Financieros")

# Labels of unresolved or neutral counterparties.
UNIDENTIFIED = "No Identificado"
WITHDRAWAL_MERCHANT = "Cajero"
NEUTRAL_MERCHANT = "-"
BENEFIT_PAYER = "INSS"


def owner_categories(cfg: LedgerConfig) -> list[CategoryRule]:
    """Money moved by one of the two owners."""
    return [
        CategoryRule(COUPLE_SETTLEMENT, participant=cfg.partner_name, ownership="personal"),
        CategoryRule(COMMON_FUNDING, participant=cfg.partner_name, ownership="common", sign=1),
        CategoryRule(OWN_TRANSFER, participant=cfg.partner_name, ownership="common", sign=-1),
        CategoryRule(COMMON_FUNDING, participant=cfg.self_name, ownership="common", sign=1),
        CategoryRule(OWN_TRANSFER, participant=cfg.self_name),
    ]


# Category of last resort, by nature and then by sign.
NATURE_CATEGORIES = [
    CategoryRule(COMMON_FUNDING, nature=PARTNER_CONTRIBUTION, sign=1),
    CategoryRule(OWN_TRANSFER, nature=PARTNER_CONTRIBUTION, sign=-1),
    CategoryRule(OWN_TRANSFER, nature=INTERNAL_TRANSFER),
    CategoryRule("MOV_LIQ_TARJETA", nature=CARD_SETTLEMENT),
    CategoryRule(MORTGAGE, nature=MORTGAGE_PAYMENT),
    CategoryRule(LOAN_DRAWDOWN, nature=LOAN_DISBURSEMENT),
    CategoryRule(PAYROLL, nature=SALARY),
    CategoryRule("VAR_DEVOLUCION", nature=EXPENSE_REFUND),
    CategoryRule("ING_RENDIMIENTOS", nature=REWARD),
    CategoryRule("ING_BIZUM", nature=BIZUM, sign=1),
    CategoryRule("VAR_BIZUM", nature=BIZUM, sign=-1),
    CategoryRule("ING_TRANSFERENCIAS", sign=1),
]
OTHER_CATEGORY = "VAR_OTROS"
