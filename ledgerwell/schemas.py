"""Declared schemas: raw statements, reference tables and the unified transaction."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Totals over many rows get room for 10^26 so that a month of a huge ledger cannot overflow.
TOTAL = T.DecimalType(28, 2)
RATIO = T.DecimalType(38, 4)
SHARE = T.DecimalType(3, 2)


def _struct(spec: str) -> T.StructType:
    kinds = {
        "s": T.StringType(),
        "d": T.DateType(),
        "m": MONEY,
        "l": T.LongType(),
        "i": T.IntegerType(),
        "t": T.TimestampType(),
        "b": T.BooleanType(),
    }
    pairs = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


_AUDIT = "source_row_id:l source_hash:s loaded_at:t updated_at:t"

RAW_ACCOUNT = _struct(f"fecha_contable:d fecha_valor:d descripcion:s importe:m saldo:m {_AUDIT}")
RAW_CARD = _struct(f"fecha:d fecha_cargo:d descripcion:s importe:m {_AUDIT}")
RAW_CASH = _struct(f"fecha:d descripcion:s importe:m saldo:m {_AUDIT}")
RAW_WALLET = _struct(
    f"fecha_inicio:d fecha_fin:d descripcion:s importe:m saldo:m comision:m divisa:s tipo:s state:s {_AUDIT}"
)

RAW_TABLES = {
    "account_personal": RAW_ACCOUNT,
    "account_common": RAW_ACCOUNT,
    "card_personal": RAW_CARD,
    "card_common": RAW_CARD,
    "card_common_2": RAW_CARD,
    "cash": RAW_CASH,
    "wallet": RAW_WALLET,
}

REFERENCE_TABLES = {
    "dim_account": _struct("account_id:s account_name:s bank:s account_type:s owner:s"),
    "master_participants": _struct("keyword:s person_name:s"),
    "rules_mapping": _struct("keyword:s category_id:s merchant_name:s priority:i"),
    "master_adjustments": _struct(
        "source_hash:s category_id_override:s merchant_override:s adjustment_type:s reason:s adjustment_amount:m"
    ),
    "dim_categories": _struct(
        "category_id:s group_name:s category_name:s subcategory_name:s movement_type:s is_pnl:b"
    ),
}

# The contract between every statement source and the core, in order.
UNIFIED_COLUMNS = (
    "value_date booking_date description amount personal_amount balance transaction_nature movement_type is_pnl "
    "account_id bank account_type account_ownership source_row_id source_hash loaded_at"
).split()

RESOLVED_COLUMNS = (
    "source_hash account_id bank account_type account_ownership value_date booking_date year_month year month "
    "description amount balance transaction_nature movement_type category_id group_name category_name "
    "subcategory_name merchant participant_name personal_amount personal_share_pct is_pnl is_shared "
    "adjustment_type adjustment_amount adjustment_reason source_row_id loaded_at"
).split()

FACT_COLUMNS = (
    "source_hash account_id bank account_type account_ownership value_date booking_date bank_year_month year month "
    "accrual_month description amount balance transaction_nature movement_type category_id group_name category_name "
    "subcategory_name merchant participant_name personal_amount personal_share_pct is_pnl is_shared "
    "adjustment_type adjustment_amount adjustment_reason loaded_at"
).split()
