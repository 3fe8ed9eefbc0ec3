"""Testdata tables as raw statements and reference tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.config import LedgerConfig
from ledgerwell.functions.text import NBSP
from ledgerwell.schemas import MONEY, RAW_TABLES, REFERENCE_TABLES
from ledgerwell.sources.inputs import Inputs

CONFIG = LedgerConfig(
    self_name="Alex Vega",
    partner_name="Noa Sierra",
    self_pattern="ALEX VEGA",
    partner_pattern="NOA SI[EÉ]RRA",
    wallet_pattern="WALLETPAY",
    capex_patterns=("OBRAS NORTE", "TASADORA SUR"),
    personal_card_pattern="PLATINUM",
    common_card_pattern="VISA CLASICA",
    joint_pattern="CUENTA T[UÚ] Y YO",
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2024, 12, 31),
    salary_start=dt.date(1995, 1, 1),
    as_of=dt.date(2024, 1, 31),
)

# Statement texts, filled from the order key and customer key.
TEMPLATES = (
    "TRANSF NOMI/ACME SA",
    "PRESTACIONES SEGURIDAD SOCIAL",
    "BIZUM DE {name}",
    "DEV PAGO BIZUM A {shop}",
    "TRANS INTERNA /ALEX VEGA",
    "TRANSFERENCIA DE {name}",
    "TRANSFERENCIA A FAVOR DE {shop}",
    "TRANSF IVAN",
    "RECIBO / AGUAS {n}",
    "RECIBO PLATINUM",
    "RECIBO VISA CLASICA",
    "CAJERO 24",
    "CAJAMAR SEGURO",
    "ANULACION O'BRIEN {shop}",
    f"NOA{NBSP}SIERRA",
    None,
    "IMP DISP PT 0001",
    "PROVISION FO NOTARIA {n}",
    "LIQUID. CUOTA PTMO 77",
    "TRANSF A CAJERO 12 NOA SIERRA",
    "CUENTA TÚ Y YO",
    "Bizum para ferretería-{shop} #pago",
    "TRA NS F NOMINA GESTORIA_{n};SL",
    "NOA SIÉRRA aportación",
    "TRANSFERENCIA FAVOR DE PEÑA/ÑANDÚ 3M-CO {n}",
    "ALEX VEGA APORTACION",
    "FINIQUITO ACME SA",
    "OBRAS NORTE TECNICOS {n}",
)
NAMES = ("MARTA GIL", "MARTA GIL SOTO", "IKER SANZ", "OLGA RUIZ", "PAU FONT", "NIL ROCA")

ACCOUNTS = (
    ("ACCOUNT_PERSONAL", "Everyday", "First Bank", "checking", "personal"),
    ("ACCOUNT_COMMON", "Household", "First Bank", "checking", "common"),
    ("CARD_PERSONAL", "Own card", "First Bank", "card", "personal"),
    ("CARD_COMMON", "Household card", "First Bank", "card", "common"),
    ("CASH", "Purse", "None", "cash", "personal"),
    ("WALLET", "Wallet", "Wallet Co", "wallet", "personal"),
    ("SAVINGS", "Unused", "First Bank", "savings", "personal"),
)
PARTICIPANTS = (
    ("ALEX VEGA", "Alex Vega"),
    ("NOA SIERRA", "Noa Sierra"),
    ("Marta Gil", "Marta Gil"),
    ("Marta Gil Soto", "Marta Gil Soto"),
    ("Iker*Sanz", "Iker Sanz"),
    ("Olga Ruiz", "Olga Ruiz"),
    ("PAU FONT", "Pau Font"),
    ("NIL ROCÁ", "Nil Roca"),
    (None, "Nobody"),
)
EXTRA_RULES = (
    ("PRESTACIONES SEGURIDAD", "ING_PRESTACIONES", "", 50),
    ("FINIQUITO", "ING_INDEMNIZACION", "Acme", 20),
    ("NOTARIA", "CPX_TRAMITES", " Notaría ", 10),
    ("TECNICOS", "CPX_TECNICOS", None, 10),
    ("AGUAS", "FIX_SUMINISTROS", " ", 5),
    ("AGUAS 1", "FIX_SUMINISTROS", "Aguas Uno", 5),
    ("SEGURO", "GC_SEGURO", "Seguros", 7),
    ("MERCADO 1", "VAR_SUPER", "Mercado Uno", None),
    ("SHOP 1", "VAR_OCIO", "Shop Uno", 3),
    ("COMERCIO 4", "GF_COMISION", None, 1),
    (None, "VAR_OCIO", "Never", 99),
)
PART_CATEGORIES = (
    "VAR_SUPER",
    "VAR_OCIO",
    "FIX_SUMINISTROS",
    "GC_SEGURO",
    "GF_COMISION",
    "CPX_CONSTRUCTORA",
    "CPX_MOBILIARIO",
    "NOT_IN_DIMENSION",
)
# VAR_OTROS is left out, so that one category has no entry; VAR_OCIO has no P&L flag.
CATEGORIES = (
    ("PAREJA_COMPENSA", "Pareja", "Compensación", "Pareja", "TRANSFER", True),
    ("MOV_FONDEO_COMUN", "Movimientos", "Fondeo", "Fondeo", "TRANSFER", False),
    ("MOV_TRASPASO", "Movimientos", "Traspaso", "Traspaso", "TRANSFER", False),
    ("MOV_LIQ_TARJETA", "Movimientos", "Tarjeta", "Liquidación", "TRANSFER", False),
    ("VAR_CAJERO", "Gastos Variables", "Efectivo", "Cajero", "EXPENSE", True),
    ("VAR_SUPER", "Gastos Variables", "Compra", "Súper", "EXPENSE", True),
    ("VAR_OCIO", "Gastos Variables", "Ocio", "Ocio", "EXPENSE", None),
    ("VAR_BIZUM", "Gastos Variables", "Bizum", "Enviado", "EXPENSE", True),
    ("VAR_DEVOLUCION", "Gastos Variables", "Devolución", "Devolución", "EXPENSE", True),
    ("FIX_HIPOTECA", "Gastos Fijos", "Vivienda", "Hipoteca", "EXPENSE", True),
    ("FIX_SUMINISTROS", "Gastos Fijos", "Vivienda", "Suministros", "EXPENSE", True),
    ("GC_SEGURO", "Gastos Compartidos", "Seguro", "Seguro", "EXPENSE", True),
    ("GF_COMISION", "Gastos Financieros", "Banco", "Comisión", "EXPENSE", True),
    ("ING_NOMINA", "Ingresos", "Trabajo", "Nómina", "INCOME", True),
    ("ING_PRESTACIONES", "Ingresos", "Trabajo", "Prestación", "INCOME", True),
    ("ING_INDEMNIZACION", "Ingresos", "Trabajo", "Indemnización", "INCOME", True),
    ("ING_RENDIMIENTOS", "Ingresos", "Otros", "Rendimientos", "INCOME", True),
    ("ING_BIZUM", "Ingresos", "Otros", "Bizum", "INCOME", True),
    ("ING_TRANSFERENCIAS", "Ingresos", "Otros", "Transferencias", None, True),
    ("CPX_DISPOSICION", "CAPEX", "Obra", "Préstamo", "TRANSFER", False),
    ("CPX_CONSTRUCTORA", "CAPEX", "Obra", "Constructora", "EXPENSE", False),
    ("CPX_TECNICOS", "CAPEX", "Obra", "Técnicos", "EXPENSE", False),
    ("CPX_TRAMITES", "CAPEX", "Obra", "Trámites", "EXPENSE", False),
    ("CPX_MOBILIARIO", "CAPEX", "Obra", "Mobiliario", "EXPENSE", False),
)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def _filled(template: str | None) -> str:
    """SQL for a text whose slot is filled from a column of the same name."""
    for slot in ("name", "shop", "n"):
        before, found, after = (template or "").partition("{" + slot + "}")
        if found:
            return f"concat({_literal(before)}, {slot}, {_literal(after)})"
    return _literal(template)


def _pick(index: str, values: Iterable[str]) -> Column:
    return F.expr(f"element_at(array({', '.join(values)}), cast({index} as int) + 1)")


def _hash(tag: str, *keys: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(tag), *(F.col(k).cast("string") for k in keys)), 256)


def _stamps(ts: str) -> list[Column]:
    return [F.col(ts).cast("timestamp").alias(name) for name in ("loaded_at", "updated_at")]


class TestData:
    """Loads and maps one scale folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet"))
        return self._tables[name]

    def _statement(self, parity: int) -> DataFrame:
        """Orders as account lines; every 97th key is delivered twice, every 1009th has no hash."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        orders = self.table("orders").filter(key % 2 == parity)
        copies = F.when(key % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        orders = orders.withColumn("copy", F.explode(copies))
        orders = orders.select(
            "*",
            _pick(f"o_custkey % {len(NAMES)}", map(_literal, NAMES)).alias("name"),
            F.expr("concat('COMERCIO ', o_custkey % 50)").alias("shop"),
            F.expr("cast(o_custkey % 10 as string)").alias("n"),
        )
        text = _pick(f"(o_orderkey div 2 + copy) % {len(TEMPLATES)}", map(_filled, TEMPLATES))
        price = F.col("o_totalprice").cast(MONEY)
        booked = F.col("o_orderdate").cast("date")
        return orders.select(
            booked.alias("fecha_contable"),
            F.date_add(booked, (key % 3).cast("int")).alias("fecha_valor"),
            F.concat(F.lit("  "), text, F.lit(" ")).alias("descripcion"),
            F.when(key % 5 < 2, price).otherwise(-price).alias("importe"),
            price.alias("saldo"),
            (key + F.col("copy") * 10_000_000_000).alias("source_row_id"),
            F.when(key % 1009 != 0, _hash("account", "o_orderkey")).alias("source_hash"),
            *_stamps("o_orderdate"),
        )

    def account_personal(self) -> DataFrame:
        return self._statement(0)

    def account_common(self) -> DataFrame:
        return self._statement(1)

    def _card(self, remainder: int) -> DataFrame:
        """Line items as card lines; the description starts from the part's name."""
        lines = self.table("lineitem").filter(F.col("l_orderkey") % 3 == remainder)
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        number, supplier = F.col("l_linenumber"), F.col("l_suppkey")
        name = F.upper("p_name")
        town = F.concat(name, F.lit(", CITY "), (supplier % 100).cast("string"))
        text = (
            F.when((number == 7) & (supplier % 10 == 0), "RECARGA WALLETPAY")
            .when((number == 6) & (F.col("l_linestatus") == "F"), F.concat(F.lit("ABONO "), name))
            .when((number == 4) & (supplier % 25 == 0), "   ")
            .when(number % 2 == 1, town)
            .otherwise(name)
        )
        price = F.col("l_extendedprice").cast(MONEY)
        spent = F.col("l_shipdate").cast("date")
        return lines.join(parts, "l_partkey").select(
            spent.alias("fecha"),
            F.last_day(spent).alias("fecha_cargo"),
            text.alias("descripcion"),
            F.when(F.col("l_returnflag") == "R", price).otherwise(-price).alias("importe"),
            (F.col("l_orderkey") * 10 + number).alias("source_row_id"),
            _hash("card", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("source_hash"),
            *_stamps("l_shipdate"),
        )

    def card_personal(self) -> DataFrame:
        return self._card(0)

    def card_common(self) -> DataFrame:
        return self._card(1)

    def card_common_2(self) -> DataFrame:
        return self._card(2)

    def wallet(self) -> DataFrame:
        event, kind = F.col("event_id"), F.col("event_type")
        day = F.col("ts").cast("date")
        value = F.col("value").cast(MONEY)
        moved = _pick(
            "event_id % 4",
            [
                "'Balance migration to another region'",
                "'Alex Vega'",
                "concat('Transferencia a  cliente_', user_id)",
                "'To NOA SIERRA'",
            ],
        )
        types = (
            F.when(kind == "signup", "Recargas")
            .when(kind == "purchase", "Pago con tarjeta")
            .when(kind == "error", "Reembolso de tarjeta")
            .when(kind == "view", "Transferir")
            .otherwise("Recompensa")
        )
        shop = F.concat(F.lit("Shop "), (F.col("user_id") % 20).cast("string"), F.lit(".com"))
        fee = _pick("event_id % 3", ["NULL", "0.00", "1.50"])
        return self.table("events").select(
            day.alias("fecha_inicio"),
            F.date_add(day, (event % 2).cast("int")).alias("fecha_fin"),
            F.when(kind == "view", moved).otherwise(shop).alias("descripcion"),
            F.when(kind.isin("purchase", "view"), -value).otherwise(value).alias("importe"),
            value.alias("saldo"),
            fee.cast(MONEY).alias("comision"),
            F.lit(" eur").alias("divisa"),
            types.alias("tipo"),
            F.when(event % 10 == 0, "PENDIENTE").otherwise(" completado ").alias("state"),
            event.alias("source_row_id"),
            _hash("wallet", "event_id").alias("source_hash"),
            *_stamps("ts"),
        )

    def cash(self) -> DataFrame:
        key = F.col("o_orderkey")
        orders = self.table("orders").filter(F.col("o_orderpriority") == "5-LOW")
        price = F.col("o_totalprice").cast(MONEY)
        return orders.select(
            F.col("o_orderdate").cast("date").alias("fecha"),
            F.concat(F.lit("Mercado "), (F.col("o_custkey") % 20).cast("string")).alias("descripcion"),
            F.when(key % 50 == 0, F.lit(0).cast(MONEY)).otherwise(-price).cast(MONEY).alias("importe"),
            price.alias("saldo"),
            key.alias("source_row_id"),
            _hash("cash", "o_orderkey").alias("source_hash"),
            *_stamps("o_orderdate"),
        )

    def _inline(self, table: str, rows: tuple) -> DataFrame:
        values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
        fields = REFERENCE_TABLES[table].fields
        typed = ", ".join(f"cast(_{i} as {f.dataType.simpleString()}) as {f.name}" for i, f in enumerate(fields))
        names = ", ".join(f"_{i}" for i in range(len(fields)))
        return self.spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({names})")

    def dim_account(self) -> DataFrame:
        return self._inline("dim_account", ACCOUNTS)

    def master_participants(self) -> DataFrame:
        return self._inline("master_participants", PARTICIPANTS)

    def dim_categories(self) -> DataFrame:
        return self._inline("dim_categories", CATEGORIES)

    def rules_mapping(self) -> DataFrame:
        """Part names as keywords, plus rules that reach the account, cash and wallet texts."""
        key = F.col("p_partkey")
        parts = self.table("part").select(
            F.col("p_name").alias("keyword"),
            _pick(f"p_partkey % {len(PART_CATEGORIES)}", map(_literal, PART_CATEGORIES)).alias("category_id"),
            F.when(key % 7 == 0, " ").otherwise(F.col("p_brand")).alias("merchant_name"),
            F.col("p_size").cast("int").alias("priority"),
        )
        return parts.unionByName(self._inline("rules_mapping", EXTRA_RULES))

    def master_adjustments(self) -> DataFrame:
        """Urgent orders are corrected by hand, those with status P a second time."""
        customer, price = F.col("o_custkey"), F.col("o_totalprice").cast(MONEY)
        hash_ = F.when(F.col("o_orderkey") % 1009 != 0, _hash("account", "o_orderkey")).alias("source_hash")
        urgent = self.table("orders").filter(F.col("o_orderpriority") == "1-URGENT")
        first = urgent.select(
            hash_,
            F.when(customer % 5 == 0, "VAR_OCIO").when(customer % 5 == 1, "FIX_HIPOTECA").alias("category_id_override"),
            F.when(customer % 7 == 0, " Ajuste manual ").when(customer % 7 == 1, "  ").alias("merchant_override"),
            F.when(customer % 4 == 0, "PARTNER_EXPENSE")
            .when(customer % 4 == 1, "MY_EXPENSE")
            .when(customer % 4 == 2, "PARTIAL_EXPENSE")
            .alias("adjustment_type"),
            F.lit("urgent").alias("reason"),
            F.when(customer % 3 != 0, customer.cast(MONEY)).alias("adjustment_amount"),
        )
        second = urgent.filter(F.col("o_orderstatus") == "P").select(
            hash_,
            F.lit("").alias("category_id_override"),
            F.lit(None).cast("string").alias("merchant_override"),
            F.lit("PARTIAL_EXPENSE").alias("adjustment_type"),
            F.lit("second").alias("reason"),
            price.alias("adjustment_amount"),
        )
        return first.unionByName(second)

    def inputs(self) -> Inputs:
        known = {*RAW_TABLES, *REFERENCE_TABLES}
        return Inputs(lambda table: getattr(self, table)() if table in known else None)
