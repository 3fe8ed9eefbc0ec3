"""The same questions in DuckDB SQL, written on their own: rules are joined tables instead of CASE chains.

Named fragments are assembled into one ``WITH`` statement per question.
"""

from __future__ import annotations

import re

from ledgerwell.fixtures import testdata as data


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value).upper() if isinstance(value, bool) else str(value)


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def _inline(columns: str, rows) -> str:
    return f"SELECT * FROM ({_values(rows)}) AS t({columns})"


def _norm(text: str, fold: bool = False) -> str:
    if fold:
        text = f"translate({text}, 'ÁÉÍÓÚáéíóú', 'AEIOUaeiou')"
    return f"lower(regexp_replace({text}, '[^A-Za-z0-9]+', ' ', 'g'))"


def _title(text: str) -> str:
    runs = rf"regexp_extract_all(lower({text}), '[\pL\pN]+|[^\pL\pN]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


def _clean(text: str, prefix: str) -> str:
    text = f"regexp_replace(replace({text}, chr(160), ' '), '{prefix}', '')"
    text = rf"regexp_replace({text}, '[;#$_/\\-]+', ' ', 'g')"
    return _title(rf"trim(regexp_replace({text}, '\s+', ' ', 'g'), ' ')")


def _ratio(top: str, bottom: str) -> str:
    """Four places, half away from zero, on whole cents."""
    n, d = (f"CAST({x} * 100 AS HUGEINT)" for x in (top, bottom))
    whole = f"((2 * abs({n}) * 10000 + abs({d})) // (2 * abs({d})))"
    signed = f"{whole} * CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    return f"CASE WHEN {bottom} <> 0 THEN CAST(CAST({signed} AS DECIMAL(30,0)) * 0.0001 AS DECIMAL(38,4)) END"


def _sum(amount: str, when: str | None = None, sign: str = "") -> str:
    inner = f"CASE WHEN {when} THEN {amount} ELSE 0.00 END" if when else amount
    return f"CAST({sign}SUM({inner}) AS DECIMAL(28,2))"


def _stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _audit(ts: str) -> str:
    return f"{_stamp(ts)} AS loaded_at, {_stamp(ts)} AS updated_at"


PERSON = (data.CONFIG.self_name, data.CONFIG.partner_name)
_OWN, _OTHER = (p.upper() for p in PERSON)
_EITHER = r"ALEX VEGA|NOA SI[EÉ]RRA"
_VOID = r"(^|[^\pL\pN_])ANUL"

NATURES = [
    ("personal", 1, "RECIBO PLATINUM", None, None, "CARD_SETTLEMENT"),
    ("personal", 2, "BIZUM", None, None, "BIZUM"),
    ("personal", 3, r"^(CAJA\s+[0-9]+|CAJERO|TRANSF\s+A\s+CAJERO)", None, None, "REGULAR"),
    ("personal", 4, f"CUENTA T[UÚ] Y YO|RECARGA WALLETPAY|TRASPASO INTERNO|{_OWN}", None, None, "INTERNAL_TRANSFER"),
    ("personal", 5, "TRANSF NOMI|PRESTACIONES SEGURIDAD SOCIAL", None, None, "SALARY"),
    ("personal", 6, _VOID, 1, None, "EXPENSE_REFUND"),
    ("common", 1, "RECIBO VISA CLASICA", None, None, "CARD_SETTLEMENT"),
    ("common", 2, _EITHER, None, None, "PARTNER_CONTRIBUTION"),
    ("common", 3, "IMP INIC PT|IMP DISP PT", None, None, "LOAN_DISBURSEMENT"),
    ("common", 4, "OBRAS NORTE|TASADORA SUR|PROVISION FO", None, None, "CAPEX"),
    ("common", 5, r"LIQUID\. CUOTA PTMO", None, None, "MORTGAGE_PAYMENT"),
    ("common", 6, "BIZUM", None, None, "BIZUM"),
    ("common", 7, _VOID, 1, None, "EXPENSE_REFUND"),
    ("cards", 1, "WALLETPAY", None, None, "INTERNAL_TRANSFER"),
    ("cards", 2, "ANUL|ABONO|DEVOLUC|REEMB", None, None, "EXPENSE_REFUND"),
    ("cards", 3, None, 1, None, "EXPENSE_REFUND"),
    ("wallet", 1, None, None, "Recargas", "INTERNAL_TRANSFER"),
    ("wallet", 2, "BALANCE MIGRATION|ALEX VEGA", None, "Transferir", "INTERNAL_TRANSFER"),
    ("wallet", 3, None, None, "Recompensa", "REWARD"),
    ("wallet", 4, None, None, "CASHBACK", "REWARD"),
    ("wallet", 5, None, None, "Reembolso de tarjeta", "EXPENSE_REFUND"),
]
# Effect of a nature in its source: movement, and whether the line stays in the base P&L.
EFFECTS = [
    ("personal", "CARD_SETTLEMENT", "TRANSFER", False),
    ("personal", "INTERNAL_TRANSFER", "TRANSFER", False),
    ("personal", "EXPENSE_REFUND", "EXPENSE", True),
    ("common", "CARD_SETTLEMENT", "TRANSFER", False),
    ("common", "PARTNER_CONTRIBUTION", "TRANSFER", False),
    ("common", "LOAN_DISBURSEMENT", "TRANSFER", False),
    ("common", "CAPEX", "EXPENSE", False),
    ("common", "EXPENSE_REFUND", "EXPENSE", True),
    ("cards", "INTERNAL_TRANSFER", "TRANSFER", False),
    ("cards", "EXPENSE_REFUND", "EXPENSE", True),
    ("wallet", "INTERNAL_TRANSFER", "TRANSFER", False),
    ("wallet", "EXPENSE_REFUND", "EXPENSE", True),
]
# Steps below 50 go before keyword rules, the others after; NULL fits anything.
DECISIONS = [
    (1, PERSON[1], "personal", None, None, "PAREJA_COMPENSA"),
    (2, PERSON[1], "common", None, 1, "MOV_FONDEO_COMUN"),
    (3, PERSON[1], "common", None, -1, "MOV_TRASPASO"),
    (4, PERSON[0], "common", None, 1, "MOV_FONDEO_COMUN"),
    (5, PERSON[0], None, None, None, "MOV_TRASPASO"),
    (50, None, None, "PARTNER_CONTRIBUTION", 1, "MOV_FONDEO_COMUN"),
    (51, None, None, "PARTNER_CONTRIBUTION", -1, "MOV_TRASPASO"),
    (52, None, None, "INTERNAL_TRANSFER", None, "MOV_TRASPASO"),
    (53, None, None, "CARD_SETTLEMENT", None, "MOV_LIQ_TARJETA"),
    (54, None, None, "MORTGAGE_PAYMENT", None, "FIX_HIPOTECA"),
    (55, None, None, "LOAN_DISBURSEMENT", None, "CPX_DISPOSICION"),
    (56, None, None, "SALARY", None, "ING_NOMINA"),
    (57, None, None, "EXPENSE_REFUND", None, "VAR_DEVOLUCION"),
    (58, None, None, "REWARD", None, "ING_RENDIMIENTOS"),
    (59, None, None, "BIZUM", 1, "ING_BIZUM"),
    (60, None, None, "BIZUM", -1, "VAR_BIZUM"),
    (61, None, None, None, 1, "ING_TRANSFERENCIAS"),
    (62, None, None, None, None, "VAR_OTROS"),
]

_TRANSFER_PREFIX = (
    r"(?i)^(TRANSFERENCIA\s+(DE|A|FAVOR DE))\s*"
    r"|^(TRA\s*NS\s*F?|TRANSF?)\s*(INTERNA|OTR[AS]*\s+ENTID|OTR[AS]*|I|NOMI[A-Z]*|/)?\s*(/|:)?\s*"
)
_CONFIG = data.CONFIG
_FIRST, _LAST, _TODAY = (f"DATE '{d}'" for d in (_CONFIG.calendar_start, _CONFIG.calendar_end, _CONFIG.as_of))

PARTS = {
    "templates": _inline("i, template", enumerate(data.TEMPLATES)),
    "names": _inline("i, name", enumerate(data.NAMES)),
    "dim_account": _inline("account_id, account_name, bank, account_type, owner", data.ACCOUNTS),
    "participants": _inline("keyword, person_name", data.PARTICIPANTS),
    "categories": _inline(
        "category_id, group_name, category_name, subcategory_name, movement_type, is_pnl", data.CATEGORIES
    ),
    "part_categories": _inline("i, category_id", enumerate(data.PART_CATEGORIES)),
    "nature_rules": _inline("src, seq, pattern, sgn, rtype, nature", NATURES),
    "effects": _inline("src, nature, movement, in_pnl", EFFECTS),
    "decisions": _inline("step, person, ownership, nature, sgn, category", DECISIONS),
    "rules": f"""
        SELECT p_name AS keyword, c.category_id, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS merchant,
            p_size AS priority
        FROM part JOIN part_categories c ON c.i = p_partkey % {len(data.PART_CATEGORIES)}
        UNION ALL
        SELECT keyword, category_id, nullif(trim(merchant, ' '), ''), priority
        FROM ({_values(data.EXTRA_RULES)}) AS t(keyword, category_id, merchant, priority)""",
    "adjustments": """
        WITH urgent AS (
            SELECT CASE WHEN o_orderkey % 1009 <> 0 THEN sha256('account|' || o_orderkey) END AS source_hash,
                o_custkey AS c, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS price
            FROM orders WHERE o_orderpriority = '1-URGENT')
        SELECT source_hash, ['VAR_OCIO', 'FIX_HIPOTECA'][c % 5 + 1] AS category_id_override,
            [' Ajuste manual ', '  '][c % 7 + 1] AS merchant_override,
            ['PARTNER_EXPENSE', 'MY_EXPENSE', 'PARTIAL_EXPENSE'][c % 4 + 1] AS adjustment_type,
            'urgent' AS adjustment_reason,
            CASE WHEN c % 3 <> 0 THEN CAST(c AS DECIMAL(18,2)) END AS adjustment_amount
        FROM urgent
        UNION ALL
        SELECT source_hash, '', NULL, 'PARTIAL_EXPENSE', 'second', price FROM urgent WHERE st = 'P'""",
    "stg_accounts": f"""
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'ACCOUNT_PERSONAL' ELSE 'ACCOUNT_COMMON' END AS account_id,
            CAST(o_orderdate AS DATE) AS booking_date,
            CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS DATE) AS value_date,
            replace(replace(replace(t.template, '{{name}}', n.name), '{{shop}}', 'COMERCIO ' || o_custkey % 50),
                '{{n}}', CAST(o_custkey % 10 AS VARCHAR)) AS description,
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 5 < 2 THEN 1 ELSE -1 END
                AS DECIMAL(18,2)) AS amount,
            CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
            CAST(o_orderkey + copy * 10000000000 AS BIGINT) AS source_row_id,
            CASE WHEN o_orderkey % 1009 <> 0 THEN sha256('account|' || o_orderkey) END AS source_hash,
            {_audit("o_orderdate")}
        FROM orders
        JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR o_orderkey % 97 = 0
        JOIN templates t ON t.i = (o_orderkey // 2 + copy) % {len(data.TEMPLATES)}
        JOIN names n ON n.i = o_custkey % {len(data.NAMES)}""",
    "stg_cards": f"""
        SELECT ['CARD_PERSONAL', 'CARD_COMMON', 'CARD_COMMON_2'][l_orderkey % 3 + 1] AS account_id,
            CAST(l_shipdate AS DATE) AS value_date, last_day(CAST(l_shipdate AS DATE)) AS billing_date,
            CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN 'RECARGA WALLETPAY'
                WHEN l_linenumber = 6 AND l_linestatus = 'F' THEN 'ABONO ' || upper(p_name)
                WHEN l_linenumber = 4 AND l_suppkey % 25 = 0 THEN ''
                WHEN l_linenumber % 2 = 1 THEN upper(p_name) || ', CITY ' || l_suppkey % 100
                ELSE upper(p_name) END AS description,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END
                AS DECIMAL(18,2)) AS amount,
            CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS source_row_id,
            sha256(concat_ws('|', 'card', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS source_hash,
            {_audit("l_shipdate")}
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "stg_cash": f"""
        SELECT 'CASH' AS account_id, CAST(o_orderdate AS DATE) AS value_date,
            'Mercado ' || o_custkey % 20 AS description,
            CAST(CASE WHEN o_orderkey % 50 <> 0 THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END
                AS DECIMAL(18,2)) AS amount,
            CAST(o_totalprice AS DECIMAL(18,2)) AS balance, o_orderkey AS source_row_id,
            sha256('cash|' || o_orderkey) AS source_hash, {_audit("o_orderdate")}
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "wallet_kinds": _inline(
        "event_type, rtype, sgn",
        [
            ("signup", "Recargas", 1),
            ("purchase", "Pago con tarjeta", -1),
            ("error", "Reembolso de tarjeta", 1),
            ("view", "Transferir", -1),
            ("click", "Recompensa", 1),
        ],
    ),
    "stg_wallet": f"""
        SELECT 'WALLET' AS account_id, CAST(ts AS DATE) AS value_date,
            CAST(CAST(ts AS DATE) + CAST(event_id % 2 AS INTEGER) AS DATE) AS booking_date,
            CASE WHEN event_type <> 'view' THEN 'Shop ' || user_id % 20 || '.com'
                ELSE ['Balance migration to another region', 'Alex Vega', 'Transferencia a  cliente_' || user_id,
                    'To NOA SIERRA'][event_id % 4 + 1] END AS description,
            CAST(CAST(value AS DECIMAL(18,2)) * k.sgn AS DECIMAL(18,2)) AS amount,
            CAST(value AS DECIMAL(18,2)) AS balance,
            CAST(CASE WHEN event_id % 3 = 2 THEN 1.50 ELSE 0 END AS DECIMAL(18,2)) AS fee,
            'EUR' AS currency, k.rtype AS raw_transaction_type, 'COMPLETADO' AS status, event_id AS source_row_id,
            sha256('wallet|' || event_id) AS source_hash, {_audit("ts")}
        FROM events JOIN wallet_kinds k USING (event_type) WHERE event_id % 10 <> 0""",
    "lines": """
        SELECT lower(split_part(account_id, '_', 2)) AS src, account_id, value_date, booking_date, description,
            amount AS gross, CAST(0 AS DECIMAL(18,2)) AS fee, balance, CAST(NULL AS VARCHAR) AS rtype,
            source_row_id, source_hash, loaded_at FROM stg_accounts
        UNION ALL
        SELECT 'cards', account_id, value_date, billing_date, description, amount, 0, NULL, NULL, source_row_id,
            source_hash, loaded_at FROM stg_cards
        UNION ALL
        SELECT 'cash', account_id, value_date, value_date, description, amount, 0, balance, NULL, source_row_id,
            source_hash, loaded_at FROM stg_cash
        UNION ALL
        SELECT 'wallet', account_id, value_date, booking_date, description, amount, fee, balance,
            raw_transaction_type, source_row_id, source_hash, loaded_at FROM stg_wallet""",
    "shapes": "SELECT DISTINCT src, description, rtype, sign(gross) AS sgn FROM lines",
    "natures": """
        SELECT s.src, s.description, s.rtype, s.sgn, coalesce(arg_min(r.nature, r.seq), 'REGULAR') AS nature
        FROM shapes s LEFT JOIN nature_rules r ON r.src = s.src
            AND (r.pattern IS NULL OR regexp_matches(s.description, '(?i)' || r.pattern))
            AND (r.sgn IS NULL OR r.sgn = s.sgn) AND (r.rtype IS NULL OR r.rtype = s.rtype)
        GROUP BY ALL""",
    "classified": """
        SELECT l.src, l.value_date, l.booking_date, l.description, CAST(gross - fee AS DECIMAL(18,2)) AS amount,
            CAST(CASE WHEN l.src = 'common' OR (l.src = 'cards' AND a.owner = 'common')
                THEN round((gross - fee) * 0.50, 2) ELSE gross - fee END AS DECIMAL(18,2)) AS personal_amount,
            l.balance, n.nature AS transaction_nature,
            coalesce(e.movement, CASE sign(gross) WHEN 1 THEN 'INCOME' WHEN -1 THEN 'EXPENSE' END, 'NEUTRAL')
                AS movement_type,
            coalesce(e.in_pnl, TRUE) AS is_pnl, l.account_id, a.bank, a.account_type,
            a.owner AS account_ownership, l.source_row_id, l.source_hash, l.loaded_at
        FROM lines l
        JOIN natures n ON n.src = l.src AND n.sgn = sign(l.gross) AND n.description IS NOT DISTINCT FROM l.description
            AND n.rtype IS NOT DISTINCT FROM l.rtype
        LEFT JOIN effects e ON e.src = l.src AND e.nature = n.nature
        LEFT JOIN dim_account a ON a.account_id = l.account_id""",
    "texts": f"SELECT description, {_norm('description')} AS norm FROM (SELECT DISTINCT description FROM lines)",
    "people_found": f"""
        SELECT t.description, p.keyword, p.person_name FROM texts t
        JOIN participants p ON contains(t.norm, {_norm("p.keyword")})""",
    "claimed": """
        SELECT c.*, p.person_name FROM classified c
        LEFT JOIN people_found p ON p.description = c.description
        QUALIFY row_number() OVER (PARTITION BY source_hash ORDER BY length(p.keyword) DESC NULLS LAST,
            p.keyword NULLS LAST, p.person_name NULLS LAST, account_id, source_row_id, value_date, booking_date,
            c.description NULLS LAST, amount, balance NULLS LAST, transaction_nature, movement_type, bank NULLS LAST,
            account_type NULLS LAST, account_ownership NULLS LAST, loaded_at) = 1""",
    "rule_found": f"""
        SELECT t.description, r.category_id, r.merchant, r.priority FROM texts t
        JOIN (SELECT *, {_norm("keyword")} AS norm FROM rules) r ON contains(t.norm, r.norm)
        QUALIFY row_number() OVER (PARTITION BY t.description ORDER BY r.priority DESC NULLS LAST,
            length(r.keyword) DESC, r.category_id NULLS LAST, r.merchant NULLS LAST, r.keyword) = 1""",
    "ruled": """
        SELECT c.*, r.category_id AS rule_category_id, r.merchant AS rule_merchant, r.priority AS rule_priority
        FROM claimed c LEFT JOIN rule_found r ON r.description = c.description""",
    "adjusted": """
        SELECT r.*, category_id_override, merchant_override, adjustment_type, adjustment_amount, adjustment_reason
        FROM ruled r LEFT JOIN adjustments a ON a.source_hash = r.source_hash""",
    "marked": r"""
        SELECT *, coalesce(amount < 0 AND regexp_matches(description,
            '(?i)(^|[^\pL\pN_])(CAJA|CAJERO)($|[^\pL\pN_])'), FALSE) AS withdrawn, sign(amount) AS sgn
        FROM adjusted""",
    "decided": """
        SELECT m.person_name, m.account_ownership, m.transaction_nature, m.sgn,
            arg_min(d.category, d.step) FILTER (WHERE d.step < 50) AS by_owner,
            arg_min(d.category, d.step) FILTER (WHERE d.step >= 50) AS by_nature
        FROM (SELECT DISTINCT person_name, account_ownership, transaction_nature, sgn FROM marked) m
        JOIN decisions d ON (d.person IS NULL OR d.person = m.person_name)
            AND (d.ownership IS NULL OR d.ownership = m.account_ownership)
            AND (d.nature IS NULL OR d.nature = m.transaction_nature) AND (d.sgn IS NULL OR d.sgn = m.sgn)
        GROUP BY ALL""",
    "extracted": rf"""
        SELECT description,
            CASE WHEN regexp_matches(description, '(?i)BIZUM')
                THEN {_clean("description", r"(?i)^(DEV\s+)?(PAGO\s+)?BIZUM\s+(A|DE|PARA)\s+")} END AS paid,
            CASE WHEN regexp_matches(description, '(?i)^(TRA\s*NS|TRANSF)')
                THEN {_clean("description", _TRANSFER_PREFIX)} END AS moved,
            CASE WHEN contains(description, ',') THEN trim(split_part(description, ',', 1), ' ')
                WHEN trim(description, ' ') <> '' THEN {_title("trim(description, ' ')")} END AS bought,
            CASE WHEN regexp_matches(description, '(?i)^(RECIBO|RECIB)')
                THEN trim(regexp_replace(description, '(?i)^(RECIBO|RECIB)\s*/?\s*', ''), ' ') END AS debited
        FROM texts""",
    "resolved": f"""
        SELECT m.* EXCLUDE (withdrawn, sgn, person_name),
            coalesce(category_id_override, CASE WHEN withdrawn THEN 'VAR_CAJERO' END, d.by_owner, rule_category_id,
                d.by_nature) AS category_id,
            coalesce(nullif(trim(merchant_override, ' '), ''), rule_merchant, CASE WHEN withdrawn THEN 'Cajero' END,
                CASE WHEN m.person_name IN {PERSON} THEN '-' END, nullif(trim(m.person_name, ' '), ''), x.paid,
                x.moved, CASE WHEN account_type = 'card' THEN x.bought END, x.debited, 'No Identificado') AS merchant,
            CASE WHEN NOT withdrawn THEN m.person_name END AS participant_name
        FROM marked m
        JOIN decided d ON d.person_name IS NOT DISTINCT FROM m.person_name
            AND d.account_ownership IS NOT DISTINCT FROM m.account_ownership
            AND d.transaction_nature = m.transaction_nature AND d.sgn = m.sgn
        LEFT JOIN extracted x ON x.description = m.description""",
    "categorised": """
        SELECT r.* EXCLUDE (movement_type), r.movement_type AS base_movement, c.group_name, c.category_name,
            c.subcategory_name, coalesce(c.is_pnl, FALSE) AS category_is_pnl,
            CASE WHEN r.category_id = 'PAREJA_COMPENSA' AND r.amount > 0 THEN 'INCOME'
                WHEN r.category_id = 'PAREJA_COMPENSA' AND r.amount < 0 THEN 'EXPENSE'
                WHEN r.amount > 0 AND c.movement_type = 'EXPENSE' THEN 'EXPENSE_REFUND'
                ELSE coalesce(c.movement_type, r.movement_type) END AS movement_type
        FROM resolved r LEFT JOIN categories c ON c.category_id = r.category_id""",
    "facts_marked": f"""
        SELECT *, coalesce(adjustment_type, '') AS adj, coalesce(account_ownership, '') AS held,
            category_id = 'MOV_FONDEO_COMUN' AS funding,
            category_id = 'MOV_FONDEO_COMUN' AND coalesce(participant_name, '') = '{PERSON[0]}' AS own_funding,
            transaction_nature = 'CARD_SETTLEMENT' AS settles,
            movement_type IN ('EXPENSE', 'INCOME', 'EXPENSE_REFUND') OR regexp_matches(category_id, '^CPX.')
                OR transaction_nature = 'CARD_SETTLEMENT' AS divisible
        FROM categorised""",
    "transactions": """
        SELECT source_hash, account_id, bank, account_type, account_ownership, value_date, booking_date,
            CAST(date_trunc('month', value_date) AS DATE) AS year_month,
            CAST(year(value_date) AS INTEGER) AS year, CAST(month(value_date) AS INTEGER) AS month, description,
            amount, balance, transaction_nature, movement_type, category_id, group_name, category_name,
            subcategory_name, merchant, participant_name,
            CAST(if(adj = 'PARTNER_EXPENSE', 0, if(adj = 'MY_EXPENSE', amount, if(adj = 'PARTIAL_EXPENSE',
                -round((abs(amount) - abs(coalesce(adjustment_amount, 0))) * 0.50, 2),
                if(held = 'personal' OR own_funding, amount,
                if(held = 'common' AND divisible AND NOT funding, round(amount * 0.50, 2), 0)))))
                AS DECIMAL(18,2)) AS personal_amount,
            CAST(if(adj = 'PARTNER_EXPENSE', 0, if(adj = 'MY_EXPENSE' OR own_funding, 1, if(funding, 0,
                if(held = 'personal', 1, if(held = 'common' AND divisible, 0.5, 0))))) AS DECIMAL(3,2))
                AS personal_share_pct,
            category_is_pnl AND adj <> 'PARTNER_EXPENSE' AND movement_type <> 'TRANSFER'
                AND transaction_nature NOT IN ('INTERNAL_TRANSFER', 'PARTNER_CONTRIBUTION')
                AND NOT (settles AND category_id_override IS NULL) AS is_pnl,
            category_is_pnl AND movement_type <> 'TRANSFER' AND adj NOT IN ('PARTNER_EXPENSE', 'MY_EXPENSE')
                AND (adj = 'PARTIAL_EXPENSE' OR category_id = 'PAREJA_COMPENSA'
                    OR (held = 'common' AND NOT (settles AND category_id_override IS NULL))) AS is_shared,
            adjustment_type, adjustment_amount, adjustment_reason, source_row_id, loaded_at
        FROM facts_marked""",
    "facts": """
        SELECT * EXCLUDE (year_month, source_row_id), year_month AS bank_year_month,
            CAST(year_month - CASE WHEN day(value_date) <= 16
                    AND category_id IN ('ING_NOMINA', 'ING_PRESTACIONES', 'ING_INDEMNIZACION')
                THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS DATE) AS accrual_month
        FROM transactions""",
    "span": """
        SELECT CAST(date_trunc('year', min(value_date)) AS DATE) AS a,
            CAST(date_trunc('year', max(value_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS b FROM lines""",
    "span_days": "SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span",
    "days": f"SELECT CAST(unnest(generate_series({_FIRST}, {_LAST}, INTERVAL 1 DAY)) AS DATE) AS d",
    "salary_months": f"""
        SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS m FROM days
        WHERE date_trunc('month', d) >= DATE '{_CONFIG.salary_start}'
            AND date_trunc('month', d) <= {_TODAY} - INTERVAL 1 MONTH""",
    "salary_totals": f"""
        WITH pay AS (SELECT merchant, personal_amount, category_id = 'ING_NOMINA' AS payroll,
                CAST(CASE WHEN day(value_date) <= 16 THEN date_trunc('month', value_date) - INTERVAL 1 MONTH
                    ELSE date_trunc('month', value_date) END AS DATE) AS accrual_date
            FROM transactions WHERE category_id IN ('ING_NOMINA', 'ING_PRESTACIONES'))
        SELECT accrual_date, coalesce(max(merchant) FILTER (WHERE payroll), 'INSS') AS empresa,
            {_sum("personal_amount", "payroll")} AS importe_nomina,
            {_sum("personal_amount", "NOT payroll")} AS importe_prestacion,
            {_sum("personal_amount")} AS importe_total
        FROM pay GROUP BY accrual_date""",
    "flows": f"SELECT year_month, account_id, {_sum('amount')} AS net_monthly_flow FROM transactions GROUP BY ALL",
    "grid": f"""
        SELECT m.*, a.account_id, a.account_name, a.account_type
        FROM (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS start_of_month, last_day(d) AS month_end_date,
            strftime(d, '%Y-%m') AS year_month FROM days WHERE d <= {_TODAY}) m
        CROSS JOIN (SELECT DISTINCT account_id, account_name, account_type FROM dim_account) a""",
    "grid_flows": """
        SELECT g.*, CAST(coalesce(f.net_monthly_flow, 0) AS DECIMAL(28,2)) AS net_monthly_flow
        FROM grid g LEFT JOIN flows f ON f.year_month = g.start_of_month AND f.account_id = g.account_id""",
    "capex_rows": """
        SELECT * FROM facts WHERE group_name = 'CAPEX'
            OR category_id IN ('CPX_DISPOSICION', 'CPX_CONSTRUCTORA', 'CPX_TECNICOS', 'CPX_TRAMITES')""",
    "measures": f"""
        SELECT accrual_month AS year_month, CAST(year(accrual_month) AS INTEGER) AS year,
            CAST(month(accrual_month) AS INTEGER) AS month,
            {_sum("personal_amount", "is_pnl AND movement_type = 'INCOME'")} AS personal_income,
            {_sum("personal_amount", "is_pnl AND movement_type LIKE 'EXPENSE%'", "-")} AS personal_expense,
            {_sum("personal_amount", "is_pnl AND group_name IN ('Gastos Fijos', 'Gastos Compartidos')", "-")}
                AS personal_fixed_expenses,
            {_sum("personal_amount", "is_pnl AND group_name IN ('Gastos Variables', 'Gastos Financieros')", "-")}
                AS personal_variable_expenses,
            {_sum("personal_amount", "is_pnl")} AS personal_net_savings,
            {_sum("amount", "is_shared AND movement_type LIKE 'EXPENSE%'", "-")} AS household_total_cost,
            {_sum("amount", "category_id = 'FIX_HIPOTECA'", "-")} AS mortgage_household_amount
        FROM facts GROUP BY accrual_month""",
    "rated": f"""
        SELECT *, CASE WHEN personal_income > 0 THEN {_ratio("personal_net_savings", "personal_income")}
            ELSE CAST(0 AS DECIMAL(38,4)) END AS savings_rate_pct FROM measures""",
    "lagged": """
        SELECT *, lag(personal_income) OVER w AS prev_personal_income,
            lag(personal_expense) OVER w AS prev_personal_expense,
            lag(personal_net_savings) OVER w AS prev_personal_net_savings,
            lag(savings_rate_pct) OVER w AS prev_savings_rate_pct,
            lag(household_total_cost) OVER w AS prev_household_total_cost
        FROM rated WINDOW w AS (ORDER BY year_month)""",
    "changed": f"""
        SELECT *, {_ratio("(personal_income - prev_personal_income)", "prev_personal_income")}
                AS personal_income_mom_pct,
            {_ratio("(personal_expense - prev_personal_expense)", "prev_personal_expense")}
                AS personal_expense_mom_pct,
            {_ratio("(household_total_cost - prev_household_total_cost)", "prev_household_total_cost")}
                AS household_cost_mom_pct
        FROM lagged""",
}

_UNIFIED = (
    "value_date, booking_date, description, amount, personal_amount, balance, transaction_nature, movement_type, "
    "is_pnl, account_id, bank, account_type, account_ownership, source_row_id, source_hash, loaded_at"
)
_KEY = "source_hash, source_row_id, account_id"
_CALENDAR = """
    SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(date_trunc('month', d) AS DATE) AS start_of_month,
        last_day(d) AS end_of_month, strftime(d, '%Y-%m') AS year_month, strftime(d, '%b %Y') AS month_year,
        strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name, 'Q' || quarter(d) AS quarter_name,
        isodow(d) > 5 AS is_weekend
    FROM span_days"""
_SALARIES = """
    SELECT m AS fecha, strftime(m, '%Y-%m') AS periodo, CAST(year(m) AS INTEGER) AS year,
        CAST(month(m) AS INTEGER) AS month, coalesce(empresa, '-') AS empresa,
        CAST(coalesce(importe_nomina, 0) AS DECIMAL(28,2)) AS importe_nomina,
        CAST(coalesce(importe_prestacion, 0) AS DECIMAL(28,2)) AS importe_prestacion,
        CAST(coalesce(importe_total, 0) AS DECIMAL(28,2)) AS importe_total
    FROM salary_months LEFT JOIN salary_totals ON accrual_date = m"""
_BALANCES = """
    SELECT year_month, month_end_date, account_id, account_name, account_type, net_monthly_flow,
        CAST(sum(net_monthly_flow) OVER (PARTITION BY account_id ORDER BY month_end_date, account_name, account_type
            ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS ending_balance
    FROM grid_flows"""
_CAPEX = f"""
    SELECT accrual_month AS year_month, {_sum("amount", "category_id = 'CPX_CONSTRUCTORA'")} AS cost_constructora,
        {_sum("amount", "category_id = 'CPX_TECNICOS'")} AS cost_tecnicos_arquitecto,
        {_sum("amount", "category_id = 'CPX_TRAMITES'")} AS cost_tramites_notaria,
        {_sum("amount", "category_id IN ('CPX_CONSTRUCTORA', 'CPX_TECNICOS', 'CPX_TRAMITES')")}
            AS total_project_investment,
        {_sum("amount", "category_id = 'CPX_DISPOSICION'")} AS loan_disbursements,
        {_sum("amount", "category_id <> 'CPX_MOBILIARIO'")} AS net_capex_cash_flow
    FROM capex_rows GROUP BY accrual_month"""
_SPINES = f"""
    SELECT 'salaries' AS spine, m AS start_of_month, last_day(m) AS month_end_date, strftime(m, '%Y-%m') AS year_month
    FROM (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS m FROM span_days)
    WHERE m >= DATE '{_CONFIG.salary_start}' AND m <= {_TODAY} - INTERVAL 1 MONTH
    UNION ALL
    SELECT DISTINCT 'balances', CAST(date_trunc('month', d) AS DATE), last_day(d), strftime(d, '%Y-%m')
    FROM span_days WHERE d <= {_TODAY}"""

_VIEWS = {
    "staging": "stg_account_personal stg_account_common stg_card_personal stg_card_common stg_card_common_2 "
    "stg_cash stg_wallet",
    "intermediate": "int_account_personal int_account_common int_cards int_cash int_wallet "
    "int_transactions_unioned int_transactions",
}
_COUNTS = {
    "dim_calendar": "SELECT count(*) FROM days",
    "fct_transactions": "SELECT count(*) FROM facts",
    "fct_salaries_monthly": "SELECT count(*) FROM salary_months",
    "fct_monthly_balances": "SELECT count(*) FROM grid",
    "fct_capex_summary": "SELECT count(DISTINCT accrual_month) FROM capex_rows",
    "fct_monthly_pnl": "SELECT count(DISTINCT accrual_month) FROM facts",
}
_REPORT = " UNION ALL ".join(
    [
        f"SELECT '{layer}' AS layer, '{model}' AS model, 'view' AS kind, 'success' AS status, CAST(NULL AS BIGINT) AS rows"
        for layer, models in _VIEWS.items()
        for model in models.split()
    ]
    + [f"SELECT 'marts', '{model}', 'table', 'success', ({count})" for model, count in _COUNTS.items()]
)


def _source(src: str) -> str:
    return f"SELECT {_UNIFIED} FROM classified WHERE src = '{src}'"


_RULES = f"SELECT {_KEY}, rule_category_id, rule_merchant, rule_priority FROM ruled"
_ADJ = f"{_KEY}, adjustment_reason"
_ADJUSTMENTS = f"""
    SELECT {_ADJ}, category_id_override, merchant_override, adjustment_type, adjustment_amount FROM adjusted"""
_CATEGORIES = f"""
    SELECT {_ADJ}, category_id, group_name, category_name, subcategory_name, category_is_pnl FROM categorised"""
_ORDER = f"""
    SELECT 'fct_salaries_monthly' AS mart, '' AS account_id, CAST(fecha AS VARCHAR) AS month,
        row_number() OVER (ORDER BY fecha DESC) AS position FROM ({_SALARIES})
    UNION ALL
    SELECT 'fct_monthly_balances', account_id, CAST(month_end_date AS VARCHAR),
        row_number() OVER (PARTITION BY account_id ORDER BY month_end_date) FROM ({_BALANCES})
    UNION ALL
    SELECT 'fct_capex_summary', '', CAST(year_month AS VARCHAR), row_number() OVER (ORDER BY year_month DESC) FROM ({_CAPEX})
    UNION ALL
    SELECT 'fct_monthly_pnl', '', CAST(year_month AS VARCHAR), row_number() OVER (ORDER BY year_month DESC) FROM changed"""

QUESTIONS = {
    "cash_running_balance": f"{_BALANCES} WHERE account_id = 'CASH'",
    "stg_accounts": "SELECT * FROM stg_accounts",
    "stg_cards": "SELECT * FROM stg_cards",
    "stg_cash": "SELECT * FROM stg_cash",
    "stg_wallet": "SELECT * FROM stg_wallet",
    "account_enrich": """
        SELECT s.account_id, s.source_row_id, s.source_hash, s.amount, a.bank, a.account_type,
            a.owner AS account_ownership
        FROM stg_accounts s LEFT JOIN dim_account a ON a.account_id = s.account_id""",
    "nature_personal": _source("personal"),
    "nature_common": _source("common"),
    "nature_cards": _source("cards"),
    "nature_cash": _source("cash"),
    "nature_wallet": _source("wallet"),
    "cards_union": """
        SELECT account_id, count(*) AS lines, count(DISTINCT source_hash) AS hashes,
            CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM stg_cards GROUP BY account_id""",
    "transactions_unioned": f"SELECT {_UNIFIED} FROM classified",
    "text_normalise": f"SELECT description, norm AS normalised, {_norm('description', fold=True)} AS folded FROM texts",
    "participant_match": f"SELECT {_KEY}, description, person_name AS participant_name FROM claimed",
    "rule_match": _RULES,
    "rule_match_nested": _RULES,
    "rule_match_gram": _RULES,
    "rule_match_coded": _RULES,
    "rule_match_shuffled": _RULES,
    "adjustment_join": _ADJUSTMENTS,
    "adjustment_join_shuffled": _ADJUSTMENTS,
    "category_resolve": f"SELECT {_ADJ}, category_id FROM resolved",
    "participant_resolve": f"SELECT {_ADJ}, participant_name FROM resolved",
    "merchant_resolve": f"SELECT {_ADJ}, merchant FROM resolved",
    "category_join": _CATEGORIES,
    "category_join_shuffled": _CATEGORIES,
    "movement_resolve": f"SELECT {_ADJ}, category_id, amount, movement_type FROM categorised",
    "personal_split": f"SELECT {_ADJ}, amount, personal_amount, personal_share_pct FROM transactions",
    "pnl_flags": f"SELECT {_ADJ}, year_month, year, month, is_pnl, is_shared FROM transactions",
    "int_transactions": "SELECT * FROM transactions",
    "fct_transactions": "SELECT * FROM facts",
    "dim_calendar": _CALENDAR,
    "month_spines": _SPINES,
    "salary_totals": "SELECT * FROM salary_totals",
    "fct_salaries_monthly": _SALARIES,
    "monthly_flow": "SELECT * FROM flows",
    "account_month_grid": "SELECT * FROM grid_flows",
    "fct_monthly_balances": _BALANCES,
    "capex_rows": "SELECT source_hash, account_id, accrual_month, category_id, group_name, amount, adjustment_reason "
    "FROM capex_rows",
    "fct_capex_summary": _CAPEX,
    "pnl_measures": "SELECT * FROM measures",
    "pnl_savings_rate": "SELECT * FROM rated",
    "pnl_lag": "SELECT * FROM lagged",
    "pnl_mom": "SELECT year_month, personal_income_mom_pct, personal_expense_mom_pct, household_cost_mom_pct "
    "FROM changed",
    "fct_monthly_pnl": "SELECT * FROM changed",
    "mart_order": _ORDER,
    "layer_run_report": _REPORT,
}


def _needed(sql: str, found: dict[str, str]) -> dict[str, str]:
    """Fragments a statement refers to, each after those it needs itself."""
    for word in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", sql):
        if word in PARTS and word not in found:
            _needed(PARTS[word], found)
            found[word] = PARTS[word]
    return found


def statement(name: str) -> str:
    question = QUESTIONS[name]
    fragments = _needed(question, {})
    heads = ",\n".join(f"{part} AS MATERIALIZED ({sql.strip()})" for part, sql in fragments.items())
    return f"WITH {heads}\n{question.strip()}" if heads else question
