"""Text functions with the matching, casing and boundary behaviour of the source ledger.

All patterns ignore case. Java folds only ASCII unless told otherwise, so that ``ó`` would not meet ``Ó``;
the slower Unicode folding is switched on just for patterns that hold other letters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = " "

# Accent pairs of the opt-in folding, patterns of the text extractors.
ACCENTED, PLAIN = "ÁÉÍÓÚáéíóú", "AEIOUaeiou"
# A whole word; the boundary before it is looked up only where its first letters are found.
WITHDRAWAL = r"CAJ(?<![\p{L}\p{N}_]CAJ)(A|ERO)(?![\p{L}\p{N}_])"
INSTANT_PAYMENT = r"BIZUM"
INSTANT_PREFIX = r"(?i)^(DEV\s+)?(PAGO\s+)?BIZUM\s+(A|DE|PARA)\s+"
TRANSFER = r"^(TRA\s*NS|TRANSF|TRANSFERENCIA)"
# Java takes the first alternative that matches, so the longer spelling has to stand first.
TRANSFER_PREFIX = (
    r"(?i)^(TRANSFERENCIA\s+(DE|A|FAVOR DE))\s*"
    r"|^(TRA\s*NS\s*F?|TRANSF?)\s*(INTERNA|OTR[AS]*\s+ENTID|OTR[AS]*|I|NOMI[A-Z]*|/)?\s*(/|:)?\s*"
)
# Opt-in variant: the one-letter "I" counts only as a word of its own.
TRANSFER_PREFIX_WHOLE = TRANSFER_PREFIX.replace("|I|", r"|I(?![\p{L}\p{N}])|")
DIRECT_DEBIT = r"^(RECIBO|RECIB)\s*/?"
DIRECT_DEBIT_PREFIX = r"(?i)^(RECIBO|RECIB)\s*/?\s*"


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(("(?i)" if pattern.isascii() else "(?iu)") + pattern)


def varchar(value: Column, length: int) -> Column:
    """Explicit cast to a bounded string: longer values are cut."""
    return F.substring(value.cast("string"), 1, length)


def normalise(text: Column, fold_accents: bool = False) -> Column:
    """Lower-case text in which every run of non-alphanumeric ASCII is one space; not trimmed.

    Accented letters are such a run unless they are folded first. The one class ``\\P{Alnum}``, ASCII in Java,
    is many times faster than a negated union of ranges.
    """
    if fold_accents:
        text = F.translate(text, ACCENTED, PLAIN)
    return F.lower(F.regexp_replace(text, r"\P{Alnum}+", " "))


def title_case(text: Column) -> Column:
    """Capital after every non-alphanumeric character, unlike ``initcap`` (only after blanks)."""
    # A word with what separates it from the next one; separators at the start are a run of their own.
    runs = F.regexp_extract_all(
        F.lower(text), F.lit(r"[\p{L}\p{N}]+[^\p{L}\p{N}]*|[^\p{L}\p{N}]+"), F.lit(0)
    )
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substring(run, 2, 1 << 30))), ""
    )


def plain_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(NBSP), F.lit(" "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def is_withdrawal(text: Column, amount: Column) -> Column:
    """Money taken out at a counter or machine; never NULL."""
    return F.coalesce((amount < 0) & matches(text, WITHDRAWAL), F.lit(False))


def _counterparty(text: Column, prefix: str) -> Column:
    name = F.regexp_replace(plain_spaces(text), prefix, "")
    name = F.regexp_replace(name, r"[;#$_/\\-]+", " ")
    return title_case(F.trim(F.regexp_replace(name, r"\s+", " ")))


def instant_payment_counterparty(text: Column) -> Column:
    return F.when(matches(text, INSTANT_PAYMENT), _counterparty(text, INSTANT_PREFIX))


def transfer_counterparty(text: Column, whole_prefix: bool = False) -> Column:
    prefix = TRANSFER_PREFIX_WHOLE if whole_prefix else TRANSFER_PREFIX
    return F.when(matches(text, TRANSFER), _counterparty(text, prefix))


def card_merchant(text: Column, account_type: Column) -> Column:
    is_card = account_type == "card"
    return F.when(is_card & F.contains(text, F.lit(",")), F.trim(F.split_part(text, F.lit(","), F.lit(1)))).when(
        is_card & (F.length(F.trim(text)) > 0), title_case(F.trim(text))
    )


def direct_debit_creditor(text: Column) -> Column:
    return F.when(matches(text, DIRECT_DEBIT), F.trim(F.regexp_replace(text, DIRECT_DEBIT_PREFIX, "")))
