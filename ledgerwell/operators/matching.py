"""Keyword dictionaries against statement text: which keyword does each text contain?

Text and keywords are normalised to the alphabet ``[a-z0-9 ]`` first, so containment is plain
``contains``. A nested loop costs texts x keywords; beyond a few dozen keywords the pairs are found with
an equi-join instead: every keyword is filed under its rarest three-letter piece, and a text that holds
the keyword holds that piece too. ``contains`` then confirms each candidate, so all ways agree exactly.

Statements repeat few texts many times. Beyond the nested loop, and while the distinct texts are few enough to
broadcast, they alone are matched, and each row looks up what its text found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.config import LedgerConfig, Limits
from ledgerwell.functions.rules import cascade
from ledgerwell.functions.text import blank_to_null, normalise
from ledgerwell.operators.joins import (
    Dimension,
    Size,
    counted,
    expanded,
    grid_join,
    marked,
    measure,
    repeated_keys,
    spread_left_join,
)
from ledgerwell.operators.topk import first_by
from ledgerwell.schemas import UNIFIED_COLUMNS
from ledgerwell.session import stored

GRAM = 3

KEYWORD = "match_key"
TEXT = "match_text"


def _pieces(df: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """One row per position and piece size, the piece hashed; position 0 is the empty piece of every row."""
    if len(sizes) > 1:
        df = df.withColumn("_size", F.explode(F.array(*(F.lit(s) for s in sizes))))
    else:
        df = df.withColumn("_size", F.lit(sizes[0]))
    # Never NULL, or the join would test every piece for it.
    whole = F.coalesce(F.col(TEXT), F.lit(""))
    last = F.greatest(F.length(whole) - F.col("_size") + 1, F.lit(0))
    df = df.withColumn("_pos", F.explode(F.sequence(F.lit(0), last)))
    df = df.filter((F.col("_pos") > 0) | (F.col("_size") == sizes[0]))
    piece = F.when(F.col("_pos") == 0, "").otherwise(F.substring(whole, F.col("_pos"), F.col("_size")))
    return df.withColumn("_gram", F.xxhash64(piece)).drop("_pos", "_size")


def filed(dictionary: DataFrame) -> DataFrame:
    """Anchored entries under the hash of their piece: numbers join faster than texts.

    Pieces that share a hash only add candidates, and each candidate is confirmed.
    """
    return dictionary.withColumn("_gram", F.xxhash64("_gram"))


def anchored(dictionary: DataFrame) -> DataFrame:
    """Dictionary entries with the piece they are filed under: the rarest in the dictionary.

    Keywords shorter than three letters are their own piece, the empty keyword included.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(KEYWORD) - GRAM + 1, F.lit(1)))
    pieces = dictionary.withColumn("_pos", F.explode(starts))
    pieces = pieces.withColumn("_gram", F.substring(F.col(KEYWORD), F.col("_pos"), F.lit(GRAM))).drop("_pos")
    # At most 1 + 37 + 37^2 + 37^3 = 52,060 pieces exist, whatever the dictionary holds.
    frequency = pieces.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    counted = pieces.join(F.broadcast(frequency), "_gram")
    return first_by(counted, [KEYWORD], [F.col("_n"), F.col("_gram")]).drop("_n")


@dataclass(frozen=True)
class Profile:
    """What the choice of a strategy needs to know about a dictionary."""

    size: Size
    sizes: tuple[int, ...]


def profile_of(dictionary: DataFrame) -> Profile:
    """Size of the dictionary and the piece sizes its keywords need, in one pass."""
    short = [F.coalesce(F.max(F.length(KEYWORD) == n), F.lit(False)) for n in range(1, GRAM)]
    long = F.coalesce(F.max(F.length(KEYWORD) >= GRAM), F.lit(False))
    size, flags = measure(dictionary, *short, long)
    return Profile(size, tuple(n for n, used in enumerate(flags, 1) if used) or (GRAM,))


def match_nested(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every keyword of a short dictionary is tried on every row."""
    return rows.join(F.broadcast(dictionary), F.contains(F.col(TEXT), F.col(KEYWORD)), "left")


def match_in_order(rows: DataFrame, dictionary: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The keywords of a short dictionary are tried on every row, best first; the first one found is the row's entry.

    The dictionary, which the caller bounds, becomes constants of the loop: no row is repeated, ranked or moved.
    """
    entries, fields = dictionary.orderBy(*order).collect(), dictionary.schema.fields
    if not entries:
        return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields})
    known = (F.struct(*(F.lit(e[f.name]).cast(f.dataType).alias(f.name) for f in fields)) for e in entries)
    known = F.array(F.lit(None).cast(dictionary.schema), *known)
    # The first place is that of no keyword: Spark takes the element at a NULL place of such an array for its first.
    tried = ((F.contains(F.col(TEXT), F.lit(e[KEYWORD])), F.lit(n)) for n, e in enumerate(entries, 2))
    place = cascade(tried, F.lit(1))
    found = rows.withColumn("_place", place).withColumn("_entry", F.element_at(known, F.col("_place")))
    return found.withColumns({f.name: F.col("_entry")[f.name] for f in fields}).drop("_place", "_entry")


def match_grams(rows: DataFrame, dictionary: DataFrame, profile: Profile) -> DataFrame:
    """Rows meet a broadcast dictionary by piece, without moving.

    The empty piece of each row meets an all-NULL entry, which keeps rows without a match. A row may
    carry that entry beside real matches and one match several times; the top-1 pick removes both.
    """
    entries = anchored(dictionary)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in dictionary.schema]
    unmatched = rows.sparkSession.range(1).select(*nulls, F.lit("").alias("_gram"))
    entries = filed(entries.unionByName(unmatched))
    candidates = _pieces(rows, profile.sizes).join(F.broadcast(entries), "_gram")
    return candidates.filter(F.col(KEYWORD).isNull() | F.contains(F.col(TEXT), F.col(KEYWORD))).drop("_gram")


class Texts:
    """The distinct values of a text column, if they are few enough to broadcast; judged once.

    The column is sketched before it is collected: a table of mostly different texts is not sorted out for nothing.
    The sketch errs by a twentieth, so twice the estimate has to fit.
    """

    def __init__(self, rows: DataFrame, column: str):
        self.column = column
        self._rows = rows.select(column).filter(F.col(column).isNotNull())

    @cached_property
    def distinct(self) -> DataFrame:
        return self._rows.distinct()

    def few(self, limits: Limits) -> bool:
        return self._size.within(limits)

    @cached_property
    def _size(self) -> Size:
        widest = F.coalesce(F.max(F.octet_length(F.col(self.column))), F.lit(0))
        row = self._rows.agg(F.approx_count_distinct(self.column, 0.05), widest).first()
        return Size(2 * row[0], 2 * row[0] * row[1])


def match_texts(
    texts: Texts, dictionary: DataFrame, profile: Profile, order: Sequence[Column], cfg: LedgerConfig
) -> DataFrame:
    """The best entry of each distinct text that holds a keyword, under the text itself."""
    rows = texts.distinct.withColumn(TEXT, normalise(F.col(texts.column), cfg.fold_accents))
    found = match_grams(rows, dictionary, profile)
    best = first_by(found.filter(F.col(KEYWORD).isNotNull()), [texts.column], order)
    return best.drop(TEXT)


def match_shuffled(
    rows: DataFrame, texts: Texts, dictionary: DataFrame, profile: Profile, order: Sequence[Column], cfg: LedgerConfig
) -> DataFrame:
    """Dictionary too large to broadcast: each distinct text is matched once, then looked up by the rows.

    Only pieces under which a keyword is filed travel. A piece found in very many texts, or under which very many
    keywords are filed, is split on both sides. What the texts found is broadcast if its measured size allows.
    """
    distinct = stored(texts.distinct.withColumn(TEXT, normalise(F.col(texts.column), cfg.fold_accents)))
    entries = stored(filed(anchored(dictionary)))
    # At most 52,060 pieces exist.
    wanted = F.broadcast(entries.select("_gram").distinct())
    pieces = _pieces(distinct, profile.sizes).distinct().join(wanted, "_gram", "left_semi")
    found = grid_join(pieces, entries, "_gram", cfg.limits).drop("_gram")
    found = found.filter(F.contains(F.col(TEXT), F.col(KEYWORD)))
    best = Dimension(stored(first_by(found, [texts.column], order).drop(TEXT)))
    if best.size.within(cfg.limits):
        return rows.join(F.broadcast(best.df), texts.column, "left")
    return expanded(spread_left_join(counted(rows), best.df, texts.column, cfg.limits))


def choose_match(size: Size, limits: Limits) -> str:
    if not size.within(limits):
        return "shuffled"
    return "nested" if size.rows <= limits.nested_loop_keywords else "grams"


def match_keywords(
    rows: DataFrame,
    dictionary: DataFrame,
    order: Sequence[Column],
    cfg: LedgerConfig,
    way: str | None = None,
    texts: Texts | None = None,
    picking: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """Rows with candidate entries, the best by ``order`` among them; NULL entry where nothing matches.

    ``way`` chooses among the ways that the sizes of the dictionary and of the distinct ``texts`` allow. Also tells
    whether each row carries its best entry only; then ``picking``, the rows with columns of the caller, stands for them.
    """
    limits, profile = cfg.limits, profile_of(dictionary)
    texts, picking = texts or Texts(rows, "description"), rows if picking is None else picking
    chosen = choose_match(profile.size, limits)
    way = chosen if way is None and chosen != "grams" else way or "coded"
    if chosen == "shuffled":
        way = chosen
    elif way == "coded" and not texts.few(limits):
        way = "grams"
    if way == "coded":
        best = match_texts(texts, dictionary, profile, order, cfg)
        return picking.join(F.broadcast(best), texts.column, "left"), True
    if way == "shuffled":
        return match_shuffled(picking, texts, dictionary, profile, order, cfg), True
    text = normalise(F.col(texts.column), cfg.fold_accents)
    if way == "nested" and profile.size.rows <= limits.nested_loop_keywords:
        return match_in_order(picking.withColumn(TEXT, text), dictionary, order).drop(TEXT), True
    rows = rows.withColumn(TEXT, text)
    found = match_nested(rows, dictionary) if way == "nested" else match_grams(rows, dictionary, profile)
    return found.drop(TEXT), False


def _collapsed(entries: DataFrame, keyword: str, order: Sequence[Column], cfg: LedgerConfig) -> DataFrame:
    """One entry per normalised keyword: the others can never win. NULL keywords match nothing."""
    entries = entries.withColumn(KEYWORD, normalise(F.col(keyword), cfg.fold_accents))
    return first_by(entries.filter(F.col(KEYWORD).isNotNull()), [KEYWORD], order)


def attach_participant(
    rows: DataFrame, participants: DataFrame, cfg: LedgerConfig, way: str | None = None, texts: Texts | None = None
) -> DataFrame:
    """Person with the longest keyword found in the description, and one row per ``source_hash``.

    Rows that share a hash are copies; the one with the longest keyword stays. Rows that carry their best person only
    move if their hash may have copies.
    """
    people = participants.select(F.col("keyword").alias("_keyword"), F.col("person_name").alias("participant_name"))
    best = [
        F.length("_keyword").desc_nulls_last(),
        F.col("_keyword").asc_nulls_last(),
        F.col("participant_name").asc_nulls_last(),
    ]
    people = _collapsed(people, "_keyword", best, cfg)
    # Told before the match, so that those with copies are matched alone for the pick among them.
    told = marked(rows, "source_hash", repeated_keys(rows, "source_hash"))
    found, picked = match_keywords(rows, people, best, cfg, way, texts, told)
    found = found.drop(KEYWORD)
    copies = ["account_id", "source_row_id"]
    copies += [c for c in UNIFIED_COLUMNS if c in rows.columns and c not in (*copies, "source_hash")]
    copies = [c for c in copies if c not in ("personal_amount", "is_pnl")]
    order = [*best, *(F.col(c).asc_nulls_last() for c in copies)]
    if not picked:
        return first_by(found, ["source_hash"], order).drop("_keyword")
    single, copied = found.filter(~F.col("_listed")), first_by(found.filter("_listed"), ["source_hash"], order)
    return single.unionByName(copied).drop("_keyword", "_listed")


def attach_rule(
    rows: DataFrame, rules: DataFrame, cfg: LedgerConfig, way: str | None = None, texts: Texts | None = None
) -> DataFrame:
    """Best rule whose keyword the description contains: highest priority, then longest keyword.

    Needs one row per ``source_hash``. Rows that tried a short dictionary in order, or looked their text up, carry
    their best rule only; a pick among the others moves them by hash.
    """
    rules = rules.select(
        F.col("keyword").alias("_keyword"),
        F.col("category_id").alias("rule_category_id"),
        blank_to_null(F.col("merchant_name")).alias("rule_merchant"),
        F.col("priority").alias("rule_priority"),
    )
    best = [
        F.col("rule_priority").desc_nulls_last(),
        F.length("_keyword").desc_nulls_last(),
        F.col("rule_category_id").asc_nulls_last(),
        F.col("rule_merchant").asc_nulls_last(),
        F.col("_keyword").asc_nulls_last(),
    ]
    rules = _collapsed(rules, "_keyword", best, cfg)
    found, picked = match_keywords(rows, rules, best, cfg, way, texts)
    if picked:
        return found.drop(KEYWORD, "_keyword")
    order = [F.col(KEYWORD).isNull(), *best]
    return first_by(found, ["source_hash"], order).drop(KEYWORD, "_keyword")
