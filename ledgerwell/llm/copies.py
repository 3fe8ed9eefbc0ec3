"""Exact copies by progressive refinement: by length, then by a hash of the first characters, then by a whole digest.

Lengths and first characters are counted with partial sums, so a group that holds much of the input sends one row per
task. Whole texts are digested only in groups that are left with several rows. Which groups are left travels as a set
of slots of fixed size: two groups in one slot cost a digest too many and change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed, fresh

#: Characters of the first look, slots of the sets that are broadcast, and the most groups that count as hot.
HEAD = 64
SLOTS = 1 << 20
HOT = 10_000


def _slot(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)).cast("int")


def _value(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


@dataclass(frozen=True)
class _Names:
    size: str
    head: str
    full: str


def _candidates(docs: DataFrame, text: str, names: _Names) -> DataFrame:
    """The rows with length, hash of the first characters and, where other rows agree in both, the whole digest."""
    value, size, head = _value(text), F.octet_length(_value(text)), F.xxhash64(F.left(_value(text), F.lit(HEAD)))
    looked = docs.select(size.alias("size"), head.alias("head"))
    lengths = looked.select("size").groupBy("size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lengths = lengths.select(_slot("size").alias("slot")).distinct()
    several = looked.join(F.broadcast(lengths), _slot("size") == F.col("slot"), "left_semi")
    heads = several.groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slot = fresh("slot")
    heads = heads.select(_slot("size", "head").alias(slot)).distinct()
    measured = docs.withColumns({names.size: size, names.head: head})
    marked = measured.join(F.broadcast(heads), _slot(names.size, names.head) == F.col(slot), "left")
    return marked.withColumn(names.full, F.when(F.col(slot).isNotNull(), F.sha2(value, 256))).drop(slot)


def _attached(rows: DataFrame, groups: DataFrame, full: str, total: int) -> DataFrame:
    """The rows with their group's columns, if any.

    Groups with a ten-thousandth of all rows or more are few, whatever the input, and meet their rows without moving
    them; a shuffle sees no larger one.
    """
    hot = F.broadcast(groups.filter(F.col("group_size") * HOT >= total))
    cold = groups.filter(F.col("group_size") * HOT < total)
    alone = rows.filter(F.col(full).isNull())
    asked = rows.filter(F.col(full).isNotNull())
    large = asked.join(hot, full)
    others = asked.join(hot.select(full), full, "left_anti").join(cold, full, "left")
    return large.unionByName(others).unionByName(alone, allowMissingColumns=True)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows without ``text``, with ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal if identical; NULL counts as empty. Of equal texts the row with the largest key stays, NULL being
    smaller than any; of rows that repeat key and text any one. ``keep_id`` is the key of the row that stays. Other
    columns stay; those named like an output are replaced. An empty table gives an empty one.
    """
    names = _Names(fresh("size"), fresh("head"), fresh("full"))
    row, group, made = fresh("row"), fresh("group"), ("keep_id", "group_size", "kept")
    others = [c for c in docs.columns if c not in (text, *made)]
    narrow = _candidates(docs, text, names).select(*others, names.full, F.monotonically_increasing_id().alias(row))
    # The row numbers are fixed from here on.
    narrow = checkpointed(narrow)
    last = F.max(F.struct(F.col(key).alias("id"), F.col(row).alias("row")))
    asked = narrow.filter(F.col(names.full).isNotNull())
    groups = asked.groupBy(names.full).agg(F.count(F.lit(1)).alias("group_size"), last.alias(group))
    groups = checkpointed(groups.filter("group_size > 1"))
    found = _attached(narrow, groups, names.full, narrow.count())
    single = F.col("group_size").isNull()
    kept = F.when(single, F.lit(True)).otherwise(F.col(row) == F.col(f"{group}.row"))
    keep_id = F.when(single, F.col(key)).otherwise(F.col(f"{group}.id"))
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    return found.select(*others, keep_id.alias("keep_id"), size.alias("group_size"), kept.alias("kept"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns and whole texts; ties and NULLs as in ``classes``.

    Only texts of which there may be copies move, and of those that repeat key and text one is left per task before.
    """
    names = _Names(fresh("size"), fresh("head"), fresh("full"))
    marked = _candidates(docs, text, names)
    asked = marked.filter(F.col(names.full).isNotNull())
    best, size, total = fresh("best"), fresh("group_size"), docs.count()
    groups = asked.groupBy(names.full).agg(F.count(F.lit(1)).alias(size), F.max(key).alias(best))
    groups = checkpointed(groups.filter(F.col(size) > 1))
    hot = F.broadcast(groups.filter(F.col(size) * HOT >= total))
    cold = groups.filter(F.col(size) * HOT < total)
    stays = F.col(key).eqNullSafe(F.col(best))
    large = asked.join(hot, names.full).filter(stays)
    others = asked.join(hot.select(names.full), names.full, "left_anti").join(cold, names.full, "left")
    single = others.filter(F.col(size).isNull())
    several = large.unionByName(others.filter(F.col(size).isNotNull() & stays)).dropDuplicates([names.full])
    kept = marked.filter(F.col(names.full).isNull())
    for part in (single, several):
        kept = kept.unionByName(part, allowMissingColumns=True)
    return kept.select(*docs.columns)
