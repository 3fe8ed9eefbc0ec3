"""Left joins that hold when the right side outgrows a broadcast or one key holds much of a side."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.config import Limits


NULL_PARTS = 4096
#: Words of 64 bits in a filter of keys, which bound its broadcast, and the bits that a key sets in its word.
FILTER_WORDS = 1 << 20
FILTER_BITS = 3
#: Over so many slots, least and most, every key is dealt out if the keys are not counted.
EVEN_PARTS = 256, 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def within(self, limits: Limits) -> bool:
        return self.rows <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def measure(df: DataFrame, *facts: Column) -> tuple[Size, tuple]:
    """Rows and text bytes, and further aggregates; counted in parallel, one row per task is sent back."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(1)) for c in df.columns), F.lit(0))
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)), *facts).first()
    return Size(row[0], row[1]), tuple(row[2:])


class Dimension:
    """A table with its size, which is measured on first use and then kept."""

    def __init__(self, df: DataFrame):
        self.df = df

    @cached_property
    def size(self) -> Size:
        return measure(self.df)[0]

    def select(self, *columns: Column | str) -> Dimension:
        """Narrower table; the size of the whole one bounds it."""
        narrow = Dimension(self.df.select(*columns))
        narrow.size = self.size
        return narrow


def hot_keys(keys: Column, df: DataFrame, limits: Limits) -> DataFrame:
    """Over how many tasks to spread each key with too many rows for one (``_bucket``, ``_parts``).

    The counts combine before the shuffle. Keys fall into a fixed number of buckets by hash, so the list can be
    broadcast however many hot keys there are: those that share a bucket are spread as the hottest of them.
    """
    counts = df.filter(keys.isNotNull()).groupBy(F.xxhash64(keys).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > limits.hot_key_rows)
    parts = F.ceil(F.max("_n") / F.lit(limits.hot_key_rows)).cast("int")
    return F.broadcast(hot.groupBy(_bucket(F.col("_key"), limits).alias("_bucket")).agg(parts.alias("_parts")))


def _bucket(key: Column, limits: Limits) -> Column:
    return F.pmod(key, F.lit(limits.hot_keys)).cast("int")


def deal(df: DataFrame, key: str, hot: DataFrame, limits: Limits) -> DataFrame:
    """Give each row one slot (``_slot``) among those of its key.

    The slot follows from the row's content alone, so a recomputed task sends its rows to the same place. Exact
    copies of a row share a slot; where they are possible, ``counted`` makes them one row first. NULL keys match
    nothing and may go anywhere.
    """
    spread = F.when(F.col(key).isNull(), F.lit(NULL_PARTS)).otherwise(F.coalesce(F.col("_parts"), F.lit(1)))
    bucket = _bucket(F.xxhash64(key), limits)
    hashed = df.withColumns({"_row": F.xxhash64(*df.columns), "_bucket": bucket}).join(hot, "_bucket", "left")
    return hashed.withColumn("_slot", F.pmod(F.col("_row"), spread).cast("int")).drop("_row", "_bucket", "_parts")


def copy_to_slots(df: DataFrame, key: str, hot: DataFrame, limits: Limits) -> DataFrame:
    """Repeat each row for every slot of its key; NULL keys match nothing and are left out."""
    known = df.filter(F.col(key).isNotNull()).withColumn("_bucket", _bucket(F.xxhash64(key), limits))
    slots = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return known.join(hot, "_bucket", "left").withColumn("_slot", F.explode(slots)).drop("_bucket", "_parts")


def counted(df: DataFrame) -> DataFrame:
    """Equal rows as one, with their number in ``_copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))


def expanded(df: DataFrame) -> DataFrame:
    """The inverse of ``counted`` after a join."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")


def spread_left_join(left: DataFrame, right: DataFrame, key: str, limits: Limits) -> DataFrame:
    """Shuffled left join in which rows of a hot left key are dealt out over several copies of the right."""
    hot = hot_keys(F.col(key), left, limits)
    dealt = deal(left, key, hot, limits)
    return dealt.join(copy_to_slots(right, key, hot, limits), [key, "_slot"], "left").drop("_slot")


def even_parts(right: Size, limits: Limits) -> int | None:
    """Slots for every key of a short right side, whose copies then stay few; None where there is no room for enough."""
    least, most = EVEN_PARTS
    parts = min(most, limits.hot_keys // max(right.rows, 1), limits.broadcast_bytes // max(right.bytes, 1))
    return parts if parts >= least else None


def even_left_join(left: DataFrame, right: DataFrame, key: str, parts: int) -> DataFrame:
    """Shuffled left join in which every key is dealt out over several copies of a short right side.

    No key is counted, so the left rows are computed once.
    """
    dealt = left.withColumn("_slot", F.pmod(F.xxhash64(*left.columns), F.lit(parts)).cast("int"))
    slots = F.sequence(F.lit(0), F.lit(parts - 1))
    copies = right.filter(F.col(key).isNotNull()).withColumn("_slot", F.explode(slots))
    return dealt.join(copies, [key, "_slot"], "left").drop("_slot")


def lookup(left: DataFrame, right: Dimension, key: str, limits: Limits) -> DataFrame:
    """Left join of many rows to a table with few rows per key; the left rows move once at most."""
    if right.size.within(limits):
        return left.join(F.broadcast(right.df), key, "left")
    parts = even_parts(right.size, limits)
    return even_left_join(left, right.df, key, parts) if parts else spread_left_join(left, right.df, key, limits)


def _word(key: Column) -> Column:
    return F.pmod(key, F.lit(FILTER_WORDS)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a hashed key; other bits of the hash choose its word."""
    places = (F.shiftrightunsigned(key, 20 + 6 * n).bitwiseAND(F.lit(63)).cast("int") for n in range(FILTER_BITS))
    return reduce(Column.bitwiseOR, (F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places))


def key_filter(keys: DataFrame) -> DataFrame:
    """Words of bits of which the hashed keys (``_key``) have set some; of fixed size at most, however many there are."""
    bits = F.bit_or(_mask(F.col("_key"))).alias("_bits")
    return F.broadcast(keys.groupBy(_word(F.col("_key")).alias("_word")).agg(bits))


def marked(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Whether the key of each row may be in a filter (``_listed``); it surely is not where this is false."""
    hashed = F.xxhash64(key)
    met = df.withColumns({"_word": _word(hashed), "_mask": _mask(hashed)}).join(keys, "_word", "left")
    listed = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return met.select(*df.columns, listed.alias("_listed"))


def parted(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is surely not in a filter, and those that may be; neither moves.

    A key that shares its bits with others is among the second without cause, so what is done there has to hold for
    any row.
    """
    met = marked(df, key, keys)
    return met.filter(~F.col("_listed")).drop("_listed"), met.filter("_listed").drop("_listed")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Filter of the keys that several rows may share, NULL among them; hashes travel, counted before they do."""
    counts = df.groupBy(F.xxhash64(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return key_filter(counts.filter("_n > 1").select("_key"))


def grid_join(left: DataFrame, right: DataFrame, key: str, limits: Limits) -> DataFrame:
    """Shuffled inner join that holds when a key is hot on either side, or on both.

    The rows of a hot key are dealt out on both sides: left rows over the lines of a grid, right rows over its columns.
    A left row is copied along its line, a right one along its column, so every pair meets in one cell, and no cell
    holds more than its share of either side.
    """

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.filter(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        parts = F.ceil(F.max("_n") / F.lit(limits.hot_key_rows)).cast("int").alias(name)
        hot = counts.filter(F.col("_n") > limits.hot_key_rows)
        return hot.groupBy(_bucket(F.col("_key"), limits).alias("_bucket")).agg(parts)

    grid = F.broadcast(shares(left, "_lines").join(shares(right, "_columns"), "_bucket", "full"))

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        known = df.filter(F.col(key).isNotNull())
        known = known.withColumns({"_row": F.xxhash64(*df.columns), "_bucket": _bucket(F.xxhash64(key), limits)})
        known = known.join(grid, "_bucket", "left").drop("_bucket")
        many = {c: F.coalesce(F.col(c), F.lit(1)) for c in (own, other)}
        dealt = known.withColumns({own: F.pmod("_row", many[own]).cast("int"), other: F.sequence(F.lit(0), many[other] - 1)})
        return dealt.withColumn(other, F.explode(other)).drop("_row")

    cells = [key, "_lines", "_columns"]
    return placed(left, "_lines", "_columns").join(placed(right, "_columns", "_lines"), cells).drop("_lines", "_columns")


def fan_out(left: DataFrame, right: Dimension, key: str, limits: Limits) -> DataFrame:
    """Left join where each key occurs at most once on the left and any number of times on the right.

    Beyond the broadcast bound the rows of a hot right key are dealt out over slots and the one left row is copied
    to each. So that a copy can tell an empty slot from a key without rows, every slot of a listed key holds a mark.
    Left rows whose key the right side lacks are told by a filter of its keys and stay where they are; the others move
    once.
    """
    matchable = right.df.filter(F.col(key).isNotNull())
    if right.size.within(limits):
        return left.join(F.broadcast(matchable), key, "left")
    apart, left = parted(left, key, key_filter(matchable.select(F.xxhash64(key).alias("_key"))))
    rows = counted(matchable)
    hot = hot_keys(F.col(key), rows, limits)
    bucket = _bucket(F.xxhash64(key), limits)
    slots = F.sequence(F.lit(0), F.col("_parts") - 1)
    listed = rows.select(key).distinct().withColumn("_bucket", bucket).join(hot, "_bucket")
    marks = listed.select(key, F.explode(slots).alias("_slot"), F.lit(False).alias("_real"))
    known = deal(rows, key, hot, limits).withColumn("_real", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    # Rows without a key match nothing and may go anywhere.
    loose = F.array(F.pmod(F.xxhash64(*left.columns), F.lit(NULL_PARTS)).cast("int"))
    places = F.when(F.col(key).isNull(), loose).otherwise(F.coalesce(slots, F.array(F.lit(0))))
    copies = left.withColumn("_bucket", bucket).join(hot, "_bucket", "left").withColumn("_slot", F.explode(places))
    joined = copies.drop("_bucket", "_parts").join(known, [key, "_slot"], "left")
    kept = joined.filter(F.coalesce(F.col("_real"), F.col(key).isNull() | (F.col("_slot") == 0))).drop("_real", "_slot")
    joined = expanded(kept.withColumn("_copies", F.coalesce("_copies", F.lit(1))))
    return apart.unionByName(joined, allowMissingColumns=True).select(*joined.columns)
