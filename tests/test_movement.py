"""Which transactions move: only those whose hash another row, or an adjustment, may share."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerwell.config import Limits
from ledgerwell.operators import matching as m
from ledgerwell.operators.joins import FILTER_WORDS, Dimension, fan_out, key_filter, parted, repeated_keys
from ledgerwell.sources import sinks
from ledgerwell.sources.sinks import read_table, replace_table

ROW = "source_hash string, account_id string, source_row_id bigint, description string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_filter_parts_rows_without_loss(spark):
    rows = spark.createDataFrame([(str(i), i) for i in range(3000)] + [("7", -1), ("7", -1), (None, -2), (None, -3)], "k string, v long")
    alone, several = (Counter(map(tuple, x.collect())) for x in parted(rows, "k", repeated_keys(rows, "k")))
    assert alone + several == Counter(map(tuple, rows.collect()))
    assert {("7", 7), ("7", -1), (None, -2), (None, -3)} <= set(several)
    assert len(several) < 100


def test_a_filter_never_misses_a_key(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("_key"))
    words = key_filter(keys)
    assert words.count() <= FILTER_WORDS
    alone, several = parted(spark.range(40_000).select("id"), "id", words)
    assert several.filter("id < 20000").count() == 20_000 and alone.count() > 19_000


def test_single_rows_are_neither_ranked_nor_moved(warehouse):
    text = plan(warehouse.with_rule())
    assert "NestedLoop" not in text
    # One branch is ranked and moved, the other stands beside it without either.
    single, copied = text.split("WindowGroupLimit", 1)
    assert "Union" in single and "_bits" in single and "Exchange hashpartitioning(source_hash" in copied + single


def test_only_adjusted_rows_move(spark):
    left = spark.createDataFrame([(str(i), i) for i in range(500)] + [(None, -1), (None, -2)], "k string, wide long")
    pairs = [("3", "a"), ("3", "b"), ("3", "b"), ("4", None), (None, "x"), ("none", "y")]
    right = Dimension(spark.createDataFrame(pairs, "k string, v string"))
    out = fan_out(left, right, "k", Limits(broadcast_rows=0, hot_key_rows=2))
    assert out.columns == ["k", "wide", "v"] and "_bits" in plan(out)
    want = [(str(i), i, None) for i in range(500) if i != 3] + [(None, -1, None), (None, -2, None)]
    want += [("3", 3, "a"), ("3", 3, "b"), ("3", 3, "b")]
    assert Counter(map(tuple, out.collect())) == Counter(want)


def test_a_short_dictionary_is_tried_in_order(spark, cfg):
    rows = spark.createDataFrame([("h", "A", 1, "marta gil soto"), ("i", "A", 2, "iker"), ("j", "A", 3, None)], ROW)
    rules = [("gil", "G", None, 1), ("marta gil", "M", "Marta", None), ("soto", "S", " ", 2), (None, "N", None, 9)]
    out = m.attach_rule(rows, spark.createDataFrame(rules, "keyword string, category_id string, merchant_name string, priority int"), cfg)
    assert "Window" not in plan(out)
    got = sorted((r.source_hash, r.rule_category_id, r.rule_merchant, r.rule_priority) for r in out.collect())
    assert got == [("h", "S", None, 2), ("i", None, None, None), ("j", None, None, None)]


def test_written_hashes_are_compressed(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("source_hash"))
    replace_table(rows, str(tmp_path / "t"))
    files = [f for f in (tmp_path / "t").rglob("*.parquet")]
    assert sum(f.stat().st_size for f in files) < 20_000 * 50
    assert read_table(spark, str(tmp_path / "t")).exceptAll(rows).isEmpty()


def test_hashes_travel_as_bytes_to_their_partition(spark, tmp_path):
    digits = F.sha2(F.col("id").cast("string"), 256)
    odd = "CASE id WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'ABCD' WHEN 3 THEN 'abc' WHEN 4 THEN 'xyz é' WHEN 5 THEN '00ff' END"
    rows = spark.range(2_000).select("id", F.when(F.col("id") < 6, F.expr(odd)).otherwise(digits).alias("source_hash"), F.expr("id % 3 AS p"))
    moved = sinks._gathered(rows, "p")
    assert "unhex(source_hash" in plan(moved).split("Exchange", 1)[1]
    assert moved.schema.names == rows.columns and Counter(map(tuple, moved.collect())) == Counter(map(tuple, rows.collect()))
    replace_table(rows, str(tmp_path / "t"), "p")
    assert Counter(map(tuple, read_table(spark, str(tmp_path / "t"), rows.columns).collect())) == Counter(map(tuple, rows.collect()))
