"""Physical plans: what must and must not happen to the transactions."""

import re
from collections import Counter
from dataclasses import replace

import pytest

from ledgerwell.config import Limits
from ledgerwell.operators.joins import Dimension, fan_out, grid_join, lookup
from ledgerwell.operators.matching import attach_rule


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def core(warehouse):
    return plan(warehouse.int_transactions())


def test_no_python_and_no_cross_join(core):
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct", core)


def test_one_account_is_attached_without_a_join(warehouse):
    """No nested loop without a condition: the keyword loop of a short dictionary has one."""
    for model in (warehouse.int_cash, warehouse.int_wallet, warehouse.int_account_common, warehouse.int_account_personal):
        assert "NestedLoop" not in plan(model())


def test_transactions_shuffle_once_by_hash(core):
    assert len(re.findall(r"Exchange hashpartitioning\(source_hash", core)) == 1
    assert "WindowGroupLimit [source_hash" in core and "Partial" in core and "Final" in core


def test_only_needed_columns_reach_the_scan(warehouse):
    text = plan(warehouse.stg_cash().select("amount"))
    assert re.search(r"ReadSchema: struct<[^>]*o_totalprice", text) and "o_custkey" not in text.split("ReadSchema")[1]


def test_early_share_and_flag_are_pruned(core):
    assert "personal_amount" not in core.split("Exchange hashpartitioning(source_hash")[1]


def test_gram_lookup_is_a_hash_join(warehouse):
    text = plan(warehouse.matched("grams").select("source_hash", "rule_category_id"))
    assert "BroadcastHashJoin [_gram" in text


def test_large_dictionary_is_joined_by_piece_and_cell(spark, cfg):
    """The pieces meet in a shuffled join on both places of the grid; what they found is stored and looked up."""
    pieces, entries = (spark.createDataFrame([(1, "a")], f"_gram long, {c} string") for c in ("text", "word"))
    text = plan(grid_join(pieces, entries, "_gram", cfg.limits))
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[_gram#\d+L, _lines#\d+, _columns", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    rows = spark.createDataFrame([("h", "A", 1, "abc")], "source_hash string, account_id string, source_row_id bigint, description string")
    rules = spark.createDataFrame([("abc", "C", "M", 1)], "keyword string, category_id string, merchant_name string, priority int")
    assert "BroadcastHashJoin [description" in plan(attach_rule(rows, rules, cfg, "shuffled"))


def test_known_texts_are_matched_once_and_looked_up(warehouse):
    text = plan(warehouse.matched("coded").select("source_hash", "rule_category_id"))
    assert "BroadcastHashJoin [description" in text


@pytest.mark.parametrize("join", [fan_out, lookup])
def test_the_left_side_of_a_large_join_moves_once(spark, join):
    left = spark.range(50).selectExpr("cast(id as string) as k", "id as wide")
    right = Dimension(spark.range(80).selectExpr("cast(id % 20 as string) as k", "id as v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join(left, right, "k", Limits(broadcast_rows=0, hot_key_rows=3)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange of each side by key and slot; all others carry counts or keys only.
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len([x for x in moved if "_slot" in x]) == 2 and not any("wide" in x for x in moved)


def test_a_lookup_in_a_short_table_computes_the_left_rows_once(spark, tmp_path):
    """Every key is dealt out without counts, the rows as they were; a long table is looked up as before."""
    rows = [(f"k{n % 5}" if n % 7 else None, n // 3) for n in range(200)]
    spark.createDataFrame(rows, "k string, n int").write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    table = spark.createDataFrame([(f"k{n % 4}", n) for n in range(6)] + [(None, 9)], "k string, v int")
    limits = Limits(broadcast_rows=0, hot_key_rows=3)
    out = lookup(left, Dimension(table), "k", limits)
    assert plan(out).count("Scan parquet") == 1 and out.columns == ["k", "n", "v"]
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, left.join(table, "k", "left").collect()))
    few = replace(limits, hot_keys=100)
    assert plan(lookup(left, Dimension(table), "k", few)).count("Scan parquet") > 1


def test_marts_combine_before_the_shuffle(warehouse):
    assert "partial_sum" in plan(warehouse.fct_monthly_pnl())
    assert "partial_sum" in plan(warehouse.fct_monthly_balances())
