"""Keyword matching: every way gives the same pairs as trying all pairs."""

import random
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerwell.config import Limits
from ledgerwell.functions.text import normalise
from ledgerwell.operators import matching as m
from ledgerwell.operators.joins import Dimension, deal, fan_out, grid_join, hot_keys, lookup
from ledgerwell.operators.resolve import with_adjustments

WAYS = ("nested", "grams", "coded", "shuffled")
ROW = "source_hash string, account_id string, source_row_id bigint, description string"
RULE = "keyword string, category_id string, merchant_name string, priority int"


def norm(text):
    out = []
    for c in text:
        c = c if c.isascii() and c.isalnum() else " "
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out).lower()


def brute_rule(text, rules):
    hits = [r for r in rules if text is not None and r[0] is not None and norm(r[0]) in norm(text)]
    if not hits:
        return (None, None, None)

    def order(r):
        merchant = (r[2] or "").strip(" ")
        return (r[3] is None, -(r[3] or 0), -len(r[0]), r[1], merchant == "", merchant, r[0])

    best = min(hits, key=order)
    return (best[1], (best[2] or "").strip(" ") or None, best[3])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    letters = "abá -*1"
    text = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    texts = [text(0, 14) for _ in range(400)] + [None, "", " ", "a", "ab", "abc"]
    rules = [(text(1, 6), f"C{rng.randint(0, 3)}", rng.choice(["M", " ", None, "N"]), rng.choice([None, 1, 2, 3])) for _ in range(120)]
    # A keyword of a blank would match nearly everything and hide the rest: give it the last place.
    rules = [(k, c, v, None if len(norm(k)) < 2 else p) for k, c, v, p in rules]
    rules += [("", "EMPTY", None, None), ("***", "BLANK", None, None), (None, "NULL", None, 99), ("b", "ONE", "x", None)]
    return texts, rules


@pytest.mark.parametrize("way", WAYS)
def test_rules_equal_brute_force(spark, cfg, corpus, way):
    texts, rules = corpus
    rows = spark.createDataFrame([(str(i), "A", i, t) for i, t in enumerate(texts)], ROW).repartition(5)
    tight = replace(cfg, limits=Limits(hot_key_rows=20))
    out = m.attach_rule(rows, spark.createDataFrame(rules, RULE), tight, way)
    got = {int(r.source_hash): (r.rule_category_id, r.rule_merchant, r.rule_priority) for r in out.collect()}
    assert got == {i: brute_rule(t, rules) for i, t in enumerate(texts)}


@pytest.mark.parametrize("way", WAYS)
def test_participants_longest_keyword_and_one_row_per_hash(spark, cfg, way):
    rows = [
        ("h1", "A", 1, "PAGO marta gil soto"),
        ("h2", "A", 2, "NADIE"),
        ("h3", "A", 3, "NADIE"),
        ("h3", "A", 4, "MARTA*GIL"),
        ("h4", "B", 5, "marta gil"),
        ("h4", "A", 6, "marta gil"),
        (None, "A", 7, "x"),
        (None, "A", 8, "y"),
        ("h5", "A", 9, None),
        ("h6", "A", 10, "MARTA GIL"),
    ] + [("hot", "A", 11, "same")] * 50
    people = [("Marta Gil", "Marta"), ("MARTA-GIL", "Other"), ("marta gil soto", "Soto"), (None, "Nobody")]
    tight = replace(cfg, limits=Limits(hot_key_rows=3))
    df = spark.createDataFrame(rows, ROW).repartition(6)
    out = m.attach_participant(df, spark.createDataFrame(people, "keyword string, person_name string"), tight, way)
    got = {r.source_hash: (r.source_row_id, r.participant_name) for r in out.collect()}
    assert out.count() == len(got) == 8
    assert got == {
        "h1": (1, "Soto"),
        "h2": (2, None),
        "h3": (4, "Other"),
        "h4": (6, "Other"),
        None: (7, None),
        "h5": (9, None),
        "h6": (10, "Other"),
        "hot": (11, None),
    }


@pytest.mark.parametrize("way", [None, *WAYS])
def test_empty_dictionaries_leave_rows_unmatched(spark, cfg, way):
    rows = spark.createDataFrame([("h", "A", 1, "PAGO"), ("i", "A", 2, None)], ROW)
    out = m.attach_rule(rows, spark.createDataFrame([], RULE), cfg, way).collect()
    assert sorted((r.source_hash, r.rule_category_id) for r in out) == [("h", None), ("i", None)]


def test_accents_match_only_when_folded(spark, cfg):
    rows = spark.createDataFrame([("h", "A", 1, "PAGO LÓPEZ")], ROW)
    people = spark.createDataFrame([("Lopez", "Lopez")], "keyword string, person_name string")
    assert m.attach_participant(rows, people, cfg).first().participant_name is None
    assert m.attach_participant(rows, people, replace(cfg, fold_accents=True)).first().participant_name == "Lopez"


def test_choice_of_way():
    size, limits = m.Size, Limits()
    assert m.choose_match(size(10, 100), limits) == "nested"
    assert m.choose_match(size(5000, 100), limits) == "grams"
    assert m.choose_match(size(10_000_000, 100), limits) == "shuffled"
    assert m.choose_match(size(10, 10**12), limits) == "shuffled"


def test_anchor_is_a_piece_of_its_keyword(spark):
    words = ["mercadona sa", "mercado sa", "carrefour sa", "sa", "s", "", "sas"]
    df = spark.createDataFrame([(w,) for w in words], f"{m.KEYWORD} string")
    anchors = {r[m.KEYWORD]: r["_gram"] for r in m.anchored(df).collect()}
    assert set(anchors) == set(words)
    assert all(g in w and len(g) == min(3, len(w)) for w, g in anchors.items())
    assert anchors["carrefour sa"] not in ("sa ", " sa")


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, hot_key_rows=5)])
def test_adjustments_fan_out(spark, limits):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("hot", 4)], "source_hash string, n int")
    schema = (
        "source_hash string, category_id_override string, merchant_override string, adjustment_type string, "
        "reason string, adjustment_amount decimal(18,2)"
    )
    manual = [("a", "X", None, "MY_EXPENSE", "1", D(1)), ("a", "Y", None, None, "2", None), (None, "N", None, None, "", None)]
    manual += [("hot", "H", None, None, str(i % 30), None) for i in range(60)] + [("zz", "Z", None, None, "", None)]
    out = with_adjustments(rows, Dimension(spark.createDataFrame(manual, schema)), limits).collect()
    got = sorted((r.n, r.category_id_override or "", r.adjustment_reason or "") for r in out)
    want = [(1, "X", "1"), (1, "Y", "2"), (2, "", ""), (3, "", "")] + [(4, "H", str(i % 30)) for i in range(60)]
    assert got == sorted(want)


def test_fan_out_keeps_columns_in_order(spark):
    left = spark.createDataFrame([("a", 1)], "k string, n int")
    right = Dimension(spark.createDataFrame([("a", "x")], "k string, v string"))
    for limits in (Limits(), Limits(broadcast_rows=0)):
        assert fan_out(left, right, "k", limits).columns == ["k", "n", "v"]


def test_normalise_agrees_with_plain_python(spark, corpus):
    texts = [t for t in corpus[0] if t is not None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalise(F.col("t")).alias("n"))
    assert all(norm(r.t) == r.n for r in df.collect())


def test_more_hot_keys_than_buckets(spark):
    """Every hot key is split, rows keep their slots when permuted, and equal rows keep their number."""
    limits = Limits(broadcast_rows=0, hot_key_rows=2, hot_keys=3)
    left = [(f"k{k % 20}" if k % 7 else None, k // 4) for k in range(200)]
    right = [(f"k{k % 25}", k) for k in range(75)] + [(None, 1), ("k1", 1), ("k1", 1)]
    rows = spark.createDataFrame(left, "key string, n int")
    table = spark.createDataFrame(right, "key string, m int")
    hot = hot_keys(F.col("key"), rows, limits)
    assert hot.count() == 3
    slots = sorted(map(str, deal(rows, "key", hot, limits).collect()))
    assert slots == sorted(map(str, deal(rows.orderBy(F.rand(3)).repartition(7), "key", hot, limits).collect()))
    plain = lambda df: sorted((str(r["key"]), r["n"], str(r["m"])) for r in df.collect())
    assert plain(lookup(rows, Dimension(table), "key", limits)) == plain(rows.join(table, "key", "left"))
    once = rows.dropDuplicates(["key"])
    assert plain(fan_out(once, Dimension(table), "key", limits)) == plain(once.join(table, "key", "left"))


def test_asking_for_a_way_does_not_lift_the_bound(spark, cfg):
    small = replace(cfg, limits=Limits(broadcast_rows=0))
    rows = spark.createDataFrame([("h", "A", 1, "abc")], "source_hash string, account_id string, source_row_id bigint, description string")
    rules = spark.createDataFrame([("abc", "C", "M", 1)], "keyword string, category_id string, merchant_name string, priority int")
    text = m.attach_rule(rows, rules, small, "nested")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "_slot" in text


def test_grid_join_with_both_sides_hot(spark):
    """Every pair meets once, and no cell holds more than its share of a hot key."""
    limits = Limits(hot_key_rows=10, hot_keys=7)
    left = spark.range(300).selectExpr("if(id < 250, 'hot', if(id % 9 = 0, null, cast(id % 11 as string))) as k", "id as n")
    right = spark.range(120).selectExpr("if(id < 90, 'hot', if(id % 7 = 0, null, cast(id % 13 as string))) as k", "id as m")
    plain = lambda df: sorted((r["k"], r["n"], r["m"]) for r in df.collect())
    assert plain(grid_join(left, right, "k", limits)) == plain(left.join(right, "k"))
    cells = left.join(right, "k").count()
    assert cells > 250 * 90 - 1 and grid_join(left.limit(0), right, "k", limits).count() == 0


def test_many_texts_are_not_coded(spark, cfg):
    rows = spark.createDataFrame([("h%d" % i, "A", i, "text %d abc" % i) for i in range(300)], ROW)
    rules = spark.createDataFrame([("abc", "C", "M", 1)], RULE)
    few = replace(cfg, limits=Limits(broadcast_rows=100))
    text = m.attach_rule(rows, rules, few, "coded")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_gram" in text
    assert m.attach_rule(rows, rules, few, "coded").filter("rule_category_id = 'C'").count() == 300
