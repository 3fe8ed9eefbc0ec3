"""Exact copies against plain grouping."""

import random

from ledgerwell.llm import copies, queries

SMALL = "/root/testdata/sf0.001"


def plain(rows):
    """(key, keep, size) of each (key, text)."""
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    out = []
    for key, text in rows:
        own = groups[text or ""]
        named = [k for k in own if k is not None]
        out.append((key, max(named) if named else None, len(own)))
    return out


def ordered(rows):
    return sorted(rows, key=str)


def odd_rows():
    rng = random.Random(2)
    long = "é🦊" * 60_000
    rows = [(k, rng.choice(["same start " * 8 + x for x in "abcd"])) for k in range(200)]
    rows += [(k, "hot") for k in range(200, 400)] + [(400, long), (401, long), (402, long + "x"), (403, long + "y")]
    rows += [(500, None), (501, ""), (None, ""), (None, "alone"), (None, "both"), (None, "both"), (7, "both"), (9, "a"), (9, "a"), (8, "a")]
    return rows + [(600 + k, "once %d" % k) for k in range(50)]


def test_classes_of_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame([(k, t, "mine", "x") for k, t in rows], "doc_id long, text string, size string, kept string").repartition(5)
    for slots, hot in ((1 << 20, 10_000), (2, 3)):
        monkeypatch.setattr(copies, "SLOTS", slots)
        monkeypatch.setattr(copies, "HOT", hot)
        out = copies.classes(df).collect()
        assert ordered((r["doc_id"], r["keep_id"], r["group_size"]) for r in out) == ordered(plain(rows))
        assert all(r["size"] == "mine" for r in out)
        assert sum(r["kept"] for r in out) == len({t or "" for _, t in rows})
        assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_rows_that_stay(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(k, t, "mine") for k, t in rows], "doc_id long, text string, best string")
    out = copies.deduplicate(df)
    assert out.columns == df.columns
    want = {(keep, t or "") for (_, t), (_, keep, _) in zip(rows, plain(rows))}
    assert ordered((r["doc_id"], r["text"] or "") for r in out.collect()) == ordered(want)


def test_empty_table_and_table_without_copies(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert copies.classes(empty).count() == 0 and copies.deduplicate(empty).count() == 0
    single = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert {tuple(r) for r in copies.classes(single).collect()} == {(1, 1, 1, True), (2, 2, 1, True)}
    assert copies.deduplicate(single).count() == 2


def test_query_over_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = queries.op11_exact(spark, SMALL).collect()
    assert ordered((r["doc_id"], r["keep_id"], r["group_size"]) for r in out) == ordered(plain(docs))
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in out)
