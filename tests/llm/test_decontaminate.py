import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerwell.llm import decontaminate, queries

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(found, size):
    return Counter(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


def alike(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(docs, items, least=0.8):
    """Best similarity over all windows of an item's size."""
    out = {}
    known = [(i, words(t)) for i, t in items]
    holders = defaultdict(set)
    for i, found in known:
        for run in bag(found, min(5, len(found))) if found else ():
            holders[run].add(i)
    sizes = {min(5, len(f)) for _, f in known if f}
    for doc, text in docs:
        own = words(text)
        near = set().union(*(holders[run] for size in sizes for run in bag(own, size) if run in holders))
        for item, found in known:
            if item not in near:
                continue
            size, n = min(5, len(found)), len(found)
            windows = (own[k : k + n] for k in range(max(1, len(own) - n + 1)))
            best = max((alike(bag(w, size), bag(found, size)) for w in windows if len(w) >= size), default=0)
            if best >= least:
                out[doc, item] = round(best, 6)
    return out


def test_query_over_the_table(spark):
    read = lambda name, key: [(r[key], r["text"]) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in queries.op1_decontamination(spark, SMALL).collect()}
    assert got == brute(read("documents", "doc_id"), read("benchmark", "item_id"))


def test_changed_passages_and_odd_rows(spark):
    passage = [f"p{k}" for k in range(40)]
    changed = [*passage[:39], "other"]
    far = [w if k % 6 else "other" for k, w in enumerate(passage)]
    filler = [f"f{k}" for k in range(60)]
    text = lambda *parts: " ".join(w for p in parts for w in p)
    docs = [
        (1, text(filler, passage, filler)),
        (2, text(filler, changed)),
        (3, text(far, filler)),
        (4, ", ".join(passage).upper() + "!"),
        (5, text(passage[:38])),
        (6, None),
        (7, ""),
        (8, text(filler, ["tiny", "item"], filler * 2000)),
        (9, text(passage, filler, passage)),
        (None, text(passage)),
        (1, text(filler, passage, filler)),
    ]
    items = [(1, text(passage)), (2, "Tiny item"), (3, None), (4, "..."), (1, text(passage))]
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS n", "3 AS hashes")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS name")
    out = decontaminate.leaks(left, right).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in out}
    assert len(out) == len(got) and got == brute(docs, items[:4])
    assert {(r["doc_id"], r["start_word"]) for r in out if r["doc_id"] in (1, 9)} == {(1, 60), (9, 0)}
    assert [r["doc_id"] for r in decontaminate.clean(left, right).select("doc_id").orderBy("doc_id").collect()] == [3, 6, 7]
    assert decontaminate.leaks(left.limit(0), right).count() == 0
    assert decontaminate.leaks(left, right.limit(0)).count() == 0


def test_blocks_find_all_within_the_radius(spark):
    flips = [0, 1, 0b101, sum(1 << k for k in range(0, 60, 3)), sum(1 << k for k in range(20))]
    df = spark.createDataFrame([(k, 0x0123456789ABCDEF, 0x0123456789ABCDEF ^ f) for k, f in enumerate(flips)], "k int, a long, b long")
    shared = F.size(F.array_intersect(decontaminate.blocks(F.col("a")), decontaminate.blocks(F.col("b"))))
    assert all(r["s"] >= 1 for r in df.select(shared.alias("s")).collect())
    cover = df.select(F.aggregate(decontaminate.blocks(F.lit(-1).cast("long")), F.lit(0), lambda t, b: t + F.bit_count(b["bits"])).alias("s")).first()
    assert cover["s"] == 64


def test_insertions_moves_and_changes(spark):
    """Windows that begin between the places where shared runs would have them begin, against every window."""
    item = [f"p{k}" for k in range(60)]
    filler = [f"f{k}" for k in range(20)]
    inserted = ["first", *item[1:30], "two", "more", *item[30:59], "last"]
    swapped = [*item[40:], *item[:40]]
    docs = [(1, filler + inserted + filler), (2, filler + swapped), (3, inserted), (4, filler + item[:56] + filler), (5, item[3:59])]
    rng = random.Random(3)
    for k in range(6, 60):
        own = list(item)
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 2)] = [f"x{rng.randrange(9)}" for _ in range(rng.randint(0, 3))]
        docs.append((k, filler[: rng.randint(0, 20)] + own + filler[: rng.randint(0, 20)]))
    docs = [(k, " ".join(found)) for k, found in docs]
    items = [(1, " ".join(item)), (2, " ".join(item[:30])), (3, " ".join(f"p{k % 7}" for k in range(60)))]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(left, right).collect()}
    assert got == brute(docs, items) and got[1, 1] == 0.806452


def test_clean_judges_rows_not_keys(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(None, passage), (None, "clean words"), (None, None), (1, passage), (1, "clean as well"), (2, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [r for r in rows if r[1] != passage]))
