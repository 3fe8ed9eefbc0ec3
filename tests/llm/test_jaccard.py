import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from ledgerwell.llm import jaccard, queries, texts

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    holders = defaultdict(set)
    for k, (i, s) in enumerate(sets):
        for j in set().union(*(holders[x] for x in s)) if s else ():
            both = len(s & sets[j][1])
            if 100 * both >= 85 * (len(s) + len(sets[j][1]) - both):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].add(k)
    return {i: (len(s), find(i)) for i, s in sets}


def family(seed=2):
    """Prose with a family of near copies, copies, a common passage and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    base, passage = prose(120), prose(30)
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += [" ".join(prose(rng.randint(5, 60)) + passage) for _ in range(60)]
    rows += ["same text of some words here"] * 30 + ["Same TEXT of some\tWords here"]
    rows += ["a b", "A  b", "a b c", "É é", "é é", "", " \n", "x " * 50]
    return list(enumerate(rows))


def test_components_equal_brute_force(spark):
    rows = family()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for join in (jaccard.Join(), jaccard.Join(frequent=3, pivots=1, rounds=1)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_documents(df, join=join).collect()}
        assert got == want


def test_query_over_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op6_jaccard(spark, SMALL).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    long = "many words in a long text " * 100_000
    rows = [(1, None), (2, ""), (3, "one"), (None, "one"), (4, "two words"), (4, "two words"), (5, long), (6, long + "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS row", "3 AS component_id")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join_documents(df).collect())
    want = [(1, 0, 1), (2, 0, 2), (3, 1, 3), (None, 1, 3), (4, 1, 4), (4, 1, 4), (5, 6, 5), (6, 7, 5)]
    assert got == Counter(want)
    assert jaccard.join_documents(df.limit(0)).count() == 0
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    # The copy without a key goes, and of the repeated row one stays.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 5])


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    column = pa.array(["Ab cd", None, "", "ef  gh\tij\nab CD", "é" * 300, "last"])
    data, starts = texts.flat(column)
    whole = texts.word_hashes(data, starts)
    monkeypatch.setattr(texts, "BLOCK", 8)
    parts = texts.word_hashes(data, starts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    hashes, places = whole
    assert hashes[0] == hashes[places[3] + 3] and hashes[1] == hashes[places[3] + 4]
    assert np.diff(places).tolist() == [2, 0, 0, 5, 1, 1]
    assert [r for r in texts.groups(starts, 6)][-1][1] == 6


def test_one_row_of_each_group(spark):
    """Copies without a key go, repeated rows leave one, and a clean row that shares its key with a copy stays."""
    rows = [(None, "a copy without key"), (None, "A copy without  key"), (1, "some words here"), (2, "some words here")]
    rows += [(2, "clean words of two"), (3, "said twice by three")] + [(3, "said twice by three")] * 3 + [(None, "some words here"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r["doc_id"], " ".join((r["text"] or "").lower().split())) for r in jaccard.one_of_each(df).collect())
    want = [(None, "a copy without key"), (1, "some words here"), (2, "clean words of two"), (3, "said twice by three"), (None, ""), (None, "")]
    assert kept == Counter(want)
