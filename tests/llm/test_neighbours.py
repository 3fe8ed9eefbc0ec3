import math

import numpy as np

from ledgerwell.llm import neighbours
from ledgerwell.llm.common import components


def brute(rows, least=0.98):
    n, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, dtype=float)
        return a / np.linalg.norm(a)

    known = [(i, unit(v), y) for i, v, y in rows]
    for i, _, _ in known:
        parent[i], n[i] = i, 0
    for k, (i, a, y) in enumerate(known):
        for j, b, z in known[:k]:
            if a is not None and b is not None and y is not None and y == z and len(a) == len(b) and a @ b >= least:
                n[i] += 1
                n[j] += 1
                x, w = find(i), find(j)
                parent[max(x, w)] = min(x, w)
    return {i: (n[i], find(i), find(i) == i) for i in parent}


def cloud(seed=1):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(size=16).tolist(), int(k % 3)) for k in range(500)]
    middle = rng.normal(size=16)
    rows += [(1000 + k, (middle + rng.normal(size=16) * 0.08).tolist(), 1) for k in range(260)]
    rows += [(2000 + k, (np.array(rows[k][1]) * 3 + rng.normal(size=16) * 0.1).tolist(), rows[k][2]) for k in range(60)]
    rows += [(3000 + k, rows[7][1], rows[7][2]) for k in range(40)]
    return rows


def test_links_equal_brute_force(spark):
    rows = cloud()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    kept = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()]
    forest = neighbours.Forest(leaf=40, block=32)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near(df, forest=forest).collect()}
    want = brute(kept)
    found, there = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert 0.99 * there <= found <= there
    assert sum(got[k][1] != want[k][1] for k in want) <= 2


def test_odd_vectors(spark):
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1)]
    rows += [(6, [1.0, 0.0], None), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [], 1)]
    rows += [(12, [-1.0, 0.0], 1), (13, [1.0, 0.0], 2), (13, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS rep", "2 AS leaf")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near(df).collect())
    alone = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)]
    assert got == sorted([*alone, (8, 1, 8, True), (9, 1, 8, False), (13, 1, 13, True), (13, 1, 13, True)])
    assert neighbours.near(df.limit(0)).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 6), (3, 10), (10, 6), (8, 8), (None, 9)] + [(100, 100 + k) for k in range(1, 50)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    assert got == {k: 1 for k in (1, 2, 3, 10, 6, 7)} | {4: 4, 5: 4} | {100 + k: 100 for k in range(50)}
    assert components(df.limit(0), "a", "b").count() == 0
