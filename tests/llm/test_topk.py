import math

import numpy as np

from affinity.llm import topk as K


def brute(rows, k=10):
    v = {}
    for n, (i, e) in enumerate(rows):
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            v[n] = (i, [math.floor(1024 * x) for x in e])
    pool = {}
    for i, a in {(i, tuple(a)) for i, a in v.values() if i % 100 == 0}:
        pool.setdefault(i, []).extend((-sum(x * y for x, y in zip(a, b)), j) for j, b in v.values() if j != i and len(b) == len(a))
    out = [(i, r + 1, j, -d) for i, s in pool.items() for r, (d, j) in enumerate(sorted(s)[:k])]
    return sorted(out)


def found(df, **kw):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in K.top_products(df, **kw).collect())


def table(spark, rows):
    return spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, v string")


def test_equals_brute_force(spark, monkeypatch):
    g = np.random.default_rng(1)
    monkeypatch.setattr(K, "BLOCK", 50)
    monkeypatch.setattr(K, "PACK", 3)
    rows = [(int(i), (g.normal(size=12) * (1 + i % 3)).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[7][1]) for i in range(300)]                  # a common vector: ties
    assert found(table(spark, rows), n_pivots=9) == brute(rows)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (100, [0.5, -0.5]), (1, [1.0, None]), (2, None), (3, [inf, 0.0]), (4, [nan, 0.0]), (None, [1.0, 1.0]),
            (5, [3.0]), (200, [2.0]), (6, [0.0, 0.0]), (6, [0.0, 0.0]), (7, [1e9, -1e9]), (300, [])]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, rows).limit(0)) == []
    assert found(table(spark, [(100, [1.0])])) == []


def test_repeated_query_rows(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0])]
    assert found(table(spark, rows)) == [(100, 1, 1, 2097152), (100, 2, 2, 2097152)]


def test_an_id_with_several_vectors(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [2.0])] + [(i, [i / 8, 1 - i / 9]) for i in range(1, 30)] + [(50, [3.0])]
    assert found(table(spark, rows)) == brute(rows)


def test_query_equals_sql(spark, duck):
    got = sorted(tuple(r) for r in K.query(spark, "/root/testdata/sf0.001").select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted(duck.execute(f"SELECT query_id, rank, vec_id, score FROM ({K.SQL})").fetchall())
