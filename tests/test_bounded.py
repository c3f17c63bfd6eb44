"""Neighbours by bounds against all pairs in numpy."""

import numpy as np
import pytest

from affinity.operators import bounded


def data(seed, n=60, cols=25, constant=0):
    rng = np.random.default_rng(seed)
    X = np.where(rng.random((n, cols)) < 0.15, rng.normal(size=(n, cols)), 0.0)
    X[:, 0] = np.where(rng.random(n) < 0.7, rng.normal(size=n), 0.0)          # a column that most rows share
    X[:, 1] = np.where(rng.random(n) < 0.5, rng.normal(size=n), 0.0)
    alpha = rng.random(n) * 3
    X[:constant] = 0.0                                                        # rows of one r: ties by id
    alpha[:constant] = 2.0
    norm = np.sqrt(alpha ** 2 + (X * X).sum(axis=1))
    norm[-1], X[-1], alpha[-1] = 0.0, 0.0, 0.0
    return X, alpha, norm


def brute(X, alpha, norm, k, ids):
    n = np.where(norm > 0, norm, 1.0)
    S = np.where(np.outer(norm, norm) > 0, (np.outer(alpha, alpha) + X @ X.T) / np.outer(n, n), 0.0)
    out = {}
    for i in range(len(ids)):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(S[i, j], 9), ids[j]))[:k]
        out[ids[i]] = [ids[j] for j in order]
    return out


def frames(spark, X, alpha, norm, ids):
    entries = spark.createDataFrame([(ids[i], int(c), float(X[i, c])) for i, c in zip(*np.nonzero(X))], "row_id long, col_id long, value double")
    info = spark.createDataFrame([(i, float(a), float(n)) for i, a, n in zip(ids, alpha, norm)], "row_id long, alpha double, norm double")
    return entries, info


@pytest.mark.parametrize("seed,hot,constant", [(1, 4096, 0), (2, 20, 0), (3, 3, 25), (4, 0, 0), (5, 4096, 40)])
def test_equals_all_pairs(spark, seed, hot, constant):
    X, alpha, norm = data(seed, constant=constant)
    ids = [int(i) for i in np.random.default_rng(seed).permutation(len(alpha)) * 7 + 10 ** 12]
    entries, info = frames(spark, X, alpha, norm, ids)
    got = bounded.cosine_topk(entries, info, 4, hot_limit=hot).orderBy("row_id", "rank").collect()
    lists = {}
    for r in got:
        lists.setdefault(r["row_id"], []).append(r["other_id"])
    assert lists == brute(X, alpha, norm, 4, ids)


def test_few_rows(spark):
    X, alpha, norm = data(6, n=3)
    entries, info = frames(spark, X, alpha, norm, [1, 2, 3])
    assert bounded.cosine_topk(entries, info, 5).count() == 6
    assert bounded.cosine_topk(entries.limit(0), info.limit(0), 5).count() == 0


def test_a_hot_column_makes_no_pairs(spark):
    """One column that all rows share: no pair is joined, and the list is left early."""
    n = 400
    rng = np.random.default_rng(9)
    X = np.zeros((n, n + 1))
    X[:, n], X[range(n), range(n)] = rng.choice([-0.02, 0.02], n), rng.random(n)       # the hot column, and one of its own
    alpha = np.ones(n)
    norm = np.sqrt(alpha ** 2 + (X * X).sum(axis=1))
    entries, info = frames(spark, X, alpha, norm, list(range(n)))
    stats = {}
    got = bounded.cosine_topk(entries, info, 3, hot_limit=50, stats=stats).orderBy("row_id", "rank").collect()
    assert stats["pairs"] == 0 and stats["read"] < n * n / 10
    want = brute(X, alpha, norm, 3, list(range(n)))
    assert [r["other_id"] for r in got] == [j for i in range(n) for j in want[i]]


def test_a_long_run_is_read_as_far_as_needed(spark):
    """Rows of one mean and no deviation: k + 1 of them are enough for every row."""
    n, stats = 500, {}
    info = spark.createDataFrame([(i, 2.0, 2.0) for i in range(n)], "row_id long, alpha double, norm double")
    none = spark.createDataFrame([], "row_id long, col_id long, value double")
    got = bounded.cosine_topk(none, info, 3, stats=stats).orderBy("row_id", "rank").collect()
    assert stats["read"] <= n * 4 and stats["runs"] == 1
    assert [r["other_id"] for r in got[:3]] == [1, 2, 3] and [r["other_id"] for r in got[-3:]] == [0, 1, 2]


def test_reach_counts_values(spark):
    rng = np.random.default_rng(1)
    values, asked = rng.integers(0, 50, 300) / 4.0, rng.integers(-4, 60, 80) / 4.0
    got = bounded.at_least(spark.createDataFrame([(float(v),) for v in values], "val double"),
                           spark.createDataFrame([(i, float(v)) for i, v in enumerate(asked)], "row_id long, val double"), "t")
    assert {r["row_id"]: r["reach"] for r in got.collect()} == {i: int((values >= v).sum()) for i, v in enumerate(asked)}


def test_only_pairs_with_a_chance_become_rows(spark):
    """Many rows share columns, but few pairs reach the threshold of the list."""
    n, cols = 300, 40
    rng = np.random.default_rng(4)
    X = np.where(rng.random((n, cols)) < 0.3, rng.choice([-1.0, 1.0], (n, cols)), 0.0)
    X[:8] = 0.0
    X[range(8), range(8)] = 0.1
    alpha = np.full(n, 1000.0)
    norm = np.sqrt(alpha ** 2 + (X * X).sum(axis=1))
    entries, info = frames(spark, X, alpha, norm, list(range(n)))
    stats = {}
    got = bounded.cosine_topk(entries, info, 3, stats=stats).orderBy("row_id", "rank").collect()
    want = brute(X, alpha, norm, 3, list(range(n)))
    assert [r["other_id"] for r in got] == [j for i in range(n) for j in want[i]]
    assert stats["pairs"] > n * n / 4 and stats["met"] < stats["pairs"] / 4


@pytest.mark.parametrize("limit", [1 << 14, 5])
def test_rows_of_nearly_equal_alpha_are_not_all_read(spark, monkeypatch, limit):
    """Copies of rows under other ids, and rows apart by less than the slack: a row reads
    some of them, and the same as all pairs give where some of them are its partners."""
    monkeypatch.setattr(bounded, "DOM_LIMIT", limit)
    rng = np.random.default_rng(11)
    n = 300
    X, alpha = np.zeros((n, 30)), np.full(n, 1.0)
    X[:, 29] = 1e-5 * np.sqrt(np.arange(n) // 10)                # a of 30 runs, all within the slack
    for i in range(40):                                          # some rows share columns
        X[i, rng.integers(0, 29, 3)] = rng.choice([-0.3, 0.3], 3)
    norm = np.sqrt(alpha ** 2 + (X * X).sum(axis=1))
    X[:, 29] = 0.0                                               # a column of no part in the sums
    ids = [int(i) for i in rng.permutation(n) + 1000]
    entries, info = frames(spark, X, alpha, norm, ids)
    stats = {}
    got = bounded.cosine_topk(entries, info, 4, stats=stats).orderBy("row_id", "rank").collect()
    lists = {}
    for r in got:
        lists.setdefault(r["row_id"], []).append(r["other_id"])
    assert lists == brute(X, alpha, norm, 4, ids)
    if limit > n:
        assert stats["read"] < n * n / 6
