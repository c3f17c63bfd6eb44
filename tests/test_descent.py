"""Stratified gradient descent against the same steps one after the other, and bounded scoring."""

import numpy as np
import pytest

from affinity.operators import changes, etl, factor, ranking


def planted(seed=3, users=40, items=30, n=600):
    rng = np.random.default_rng(seed)
    P, Q = rng.random((users, 4)), rng.random((items, 4)) * 2
    pick = rng.choice(users * items, n, replace=False)
    return [(int(k // items) * 11 + 10 ** 11, int(k % items) * 3, float(P[k // items] @ Q[k % items])) for k in pick]


def one_by_one(rows, rank, epochs, rate, blocks, block_of):
    P = {u: factor.start_vector(np.array([u]), rank, 0)[0] for u, _, _ in rows}
    Q = {i: factor.start_vector(np.array([i]), rank, 1)[0] for _, i, _ in rows}
    for step in range(epochs * blocks):
        part = [r for r in rows if block_of[r[1]] == (block_of[r[0]] + step) % blocks]
        for seat in range(blocks):
            own = sorted(r for r in part if block_of[r[0]] == seat)
            # Rounds without a repeated user or item, each rating alone.
            while own:
                seen_u, seen_i, later = set(), set(), []
                for u, i, g in own:
                    if u in seen_u or i in seen_i:
                        later.append((u, i, g))
                    else:
                        err = g - P[u] @ Q[i]
                        P[u], Q[i] = P[u] + rate * err * Q[i], Q[i] + rate * err * P[u]
                    seen_u.add(u)
                    seen_i.add(i)
                own = later
    return P, Q


@pytest.mark.parametrize("blocks", [1, 3])
def test_equals_steps_one_by_one(spark, blocks):
    from pyspark.sql import functions as F
    rows = planted()
    cells = spark.createDataFrame(rows, "user_id long, mov_id long, grade double")
    ids = spark.createDataFrame([(x,) for r in rows for x in r[:2]], "id long").distinct()
    block_of = {r["id"]: r["b"] for r in ids.select("id", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("b")).collect()}
    uf, vf = factor.sgd_factors(cells, rank=5, epochs=2, rate=0.05, blocks=blocks)
    P, Q = one_by_one(rows, 5, 2, 0.05, blocks, block_of)
    for got, want in ((uf, P), (vf, Q)):
        got = {r["id"]: np.array(r["features"]) for r in got.collect()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[k], want[k], rtol=0, atol=1e-12) for k in want)


def test_rounds_are_found_in_one_pass(monkeypatch):
    """A user with very many ratings makes as many rounds; they are not searched one by one."""
    rng = np.random.default_rng(8)
    users, items = np.append(np.zeros(400, np.int64), rng.integers(1, 20, 600)), rng.integers(0, 30, 1000)
    grades = rng.random(1000)
    P, Q = rng.random((20, 3)), rng.random((30, 3))
    p, q = P.copy(), Q.copy()
    for u, i, g in zip(users, items, grades):
        err = g - p[u] @ q[i]
        p[u], q[i] = p[u] + 0.1 * err * q[i], q[i] + 0.1 * err * p[u]
    calls, real = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: calls.append(1) or real(*a, **k))
    factor.descend(users, items, grades, P, Q, 0.1)
    assert len(calls) <= 2 and np.allclose(P, p, rtol=0, atol=1e-12) and np.allclose(Q, q, rtol=0, atol=1e-12)


def test_descent_learns_and_leaves_unknown_pairs_open(spark):
    rows = planted(n=800)
    cells = spark.createDataFrame(rows, "user_id long, mov_id long, grade double")
    pred = factor.predict_mf(cells, cells, rank=6, epochs=12, rate=0.05, blocks=2).collect()
    mean = np.mean([g for *_, g in rows])
    rmse = lambda p: float(np.sqrt(np.mean([(r["grade"] - p(r)) ** 2 for r in pred])))
    assert rmse(lambda r: r["prediction"]) < 0.6 * rmse(lambda r: mean)
    odd = spark.createDataFrame([(1, 3, 2.0), (rows[0][0], -5, 2.0)], "user_id long, mov_id long, grade double")
    assert [r["prediction"] for r in factor.predict_mf(cells, odd, blocks=1).collect()] == [None, None]


def test_blocks_of_small_norm_are_skipped(spark):
    rng = np.random.default_rng(4)
    U, V = rng.random((50, 6)), rng.random((200, 6))
    V *= np.linspace(3, 0.05, 200)[rng.permutation(200)][:, None]
    uf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(U)], "id long, features array<double>")
    vf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(V)], "id long, features array<double>")
    stats = {}
    got = factor.top_dot_products(uf, vf, 5, block=20, stats=stats).orderBy("user_id", "rank").collect()
    S = U @ V.T
    want = [j for i in range(50) for j in sorted(range(200), key=lambda j: (-round(S[i, j], 9), j))[:5]]
    assert [r["mov_id"] for r in got] == want
    assert stats["all"] == 50 * 10 and stats["read"] < stats["all"] / 2
    # Fewer items than asked for, and a zero vector: every block is read.
    few = factor.top_dot_products(uf, vf.limit(3), 5, block=2)
    assert few.count() == 150
    zero = spark.createDataFrame([(9, [0.0] * 6)], "id long, features array<double>")
    assert [r["mov_id"] for r in factor.top_dot_products(zero, vf, 4, block=50).orderBy("rank").collect()] == [0, 1, 2, 3]


def test_null_keys_count_as_rows(spark):
    r = spark.createDataFrame([(1, 1, 3.0), (1, 1, 4.0), (None, 1, 2.0), (1, None, 5.0)], "user_id long, mov_id long, grade double")
    assert [x["rows"] for x in ranking.stage_counts(r, 0, 0).orderBy("step").collect()][:2] == [4, 3]


def test_large_ids_and_repeated_keys(spark):
    m = spark.createDataFrame([(10 ** 15, "a"), (7, "b")], "mov_id long, name string")
    assert changes.onboarding_sample(m, 5).count() == 2
    inc = spark.createDataFrame([(1, "y"), (1, "x"), (7, "z"), (None, "n")], "mov_id long, name string")
    assert sorted(map(tuple, changes.append_new_items(m, inc).collect())) == [(1, "x"), (7, "b"), (10 ** 15, "a")]
    users = spark.createDataFrame([(5, "u", "U")], "user_id long, username string, name string")
    signup = spark.createDataFrame([("b", "B", 1), ("a", "A", 1), ("u", "no", 0)], "username string, name string, seq long")
    got = sorted(tuple(x) for x in changes.append_new_users(users, signup).collect())
    assert got == [(5, "u", "U"), (6, "a", "A"), (7, "b", "B")]
    big = spark.createDataFrame([(3 * 10 ** 15, "n", "u")], "user_id long, name string, username string")
    rate = spark.createDataFrame([(3 * 10 ** 15, 7, 2.0)], "user_id long, mov_id long, grade double")
    ig = spark.createDataFrame([(7, 2)], "mov_id long, genre_id long")
    assert etl.user_favorite_genre(big, rate, ig).first()["genre_id"] == 2


def test_a_stored_model_scores_without_a_fit(spark, tmp_path):
    from affinity.sources.files import Catalog
    rows = planted(n=400)
    path = str(tmp_path / "r")
    spark.createDataFrame(rows, "user_id long, mov_id long, grade double").write.parquet(path)
    cells = spark.read.parquet(path)
    cat, version = Catalog(spark, str(tmp_path / "m")), factor.input_version(cells)
    one = factor.recommend_als(factor.stored_als(cat, lambda: cells, version, rank=3), 3).orderBy("user_id", "rank").collect()

    def no_fit():
        raise AssertionError("fitted again")

    again = factor.recommend_als(factor.stored_als(Catalog(spark, cat.base), no_fit, version, rank=3), 3)
    assert again.orderBy("user_id", "rank").collect() == one and len(one) == 3 * len({u for u, *_ in rows})
    cells.limit(300).write.mode("append").parquet(path)                                    # other input: another model
    later = factor.input_version(spark.read.parquet(path))
    with pytest.raises(AssertionError):
        factor.stored_als(cat, no_fit, later, rank=3)
    factor.stored_als(cat, lambda: spark.read.parquet(path).dropDuplicates(["user_id", "mov_id"]), later, rank=3)
    assert cat.version() == 2


def test_only_cells_that_may_be_best_are_rounded(monkeypatch):
    """Ties of rounded scores, few items, scores below the threshold, infinite and missing ones."""
    rng = np.random.default_rng(6)
    S = np.round(rng.normal(size=(40, 300)), 2) + rng.choice([0, 3e-10, -3e-10], size=(40, 300))
    odd = S[:, :50].copy()
    odd[3, 7], odd[4] = np.inf, -np.inf
    none = S.copy()
    none[5, 9] = np.nan
    blank = np.full(40, np.nan)
    for cells in (S, odd, none, S[:, :4], S * 1e6, S[:0]):
        want = factor._topk(factor.round_half_up(cells), 5)
        assert all(np.array_equal(a, b) for a, b in zip(factor._best_cells(cells, 5, blank[:len(cells)]), want))
    kth = np.sort(S, axis=1)[:, -5] - 2e-9
    assert all(np.array_equal(a, b) for a, b in zip(factor._best_cells(S, 5, kth), factor._topk(factor.round_half_up(S), 5)))
    sizes, real = [], factor.round_half_up
    monkeypatch.setattr(factor, "round_half_up", lambda x: sizes.append(x.size) or real(x))
    factor._best_cells(S, 5, blank)
    assert sum(sizes) < S.size // 10


def test_users_are_copied_for_groups_of_blocks_not_for_blocks(spark, monkeypatch):
    """Users that read many blocks go as one row a group of blocks, with the same lists."""
    rng = np.random.default_rng(6)
    U, V = rng.normal(size=(90, 5)), rng.normal(size=(240, 5)).round(1)
    V[7] = V[130]
    uf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(U)], "id long, features array<double>")
    vf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(V)], "id long, features array<double>")
    copies, real = spark.sparkContext.accumulator(0), factor._user_slices

    def counted(*a):
        run = real(*a)

        def count(pdf):
            out = run(pdf)
            copies.add(sum(len(x) // 8 for x in out["ids"]))
            return out
        return count

    monkeypatch.setattr(factor, "_user_slices", counted)
    monkeypatch.setattr(factor, "GROUP_USERS", 40)
    stats = {}
    got = factor.top_dot_products(uf, vf, 4, block=6, stats=stats).orderBy("user_id", "rank").collect()
    S = U @ V.T
    assert [r["mov_id"] for r in got] == [j for i in range(90) for j in sorted(range(240), key=lambda j: (-round(S[i, j], 9), j))[:4]]
    assert 0 < copies.value < (stats["read"] - 90) / 2
    assert factor.group_starts([9, 3, 3, 3, 0, 0], 2, 10) == [1, 2] and factor.group_starts([5] * 6, 1, 4) == [1, 5]
    assert factor.group_starts([], 3, 2) == []


def test_a_step_moves_blocks_of_factors_not_rows(spark, monkeypatch):
    rows = planted(n=500)
    cells = spark.createDataFrame(rows, "user_id long, mov_id long, grade double")
    moved, real = {}, factor.materialize

    def counted(df, name="stage"):
        out = real(df, name)
        moved[name] = out.count()
        return out

    monkeypatch.setattr(factor, "materialize", counted)
    uf, vf = factor.sgd_factors(cells, rank=5, epochs=1, blocks=3)
    assert max(n for name, n in moved.items() if name.startswith("sgd-st")) == 2 * 3
    assert uf.count() == len({r[0] for r in rows}) and vf.count() == len({r[1] for r in rows})
