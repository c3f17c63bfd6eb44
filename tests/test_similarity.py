"""Tiled similarity, user CF and TF-IDF against dense numpy brute force."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from affinity.operators import collab, content, ranking, tiles
from affinity.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _brute_topk(ids, sim, k, exclude_zero):
    out = {}
    for a, u in enumerate(ids):
        cand = [(-round(sim[a, b], 9), v) for b, v in enumerate(ids) if b != a
                and not (exclude_zero and round(sim[a, b], 9) <= 0)]
        out[u] = [v for _, v in sorted(cand)[:k]]
    return out


def test_tiles_match_brute_force_across_blocks(spark):
    rng = np.random.default_rng(7)
    n_rows, n_cols = 60, 25
    X = (rng.random((n_rows, n_cols)) < 0.3) * rng.integers(1, 4, (n_rows, n_cols)).astype(float)
    X[5] = X[6]                     # exact duplicate rows -> ties at 1.0
    X[9] = 0                        # empty row
    alpha = rng.random(n_rows)
    ids = np.arange(100, 100 + n_rows)
    norm = np.sqrt(alpha ** 2 + (X ** 2).sum(1))
    sim = (np.outer(alpha, alpha) + X @ X.T) / np.outer(norm, norm)
    r, c = np.nonzero(X)
    entries = spark.createDataFrame(pd.DataFrame({"row_id": ids[r], "col_id": c, "value": X[r, c]}))
    info = spark.createDataFrame(pd.DataFrame({"row_id": ids, "alpha": alpha, "norm": norm}))
    for blocks in (1, 4):
        got = tiles.cosine_topk(entries, info, 5, blocks=blocks).toPandas()
        got = got.sort_values(["row_id", "rank"]).groupby("row_id")["other_id"].apply(list).to_dict()
        assert got == _brute_topk(ids, sim, 5, False)


def _dense_user_cosine(spark):
    cells, _ = ranking.prepared_cells(td.ratings(spark, SF), 30, 10)
    p = cells.toPandas().pivot_table(index="user_id", columns="mov_id", values="grade")
    imp = p.T.fillna(p.mean(axis=1)).T
    v = imp.to_numpy()
    n = np.linalg.norm(v, axis=1)
    sim = (v @ v.T) / np.outer(n, n)
    return cells, p, imp, sim


def test_user_neighbors_match_dense_imputed_cosine(spark):
    cells, p, imp, sim = _dense_user_cosine(spark)
    ids = list(p.index)
    want = _brute_topk(ids, sim, 5, False)
    got = collab.user_neighbors(cells, 5, hot_limit=10).toPandas()
    got_lists = got.sort_values(["user_id", "rank"]).groupby("user_id")["neighbor_id"].apply(list).to_dict()
    assert got_lists == want
    idx = {u: i for i, u in enumerate(ids)}
    for row in got.itertuples():
        assert math.isclose(row.sim, sim[idx[row.user_id], idx[row.neighbor_id]], rel_tol=1e-9)


def test_recommend_user_cf_matches_dense(spark):
    cells, p, imp, sim = _dense_user_cosine(spark)
    nb = collab.user_neighbors(cells, 5)
    got = collab.recommend_user_cf(cells, nb, 10).toPandas()
    ids = list(p.index)
    nbp = nb.toPandas()
    for u in ids[:25]:
        rows = nbp[nbp.user_id == u]
        vs = [ids.index(v) for v in rows.neighbor_id]
        score = (imp.iloc[vs].T * rows.sim.to_numpy()).T.mean(axis=0)
        unrated = p.loc[u][p.loc[u].isna()].index
        s = score[unrated]
        want = sorted(((-round(x, 9), m) for m, x in s.items()))[:10]
        g = got[got.user_id == u].sort_values("rank")
        assert list(g.mov_id) == [m for _, m in want]
        assert np.allclose(g.score.to_numpy(), [-x for x, _ in want], atol=2e-6)


def test_tfidf_rows_are_unit_and_similar_items_brute_force(spark):
    docs = td.overviews(spark, SF)
    w = content.tfidf_weights(docs).toPandas()
    norms = w.groupby("mov_id").weight.apply(lambda s: float(np.sqrt((s ** 2).sum())))
    assert np.allclose(norms.to_numpy(), 1.0)
    m = w.pivot_table(index="mov_id", columns="term", values="weight", fill_value=0.0)
    sim = m.to_numpy() @ m.to_numpy().T
    want = _brute_topk(list(m.index), sim, 10, True)
    got = content.similar_items(docs, 10, max_rows_per_block=50).toPandas()
    got_lists = got.sort_values(["mov_id", "rank"]).groupby("mov_id")["similar_id"].apply(list).to_dict()
    assert {k: v for k, v in want.items() if v} == got_lists


def test_seeded_tiles_equal_all_pairs_rows(spark):
    rng = np.random.default_rng(3)
    X = (rng.random((50, 20)) < 0.25) * rng.random((50, 20))
    ids = np.arange(50)
    r, c = np.nonzero(X)
    entries = spark.createDataFrame(pd.DataFrame({"row_id": ids[r], "col_id": c, "value": X[r, c]}))
    info = spark.createDataFrame(pd.DataFrame({"row_id": ids, "alpha": 0.0, "norm": np.linalg.norm(X, axis=1)}))
    seeds = spark.createDataFrame(pd.DataFrame({"row_id": [3, 17, 41]}))
    full = tiles.cosine_topk(entries, info, 4, exclude_zero=True, blocks=3).toPandas()
    seeded = tiles.cosine_topk_seeded(entries, info, seeds, 4, exclude_zero=True, max_rows_per_block=7).toPandas()
    key = ["row_id", "rank", "other_id"]
    a = full[full.row_id.isin([3, 17, 41])].sort_values(key)[key].to_numpy()
    b = seeded.sort_values(key)[key].to_numpy()
    assert (a == b).all()


def test_user_cf_exact_under_hot_user_and_hot_item(spark):
    """One user holds a third of all ratings; one item is rated by almost everyone."""
    rng = np.random.default_rng(11)
    rows = []
    for u in range(1, 60):
        for m in rng.choice(np.arange(1, 400), size=6, replace=False):
            rows.append((u, int(m), float(rng.integers(0, 6))))
        rows.append((u, 0, float(rng.integers(0, 6))))            # hot item 0
    hot = [(1000, int(m), float(rng.integers(0, 6))) for m in range(0, 220)]
    rows += hot                                                     # hot user ~ 1/3 of rows
    assert len(hot) >= len(rows) / 3
    cells = ranking.rating_cells(spark.createDataFrame(rows, "user_id long, mov_id long, grade double"))
    p = cells.toPandas().pivot_table(index="user_id", columns="mov_id", values="grade")
    imp = p.T.fillna(p.mean(axis=1)).T
    v = imp.to_numpy()
    sim = (v @ v.T) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    ids = list(p.index)
    nb = collab.user_neighbors(cells, 5, hot_limit=4)
    got = nb.toPandas().sort_values(["user_id", "rank"]).groupby("user_id")["neighbor_id"].apply(list).to_dict()
    assert got == _brute_topk(ids, sim, 5, False)
    rec = collab.recommend_user_cf(cells, nb, 10).toPandas()
    nbp = nb.toPandas()
    for u in [1000, 1, 2, 3]:
        r = nbp[nbp.user_id == u]
        score = (imp.iloc[[ids.index(x) for x in r.neighbor_id]].T * r.sim.to_numpy()).T.mean(axis=0)
        s = score[p.loc[u][p.loc[u].isna()].index]
        want = [m for _, m in sorted((-round(x, 9), m) for m, x in s.items())[:10]]
        assert list(rec[rec.user_id == u].sort_values("rank").mov_id) == want


def test_large_column_ids_stay_apart(spark):
    entries = spark.createDataFrame([(1, 2 ** 60, 1.0), (2, 2 ** 60 + 1, 1.0)], "row_id long, col_id long, value double")
    info = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0)], "row_id long, alpha double, norm double")
    for blocks in (1, 4):
        assert tiles.cosine_topk(entries, info, 3, exclude_zero=True, blocks=blocks).count() == 0
    seeds = spark.createDataFrame([(1,)], "row_id long")
    assert tiles.cosine_topk_seeded(entries, info, seeds, 3, exclude_zero=True).count() == 0
    assert tiles.cosine_topk_seeded(entries, info, seeds, 3, exclude_zero=True, max_rows_per_block=1).count() == 0


def test_copies_of_a_pack_follow_groups_not_packs(spark, monkeypatch):
    """Sixty packs in a few groups: same lists as brute force, few copies of every entry."""
    rng = np.random.default_rng(3)
    X = (rng.random((60, 25)) < 0.3) * rng.integers(1, 4, (60, 25)).astype(float)
    r, c = np.nonzero(X)
    norm = np.sqrt((X ** 2).sum(1))
    entries = spark.createDataFrame(pd.DataFrame({"row_id": r, "col_id": c, "value": X[r, c]}))
    info = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(60), "alpha": 0.0, "norm": norm}))
    dealt, real = {}, tiles.pair_tiles
    monkeypatch.setattr(tiles, "pair_tiles", lambda left, gl, *a: (dealt.update(groups=gl), real(left, gl, *a))[1])
    got = tiles.cosine_topk(entries, info, 5, exclude_zero=True, blocks=60).toPandas()
    got = got.sort_values(["row_id", "rank"]).groupby("row_id")["other_id"].apply(list).to_dict()
    assert got == {k: v for k, v in _brute_topk(np.arange(60), X @ X.T / np.outer(norm, norm), 5, True).items() if v}
    assert dealt["groups"] <= 2 * math.ceil(math.sqrt(spark.sparkContext.defaultParallelism))
    assert tiles.groups_for(spark, 250, 500_000, 60_000_000) <= max(8, dealt["groups"])


def test_rare_and_common_terms_get_the_same_weights(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"word{j}" for j in range(1, 40) if i % j == 0)) for i in range(1, 60)]
                                 + [(7, "word1 again"), (None, "word2"), (61, None)], "mov_id long, overview string")
    got = {}
    for most in (3, 10 ** 6):
        monkeypatch.setattr(content, "COMMON_TERMS", most)
        got[most] = {(r["mov_id"], r["term"]): round(r["weight"], 12) for r in content.tfidf_weights(docs).collect()}
    assert got[3] == got[10 ** 6] and len(got[3]) > 100
    plan = content.term_counts(docs)
    assert plan.groupBy("mov_id", "term").count().where("count > 1").isEmpty()


def test_copies_go_round_by_round(spark, monkeypatch):
    """With room for few copies, tiles are taken in rounds and give the same lists, seeded too."""
    rng = np.random.default_rng(8)
    X = (rng.random((60, 25)) < 0.3) * rng.integers(1, 4, (60, 25)).astype(float)
    X[4] = X[51]
    r, c = np.nonzero(X)
    entries = spark.createDataFrame(pd.DataFrame({"row_id": r * 3, "col_id": c, "value": X[r, c]}))
    norm = np.sqrt((X ** 2).sum(1))
    want = _brute_topk(np.arange(60) * 3, X @ X.T / np.outer(norm, norm), 5, True)
    dealt, real = [], tiles.pair_tiles
    monkeypatch.setattr(tiles, "pair_tiles", lambda *a: (dealt.append(a), real(*a))[1])
    monkeypatch.setattr(tiles, "ROUND_ENTRIES", 1)
    monkeypatch.setattr(tiles, "groups_for", lambda *a: 4)
    lists = lambda df: df.toPandas().sort_values(["row_id", "rank"]).groupby("row_id")["other_id"].apply(list).to_dict()
    assert lists(tiles.cosine_topk(entries, None, 5, exclude_zero=True, blocks=9)) == {k: v for k, v in want.items() if v}
    diagonals = [a[6] for a in dealt]
    groups = dealt[0][1]
    assert diagonals == [[d] for d in range(groups // 2 + 1)]            # one diagonal a round: two copies of a pack
    seeds = [0, 6, 9, 153, 177, 1000]
    got = tiles.cosine_topk_seeded(entries, None, spark.createDataFrame([(s,) for s in seeds], "row_id long"), 5,
                                   exclude_zero=True, max_rows_per_block=7)
    assert lists(got) == {k: want[k] for k in seeds[:-1] if want[k]}
