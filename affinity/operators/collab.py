"""User-user collaborative filtering on mean-imputed ratings, without the matrix.

The reference fills every unrated cell with the user's mean and takes dense
cosine similarity between users.  With M items, mean mu_u and deviations
d_ui = r_ui - mu_u on rated cells (sum_i d_ui = 0):

    dot(u, v) = M * mu_u * mu_v + sum_{co-rated i} d_ui * d_vi
    |u|^2     = M * mu_u^2 + sum_i d_ui^2

so the similarity has a rank-one term alpha_u = sqrt(M) * mu_u over the sparse
deviations, and ``bounded.cosine_topk`` finds the neighbours exactly: co-raters by a
join, all others from the top of a list sorted by that term (no dense matrix).

Recommendation scores use the same split: the imputed value of v on item i
is mu_v + d_vi, so for the k neighbours N(u)

    score(u, i) = base_u + (1/k) * sum_{v in N(u), v rated i} sim_uv * d_vi
    base_u      = (1/k) * sum_{v in N(u)} sim_uv * mu_v

Items no neighbour rated all score base_u; among those the smallest ids win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators import bounded
from affinity.operators.ids import dense_index
from affinity.operators.ranking import rank_key, user_mean_rating
from affinity.session import materialize

NEIGHBOURS = 5      # fixed value (reference): neighbours per user
RECOMMEND_N = 10    # fixed value (reference): recommendations shown
OUT_PLACES = 6


def _means(cells: DataFrame) -> DataFrame:
    return user_mean_rating(cells).select("user_id", F.col("mean").alias("mu"))


def _deviations(cells: DataFrame, means: DataFrame) -> DataFrame:
    return cells.join(means, "user_id").select("user_id", "mov_id", (F.col("grade") - F.col("mu")).alias("d"))


def user_neighbors(cells: DataFrame, k: int = NEIGHBOURS, **kw) -> DataFrame:
    """Top-k most similar other users (user_id, neighbor_id, sim, rank)."""
    cells = materialize(cells, "cells")
    means = _means(cells)
    m_items = cells.select("mov_id").distinct().agg(F.count("*").cast("double")).scalar()
    dev = _deviations(cells, means)
    ss = dev.groupBy("user_id").agg(F.sum(F.col("d") * F.col("d")).alias("ss"))
    info = means.join(ss, "user_id", "left").select(
        F.col("user_id").alias("row_id"),
        (F.sqrt(m_items) * F.col("mu")).alias("alpha"),
        F.sqrt(m_items * F.col("mu") * F.col("mu") + F.coalesce(F.col("ss"), F.lit(0.0))).alias("norm"))
    entries = dev.select(F.col("user_id").alias("row_id"), F.col("mov_id").alias("col_id"),
                         F.col("d").alias("value"))
    nb = bounded.cosine_topk(entries, info, k, **kw)
    return nb.select(F.col("row_id").alias("user_id"), F.col("other_id").alias("neighbor_id"),
                     "sim", "rank")


def neighbour_contributions(cells: DataFrame, neighbors: DataFrame) -> DataFrame:
    """(user_id, mov_id, contrib) = sum over neighbours who rated the item of sim * d."""
    dev = _deviations(cells, _means(cells)).select(
        F.col("user_id").alias("neighbor_id"), "mov_id", "d")
    nb = neighbors.select("user_id", "neighbor_id", "sim")
    return (nb.join(dev, "neighbor_id", "inner")
              .groupBy("user_id", "mov_id").agg(F.sum(F.col("sim") * F.col("d")).alias("contrib")))


def unrated_items(cells: DataFrame, neighbors: DataFrame) -> DataFrame:
    """P9 as used by R4: items the user's neighbours rated that the user has not."""
    c = neighbour_contributions(cells, neighbors).select("user_id", "mov_id")
    return c.join(cells.select("user_id", "mov_id"), ["user_id", "mov_id"], "left_anti")


def recommend_user_cf(cells: DataFrame, neighbors: DataFrame, n: int = RECOMMEND_N) -> DataFrame:
    """Top-n unrated items per user by mean of neighbour-weighted imputed ratings."""
    means = _means(cells)
    neighbors = materialize(neighbors, "neighbours")
    nb = neighbors.select("user_id", "neighbor_id", "sim")
    base = (nb.join(means.select(F.col("user_id").alias("neighbor_id"), "mu"), "neighbor_id")
              .groupBy("user_id").agg((F.sum(F.col("sim") * F.col("mu")) / F.count("*")).alias("base"),
                                      F.count("*").alias("kn")))
    rated = cells.select("user_id", "mov_id")
    contrib = materialize(neighbour_contributions(cells, neighbors), "contributions")
    scored = (contrib.join(rated, ["user_id", "mov_id"], "left_anti").join(base, "user_id")
                     .select("user_id", "mov_id",
                             (F.col("base") + F.col("contrib") / F.col("kn")).alias("score")))
    # Fallback: items nobody in N(u) rated score base_u; take the smallest ids
    # outside u's excluded set (rated or neighbour-rated).
    # Only users with fewer than n scored items above the base need them.
    above = (scored.join(base.select("user_id", "base"), "user_id")
                   .where(rank_key(F.col("score")) > rank_key(F.col("base")))
                   .groupBy("user_id").agg(F.count("*").alias("above")))
    base = (base.join(above, "user_id", "left").where(F.coalesce("above", F.lit(0)) < n).drop("above"))
    excluded = (rated.unionByName(contrib.select("user_id", "mov_id")).distinct()
                     .join(base.select("user_id"), "user_id", "left_semi"))
    n_excl = excluded.groupBy("user_id").agg(F.count("*").alias("x"))
    items = dense_index(cells, "mov_id")
    n_items = items.agg(F.count("*")).scalar()
    reach = base.join(n_excl, "user_id", "left").select(
        "user_id", "base",
        F.least(F.lit(n) + F.coalesce(F.col("x"), F.lit(0)), n_items).alias("reach"))
    probe = reach.where(F.col("reach") > 0).select(
        "user_id", "base", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)).alias("idx"))
    fallback = (probe.join(items, "idx", "inner")
                     .join(excluded, ["user_id", "mov_id"], "left_anti")
                     .select("user_id", "mov_id", F.col("base").alias("score")))
    cand = scored.unionByName(fallback)
    w = Window.partitionBy("user_id").orderBy(F.desc(rank_key(F.col("score"))), F.asc("mov_id"))
    return (cand.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
                .select("user_id", "rank", "mov_id", F.round("score", OUT_PLACES).alias("score")))


def predict_user_cf(cells: DataFrame, neighbors: DataFrame, test: DataFrame) -> DataFrame:
    """For test rows, sum(imputed * sim) / sum(sim) over the user's neighbours.

    NULL when the user or the item is not in the training cells (the
    reference raises there).
    """
    means = _means(cells)
    pairs = test.select("user_id", "mov_id").distinct()
    nb = neighbors.select("user_id", "neighbor_id", "sim")
    cv = cells.select(F.col("user_id").alias("neighbor_id"), "mov_id", F.col("grade").alias("g"))
    mv = means.select(F.col("user_id").alias("neighbor_id"), "mu")
    j = (pairs.join(cells.select("mov_id").distinct(), "mov_id", "left_semi")
              .join(nb, "user_id", "inner")
              .join(cv, ["neighbor_id", "mov_id"], "left")
              .join(mv, "neighbor_id", "left"))
    num, den = F.sum(F.coalesce("g", "mu") * F.col("sim")), F.sum("sim")
    pred = j.groupBy("user_id", "mov_id").agg(F.when(den != 0, num / den).alias("prediction"))
    return test.select("user_id", "mov_id", "grade").join(pred, ["user_id", "mov_id"], "left")
