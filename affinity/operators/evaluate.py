"""Hold-out evaluation: predictions per method, RMSE, method comparison.

All methods share one split (``ranking.holdout_split``): train cells and
test rows.  A prediction that cannot be made (unknown user or item) is NULL;
RMSE is taken over the scored rows and the rest are counted, where the
reference would fail on NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import ranking
from affinity.session import materialize

BIAS_SWEEPS = 3      # fixed number of alternating sweeps
OUT_PLACES = 6


def predict_mean(cells: DataFrame, test: DataFrame) -> DataFrame:
    """Mean method: the item's mean over train cells."""
    m = ranking.item_mean_rating(cells).select("mov_id", F.col("mean").alias("prediction"))
    return test.select("user_id", "mov_id", "grade").join(m, "mov_id", "left")


def predict_weighted(cells: DataFrame, test: DataFrame, m: int = ranking.DAMPING_M) -> DataFrame:
    """Weighted method: the item's damped mean."""
    s = ranking.weighted_scores(cells, m).select("mov_id", F.col("score").alias("prediction"))
    return test.select("user_id", "mov_id", "grade").join(s, "mov_id", "left")


def fit_bias(cells: DataFrame, sweeps: int = BIAS_SWEEPS) -> tuple[F.Column, DataFrame, DataFrame]:
    """Least-squares additive model grade ~ c + b_user + b_item.

    The reference's network (concatenated embeddings -> Dense -> Dense, no
    activation) is linear, i.e. exactly this model.  Fitted by alternating
    grouped means of residuals; each sweep's bias tables are materialised so
    the plan does not grow with the number of sweeps.
    """
    cells = materialize(cells, "bias-cells")
    c = cells.agg(F.avg("grade")).scalar()
    bu = cells.select("user_id").distinct().withColumn("bu", F.lit(0.0))
    bi = None
    for _ in range(sweeps):
        r = cells.join(bu, "user_id", "left")
        bi = materialize(r.groupBy("mov_id").agg(
            F.avg(F.col("grade") - c - F.coalesce("bu", F.lit(0.0))).alias("bi")), "bias-item")
        r = cells.join(bi, "mov_id", "left")
        bu = materialize(r.groupBy("user_id").agg(
            F.avg(F.col("grade") - c - F.coalesce("bi", F.lit(0.0))).alias("bu")), "bias-user")
    return c, bu, bi


def predict_bias(cells: DataFrame, test: DataFrame, sweeps: int = BIAS_SWEEPS) -> DataFrame:
    c, bu, bi = fit_bias(cells, sweeps)
    t = test.select("user_id", "mov_id", "grade").join(bu, "user_id", "left").join(bi, "mov_id", "left")
    return t.select("user_id", "mov_id", "grade",
                    (c + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0))).alias("prediction"))


def rmse(pred: DataFrame, method: str) -> DataFrame:
    """V2: one row (method, rmse, n_scored, n_missing)."""
    err = F.col("grade") - F.col("prediction")
    return pred.agg(
        F.sqrt(F.avg(F.when(F.col("prediction").isNotNull(), err * err))).alias("rmse"),
        F.count("prediction").alias("n_scored"),
        F.count_if(F.col("prediction").isNull()).alias("n_missing"),
    ).select(F.lit(method).alias("method"), F.round("rmse", OUT_PLACES).alias("rmse"),
             "n_scored", "n_missing")


def compare_methods(results: list[DataFrame]) -> DataFrame:
    """V3: one row per method."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
