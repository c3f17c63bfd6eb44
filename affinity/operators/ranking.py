"""Rating aggregation and ranking operators (long form; no pivot).

The reference builds a dense user x item matrix and ranks with ``argsort``.
Here ratings stay long-form ``(user_id, mov_id, grade)``: an absent row is an
unrated cell, so means and counts over "observed cells" are plain grouped
aggregates with map-side partial aggregation.

Ranking ties are broken by id ascending on a score rounded to 9 places so
that results are deterministic and reproducible by other engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import materialize

# Fixed values (reference defaults).
DAMPING_M = 10              # weighted mean: minimum votes
TOP_N = 10                  # notebook rankings
FRONT_N = 12                # front page list
SPLIT_MOD = 10              # hash split: test when (user*31 + item*17) mod 10 >= 8
SPLIT_USER_MUL = 31
SPLIT_ITEM_MUL = 17
SPLIT_TEST_FROM = 8
SCORE_PLACES = 9            # rounding used for ordering
OUT_PLACES = 6              # rounding used for reported values
DRAW_MUL, DRAW_ADD, DRAW_MOD = 1103515245, 12345, 2147483648   # portable pseudo-random order
DRAW_BUCKETS = 4096


def rank_key(score: Column) -> Column:
    return F.round(score, SCORE_PLACES)


# --------------------------------------------------------------------------
# Filtering and splitting
# --------------------------------------------------------------------------

def dense_core_ratings(ratings: DataFrame, min_item: int = 100, min_user: int = 10) -> DataFrame:
    """Keep ratings whose item has > min_item and whose user has > min_user rows.

    Both counts are taken on the unfiltered table (one pass, not iterated).
    The counts are partially aggregated map-side; the two key sets are
    applied as semi-joins, which the planner turns into broadcast or
    shuffle joins from their measured size.
    """
    items = ratings.groupBy("mov_id").count().where(F.col("count") > min_item).select("mov_id")
    users = ratings.groupBy("user_id").count().where(F.col("count") > min_user).select("user_id")
    return ratings.join(items, "mov_id", "left_semi").join(users, "user_id", "left_semi")


def is_test_pair(user: Column | str = "user_id", item: Column | str = "mov_id") -> Column:
    user = F.col(user) if isinstance(user, str) else user
    item = F.col(item) if isinstance(item, str) else item
    h = F.pmod(user * SPLIT_USER_MUL + item * SPLIT_ITEM_MUL, F.lit(SPLIT_MOD))
    return h >= SPLIT_TEST_FROM


def holdout_split(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deterministic hold-out: (train, test) by a hash of the (user, item) pair.

    Every row of one pair lands on the same side, so a test pair is never
    rated in train.  The split is a per-row expression: no shuffle.
    """
    t = is_test_pair()
    return ratings.where(~t), ratings.where(t)


def pair_draw(user: str = "user_id", item: str = "mov_id", seed: int = 17) -> Column:
    """A portable pseudo-random number in [0, 2^31) of a (user, item) pair."""
    mod = F.lit(DRAW_MOD)
    mixed = F.pmod(F.pmod(F.col(user), mod) * 7919 + F.pmod(F.col(item), mod) * 104729 + F.lit(seed), mod)
    return F.pmod(mixed * DRAW_MUL + DRAW_ADD, mod)


def holdout_exact(ratings: DataFrame, n: int, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Exactly the n (user, item) pairs first in a seeded draw order are test.

    ``n`` may be a share of all pairs, so no task sorts or gathers n rows: a
    histogram of the draws (``DRAW_BUCKETS`` rows at most) gives the bucket in
    which the n-th pair falls; lower buckets are test as a whole and only that
    one bucket is ranked.  Every row of a test pair is held out.  With fewer
    than n pairs all are test.
    """
    pairs = materialize(ratings.select("user_id", "mov_id").distinct().withColumn("draw", pair_draw(seed=seed))
                               .withColumn("bucket", F.floor(F.col("draw") / (DRAW_MOD // DRAW_BUCKETS))), "pair-draws")
    edge, left = None, n
    for r in sorted(pairs.groupBy("bucket").count().collect()):       # at most DRAW_BUCKETS rows
        if r["count"] > left:
            edge = r["bucket"]
            break
        left -= r["count"]
    whole = pairs.where(F.col("bucket") < (edge if edge is not None else DRAW_BUCKETS + 1))
    rest = pairs.where(F.col("bucket") == (edge if edge is not None else -1)).orderBy("draw", "user_id", "mov_id").limit(left)
    test_keys = whole.select("user_id", "mov_id").unionByName(rest.select("user_id", "mov_id"))
    test = ratings.join(test_keys, ["user_id", "mov_id"], "left_semi")
    train = ratings.join(test_keys, ["user_id", "mov_id"], "left_anti")
    return train, test


def holdout_labeled(ratings: DataFrame) -> DataFrame:
    """Rows tagged with ``part`` = 'train' / 'test' (the registered form)."""
    return ratings.withColumn("part", F.when(is_test_pair(), "test").otherwise("train"))


# --------------------------------------------------------------------------
# Cell and marginal aggregates
# --------------------------------------------------------------------------

def rating_cells(ratings: DataFrame) -> DataFrame:
    """One mean grade per (user, item): the pivot-table cell, long form."""
    return ratings.groupBy("user_id", "mov_id").agg(F.avg("grade").alias("grade"))


def item_mean_rating(cells: DataFrame) -> DataFrame:
    """Mean and count of cells per item."""
    return cells.groupBy("mov_id").agg(F.avg("grade").alias("mean"), F.count("*").alias("n"))


def item_sums(cells: DataFrame) -> DataFrame:
    """Sum and count of cells per item (mean = total / n)."""
    return cells.groupBy("mov_id").agg(F.sum("grade").alias("total"), F.count("*").alias("n"))


def user_mean_rating(cells: DataFrame) -> DataFrame:
    return cells.groupBy("user_id").agg(F.avg("grade").alias("mean"), F.count("*").alias("n"))


def prepared_cells(ratings: DataFrame, min_item: int, min_user: int,
                   holdout: bool = True) -> tuple[DataFrame, DataFrame]:
    """Filter -> split -> cells.  Returns (train cells, test rows)."""
    core = dense_core_ratings(ratings, min_item, min_user)
    if holdout:
        train, test = holdout_split(core)
    else:
        train, test = core, core.limit(0)
    return rating_cells(train), test


# --------------------------------------------------------------------------
# Rankings
# --------------------------------------------------------------------------

def _top(scored: DataFrame, score_col: str, n: int) -> DataFrame:
    """Global top-n by score (TakeOrderedAndProject), then 1-based rank.

    The window only sees the n survivors of the limit.
    """
    top = scored.orderBy(F.desc(rank_key(F.col(score_col))), F.asc("mov_id")).limit(n)
    w = Window.orderBy(F.desc(rank_key(F.col(score_col))), F.asc("mov_id"))
    return top.withColumn("rank", F.row_number().over(w).cast("long"))


def weighted_scores(cells: DataFrame, m: int = DAMPING_M) -> DataFrame:
    """Damped mean per item: v/(v+m)*R + m/(v+m)*C, C = mean over all cells."""
    # C comes from the per-item sums, so the scalar subquery reuses the
    # per-item aggregate's exchange instead of recomputing the cells.
    stats = item_sums(cells).withColumn("mean", F.col("total") / F.col("n"))
    c = stats.agg(F.sum("total") / F.sum("n")).scalar()
    v, r = F.col("n"), F.col("mean")
    score = v / (v + F.lit(m)) * r + F.lit(m) / (v + F.lit(m)) * c
    return stats.withColumn("score", score)


def with_titles(ranked: DataFrame, movies: DataFrame) -> DataFrame:
    t = movies.select("mov_id", "name")
    return ranked.join(t, "mov_id", "left")


def rank_weighted(ratings: DataFrame, movies: DataFrame, n: int = TOP_N, m: int = DAMPING_M,
                  min_item: int = 100, min_user: int = 10, holdout: bool = True) -> DataFrame:
    """R2: top-n items by damped mean rating with count and title."""
    cells, _ = prepared_cells(ratings, min_item, min_user, holdout)
    ranked = _top(weighted_scores(cells, m), "score", n)
    out = with_titles(ranked, movies)
    return out.select("rank", "mov_id", "name", F.round("score", OUT_PLACES).alias("score"), "n")


def rank_mean(ratings: DataFrame, movies: DataFrame, n: int = TOP_N,
              min_item: int = 100, min_user: int = 10, holdout: bool = True) -> DataFrame:
    """Top-n items by plain mean of cells, with count, title and bar label."""
    cells, _ = prepared_cells(ratings, min_item, min_user, holdout)
    ranked = _top(item_mean_rating(cells).withColumnRenamed("mean", "score"), "score", n)
    out = with_titles(ranked, movies)
    label = F.concat(F.coalesce(F.col("name"), F.lit("")), F.lit(": "),
                     F.col("n").cast("string"), F.lit(" Ratings"))
    return out.select("rank", "mov_id", "name", F.round("score", OUT_PLACES).alias("score"), "n",
                      label.alias("label"))


def front_list(ratings: DataFrame, movies: DataFrame, n: int = FRONT_N, m: int = DAMPING_M,
               min_item: int = 100, min_user: int = 10) -> DataFrame:
    """The anonymous front page: top-n weighted items with their movie rows."""
    ranked = rank_weighted(ratings, movies.select("mov_id", "name"), n, m, min_item, min_user)
    return fetch_ranked_items(ranked.select("rank", "mov_id", "score"), movies)


def fetch_ranked_items(ranked: DataFrame, movies: DataFrame) -> DataFrame:
    """Movie rows for a ranked id list, keeping the rank.

    The ranked side is bounded by its limit, so the planner broadcasts it
    and the catalogue is scanned once with no shuffle.
    """
    return movies.join(ranked, "mov_id", "inner")


# --------------------------------------------------------------------------
# Histograms, HAVING + ORDER, per-user top-k, unrated and imputation
# --------------------------------------------------------------------------

def grade_histogram(rate: DataFrame) -> DataFrame:
    """Counts of grade 1..5 for every item in one pass (grade 0 not counted)."""
    aggs = [F.count_if(F.col("grade") == k).alias(f"n{k}") for k in range(1, 6)]
    return rate.groupBy("mov_id").agg(*aggs)


def popular_top_mean(rate: DataFrame, movies: DataFrame, min_count: int = 20,
                     n: int = FRONT_N) -> DataFrame:
    """Items with more than min_count ratings, top-n by mean grade.

    IN (subquery with HAVING/ORDER/LIMIT) becomes aggregate -> filter ->
    top-n -> semi-join; the id list is bounded by n.
    """
    agg = (rate.groupBy("mov_id").agg(F.count("*").alias("n"), F.avg("grade").alias("mean"))
               .where(F.col("n") > min_count))
    top = agg.orderBy(F.desc(rank_key(F.col("mean"))), F.asc("mov_id")).limit(n).select("mov_id")
    return movies.join(top, "mov_id", "left_semi")


def user_top_rated(rate: DataFrame, k: int = 3) -> DataFrame:
    """Each user's k best-rated items (grade desc, id asc).

    ``row_number() <= k`` is planned as a partial WindowGroupLimit before the
    shuffle, so a heavy user sends at most k rows per map partition.
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("grade"), F.asc("mov_id"))
    return (rate.select("user_id", "mov_id", "grade")
                .withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k))


def impute_user_mean(pairs: DataFrame, cells: DataFrame, user_means: DataFrame | None = None) -> DataFrame:
    """P10: for the given (user, item) pairs, the cell grade or else the user's mean."""
    if user_means is None:
        user_means = user_mean_rating(cells)
    um = user_means.select("user_id", F.col("mean").alias("user_mean"))
    c = cells.select("user_id", "mov_id", F.col("grade").alias("cell_grade"))
    j = pairs.join(c, ["user_id", "mov_id"], "left").join(um, "user_id", "left")
    return j.withColumn("imputed", F.coalesce("cell_grade", "user_mean"))


def stage_counts(ratings: DataFrame, min_item: int, min_user: int) -> DataFrame:
    """Row counts of the modelling stages (step, stage, rows).

    One pass over the ratings: they are folded to (user, item) pairs with their
    row counts, and every stage is a conditional sum over the pairs."""
    pairs = ratings.groupBy("user_id", "mov_id").agg(F.count("*").alias("n"))
    items = (pairs.groupBy(F.col("mov_id").alias("_i")).agg(F.sum("n").alias("ni")))
    users = (pairs.groupBy(F.col("user_id").alias("_u")).agg(F.sum("n").alias("nu")))
    # Left joins: rows without a key count as rows, but belong to no item or user.
    j = (pairs.join(items, F.col("mov_id") == F.col("_i"), "left").join(users, F.col("user_id") == F.col("_u"), "left"))
    core = F.coalesce((F.col("ni") > min_item) & (F.col("nu") > min_user), F.lit(False))
    train = core & ~is_test_pair()
    total = lambda cond, what: F.coalesce(F.sum(F.when(cond, what)), F.lit(0)).cast("long")
    sums = j.agg(total(F.lit(True), F.col("n")).alias("a"), F.count("*").alias("b"), total(core, F.col("n")).alias("c"),
                 total(train, F.col("n")).alias("d"), total(train, F.lit(1)).alias("e"))
    return sums.select(F.expr("stack(5, 0L, 'rating_rows', a, 1L, 'rate', b, 2L, 'core', c, 3L, 'train', d, "
                              "4L, 'train_cells', e) as (step, stage, rows)"))
