"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Parameters are the reference defaults except the item threshold: the test
tables have at most ~50 ratings per item, so ``> 100`` would leave nothing;
``> 30`` keeps about half of the items.  Every query reads the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions import scalars
from affinity.operators import (audit, changes, collab, content, etl, evaluate, factor, ids, integrity,
                                lookup, name_index, ranking)
from affinity.sources import files, raw
from affinity.session import materialize
from affinity.sources import testdata as td

MIN_ITEM, MIN_USER = 30, 10
SEARCH_TEXT = "R"
INDEXED_TEXT = "ER#0%01"
HOLDOUT_PAIRS = 10_000                       # exact hold-out size
# Keys of the point lookups (page requests for these entities).
ITEM_KEYS, PERSON_KEYS = (3, 17, 58, 131, 10 ** 12), (1, 2, 5, 10 ** 12)
USER_KEYS = ("customer#000000003", "customer#000000011", "nobody")

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- ranking --

@register("rank_weighted")
def _rank_weighted(spark, d):
    return ranking.rank_weighted(td.ratings(spark, d), td.movies(spark, d), n=10,
                                 min_item=MIN_ITEM, min_user=MIN_USER)


@register("rank_mean")
def _rank_mean(spark, d):
    return ranking.rank_mean(td.ratings(spark, d), td.movies(spark, d), n=10,
                             min_item=MIN_ITEM, min_user=MIN_USER)


@register("front_list")
def _front_list(spark, d):
    return ranking.front_list(td.ratings(spark, d), td.movies(spark, d), n=12,
                              min_item=MIN_ITEM, min_user=MIN_USER)


@register("rating_scan")
def _rating_scan(spark, d):
    # Whole rating table, column subset -> pruned Parquet scan
    return td.rating_rows(spark, d).select("mov_id", "user_id", "grade")


@register("fetch_ranked_items")
def _fetch_ranked(spark, d):
    ranked = ranking.rank_mean(td.ratings(spark, d), td.movies(spark, d), n=10,
                               min_item=MIN_ITEM, min_user=MIN_USER)
    return ranking.fetch_ranked_items(ranked.select("rank", "mov_id", "score"), td.movies(spark, d))


@register("dense_core_ratings")
def _dense_core(spark, d):
    return ranking.dense_core_ratings(td.ratings(spark, d), MIN_ITEM, MIN_USER)


@register("holdout_split")
def _holdout(spark, d):
    return ranking.holdout_labeled(ranking.dense_core_ratings(td.ratings(spark, d), MIN_ITEM, MIN_USER))


@register("rating_cells")
def _cells(spark, d):
    return ranking.rating_cells(td.ratings(spark, d))


@register("item_mean_rating")
def _item_mean(spark, d):
    m = ranking.item_mean_rating(ranking.rating_cells(td.ratings(spark, d)))
    return m.select("mov_id", F.round("mean", 6).alias("mean"), "n")


@register("user_mean_rating")
def _user_mean(spark, d):
    m = ranking.user_mean_rating(ranking.rating_cells(td.ratings(spark, d)))
    return m.select("user_id", F.round("mean", 6).alias("mean"), "n")


@register("grade_histogram")
def _histogram(spark, d):
    return ranking.grade_histogram(td.rate_table(spark, d))


@register("popular_top_mean")
def _popular(spark, d):
    return ranking.popular_top_mean(td.rate_table(spark, d), td.movies(spark, d), 20, 12)


@register("user_top_rated")
def _user_top(spark, d):
    return ranking.user_top_rated(td.rate_table(spark, d), 3)


@register("first_by_key")
def _first_by_key(spark, d):
    r = td.rating_rows(spark, d)
    order = ["l_orderkey", "l_linenumber", "mov_id", "l_suppkey", "l_quantity"]
    return etl.first_by_key(r, ["mov_id", "user_id"], order)


@register("stage_counts")
def _stage_counts(spark, d):
    return ranking.stage_counts(td.ratings(spark, d), MIN_ITEM, MIN_USER)


@register("holdout_exact")
def _holdout_exact(spark, d):
    train, test = ranking.holdout_exact(td.ratings(spark, d), HOLDOUT_PAIRS)
    return (train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
                 .select("user_id", "mov_id", "grade", "part"))


# ----------------------------------------------------------------- lookup --

@register("item_by_id")
def _item_by_id(spark, d):
    return lookup.item_by_id(td.movies(spark, d))


@register("item_genres")
def _item_genres(spark, d):
    return lookup.item_genres(td.movies(spark, d), td.belong_to(spark, d), td.genres(spark, d))


@register("item_cast")
def _item_cast(spark, d):
    return lookup.item_cast(td.movies(spark, d), td.act(spark, d), td.cast_members(spark, d))


@register("item_directors")
def _item_directors(spark, d):
    return lookup.item_directors(td.movies(spark, d), td.direct(spark, d), td.directors(spark, d))


@register("item_reviews")
def _item_reviews(spark, d):
    return lookup.item_reviews(td.rate_table(spark, d), td.users(spark, d))


@register("user_item_rating")
def _user_item_rating(spark, d):
    return lookup.user_item_rating(td.movies(spark, d), td.rate_table(spark, d), td.users(spark, d))


@register("item_ratings_named")
def _item_ratings_named(spark, d):
    return lookup.item_ratings_named(td.movies(spark, d), td.rate_table(spark, d), td.users(spark, d))


@register("person_items")
def _person_items(spark, d):
    return lookup.person_items(td.movies(spark, d), td.act(spark, d), td.cast_members(spark, d))


@register("director_items")
def _director_items(spark, d):
    return lookup.director_items(td.movies(spark, d), td.direct(spark, d))


def _profiles(spark, d):
    return etl.user_favorite_genre(td.users(spark, d), td.rate_table(spark, d), td.belong_to(spark, d))


@register("user_genre_name")
def _user_genre_name(spark, d):
    return lookup.user_genre_name(_profiles(spark, d), td.genres(spark, d))


@register("user_history")
def _user_history(spark, d):
    return lookup.user_history(td.rate_table(spark, d), td.movies(spark, d))


@register("items_in_genre")
def _items_in_genre(spark, d):
    return lookup.items_in_genre(td.movies(spark, d), td.belong_to(spark, d), td.genres(spark, d))


@register("item_wide")
def _item_wide(spark, d):
    return lookup.item_wide(td.movies(spark, d), td.belong_to(spark, d), td.genres(spark, d),
                            td.act(spark, d), td.cast_members(spark, d))


@register("item_facets")
def _item_facets(spark, d):
    return lookup.item_facets(td.direct(spark, d), td.directors(spark, d), td.belong_to(spark, d),
                              td.genres(spark, d), td.act(spark, d), td.cast_members(spark, d))


@register("person_by_id")
def _person_by_id(spark, d):
    return lookup.person_by_id(td.cast_members(spark, d), td.directors(spark, d))


@register("user_by_name")
def _user_by_name(spark, d):
    return lookup.user_by_name(td.users(spark, d))


@register("search_names")
def _search_names(spark, d):
    return lookup.search_names(td.movies(spark, d), td.cast_members(spark, d), td.directors(spark, d),
                               SEARCH_TEXT)


def _search_index(spark, d, text):
    path = files.scratch_path(spark, "name-index")
    names = [(td.movies(spark, d), "movie", "mov_id"), (td.cast_members(spark, d), "cast", "cast_id"),
             (td.directors(spark, d), "director", "director_id")]
    parts = [df.select(F.lit(e).alias("entity"), F.col(k).cast("long").alias("id"), "name") for df, e, k in names]
    name_index.build_index(parts[0].unionByName(parts[1]).unionByName(parts[2]), path)
    return name_index.search(spark, path, text)


@register("search_names_indexed")
def _search_names_indexed(spark, d):
    # Trigrams of both fixed stretches, a wildcard between them.
    return _search_index(spark, d, INDEXED_TEXT)


@register("link_by_item")
def _link_by_item(spark, d):
    rm = raw.raw_movies(spark, d)
    return lookup.link_by_item(etl.etl_link(rm, etl.etl_item(rm)), ITEM_KEYS)


# Point lookups: the same lookups for a few keys, pushed into the scans.

@register("lookup_item")
def _lookup_item(spark, d):
    return lookup.item_by_id(td.movies(spark, d), ITEM_KEYS)


@register("lookup_item_genres")
def _lookup_item_genres(spark, d):
    return lookup.item_genres(td.movies(spark, d), td.belong_to(spark, d), td.genres(spark, d), ITEM_KEYS)


@register("lookup_item_cast")
def _lookup_item_cast(spark, d):
    return lookup.item_cast(td.movies(spark, d), td.act(spark, d), td.cast_members(spark, d), ITEM_KEYS)


@register("lookup_item_reviews")
def _lookup_item_reviews(spark, d):
    return lookup.item_reviews(td.rate_table(spark, d), td.users(spark, d), ITEM_KEYS)


@register("lookup_person")
def _lookup_person(spark, d):
    return lookup.person_by_id(td.cast_members(spark, d), td.directors(spark, d), PERSON_KEYS)


@register("lookup_user")
def _lookup_user(spark, d):
    return lookup.user_by_name(td.users(spark, d), USER_KEYS)


# -------------------------------------------------------------------- etl --

@register("etl_item")
def _etl_item(spark, d):
    return etl.etl_item(raw.raw_movies(spark, d))


@register("reject_malformed")
def _reject(spark, d):
    return etl.reject_malformed(raw.raw_movies(spark, d))


@register("etl_rating")
def _etl_rating(spark, d):
    return etl.etl_rating(raw.raw_ratings(spark, d), etl.etl_item(raw.raw_movies(spark, d)))


@register("etl_genre")
def _etl_genre(spark, d):
    return etl.etl_genre(raw.raw_movies(spark, d))


@register("etl_item_genre")
def _etl_item_genre(spark, d):
    rm = raw.raw_movies(spark, d)
    return etl.etl_item_genre(rm, etl.etl_item(rm))


@register("etl_director")
def _etl_director(spark, d):
    return etl.etl_director(raw.raw_credits(spark, d))


@register("etl_cast")
def _etl_cast(spark, d):
    return etl.etl_cast(raw.raw_credits(spark, d))


@register("etl_item_director")
def _etl_item_director(spark, d):
    return etl.etl_item_director(raw.raw_credits(spark, d), etl.etl_item(raw.raw_movies(spark, d)))


@register("etl_item_cast")
def _etl_item_cast(spark, d):
    return etl.etl_item_cast(raw.raw_credits(spark, d), etl.etl_item(raw.raw_movies(spark, d)))


@register("user_favorite_genre")
def _user_fav(spark, d):
    return _profiles(spark, d)


@register("etl_link")
def _etl_link(spark, d):
    rm = raw.raw_movies(spark, d)
    return etl.etl_link(rm, etl.etl_item(rm))


@register("etl_website")
def _etl_website(spark, d):
    return etl.etl_website(raw.raw_movies(spark, d))


@register("etl_load_all")
def _etl_load_all(spark, d):
    return etl.load_all(raw.raw_movies(spark, d), raw.raw_credits(spark, d), raw.raw_ratings(spark, d),
                        td.users(spark, d), files.scratch_path(spark, "catalog"))


@register("parse_nested")
def _parse_nested(spark, d):
    c = scalars.with_nested(raw.raw_literals(spark, d), "cast", scalars.CAST_LIST)
    p = c.select(F.col("id").cast("long").alias("mov_id"), F.explode("cast").alias("m"))
    return p.select("mov_id", F.col("m.id").alias("cast_id"), F.col("m.name").alias("name"),
                    F.col("m.gender").alias("gender"), F.col("m.character").alias("role"))


@register("reject_literals")
def _reject_literals(spark, d):
    return etl.reject_literals(raw.raw_literals(spark, d), "cast", scalars.CAST_LIST).unionByName(
        etl.reject_literals(raw.raw_movies(spark, d), "genres", scalars.GENRE_LIST))


@register("csv_scan")
def _csv_scan(spark, d):
    path = files.write_csv(raw.raw_movies(spark, d).drop("pos"), files.scratch_path(spark, "raw_movies_csv"))
    return files.read_csv_parallel(spark, path, columns=["title", "id", "runtime", "genres", "imdb_id"])


@register("load_table")
def _load_table(spark, d):
    return files.load_table(td.rate_table(spark, d), files.scratch_path(spark, "rate"), "rate")


# ---------------------------------------------------------------- content --

@register("tfidf_weights")
def _tfidf(spark, d):
    w = content.tfidf_weights(td.overviews(spark, d))
    return w.select("mov_id", "term", F.round("weight", 6).alias("weight"))


def _similar(spark, d):
    return content.similar_items(td.overviews(spark, d), 10)


@register("similar_items")
def _similar_items(spark, d):
    return _similar(spark, d).select("mov_id", "rank", "similar_id", F.round("sim", 6).alias("sim"))


@register("recommend_content")
def _recommend_content(spark, d):
    return content.recommend_content_from_docs(td.rate_table(spark, d), td.overviews(spark, d), 10)


@register("similar_items_facets")
def _similar_facets(spark, d):
    s = content.similar_items_facets(td.direct(spark, d), td.directors(spark, d), td.act(spark, d),
                                     td.cast_members(spark, d), td.belong_to(spark, d),
                                     td.genres(spark, d), 10)
    return s.select("mov_id", "rank", "similar_id", F.round("sim", 6).alias("sim"))


# ----------------------------------------------------------------- collab --

def _train(spark, d):
    """Train cells, written once and shared by every branch."""
    return materialize(ranking.prepared_cells(td.ratings(spark, d), MIN_ITEM, MIN_USER)[0], "train-cells")


def _train_test(spark, d):
    """Train cells and test rows; the filtered ratings behind both are written once."""
    core = materialize(ranking.dense_core_ratings(td.ratings(spark, d), MIN_ITEM, MIN_USER), "core")
    train, test = ranking.holdout_split(core)
    return materialize(ranking.rating_cells(train), "train-cells"), test


@register("user_neighbors")
def _user_neighbors(spark, d):
    cells = _train(spark, d)
    nb = collab.user_neighbors(cells, 5)
    return nb.select("user_id", "rank", "neighbor_id", F.round("sim", 6).alias("sim"))


@register("recommend_user_cf")
def _recommend_user_cf(spark, d):
    cells = _train(spark, d)
    return collab.recommend_user_cf(cells, collab.user_neighbors(cells, 5), 10)


@register("predict_user_cf")
def _predict_user_cf(spark, d):
    cells, test = _train_test(spark, d)
    p = collab.predict_user_cf(cells, collab.user_neighbors(cells, 5), test)
    return p.select("user_id", "mov_id", "grade", F.round("prediction", 6).alias("prediction"))


@register("unrated_items")
def _unrated(spark, d):
    cells = _train(spark, d)
    return collab.unrated_items(cells, collab.user_neighbors(cells, 5))


@register("impute_user_mean")
def _impute(spark, d):
    cells, test = _train_test(spark, d)
    pairs = test.select("user_id", "mov_id").distinct()
    out = ranking.impute_user_mean(pairs, cells)
    return out.select("user_id", "mov_id", F.round("imputed", 6).alias("imputed"))


@register("impute_rated")
def _impute_rated(spark, d):
    # Rated pairs keep their grade, all others of the same users get the mean.
    cells, test = _train_test(spark, d)
    pairs = test.select("user_id", "mov_id").unionByName(cells.select("user_id", "mov_id")).distinct()
    out = ranking.impute_user_mean(pairs, cells)
    return out.select("user_id", "mov_id", F.round("imputed", 6).alias("imputed"))


@register("dense_ids")
def _dense_ids(spark, d):
    return ids.dense_ids(td.ratings(spark, d))


# --------------------------------------------------------------- evaluate --

@register("predict_bias")
def _predict_bias(spark, d):
    cells, test = _train_test(spark, d)
    p = evaluate.predict_bias(cells, test)
    return p.select("user_id", "mov_id", "grade", F.round("prediction", 6).alias("prediction"))


def _rmse_all(cells, test):
    return {
        "mean": lambda: evaluate.rmse(evaluate.predict_mean(cells, test), "mean"),
        "weighted": lambda: evaluate.rmse(evaluate.predict_weighted(cells, test), "weighted"),
        "user_cf": lambda: evaluate.rmse(
            collab.predict_user_cf(cells, collab.user_neighbors(cells, 5), test), "user_cf"),
        "bias": lambda: evaluate.rmse(evaluate.predict_bias(cells, test), "bias"),
    }


def _rmse_query(method):
    def q(spark, d):
        return _rmse_all(*_train_test(spark, d))[method]()
    return q


for _m in ("mean", "weighted", "user_cf", "bias"):
    register(f"rmse_{_m}")(_rmse_query(_m))


@register("compare_methods")
def _compare(spark, d):
    fns = _rmse_all(*_train_test(spark, d))
    return evaluate.compare_methods([fns[m]() for m in ("mean", "weighted", "user_cf", "bias")])


@register("compare_models")
def _compare_models(spark, d):
    # All six methods on the same split, with scored and missing counts.
    cells, test = _train_test(spark, d)
    fns = _rmse_all(cells, test)
    return evaluate.compare_methods(
        [fns[m]() for m in ("mean", "weighted", "user_cf", "bias")]
        + [evaluate.rmse(factor.predict_mf(cells, test), "mf"),
           evaluate.rmse(factor.predict_als(factor.fit_als(cells), test), "als")])


# ---------------------------------------------------------------- changes --

@register("apply_rating_changes")
def _apply_changes(spark, d):
    return changes.apply_rating_changes(td.rate_table(spark, d), td.change_log(spark, d))


@register("merge_rating_changes")
def _merge_changes(spark, d):
    # The change log folded into a written snapshot, partition by partition.
    path = files.scratch_path(spark, "rate-snapshot")
    changes.write_snapshot(td.rate_table(spark, d), path)
    changes.merge_rating_changes(spark, path, td.change_log(spark, d))
    return changes.read_snapshot(spark, path)


@register("append_new_items")
def _append_items(spark, d):
    # The incoming batch renames every movie: rows that exist keep their name.
    m = td.movies(spark, d)
    incoming = m.withColumn("name", F.concat(F.lit("New "), F.col("name")))
    return changes.append_new_items(m.where(F.col("runtime") <= 40), incoming)


def _signups(spark, d):
    e = td.table(spark, d, "events").where(F.col("event_type") == "signup")
    # Even events ask for a name that a customer already has, odd ones for a new one.
    taken = F.format_string("customer#%09d", F.col("user_id"))
    name = F.when(F.col("event_id") % 2 == 0, taken).otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string")))
    return e.select(name.alias("username"),
                    F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
                    F.col("event_id").alias("seq"))


@register("append_new_users")
def _append_users(spark, d):
    return changes.append_new_users(td.users(spark, d), _signups(spark, d))


@register("onboarding_sample")
def _onboarding(spark, d):
    return changes.onboarding_sample(td.movies(spark, d), 8)


@register("onboarding_fold")
def _onboarding_fold(spark, d):
    return changes.onboard_user(td.rate_table(spark, d), td.users(spark, d), td.movies(spark, d), 8)


# -------------------------------------------------------------- integrity --

def _links(spark, d):
    """Loaded website and link tables."""
    rm = raw.raw_movies(spark, d)
    return etl.etl_website(rm), etl.etl_link(rm, etl.etl_item(rm))


def _feed_links(spark, d):
    """One link row per order line: repeated keys and unknown ids occur."""
    li = td.table(spark, d, "lineitem")
    return li.select((F.col("l_partkey") + F.col("l_linenumber") - 1).alias("mov_id"),
                     F.concat(F.lit("tt"), F.lpad(F.col("l_partkey").cast("string"), 7, "0")).alias("web_id"))


@register("pk_violations")
def _pk(spark, d):
    u = td.users(spark, d)
    website, link = _links(spark, d)
    return integrity.pk_violations({
        "rating_rows": (td.ratings(spark, d), ["mov_id", "user_id"]),
        "rate": (td.rate_table(spark, d), ["mov_id", "user_id"]),
        "movie": (td.movies(spark, d), ["mov_id"]),
        "genre": (td.genres(spark, d), ["genre_id"]),
        "director": (td.directors(spark, d), ["director_id"]),
        "mov_cast": (td.cast_members(spark, d), ["cast_id"]),
        "user_most_like": (u, ["user_id"]),
        "user_most_like.username": (u, ["username"]),
        "belong_to": (td.belong_to(spark, d), ["mov_id", "genre_id"]),
        "direct": (td.direct(spark, d), ["mov_id", "director_id"]),
        "act": (td.act(spark, d), ["mov_id", "cast_id"]),
        "website": (website, ["web_id"]),
        "link": (link, ["mov_id"]),
        "feed_link": (_feed_links(spark, d), ["mov_id", "web_id"]),
    })


@register("fk_violations")
def _fk(spark, d):
    m, u = td.movies(spark, d), td.users(spark, d)
    r, log = td.rate_table(spark, d), td.change_log(spark, d)
    website, link = _links(spark, d)
    feed = _feed_links(spark, d)
    belong, direct, act = td.belong_to(spark, d), td.direct(spark, d), td.act(spark, d)
    return integrity.fk_violations([
        ("rate", r, "mov_id", m, "mov_id"), ("rate", r, "user_id", u, "user_id"),
        ("belong_to", belong, "mov_id", m, "mov_id"),
        ("belong_to", belong, "genre_id", td.genres(spark, d), "genre_id"),
        ("direct", direct, "mov_id", m, "mov_id"),
        ("direct", direct, "director_id", td.directors(spark, d), "director_id"),
        ("act", act, "mov_id", m, "mov_id"),
        ("act", act, "cast_id", td.cast_members(spark, d), "cast_id"),
        ("rating_changes", log, "mov_id", m, "mov_id"), ("rating_changes", log, "user_id", u, "user_id"),
        ("link", link, "mov_id", m, "mov_id"), ("link", link, "web_id", website, "web_id"),
        ("feed_link", feed, "mov_id", m, "mov_id"), ("feed_link", feed, "web_id", website, "web_id"),
        ("user_most_like", _profiles(spark, d), "genre_id", td.genres(spark, d), "genre_id"),
        # Parents removed from the catalogue: short movies gone, their rows left behind.
        ("rate_after_removal", r, "mov_id", m.where(F.col("runtime") > 5), "mov_id"),
    ])


@register("check_violations")
def _check(spark, d):
    return integrity.check_violations([
        ("rate", "grade_range", td.rate_table(spark, d), ["mov_id", "user_id"], integrity.grade_in_range()),
        ("rating_rows", "rating_range", td.rating_rows(spark, d), ["l_orderkey", "l_linenumber"],
         integrity.grade_in_range("rating")),
        ("rating_changes", "grade_range", td.change_log(spark, d), ["seq"], integrity.grade_in_range()),
        # A feed on a scale of nine instead of ten overshoots.
        ("rating_feed", "rating_range", td.rating_rows(spark, d).withColumn("rating", F.col("l_quantity") / 9.0),
         ["l_orderkey", "l_linenumber"], integrity.grade_in_range("rating")),
        ("director", "gender_range", td.directors(spark, d), ["director_id"], integrity.gender_in_range()),
        ("user_most_like", "birthday_range", _profiles(spark, d), ["user_id"], integrity.birthday_in_range()),
    ])


@register("domain_violations")
def _domain(spark, d):
    u = td.users(spark, d)
    website, link = _links(spark, d)
    return integrity.domain_violations([
        ("movie", td.movies(spark, d), ["mov_id"], "name", False),
        ("genre", td.genres(spark, d), ["genre_id"], "name", False),
        ("director", td.directors(spark, d), ["director_id"], "name", False),
        ("mov_cast", td.cast_members(spark, d), ["cast_id"], "name", False),
        ("user_most_like", u, ["user_id"], "name", False),
        ("user_most_like", u, ["user_id"], "username", True),
        ("website", website, ["web_id"], "web_id", True),
        ("link", link, ["mov_id"], "web_id", True),
        # Free text loaded into a name column, and a column that must not be empty.
        ("movie_from_text", td.overviews(spark, d).withColumnRenamed("overview", "name"), ["mov_id"], "name", False),
        ("rate", td.rate_table(spark, d), ["mov_id", "user_id"], "review", True),
    ])


@register("audit_violations")
def _audit(spark, d):
    # The tables and rules of the four queries above, every table read once.
    rows, m, u = td.rating_rows(spark, d), td.movies(spark, d), td.users(spark, d)
    website, link = _links(spark, d)
    R, grade = audit.Rules, integrity.grade_in_range
    pair = ("mov_id", "user_id")
    feed_rows = ("l_orderkey", "l_linenumber")
    tables = {
        "rating_rows": rows, "rate": td.rate_table(spark, d), "movie": m, "genre": td.genres(spark, d),
        "director": td.directors(spark, d), "mov_cast": td.cast_members(spark, d), "users": u,
        "user_most_like": _profiles(spark, d), "belong_to": td.belong_to(spark, d), "direct": td.direct(spark, d),
        "act": td.act(spark, d), "website": website, "link": link, "feed_link": _feed_links(spark, d),
        "rating_changes": td.change_log(spark, d), "rating_feed": rows.withColumn("rating", F.col("l_quantity") / 9.0),
        "movie_kept": m.where(F.col("runtime") > 5),
        "movie_from_text": td.overviews(spark, d).withColumnRenamed("overview", "name"),
    }
    rules = {
        "rating_rows": R(feed_rows, checks={"rating_range": lambda: grade("rating")}),
        "rate": R(pair, {"key": pair}, (("mov_id", "movie", "mov_id"), ("user_id", "users", "user_id"),
                                        ("mov_id", "movie_kept", "mov_id")),
                  {"grade_range": grade}, not_null=("review",)),
        "movie": R(("mov_id",), {"key": ("mov_id",)}, texts=("name",)),
        "genre": R(("genre_id",), {"key": ("genre_id",)}, texts=("name",)),
        "director": R(("director_id",), {"key": ("director_id",)}, texts=("name",),
                      checks={"gender_range": integrity.gender_in_range}),
        "mov_cast": R(("cast_id",), {"key": ("cast_id",)}, texts=("name",)),
        "users": R(("user_id",), {"key": ("user_id",), "username": ("username",)}, texts=("name", "username"),
                   not_null=("username",)),
        "user_most_like": R(("user_id",), refs=(("genre_id", "genre", "genre_id"),),
                            checks={"birthday_range": integrity.birthday_in_range}),
        "belong_to": R(("mov_id", "genre_id"), {"key": ("mov_id", "genre_id")},
                       (("mov_id", "movie", "mov_id"), ("genre_id", "genre", "genre_id"))),
        "direct": R(("mov_id", "director_id"), {"key": ("mov_id", "director_id")},
                    (("mov_id", "movie", "mov_id"), ("director_id", "director", "director_id"))),
        "act": R(("mov_id", "cast_id"), {"key": ("mov_id", "cast_id")},
                 (("mov_id", "movie", "mov_id"), ("cast_id", "mov_cast", "cast_id"))),
        "website": R(("web_id",), {"key": ("web_id",)}, texts=("web_id",), not_null=("web_id",)),
        "link": R(("mov_id",), {"key": ("mov_id",)}, (("mov_id", "movie", "mov_id"), ("web_id", "website", "web_id")),
                  texts=("web_id",), not_null=("web_id",)),
        "feed_link": R(("mov_id", "web_id"), {"key": ("mov_id", "web_id")},
                       (("mov_id", "movie", "mov_id"), ("web_id", "website", "web_id"))),
        "rating_changes": R(("seq",), refs=(("mov_id", "movie", "mov_id"), ("user_id", "users", "user_id")),
                            checks={"grade_range": grade}),
        "rating_feed": R(feed_rows, checks={"rating_range": lambda: grade("rating")}),
        "movie_from_text": R(("mov_id",), texts=("name",)),
    }
    return audit.audit(spark, tables, rules)


@register("etl_load_checked")
def _etl_load_checked(spark, d):
    # Published only if no declared rule is broken; the dirty raw rows are rejects by then.
    return etl.load_all(raw.raw_movies(spark, d), raw.raw_credits(spark, d), raw.raw_ratings(spark, d),
                        td.users(spark, d), files.scratch_path(spark, "catalog"), checked=True)


# ----------------------------------------------------------------- factor --

@register("als_fit_rmse")
def _als_rmse(spark, d):
    cells, test = _train_test(spark, d)
    return factor.als_fit_rmse(cells, test)


_MODELS: dict[str, files.Catalog] = {}       # one model catalogue an application


def _als_recs(spark, d, n):
    app = spark.sparkContext.applicationId
    if app not in _MODELS:
        _MODELS[app] = files.Catalog(spark, files.scratch_path(spark, "models"))
    version = factor.input_version(td.ratings(spark, d))
    return factor.recommend_als(factor.stored_als(_MODELS[app], lambda: _train(spark, d), version), n)


@register("recommend_als")
def _recommend_als(spark, d):
    return _als_recs(spark, d, 10)


@register("predict_mf")
def _predict_mf(spark, d):
    cells, test = _train_test(spark, d)
    return factor.predict_mf(cells, test)


@register("factor_top")
def _factor_top(spark, d):
    # The factor scoring kernel on given vectors: ten best for every vector.
    e = td.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    t = factor.top_dot_products(e, e, 10)
    return t.select("user_id", "rank", "mov_id", F.round("score", 6).alias("score"))


def _weighted(spark, d):
    return ranking.rank_weighted(td.ratings(spark, d), td.movies(spark, d), n=5, min_item=MIN_ITEM, min_user=MIN_USER)


def _content(spark, d):
    return content.recommend_content_from_docs(td.rate_table(spark, d), td.overviews(spark, d), 5)


@register("recommend_lists")
def _recommend_lists(spark, d):
    # The side-by-side lists without ALS: every user gets the weighted list as well.
    none = spark.createDataFrame([], "user_id long, rank long, mov_id long, score double")
    return factor.recommend_all(none, _content(spark, d), _weighted(spark, d), 5, users=td.users(spark, d))


@register("recommend_all")
def _recommend_all(spark, d):
    return factor.recommend_all(_als_recs(spark, d, 5), _content(spark, d), _weighted(spark, d), 5,
                                users=td.users(spark, d))
