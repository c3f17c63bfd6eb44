"""Catalogue lookups, searches and their joins as bulk tables.

The web app of the reference issues one point query per page element.  Here
every lookup is a bulk DataFrame over all keys, with an optional key filter
(``ids``) that Catalyst pushes into the Parquet scan and infers across the
join for the other side.  Joins are equi-joins; the planner picks broadcast
or sort-merge from measured sizes (AQE), so no side is broadcast blindly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEARCH_LIMIT = 10     # fixed value: rows per entity in a name search
GENRE_PAGE = 12       # fixed value: movies shown per genre page


def _keyed(df: DataFrame, col: str, ids: Iterable | None) -> DataFrame:
    if ids is None:
        return df
    return df.where(F.col(col).isin(list(ids)))


def item_by_id(movies: DataFrame, ids: Iterable | None = None) -> DataFrame:
    """Movie rows by key."""
    return _keyed(movies, "mov_id", ids)


def item_genres(movies: DataFrame, belong_to: DataFrame, genres: DataFrame,
                ids: Iterable | None = None) -> DataFrame:
    """Genres of movies (movie semi-join keeps the existence check)."""
    bt = _keyed(belong_to, "mov_id", ids)
    g = genres.select("genre_id", F.col("name").alias("genre"))
    return (bt.join(movies.select("mov_id"), "mov_id", "left_semi")
              .join(g, "genre_id", "inner").select("mov_id", "genre_id", "genre"))


def item_cast(movies: DataFrame, act: DataFrame, cast: DataFrame,
              ids: Iterable | None = None) -> DataFrame:
    """Cast of movies with role."""
    a = _keyed(act, "mov_id", ids).join(movies.select("mov_id"), "mov_id", "left_semi")
    c = cast.select("cast_id", F.col("name").alias("cast_name"))
    return a.join(c, "cast_id", "inner").select("mov_id", "cast_id", "cast_name", "role")


def item_directors(movies: DataFrame, direct: DataFrame, directors: DataFrame,
                   ids: Iterable | None = None) -> DataFrame:
    """Directors of movies."""
    d = _keyed(direct, "mov_id", ids).join(movies.select("mov_id"), "mov_id", "left_semi")
    dd = directors.select("director_id", F.col("name").alias("director"))
    return d.join(dd, "director_id", "inner").select("mov_id", "director_id", "director")


def item_reviews(rate: DataFrame, users: DataFrame, ids: Iterable | None = None) -> DataFrame:
    """Non-null reviews with the reviewer's name."""
    r = _keyed(rate, "mov_id", ids).where(F.col("review").isNotNull())
    u = users.select("user_id", F.col("name").alias("reviewer"))
    return r.join(u, "user_id", "inner").select("mov_id", "user_id", "reviewer", "grade", "review")


def user_item_rating(movies: DataFrame, rate: DataFrame, users: DataFrame,
                     user_ids: Iterable | None = None, mov_ids: Iterable | None = None) -> DataFrame:
    """A user's own rating of a movie (both keys optional filters)."""
    r = _keyed(_keyed(rate, "user_id", user_ids), "mov_id", mov_ids)
    m = movies.select("mov_id", F.col("name").alias("title"))
    return (r.join(users.select("user_id"), "user_id", "left_semi")
             .join(m, "mov_id", "inner")
             .select("user_id", "mov_id", "title", "grade", "review"))


def item_ratings_named(movies: DataFrame, rate: DataFrame, users: DataFrame,
                       ids: Iterable | None = None) -> DataFrame:
    """Movie name + grade + review of every rater, with the rater's name."""
    r = _keyed(rate, "mov_id", ids)
    m = movies.select("mov_id", F.col("name").alias("title"))
    u = users.select("user_id", F.col("name").alias("rater"))
    return r.join(m, "mov_id", "inner").join(u, "user_id", "inner").select(
        "mov_id", "title", "user_id", "rater", "grade", "review")


def person_items(movies: DataFrame, act: DataFrame, cast: DataFrame,
                 cast_ids: Iterable | None = None) -> DataFrame:
    """Actor filmography with role."""
    a = _keyed(act, "cast_id", cast_ids)
    m = movies.select("mov_id", F.col("name").alias("title"))
    c = cast.select("cast_id", F.col("name").alias("cast_name"))
    return a.join(c, "cast_id", "inner").join(m, "mov_id", "inner").select(
        "cast_id", "cast_name", "mov_id", "title", "role")


def director_items(movies: DataFrame, direct: DataFrame,
                   director_ids: Iterable | None = None) -> DataFrame:
    """Director filmography."""
    d = _keyed(direct, "director_id", director_ids)
    m = movies.select("mov_id", F.col("name").alias("title"))
    return d.join(m, "mov_id", "inner").select("director_id", "mov_id", "title")


def user_genre_name(user_profiles: DataFrame, genres: DataFrame,
                    user_ids: Iterable | None = None) -> DataFrame:
    """A user's favourite genre name."""
    u = _keyed(user_profiles, "user_id", user_ids)
    g = genres.select("genre_id", F.col("name").alias("genre"))
    return u.join(g, "genre_id", "inner").select("user_id", "genre_id", "genre")


def user_history(rate: DataFrame, movies: DataFrame, user_ids: Iterable | None = None) -> DataFrame:
    """A user's rating history with titles."""
    r = _keyed(rate, "user_id", user_ids)
    m = movies.select("mov_id", F.col("name").alias("title"))
    return r.join(m, "mov_id", "inner").select("user_id", "mov_id", "title", "grade")


def items_in_genre(movies: DataFrame, belong_to: DataFrame, genres: DataFrame,
                   genre_names: Iterable | None = None, n: int = GENRE_PAGE) -> DataFrame:
    """The first n movies (by id) of each genre page.

    ``row_number() <= n`` per genre runs as a partial WindowGroupLimit before
    the shuffle, so a genre holding a third of the catalogue still sends at
    most n rows per map partition.
    """
    g = genres.select("genre_id", F.col("name").alias("genre"))
    if genre_names is not None:
        g = g.where(F.col("genre").isin(list(genre_names)))
    # Rank on the narrow (genre_id, mov_id) key table first so the limit runs
    # partially before the shuffle; names are joined to <= n rows per genre.
    bt = (belong_to.join(movies.select("mov_id"), "mov_id", "left_semi")
                   .join(g.select("genre_id"), "genre_id", "left_semi"))
    w = Window.partitionBy("genre_id").orderBy("mov_id")
    top = bt.withColumn("pos", F.row_number().over(w).cast("long")).where(F.col("pos") <= n)
    m = movies.select("mov_id", F.col("name").alias("title"))
    return top.join(g, "genre_id", "inner").join(m, "mov_id", "inner").select("genre", "pos", "mov_id", "title")


def item_wide(movies: DataFrame, belong_to: DataFrame, genres: DataFrame,
              act: DataFrame, cast: DataFrame) -> DataFrame:
    """Denormalised movie x genre x cast view (row multiplication kept)."""
    g = genres.select("genre_id", F.col("name").alias("genre"))
    c = cast.select("cast_id", F.col("name").alias("cast_name"))
    m = movies.select("mov_id", F.col("name").alias("title"))
    return (m.join(belong_to, "mov_id", "inner").join(g, "genre_id", "inner")
             .join(act, "mov_id", "inner").join(c, "cast_id", "inner")
             .select("mov_id", "title", "genre", "cast_name", "role"))


def item_facets(direct: DataFrame, directors: DataFrame, belong_to: DataFrame,
                genres: DataFrame, act: DataFrame, cast: DataFrame) -> DataFrame:
    """Raw many-to-many merge (director x genre x cast per movie)."""
    d = direct.join(directors.select("director_id", F.col("name").alias("director")), "director_id")
    g = belong_to.join(genres.select("genre_id", F.col("name").alias("genre")), "genre_id")
    c = act.join(cast.select("cast_id", F.col("name").alias("cast_name")), "cast_id")
    return (d.join(g, "mov_id", "inner").join(c, "mov_id", "inner")
             .select("mov_id", "director", "genre", "cast_name"))


def link_by_item(links: DataFrame, ids: Iterable | None = None) -> DataFrame:
    """Outside links by movie."""
    return _keyed(links, "mov_id", ids)


def person_by_id(cast: DataFrame, directors: DataFrame, ids: Iterable | None = None) -> DataFrame:
    """Actor and director rows by key, tagged with the entity."""
    c = _keyed(cast, "cast_id", ids).select(
        F.lit("cast").alias("entity"), F.col("cast_id").alias("person_id"), "name",
        F.col("gender").cast("string").alias("gender"))
    d = _keyed(directors, "director_id", ids).select(
        F.lit("director").alias("entity"), F.col("director_id").alias("person_id"), "name",
        F.col("gender").cast("string").alias("gender"))
    return c.unionByName(d)


def user_by_name(users: DataFrame, usernames: Iterable | None = None) -> DataFrame:
    """User rows by username."""
    return _keyed(users, "username", usernames)


def search_names(movies: DataFrame, cast: DataFrame, directors: DataFrame, text: str,
                 limit: int = SEARCH_LIMIT) -> DataFrame:
    """Case-insensitive substring search over three name columns.

    The user text is wrapped in ``%`` but not escaped, so ``%`` and ``_``
    typed by the user act as wildcards (as in the reference).  Each entity
    returns its first ``limit`` matches by id; the planner turns
    ``orderBy.limit`` into a top-k per entity.
    """
    pattern = f"%{text}%"

    def one(df, entity, id_col):
        hits = df.where(F.col("name").ilike(pattern)).select(
            F.lit(entity).alias("entity"), F.col(id_col).alias("id"), "name")
        return hits.orderBy("id").limit(limit)

    return (one(movies, "movie", "mov_id")
            .unionByName(one(cast, "cast", "cast_id"))
            .unionByName(one(directors, "director", "director_id")))
