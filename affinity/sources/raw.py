"""Raw (pre-ETL) inputs derived from the test tables.

The ETL reads three raw files: a movie metadata file (strings, with a
Python-literal ``genres`` list), a credits file (Python-literal ``cast`` and
``crew`` lists) and a ratings file.  These builders produce DataFrames of the
same shape from the test tables, one raw row per source row, so the ETL jobs
parse, filter and deduplicate real volumes:

* movie metadata: one row per ``part``; runtime as text ``"<p_size>.0"``;
  ``genres`` = ``[{'id': <genre id>, 'name': '<p_type>'}]``;
  ``imdb_id`` = ``''`` when p_size mod 10 = 0, ``'nm'``+id when p_size mod 10
  = 5, else ``'tt'`` + 7-digit id.
  Some parts add a second, dirty row after all others: an id that occurs
  before, ids, runtimes, dates and revenues that do not parse, and odd but valid
  values (quotes and a backslash in the title, empty texts, a cut literal).
* credits: one row per ``lineitem`` row; ``cast`` = the line's supplier as
  ``[{'id', 'name', 'gender', 'character'}]`` (character = return flag);
  ``crew`` = the part's brand as Director plus the supplier as Producer.
* ratings: one row per rating row; ``rating`` = ``l_quantity / 10`` as text.

Every raw frame carries ``pos``, an explicit source-order column ("first
wins" needs one: file order is not a Spark guarantee).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.sources import testdata as td


def _q(col) -> F.Column:
    # single-quoted Python string literal (names hold no quote or backslash)
    return F.concat(F.lit("'"), col, F.lit("'"))


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = td.table(spark, sf_dir, "part")
    g = td.genres(spark, sf_dir).select(F.col("name").alias("p_type"), "genre_id")
    j = p.join(g, "p_type", "left")
    size_mod = F.col("p_size") % 10
    imdb = (F.when(size_mod == 0, F.lit(""))
             .when(size_mod == 5, F.concat(F.lit("nm"), F.col("p_partkey").cast("string")))
             .otherwise(F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"))))
    genres = F.concat(F.lit("[{'id': "), F.col("genre_id").cast("string"),
                      F.lit(", 'name': "), _q(F.col("p_type")), F.lit("}]"))
    clean = j.select(
        F.col("p_name").alias("title"),
        F.col("p_partkey").cast("string").alias("id"),
        F.lit("en").alias("original_language"),
        F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("runtime"),
        F.lit(None).cast("string").alias("release_date"),
        F.format_string("%.0f", F.col("p_retailprice") * 100).alias("revenue"),
        F.lit(None).cast("string").alias("poster_path"),
        F.lit(None).cast("string").alias("overview"),
        genres.alias("genres"),
        imdb.alias("imdb_id"),
        F.col("p_partkey").alias("pos"),
    )
    return clean.unionByName(_dirty_movies(p).select(*clean.columns))


DIRTY_MOD, DIRTY_POS = 20, 1_000_000_000
ODD_TITLE = "O'Neil \"X\\Y\""


def _dirty_movies(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey") % DIRTY_MOD
    new_id = lambda base: (F.lit(base) + F.col("p_partkey")).cast("string")
    case = lambda pairs, other: F.coalesce(*[F.when(k == n, v) for n, v in pairs], other)
    text = F.lit
    return part.where(k.between(1, 8)).select(
        case([(1, F.concat(text("Again "), F.col("p_name"))), (7, text(ODD_TITLE))], F.col("p_name")).alias("title"),
        case([(1, F.col("p_partkey").cast("string")), (2, F.concat(text("x"), F.col("p_partkey").cast("string"))),
              (7, new_id(20_000_000)), (8, new_id(30_000_000))], new_id(10_000_000)).alias("id"),
        text("en").alias("original_language"),
        case([(1, text("1.0")), (3, text("abc")), (4, text("")), (7, text("81.7"))], text("70")).alias("runtime"),
        case([(5, text("1995-02-30")), (7, text("1995-12-17"))], text("")).alias("release_date"),
        case([(6, text("12,5"))], text("")).alias("revenue"),
        text("").alias("poster_path"), text("").alias("overview"),
        case([(8, text("[{'id': 1"))], text("[]")).alias("genres"),
        text("").alias("imdb_id"),
        (F.lit(DIRTY_POS) + F.col("p_partkey")).alias("pos"))


def raw_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cast): one literal per ``lineitem`` row in eight forms by order key: plain,
    a quote in the name, an escape, None and a decimal id, an empty list, the word
    None, text after the list, and a dict instead of a list."""
    li = td.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    s = td.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    key, gender = F.col("l_suppkey").cast("string"), (F.col("l_suppkey") % 2).cast("string")

    def member(id_, name, gender_):
        return F.concat(F.lit("{'id': "), id_, F.lit(", 'name': "), name, F.lit(", 'gender': "), gender_,
                        F.lit(", 'character': "), _q(F.col("l_returnflag")), F.lit("}"))

    def listed(m):
        return F.concat(F.lit("["), m, F.lit("]"))

    name, none = _q(F.col("s_name")), F.lit("None")
    plain = member(key, name, gender)
    forms = [listed(plain),
             listed(member(key, F.concat(F.lit("\"O'"), F.col("s_name"), F.lit("\"")), gender)),
             listed(member(key, F.concat(F.lit("'"), F.col("s_name"), F.lit("\\x41'")), gender)),
             listed(member(F.concat(key, F.lit(".0")), name, none)),
             F.lit("[]"), none, F.concat(listed(plain), F.lit(" junk")), plain]
    kind = F.col("l_orderkey") % len(forms)
    return j.select(F.col("l_partkey").cast("string").alias("id"),
                    F.coalesce(*[F.when(kind == i, f) for i, f in enumerate(forms)]).alias("cast"))


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = td.table(spark, sf_dir, "lineitem").select(*td.ORDER_COLS, "l_returnflag")
    s = td.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    p = td.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    d = td.directors(spark, sf_dir).select(F.col("name").alias("p_brand"), "director_id",
                                          F.col("gender").alias("d_gender"))
    j = (li.join(s, li.l_suppkey == s.s_suppkey, "left")
           .join(p, li.l_partkey == p.p_partkey, "left")
           .join(d, "p_brand", "left"))
    s_gender = (F.col("l_suppkey") % 2).cast("string")
    cast = F.concat(F.lit("[{'id': "), F.col("l_suppkey").cast("string"),
                    F.lit(", 'name': "), _q(F.col("s_name")),
                    F.lit(", 'gender': "), s_gender,
                    F.lit(", 'character': "), _q(F.col("l_returnflag")), F.lit("}]"))
    crew = F.concat(F.lit("[{'id': "), F.col("director_id").cast("string"),
                    F.lit(", 'name': "), _q(F.col("p_brand")),
                    F.lit(", 'gender': "), F.col("d_gender").cast("string"),
                    F.lit(", 'job': 'Director'}, {'id': "), F.col("l_suppkey").cast("string"),
                    F.lit(", 'name': "), _q(F.col("s_name")),
                    F.lit(", 'gender': "), s_gender, F.lit(", 'job': 'Producer'}]"))
    return j.select(
        cast.alias("cast"), crew.alias("crew"),
        F.col("l_partkey").cast("string").alias("id"),
        F.struct(*[F.col(c) for c in td.ORDER_COLS]).alias("pos"),
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = td.rating_rows(spark, sf_dir)
    return r.select(
        F.col("user_id").cast("string").alias("userId"),
        F.col("mov_id").cast("string").alias("movieId"),
        F.col("rating").cast("string").alias("rating"),
        F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("mov_id").alias("l_partkey"),
                 F.col("l_suppkey"), F.col("l_quantity")).alias("pos"),
    )
