"""Star-schema views over the generated test tables.

The test folders hold TPC-H-like tables.  This module maps them onto the
ratings + catalogue model the library works on (the same mapping is used by
the DuckDB oracle SQL in ``affinity.plans.oracle``):

* rating rows: ``lineitem`` joined to ``orders``; user = ``o_custkey``,
  item = ``l_partkey``, raw rating = ``l_quantity / 10`` and
  grade = ``floor(l_quantity / 10)`` (the ETL truncation).  Duplicated
  (user, item) rows are kept; they exercise the mean-of-cell step.
* source order ("first wins"): ``(l_orderkey, l_linenumber, l_partkey,
  l_suppkey, l_quantity)``.
* review text: ``l_returnflag`` unless it is ``'N'`` (then NULL).
* movie: ``part`` (mov_id = p_partkey, name = p_name, runtime = p_size,
  revenue = p_retailprice).
* genre: distinct ``p_type``, id = dense rank of the name; director:
  distinct ``p_brand``, id = dense rank, gender = id mod 3.
* cast: ``supplier``; act = distinct (l_partkey, l_suppkey) with the role
  taken from the first line in source order.
* user: ``customer``; gender = id mod 2.
* overview text: all ``documents`` (the stop list is English, the texts need not be).
* rating change log: ``events``.

All functions are lazy; the parquet scan receives only the columns and
filters the caller's plan needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.operators.ids import dense_index
from affinity.session import materialize

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the mapping (shared with the oracle SQL).
ORDER_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
RATING_ORDER = ("l_orderkey", "l_linenumber", "mov_id", "l_suppkey", "l_quantity")
CHANGE_LOG_ITEMS = 50          # events: item = event_id mod 50
CHANGE_LOG_GRADE_STEP = 50.0   # events: grade = least(5, floor(value / 50))
UPSERT_EVENTS = ("signup", "purchase", "view")
UPDATE_EVENTS = ("click",)
DELETE_EVENTS = ("error",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rating rows with their source-order columns.

    Columns: mov_id, user_id, rating (raw, half-star-like), grade (truncated),
    review, l_orderkey, l_linenumber, l_suppkey, l_quantity.
    The lineitem/orders join is a plain equi-join on the order key; on a
    cluster both tables are bucketed or hash-partitioned on it.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.col("l_partkey").alias("mov_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("l_quantity") / 10.0).alias("rating"),
        F.floor(F.col("l_quantity") / 10.0).cast("double").alias("grade"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("review"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, mov_id, grade) rating rows, duplicates kept."""
    return rating_rows(spark, sf_dir).select("user_id", "mov_id", "grade")


def rate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised ``rate`` table: one row per (mov_id, user_id), first wins."""
    r = rating_rows(spark, sf_dir)
    w = Window.partitionBy("mov_id", "user_id").orderBy(*RATING_ORDER)
    return (r.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
             .select("mov_id", "user_id", "grade", "review"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_name").alias("name"),
        F.col("p_partkey").alias("mov_id"),
        F.col("p_size").alias("runtime"),
        F.col("p_retailprice").alias("revenue"),
    )


_DIMENSIONS: dict = {}


def _dim_from_attribute(spark, sf_dir, attr, id_col):
    """Distinct values of an attribute numbered 1.. in name order.

    Numbered with ``dense_index`` (range partitions + per-partition offsets,
    no single-task window) and written once per session and state of the
    ``part`` table (its files and their times), then read by every query.
    """
    part = table(spark, sf_dir, "part")
    files = tuple(sorted(map(tuple, part.select("_metadata.file_path", F.col("_metadata.file_modification_time").cast("string"))
                                        .distinct().collect())))
    key = (spark.sparkContext.applicationId, files, attr, id_col)
    if key not in _DIMENSIONS:
        idx = dense_index(part.select(attr), attr)
        dim = idx.select(F.col(attr).alias("name"), (F.col("idx") + 1).cast("long").alias(id_col))
        _DIMENSIONS[key] = materialize(dim, f"dim-{attr}")
    return _DIMENSIONS[key]


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_from_attribute(spark, sf_dir, "p_type", "genre_id")


def belong_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    g = genres(spark, sf_dir)
    return (p.join(g, p.p_type == g.name, "inner")
             .select(F.col("p_partkey").alias("mov_id"), "genre_id"))


def directors(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dim_from_attribute(spark, sf_dir, "p_brand", "director_id")
    return d.withColumn("gender", (F.col("director_id") % 3).cast("int"))


def direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    d = directors(spark, sf_dir)
    return (p.join(d, p.p_brand == d.name, "inner")
             .select(F.col("p_partkey").alias("mov_id"), "director_id"))


def cast_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("cast_id"),
                    (F.col("s_suppkey") % 2).cast("string").alias("gender"))


def act(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mov_id, role, cast_id): first line per (part, supplier) in source order."""
    li = table(spark, sf_dir, "lineitem").select(*ORDER_COLS, "l_returnflag")
    w = Window.partitionBy("l_partkey", "l_suppkey").orderBy(*ORDER_COLS)
    return (li.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
              .select(F.col("l_partkey").alias("mov_id"), F.col("l_returnflag").alias("role"),
                      F.col("l_suppkey").alias("cast_id")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                    F.lower(F.col("c_name")).alias("username"),
                    (F.col("c_custkey") % 2).cast("string").alias("gender"))


def overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mov_id, overview): every document, whole text."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("mov_id"), F.col("text").alias("overview"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating change log (mov_id, user_id, op, grade, review, ts, seq)."""
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type").isin(*UPSERT_EVENTS), "upsert")
           .when(F.col("event_type").isin(*UPDATE_EVENTS), "update")
           .when(F.col("event_type").isin(*DELETE_EVENTS), "delete"))
    return e.select(
        (F.col("event_id") % CHANGE_LOG_ITEMS).alias("mov_id"),
        F.col("user_id"),
        op.alias("op"),
        F.least(F.lit(5.0), F.floor(F.col("value") / CHANGE_LOG_GRADE_STEP).cast("double")).alias("grade"),
        F.col("event_type").alias("review"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )
