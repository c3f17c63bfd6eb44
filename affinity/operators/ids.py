"""Dense 0-based integer ids (A14) without a single-partition window.

Distinct keys are range-partitioned and sorted; ``monotonically_increasing_id``
then holds the partition and the local position.  The numbered frame is
written once (so both uses read the same rows) and per-partition offsets
(one row per partition, a proven size bound) are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import materialize

LOCAL_BITS = 33      # bits of a monotonically increasing id that hold the local position


def dense_index(keys: DataFrame, col: str, idx_col: str = "idx",
                partitions: int | None = None) -> DataFrame:
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = (keys.select(col).distinct().repartitionByRange(n, col).sortWithinPartitions(col)
             .withColumn("_mid", F.monotonically_increasing_id()))
    loc = materialize(d, "dense-index").select(
        col, F.shiftright("_mid", LOCAL_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND((1 << LOCAL_BITS) - 1).alias("_local"))
    counts = loc.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (loc.join(F.broadcast(offsets), "_pid", "inner")
               .select(col, (F.col("_off") + F.col("_local")).cast("long").alias(idx_col)))


def dense_ids(ratings: DataFrame) -> DataFrame:
    """(kind, id, idx): dense ids of users and items, ordered by id."""
    u = dense_index(ratings, "user_id").select(F.lit("user").alias("kind"),
                                               F.col("user_id").alias("id"), "idx")
    m = dense_index(ratings, "mov_id").select(F.lit("item").alias("kind"),
                                              F.col("mov_id").alias("id"), "idx")
    return u.unionByName(m)
