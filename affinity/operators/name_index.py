"""Substring search over names by a posting table of trigrams.

``build_index`` writes, per entity, every distinct trigram of the lower-cased name with the
id (postings, clustered by hashed trigram so that a search opens few files) next to the
names themselves.  A search takes the trigrams of the fixed stretches of its pattern
(``%`` and ``_`` typed by the user stay wildcards), reads only those postings, keeps ids that
hold all of them, and verifies the pattern on the names of these ids.  Patterns without three
fixed characters in a row have no trigram and scan the names, as they must.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 3
BUCKETS = 64          # folders of the posting table
SEARCH_LIMIT = 10     # fixed value (reference): hits shown per entity


def grams(col) -> F.Column:
    """Distinct lower-case trigrams of a text."""
    t = F.lower(col)
    starts = F.when(F.length(t) >= GRAM, F.sequence(F.lit(1), F.length(t) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(t, i, F.lit(GRAM))))


def _bucket(col) -> F.Column:
    return F.pmod(F.xxhash64(col), F.lit(BUCKETS)).cast("int")


def build_index(names: DataFrame, path: str) -> None:
    """names: (entity, id, name).  Rows without a name are in no search."""
    n = names.where(F.col("name").isNotNull()).select("entity", F.col("id").cast("long").alias("id"), "name")
    n.write.mode("overwrite").parquet(f"{path}/names")
    # A frequent trigram is spread by the id as well: a bucket is written by several tasks.
    p = n.select("entity", "id", F.explode(grams(F.col("name"))).alias("gram")).withColumn("bucket", _bucket("gram"))
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (p.repartition(parts, "bucket", F.pmod(F.xxhash64("id"), F.lit(4))).sortWithinPartitions("bucket", "gram")
      .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))


def pattern_grams(spark: SparkSession, text: str) -> list[str]:
    """Trigrams that every match of ``%text%`` holds, lower-cased as the index is."""
    fixed = [s for s in re.split("[%_]", text) if s]
    if not fixed:
        return []
    rows = spark.createDataFrame([(s,) for s in fixed], "s string").select(F.explode(grams(F.col("s"))).alias("g")).distinct().collect()
    return sorted(r["g"] for r in rows)


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame | None:
    """(entity, id) of the names that hold all trigrams of the pattern; None without any."""
    wanted = pattern_grams(spark, text)
    if not wanted:
        return None
    # The buckets of the pattern's trigrams as literals: only their folders are opened.
    spots = [r["b"] for r in spark.createDataFrame([(g,) for g in wanted], "g string").select(_bucket("g").alias("b")).distinct().collect()]
    hits = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(spots) & F.col("gram").isin(wanted))
    return (hits.groupBy("entity", "id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") == len(wanted)).select("entity", "id"))


def search(spark: SparkSession, path: str, text: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """(entity, id, name): the first ``limit`` matches by id of every entity, as ILIKE
    ``%text%`` finds them."""
    names = spark.read.parquet(f"{path}/names")
    some = candidates(spark, path, text)
    if some is not None:
        names = names.join(some, ["entity", "id"], "left_semi")
    hits = names.where(F.col("name").ilike(f"%{text}%")).select("entity", "id", "name")
    seat = F.row_number().over(Window.partitionBy("entity").orderBy("id", "name"))
    return hits.withColumn("_seat", seat).where(F.col("_seat") <= limit).drop("_seat")
