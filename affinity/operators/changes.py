"""Change application, re-aimed from the web forms' INSERT / UPDATE / DELETE.

A batch of changes is folded into the current snapshot set-wise: the latest
operation per key wins (an update only applies to a row that exists), and
the new snapshot is returned (to be written with ``files.load_table``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.ids import dense_index
from affinity.session import materialize, release

KEY = ["mov_id", "user_id"]
ONBOARD_N = 8                       # fixed value (reference): onboarding movies
SAMPLE_MUL, SAMPLE_ADD, SAMPLE_MOD = 1103515245, 12345, 2147483648   # portable hash order


def apply_rating_changes(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """M1: fold (mov_id, user_id, op, grade, review, ts, seq) into the snapshot.

    Per key, ordered by (ts, seq): the last upsert/delete decides existence;
    if it is an upsert (or there is none and the key already exists), the
    row takes grade/review of the latest upsert-or-update.
    """
    order = F.struct("ts", "seq")
    agg = log.groupBy(*KEY).agg(
        F.max_by(F.struct("grade", "review"), order).alias("last"),
        F.max_by("op", F.when(F.col("op") != "update", order)).alias("last_struct_op"))
    base = snapshot.select(*KEY, F.lit(True).alias("existed"))
    j = agg.join(base, KEY, "left")
    alive = (F.col("last_struct_op") == "upsert") | (
        F.col("last_struct_op").isNull() & F.coalesce(F.col("existed"), F.lit(False)))
    changed = j.where(alive).select(*KEY, F.col("last.grade").alias("grade"),
                                    F.col("last.review").alias("review"))
    untouched = snapshot.join(agg.select(*KEY), KEY, "left_anti").select(*KEY, "grade", "review")
    return untouched.unionByName(changed)


SNAPSHOT_PARTS = 64      # partitions of a clustered snapshot


def _part(parts: int) -> F.Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(parts)).cast("int").alias("part")


def write_snapshot(snapshot: DataFrame, path: str, parts: int = SNAPSHOT_PARTS) -> None:
    """The rating snapshot clustered by hashed key: (mov_id, user_id) decides the folder."""
    (snapshot.select(*KEY, "grade", "review", _part(parts)).repartition(parts, "part")
             .write.mode("overwrite").partitionBy("part").parquet(path))


def merge_rating_changes(spark, path: str, log: DataFrame, parts: int = SNAPSHOT_PARTS) -> int:
    """M1 in place: fold a change log into a snapshot that ``write_snapshot`` wrote, reading
    and rewriting only the partitions the log touches; returns their number.

    The new rows are computed in full before any file is replaced (dynamic partition
    overwrite); a partition that loses its last row is removed.  ``parts`` is the
    number the snapshot was written with."""
    schema = "mov_id long, user_id long, grade double, review string, part int"
    marked = materialize(log.withColumn("part", _part(parts)), "merge-log")
    touched = [r["part"] for r in marked.select("part").distinct().collect()]        # at most ``parts`` numbers
    if not touched:
        return 0
    old = spark.read.schema(schema).parquet(path).where(F.col("part").isin(touched)).drop("part")
    new = materialize(apply_rating_changes(old, marked.drop("part")).select(*KEY, "grade", "review", _part(parts)), "merge-rows")
    left = {r["part"] for r in new.select("part").distinct().collect()}
    (new.repartition(len(touched), "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("part").parquet(path))
    for part in set(touched) - left:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    release(marked)
    release(new)
    return len(touched)


def read_snapshot(spark, path: str) -> DataFrame:
    return spark.read.schema("mov_id long, user_id long, grade double, review string, part int").parquet(path).drop("part")


def append_new_items(existing: DataFrame, incoming: DataFrame, key: str = "mov_id") -> DataFrame:
    """M2: insert incoming rows whose key is absent (existing rows win).  Of incoming rows
    with one key the least row (by all columns) is inserted; rows without a key are not."""
    cols = existing.columns
    rest = [c for c in cols if c != key]
    one = (incoming.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*").select(*cols)
           if rest else incoming.where(F.col(key).isNotNull()).select(key).distinct())
    new = one.join(existing.select(key), key, "left_anti")
    return existing.unionByName(new)


def append_new_users(existing: DataFrame, signups: DataFrame) -> DataFrame:
    """M3: register-if-absent on username, first signup wins; new ids follow max id.

    signups: (username, name, seq).  New ids are max(existing) + 1 + the
    dense rank of (seq, username), so names with one seq get ids of their own (no
    single-partition window).
    """
    first = (signups.groupBy("username").agg(F.min(F.struct("seq", "name")).alias("f"))
                    .select("username", F.col("f.name").alias("name"), F.col("f.seq").alias("seq")))
    new = first.join(existing.select("username"), "username", "left_anti")
    new = new.withColumn("_place", F.struct("seq", "username"))
    idx = dense_index(new, "_place")
    top = existing.agg(F.max("user_id")).scalar()
    added = new.join(idx, "_place").select(
        (F.coalesce(top, F.lit(-1)) + 1 + F.col("idx")).cast("long").alias("user_id"), "username", "name")
    return existing.select("user_id", "username", "name").unionByName(added)


def onboarding_sample(movies: DataFrame, n: int = ONBOARD_N, seed: int = SAMPLE_ADD) -> DataFrame:
    """O2/M4: n catalogue movies in a seeded pseudo-random order (top-k, no sort of all)."""
    # The remainder first: the product of a large id would leave the long range.
    h = F.pmod(F.pmod(F.col("mov_id"), F.lit(SAMPLE_MOD)) * SAMPLE_MUL + F.lit(seed), F.lit(SAMPLE_MOD))
    return (movies.withColumn("draw", h).orderBy("draw", "mov_id").limit(n)
                  .select("mov_id", "name", "draw"))


def onboard_user(snapshot: DataFrame, users: DataFrame, movies: DataFrame, n: int = ONBOARD_N) -> DataFrame:
    """M4: a new user (next free id) rates the n sampled movies; the first ratings are
    folded into the snapshot as upserts.  The grade shown is 1 + draw mod 5."""
    new_id = users.agg((F.max("user_id") + 1).alias("i")).scalar()
    log = onboarding_sample(movies, n).select(
        "mov_id", new_id.alias("user_id"), F.lit("upsert").alias("op"),
        (1 + F.col("draw") % 5).cast("double").alias("grade"), F.lit(None).cast("string").alias("review"),
        F.lit("2000-01-01").cast("timestamp").alias("ts"), F.col("draw").alias("seq"))
    return apply_rating_changes(snapshot, log)
