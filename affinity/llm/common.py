"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import materialize


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_bucket(col: str, n: int):
    """crc32 of the id as text, modulo n (the documented hold-out hash)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every row; null counts as the empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_numpy(zero_copy_only=False)]


def byte_chunks(texts: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes (one row at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def row_slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of a text column (one row at least)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends, start = np.cumsum(size), 0
    while start < len(size):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, end
        start = end


def word_ids(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Lower-case (A-Z) words split at ASCII white space.

    Returns (distinct words, index of each word in it, number of words per text).
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    enc = lists.flatten().dictionary_encode()
    words = enc.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if b"" in words:                                  # white space at the ends of a text
        e = words.index(b"")
        lens -= segment_sum(ids == e, lens).round().astype(np.int64)
        ids = ids[ids != e]
        ids[ids > e] -= 1
        words.pop(e)
    return words, ids, lens


def segment_sum(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of the given lengths (0 for empty ones)."""
    c = np.concatenate([np.zeros(1, dtype=np.float64), np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(lens)
    return c[ends] - c[ends - lens]


def gapless(df: DataFrame, group: list[str], order: list[str], out: str, name: str) -> DataFrame:
    """Number rows 0.. within each group without collecting a group into one task.

    Rows are range-partitioned by (group, order) and written once; each written
    partition keeps its local order, and the offsets table (one row per group
    and partition it touches) is joined back.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    d = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("_mid", F.monotonically_increasing_id()))
    d = materialize(d, name).withColumn("_pid", F.shiftright("_mid", 33))
    per = d.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_pid").alias("_p"), "_first",
                     F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    cond = F.col("_pid") == F.col("_p")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return (d.join(off, cond)
             .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
             .drop("_mid", "_pid", "_p", "_first", "_off", *[f"_g_{g}" for g in group]))
