"""Exact top-k inner products through a pivot-distance index.

Components become integers floor(1024 x).  One extra coordinate sqrt(M - |v|^2), with M
the largest squared norm, turns inner products into distances: for a query q (extra
coordinate 0) |q - v|^2 = |q|^2 + M - 2 q.v.  Every vector is keyed by its nearest
pivot and its distance to it; the rows of a pivot are cut into sorted annuli (blocks
of at most about ``BLOCK`` rows; a hot annulus gets several).

Queries (all rows whose id is divisible by 100) go to pivots in packs of at most
``PACK``.  Round 1 visits the annulus of the nearest pivot that each query falls into;
the k-th score found there is a lower limit.  Round 2 visits every annulus that may
hold as much: by the triangle inequality a vector at distance r from the pivot is at
least |d(q, p) - r| from the query, and at least (d(q, p) - d(q, nearest pivot)) / 2 as
it lies nearer to its pivot than to any other.  All other annuli are skipped; nothing
else is, so the result is exact.

Pivots (``n_pivots``) and annulus borders are fitted on ``SAMPLE`` rows at most (least
hashes of ids); every row is indexed.  Edge cases: vectors that are null or hold null
or non-finite components, or whose id is null, take no part; vectors only meet others
of their dimension; ties go to the smaller id; repeated rows are candidates each, rows
with the query's own id never are; a query id with several vectors ranks the scores of all of them together; scores beyond 64 bits are clipped; fewer than k
candidates give fewer rows; other columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import table
from affinity.session import materialize

SCALE, QUERY_STEP = 1024.0, 100
SAMPLE, ANNULI, BLOCK, PACK = 4096, 16, 1024, 256
EXACT = 2.0 ** 53


@contextmanager
def small_batches(spark, rows: int):
    """Few rows per Arrow batch, for rows that hold whole blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


class Pivots:
    def __init__(self, sample: np.ndarray, top: float, n: int):
        ext = np.concatenate([sample, np.sqrt(np.maximum(top - (sample ** 2).sum(axis=1), 0))[:, None]], axis=1)
        chosen = [0]
        near = ((ext - ext[0]) ** 2).sum(axis=1)
        while len(chosen) < min(n, len(ext)):
            far = int(near.argmax())
            if near[far] <= 0:
                break
            chosen.append(far)
            near = np.minimum(near, ((ext - ext[far]) ** 2).sum(axis=1))
        self.points, self.top = ext[chosen], top
        d = self.distances(sample)
        p = d.argmin(axis=1)
        r = d[np.arange(len(d)), p]
        q = np.linspace(0, 1, ANNULI + 1)[1:-1]
        self.borders = [np.quantile(r[p == i], q) if (p == i).any() else np.zeros(0) for i in range(len(chosen))]

    def distances(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        sq = (v ** 2).sum(axis=1)
        last = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.top - sq, 0))
        total = sq if query else np.maximum(sq, self.top)
        dot = v @ self.points[:, :-1].T + np.outer(last, self.points[:, -1])
        return np.sqrt(np.maximum(total[:, None] + (self.points ** 2).sum(axis=1) - 2 * dot, 0))


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, dim, v) with v = floor(1024 x) as doubles."""
    x = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = ("vec_id IS NOT NULL AND e IS NOT NULL AND "
            "forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    return x.where(fine).select("vec_id", F.size("e").alias("dim"),
                                F.transform("e", lambda c: F.floor(c * SCALE).cast("double")).alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _index(pivots):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            v = _matrix(batch.column("v"))
            d = pivots.value.distances(v)
            p = d.argmin(axis=1)
            r = d[np.arange(len(d)), p]
            ring = np.array([np.searchsorted(pivots.value.borders[i], x, side="right") for i, x in zip(p, r)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(p, pa.int32()), pa.array(ring, pa.int32()), pa.array(r),
                 pa.array([x.tobytes() for x in v], pa.binary())], ["vec_id", "pivot", "ring", "r", "v"])
    return run


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["r", "vec_id"])
    return pd.DataFrame({"pivot": [pdf["pivot"].iat[0]], "lo": [pdf["r"].iat[0]], "hi": [pdf["r"].iat[-1]],
                         "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "mat": [b"".join(pdf["v"])]})


def _route(pivots, first: bool):
    """Query rows once for every pivot that may hold a result."""
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            v, pv = _matrix(batch.column("v")), pivots.value
            d = pv.distances(v, query=True)
            best = d.min(axis=1)
            sq = (v ** 2).sum(axis=1)
            if first:
                q, p = np.arange(len(d)), d.argmin(axis=1)
                least = np.full(len(d), -np.inf)
            else:
                least = np.array([-np.inf if x is None else float(x) for x in batch.column("least").to_pylist()])
                gap = np.maximum(d - best[:, None], 0) / 2
                bound = (sq[:, None] + pv.top - gap ** 2) / 2
                q, p = np.nonzero(bound >= (least - _slack(sq, pv.top))[:, None])
            take = pa.array(q)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), batch.column("vec_id").take(take), pa.array(d[q, p]), pa.array(least[q]),
                 pa.array([x.tobytes() for x in v[q]], pa.binary())], ["pivot", "query_id", "d", "least", "v"])
    return run


def _slack(sq, top):
    return 1.0 + 1e-9 * (sq + top)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("query_id")
    return pd.DataFrame({"pivot": [pdf["pivot"].iat[0]], "q_ids": [pdf["query_id"].to_numpy(np.int64).tobytes()],
                         "d": [pdf["d"].to_numpy(float).tobytes()], "least": [pdf["least"].to_numpy(float).tobytes()],
                         "q_mat": [b"".join(pdf["v"])]})


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    most = np.abs(q).max(initial=0) * np.abs(m).max(initial=0) * max(q.shape[1], 1)
    if most < EXACT:
        return (q @ m.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q], dtype=object) @ \
        np.array([[int(x) for x in row] for row in m], dtype=object).T
    return np.clip(exact, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)


def _visit(k: int, top: float, first: bool):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, q_ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                d, least = np.frombuffer(r["d"], float), np.frombuffer(r["least"], float)
                q = np.frombuffer(r["q_mat"], float).reshape(len(q_ids), -1)
                away = np.maximum(np.maximum(r["lo"] - d, d - r["hi"]), 0)
                sq = (q ** 2).sum(axis=1)
                use = away <= 1e-6 * (1 + d) if first else (sq + top - away ** 2) / 2 >= least - _slack(sq, top)
                if not use.any():
                    continue
                q, q_ids, least = q[use], q_ids[use], least[use]
                score = _products(q, np.frombuffer(r["mat"], float).reshape(len(ids), -1))
                ok = (score >= least[:, None]) & (ids[None, :] != q_ids[:, None])
                qi, ci = np.nonzero(ok)
                s = score[qi, ci]
                order = np.lexsort((ids[ci], -s, qi))
                qi, ci, s = qi[order], ci[order], s[order]
                rank = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
                keep = rank < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[qi[keep]]), pa.array(ids[ci[keep]]), pa.array(s[keep])],
                    ["query_id", "vec_id", "score"])
    return run


def top_products(rows: DataFrame, k: int = 10, n_pivots: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row whose id is divisible by 100."""
    spark = rows.sparkSession
    vectors = materialize(valid_vectors(rows), "op9-vectors")
    norms = vectors.groupBy("dim").agg(
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).orderBy("dim").collect()
    results = [_one_dimension(spark, vectors.where(F.col("dim") == r["dim"]), float(r["top"]), k, n_pivots)
               for r in norms]
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    if len(results) > 1:                              # an id may have vectors of several dimensions
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out


def _one_dimension(spark, vectors: DataFrame, top: float, k: int, n_pivots: int) -> DataFrame:
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    pivots = spark.sparkContext.broadcast(Pivots(np.array([np.asarray(x, float) for x in sample]).reshape(len(sample), -1),
                                                 top, n_pivots))
    indexed = materialize(vectors.mapInArrow(_index(pivots), "vec_id long, pivot int, ring int, r double, v binary"),
                          "op9-index")
    # One row per cell (n_pivots * ANNULI at most): how many blocks it needs.
    cells = (indexed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"))
                    .select("pivot", "ring", F.ceil(F.col("n") / BLOCK).alias("parts")))
    blocks = (indexed.join(F.broadcast(cells), ["pivot", "ring"])
                     .withColumn("part", F.pmod(F.xxhash64("vec_id", "r"), F.col("parts")))
                     .groupBy("pivot", "ring", "part")
                     .applyInPandas(_block, "pivot int, lo double, hi double, ids binary, mat binary"))
    blocks = materialize(blocks, "op9-blocks")
    queries = vectors.where(F.col("vec_id") % QUERY_STEP == 0).dropDuplicates(["vec_id", "v"])

    def search(q: DataFrame, first: bool) -> DataFrame:
        routed = q.mapInArrow(_route(pivots, first), "pivot int, query_id long, d double, least double, v binary")
        routed = materialize(routed, "op9-routed")
        per = routed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))      # at most n_pivots rows
        packs = (routed.join(F.broadcast(per), "pivot").withColumn("pack", F.pmod(F.xxhash64("query_id"), F.col("packs")))
                       .groupBy("pivot", "pack")
                       .applyInPandas(_pack, "pivot int, q_ids binary, d binary, least binary, q_mat binary"))
        packs = materialize(packs, "op9-packs")
        with small_batches(spark, 16):
            hits = materialize(blocks.join(packs, "pivot").mapInArrow(
                _visit(k, top, first), "query_id long, vec_id long, score long"), f"op9-hits{int(first)}")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    least = search(queries, True).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    again = queries.join(least, queries["vec_id"] == least["query_id"], "left").select("vec_id", "v", "least")
    return search(again, False).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
