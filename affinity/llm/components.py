"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import materialize, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on undirected edges (u, v); every row is handled by a partial
    aggregate and a join, of which AQE splits the partitions of a node with very many edges."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(low, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): every node of an edge and the least node it is connected to."""
    e = materialize(edges.select("u", "v").where("u <> v").distinct(), f"{name}-edges")
    state = None
    step = 0
    while True:
        last, e = e, materialize(_star(_star(e, True), False), f"{name}-step{step}")
        release(last)
        step += 1
        # The least fixed point is a star per component: no edge changes any more.
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    out = materialize(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
                       .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), f"{name}-roots")
    release(e)
    return out
