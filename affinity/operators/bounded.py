"""Exact top-k neighbours by bounds: only pairs that share a column, and a short list.

    sim(u, v) = a_u * a_v + sum_c x_uc * x_vc          (a and x already divided by the norms)

as in ``tiles``, where the rank-one term makes every pair similar.  Scoring all pairs is
avoided by three facts:

* Pairs that share a column with at most ``hot_limit`` rows are met column by column; the
  work is the sum of squares of those column sizes, at most ``hot_limit`` times the
  entries.  They are met inside tiles of packed rows (``tiles.pair_tiles``): a pair has all
  its columns in one tile, so that its sum is whole there, and only pairs that may still
  matter become rows.  Columns beyond that (an item that a third of all users rated) are
  not met: they only add to bounds until the few pairs that may matter are scored.
* All others have sim <= a_u * a_v + c_u * C with c the length of a row's hot part and C
  the longest, so a list of all rows in the order of a can be read from its top and left
  as soon as that falls below the k-th best found.  The first k + 1 rows of the list
  already give every row a threshold, which drops most joined pairs before any sort.
* Of rows without a hot part, one that k others come before (larger or equal a and a smaller
  id: better for every reader, or equal and first) is not needed by a row, unless some of
  those k are joined partners of it or itself.  ``dom`` is how many come before a row; a row with q
  partners in its part of the list reads rows of dom <= k + q, so that many rows of equal
  or nearly equal a cost a row some k log of them and not all.  The list is kept per
  class of k + q (doubling), each class read from its top.

How far each row reads is found for all rows at once: thresholds and list are sorted
together by range partitions and counted (``at_least``); no pair of rows is formed that
the bound or ``dom`` excludes.  To count ``dom``, the smallest ids of every range partition
(at most ``DOM_LIMIT``) pass through the driver.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators.tiles import (SCORE_PLACES, Pack, blocks_for, cooccurrences, groups_for, packed, pair_tiles,
                                      shared_columns)
from affinity.session import materialize, release

HOT_LIMIT = 4096          # rows of a column that is joined
SLACK = 2e-9              # two units of the last place of a rounded score
PACK_ROWS, PACK_ENTRIES = 1 << 16, 1_000_000
PAIR_STEP = 4_000_000     # pairs of entries in memory at once
DOM_LIMIT = 1 << 14       # a row that so many come before counts no further ones
SMALL_LIST = 100_000      # list rows that are broadcast
MET_SCHEMA = "row_id long, other_id long, p double, partners long"


def _numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` written in the order given, with the range partition (pid) of each row and its
    place among all rows (pos, from 0)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("mid", F.monotonically_increasing_id()), name).withColumn("pid", F.shiftright("mid", 33))
    per = laid.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))                   # one row a partition
    off = per.select(F.col("pid").alias("p"), F.coalesce(F.sum("n").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    return (laid.join(F.broadcast(off), F.col("pid") == F.col("p"))
                .withColumn("pos", F.col("off") + F.col("mid").bitwiseAND((1 << 33) - 1)).drop("mid", "p", "off"))


def at_least(values: DataFrame, queries: DataFrame, name: str, lead: tuple = ()) -> DataFrame:
    """(row_id, reach): how many of ``values`` (val) are >= each query's (row_id, val); with
    ``lead`` columns, ascending, those of smaller lead values are counted too."""
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (values.select(*lead, "val", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row_id"))
                  .unionByName(queries.select(*lead, "val", F.lit(1).alias("kind"), "row_id")))
    order = [*map(F.asc, lead), F.desc("val"), F.asc("kind"), F.asc("row_id")]
    laid = materialize(both.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .withColumn("mid", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("pid", F.shiftright("mid", 33))
    per = laid.groupBy("pid").agg(F.sum(1 - F.col("kind")).alias("n"))            # one row a partition
    off = per.select(F.col("pid").alias("p"), F.coalesce(F.sum("n").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    here = F.sum(1 - F.col("kind")).over(Window.partitionBy("pid").orderBy("mid"))
    return (laid.withColumn("here", here).where("kind = 1").join(F.broadcast(off), F.col("pid") == F.col("p"))
                .select("row_id", (F.col("off") + F.col("here")).cast("long").alias("reach")))


def _smaller_before(limit: int):
    """Adds to (row_id, c, a), in order, how many earlier rows of the partition without a hot
    part have a smaller id (``limit`` at most; 0 for rows with a hot part)."""
    def run(batches):
        low: list[int] = []                               # the smallest ids so far
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.int64)
            plain = batch.column("c").to_numpy(zero_copy_only=False) == 0
            for i, r in enumerate(batch.column("row_id").to_pylist()):
                if plain[i]:
                    at = bisect_left(low, r)
                    out[i] = at
                    if at < limit:
                        insort(low, r)
                        del low[limit:]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "dom"])
    return run


def _come_before(laid: DataFrame, limit: int) -> DataFrame:
    """(row_id, a, c, dom) of rows numbered in the order of a descending, ids ascending: how
    many rows without a hot part come before one of them (exact below ``limit``)."""
    spark = laid.sparkSession
    least = {r["pid"]: np.array(r["ids"], dtype=np.int64) for r in laid.where("c = 0 and dom < %d" % limit).groupBy("pid").agg(
        F.slice(F.array_sort(F.collect_list("row_id")), 1, limit).alias("ids")).toLocalIterator()}
    before, so_far = {}, np.empty(0, np.int64)
    for pid in sorted(least):
        before[pid] = so_far
        so_far = np.sort(np.append(so_far, least[pid]))[:limit]
    shared = spark.sparkContext.broadcast(before)

    def run(batches):
        for batch in batches:
            pid, ids = batch.column("pid").to_numpy(), batch.column("row_id").to_numpy()
            dom = batch.column("dom").to_numpy().copy()
            plain = batch.column("c").to_numpy() == 0
            for p in np.unique(pid).tolist():
                here = np.flatnonzero((pid == p) & plain)
                dom[here] += np.searchsorted(shared.value.get(p, np.empty(0, np.int64)), ids[here])
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("a"), batch.column("c"), pa.array(dom)],
                                             ["row_id", "a", "c", "dom"])
    return laid.select("pid", "row_id", "a", "c", "dom").mapInArrow(run, "row_id long, a double, c double, dom long")


def _met(cold: DataFrame, info: DataFrame, longest) -> DataFrame:
    """(row_id, other_id, p) of the pairs that share a column and have a chance, both ways;
    and (row_id, partners) without an other row: how many pairs a row has in a tile.

    info: (row_id, a, c, floor).  A pair has a chance for row u if its bound reaches the
    floor of u, or the other row is listed where u may read it (any floor found later is
    at least this one)."""
    last = F.when(F.col("a") > 0, (F.col("floor") - 2 * SLACK - F.col("c") * longest) / F.col("a")).otherwise(F.lit(-1.0))
    some = info.join(cold.select("row_id").distinct(), "row_id")
    info = materialize(some.select("row_id", "a", "c", "floor", last.alias("last")), "bound-info")
    n, m = info.count(), cold.count()
    packs = blocks_for(n, m, PACK_ROWS, PACK_ENTRIES)
    p = packed(cold, info, packs, "bound-packs")
    return pair_tiles(p, groups_for(cold.sparkSession, packs, n, m), _met_tile, MET_SCHEMA)


def _met_tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    one = left is right
    first = [Pack(r, 4) for r in left.itertuples()]
    second = first if one else [Pack(r, 4) for r in right.itertuples()]
    partners = {p.number: np.zeros(len(p), dtype=np.int64) for p in first + second}
    out = []

    def keep(p, q, i, j, x):
        """Rows i of p with a chance to have row j of q among their best."""
        (a, c, floor, last), (oa, oc) = (v[i] for v in p.info), (v[j] for v in q.info[:2])
        ok = (a * oa + x + c * oc >= floor - SLACK - 1e-12) | (oa >= last)
        out.append((p.ids[i[ok]], q.ids[j[ok]], x[ok]))

    for n, p in enumerate(first):
        for q in (second[n:] if one else second):
            for i, j, x in _pair_sums(p, q):
                if p is q:
                    half = i < j                       # both rows are in the pack: each pair is met twice
                    i, j, x = i[half], j[half], x[half]
                partners[p.number] += np.bincount(i, minlength=len(p))
                partners[q.number] += np.bincount(j, minlength=len(q))
                keep(p, q, i, j, x)
                keep(q, p, j, i, x)
    some = [(p, np.flatnonzero(partners[p.number])) for p in {p.number: p for p in first + second}.values()]
    met = [np.concatenate(v) for v in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    rows = np.concatenate([p.ids[at] for p, at in some]) if some else np.empty(0, np.int64)
    count = np.concatenate([partners[p.number][at] for p, at in some]) if some else np.empty(0, np.int64)
    return pd.concat([pd.DataFrame({"row_id": met[0], "other_id": pd.array(met[1], dtype="Int64"), "p": met[2], "partners": 0}),
                      pd.DataFrame({"row_id": rows, "other_id": pd.array([None] * len(rows), dtype="Int64"), "p": 0.0,
                                    "partners": count})], ignore_index=True)


def _pair_sums(p: Pack, q: Pack):
    """(rows of p, rows of q, sums of products over all shared columns), each pair of rows
    once, for some rows of p at a time."""
    i, j = shared_columns(p, q)
    if len(i) == 0:
        return
    # Pairs of entries by row of p: as many rows a step as make some PAIR_STEP pairs.
    work = np.zeros(len(p.col), dtype=np.int64)
    work[i] = q.count[j]
    each = np.bincount(p.rows, weights=np.repeat(work, p.count), minlength=len(p)).astype(np.int64)
    step = np.cumsum(each) // PAIR_STEP
    cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(p))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        parts = list(cooccurrences(p, q, i, j, rows=(lo, hi)))
        r, c, x = (np.concatenate(v) for v in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        if len(r) == 0:
            continue
        key = r.astype(np.int64) * len(q) + c
        o = np.argsort(key, kind="stable")
        key, x = key[o], x[o]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield key[at] // len(q), key[at] % len(q), np.add.reduceat(x, at)


def _rank_key(col: str = "sim"):
    return F.round(col, SCORE_PLACES)


def _best(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row_id").orderBy(F.desc(_rank_key()), F.asc("other_id"))
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def cosine_topk(entries: DataFrame, info: DataFrame, k: int, hot_limit: int = HOT_LIMIT,
                stats: dict | None = None) -> DataFrame:
    """Top-k most similar other rows per row: (row_id, other_id, sim, rank).

    entries: (row_id, col_id, value), one row per cell; info: (row_id, alpha >= 0, norm),
    one row per row id (norm 0: similar to nothing, sim 0).  ``stats`` receives the number
    of joined pairs and of list rows read (two extra counts).
    """
    norm = F.when(F.col("norm") > 0, F.col("norm"))
    base = info.select(F.col("row_id").cast("long"), F.coalesce(F.col("alpha") / norm, F.lit(0.0)).alias("a"), norm.alias("norm"))
    cell = (entries.select(F.col("row_id").cast("long"), F.col("col_id").cast("long"), F.col("value").cast("double"))
                   .join(base.select("row_id", "norm"), "row_id").where("norm > 0 and value <> 0")
                   .select("row_id", "col_id", (F.col("value") / F.col("norm")).alias("x")))
    cell = materialize(cell, "bound-cells")
    size = cell.groupBy("col_id").agg(F.count(F.lit(1)).alias("n"))
    hot_cells = cell.join(size.where(F.col("n") > hot_limit).select("col_id"), "col_id", "left_semi")
    hot_rows = hot_cells.groupBy("row_id").agg(                         # at most entries / hot_limit columns
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("c"), F.map_from_entries(F.collect_list(F.struct("col_id", "x"))).alias("hot"))
    rows = materialize(base.select("row_id", "a").join(hot_rows, "row_id", "left").select(
        "row_id", "a", F.coalesce("c", F.lit(0.0)).alias("c"), "hot"), "bound-rows")
    longest = rows.agg(F.coalesce(F.max("c"), F.lit(0.0))).scalar()

    cold = cell.join(size.where((F.col("n") > 1) & (F.col("n") <= hot_limit)).select("col_id"), "col_id", "left_semi")
    cold = materialize(cold.select("row_id", "col_id", F.col("x").alias("value")), "bound-cold")
    side = rows.select("row_id", "a", "c")
    other = rows.select(F.col("row_id").alias("other_id"), F.col("a").alias("oa"), F.col("c").alias("oc"))

    # A first threshold from the top of the list: k-th best of what those rows reach at least.
    top = rows.orderBy(F.desc("a"), F.asc("row_id")).limit(k + 1)
    listed = top.agg(F.collect_list(F.struct("row_id", "a", "c")).alias("l")).scalar()       # k + 1 rows
    first = (side.select("row_id", "a", "c", F.explode(listed).alias("t"))
                 .select("row_id", "a", "c", F.col("t.row_id").alias("other_id"), F.col("t.a").alias("oa"), F.col("t.c").alias("oc"))
                 .where("row_id <> other_id"))
    mate = (cold.join(F.broadcast(top.select("row_id")), "row_id")                  # cells of those rows
                .select("col_id", F.col("row_id").alias("other_id"), F.col("value").alias("y")))
    seen = (cold.join(mate, "col_id").where("row_id <> other_id").groupBy("row_id", "other_id")
                .agg(F.sum(F.col("value") * F.col("y")).alias("p")))
    first = first.join(seen, ["row_id", "other_id"], "left").withColumn("p", F.coalesce("p", F.lit(0.0)))
    low = F.col("a") * F.col("oa") + F.col("p") - F.col("c") * F.col("oc")
    first = materialize(first.withColumn("sim", low), "bound-first")
    kth = lambda df: df.groupBy("row_id").agg(F.sort_array(F.collect_list("sim"), asc=False).alias("s"))  # noqa: E731 (k + 1 each)
    floor = kth(first).select("row_id", F.when(F.size("s") >= k, F.col("s")[k - 1]).otherwise(F.lit(-4.0)).alias("floor"))

    # Pairs that share a column: those that may still be among the best or are in the
    # part of the list that a row may read, and how many there are of each row.
    met = materialize(_met(cold, side.join(floor, "row_id"), longest), "bound-pairs")
    high = F.col("a") * F.col("oa") + F.col("p") + F.col("c") * F.col("oc")
    pairs = materialize(met.where("other_id IS NOT NULL").select("row_id", "other_id", "p")
                           .join(side.join(floor, "row_id"), "row_id").join(other, "other_id")
                           .withColumn("open", high >= F.col("floor") - SLACK).withColumn("sim", low)
                           .select("row_id", "other_id", "a", "c", "oa", "oc", "p", "sim", "open"), "bound-open")
    open_ = pairs.where("open").drop("open")
    lows = open_.select("row_id", "other_id", "sim").unionByName(first.select("row_id", "other_id", "sim"))
    floor = (_best(lows.groupBy("row_id", "other_id").agg(F.min("sim").alias("sim")), k)
             .groupBy("row_id").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
             .select("row_id", F.when(F.col("n") >= k, F.col("low")).otherwise(F.lit(-4.0)).alias("floor")))
    limit = F.when(F.col("a") > 0, (F.col("floor") - SLACK - F.col("c") * longest) / F.col("a")).otherwise(F.lit(-1.0))
    reach = materialize(side.join(floor, "row_id", "left").select(
        "row_id", "a", "c", F.coalesce("floor", F.lit(-4.0)).alias("floor")).withColumn("val", limit), "bound-floor")

    # Every row's part of the list, and the class of how many of it may not count for it.
    q = (pairs.select("row_id", "oa").join(reach.select("row_id", "val"), "row_id").where("oa >= val")
              .groupBy("row_id").agg(F.count(F.lit(1)).alias("q")))
    need = F.coalesce(F.col("q"), F.lit(0)) + k + 1
    asked = materialize(reach.join(q, "row_id", "left").select(
        "row_id", "a", "c", "val", need.alias("need"), F.when(need > k + 1, F.floor(F.log2(need / (k + 1))) + 1).otherwise(0)
        .cast("int").alias("class")), "bound-asked")
    lowest, last = asked.agg(F.min("val"), F.max("class")).first()
    last = last or 0
    most = min(DOM_LIMIT, (k + 1) << last)
    here = rows.where(F.col("row_id").isNotNull() & (F.col("a") >= F.lit(lowest))).select("row_id", "a", "c")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("a"), F.asc("row_id")]
    laid = materialize(here.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .mapInArrow(_smaller_before(most), "row_id long, a double, c double, dom long")
                           .withColumn("pid", F.spark_partition_id()), "bound-list")
    # A row is in all classes that its dom leaves it in.
    sizes = F.array(*[F.lit((k + 1) << j) for j in range(last + 1)])
    listed = (_come_before(laid, most).withColumn("dom", F.least("dom", F.lit(most)))
              .select(F.posexplode(sizes).alias("class", "size"), "row_id", "a", "c", "dom")
              .where("dom < size"))
    listed = _numbered(listed.select("class", "row_id", "a", "c", "dom"), [F.asc("class"), F.desc("a"), F.asc("row_id")], "bound-classes")
    depth = at_least(listed.select("class", F.col("a").alias("val")), asked.select("class", "row_id", "val"), "bound-reach", ("class",))
    start = listed.groupBy("class").agg(F.min("pos").alias("start"))                # one row a class
    member = listed.select("pos", F.col("row_id").alias("other_id"), F.col("a").alias("oa"), F.col("c").alias("oc"), "dom")
    if listed.count() <= SMALL_LIST:
        member = F.broadcast(member)
    read = (asked.join(depth, "row_id").join(F.broadcast(start), "class").where("reach > start")
                 .select("row_id", "a", "c", "need", F.explode(F.sequence(F.col("start"), F.col("reach") - 1)).alias("pos"))
                 .join(member, "pos").where("dom < need and row_id <> other_id"))
    # Without a hot part the similarity is known: as many as may count for the row are enough.
    plain = (F.col("c") == 0) | (F.col("oc") == 0)
    w = Window.partitionBy("row_id", "plain").orderBy(F.desc(F.round(F.col("a") * F.col("oa"), SCORE_PLACES)), F.asc("other_id"))
    lone = (read.withColumn("plain", plain).withColumn("nth", F.row_number().over(w)).where(~F.col("plain") | (F.col("nth") <= F.col("need")))
                .select("row_id", "other_id", "a", "c", "oa", "oc", F.lit(0.0).alias("p"), F.lit(False).alias("met"), F.lit(True).alias("open")))
    # A listed row that is a joined partner is dropped; dealt by row, so that the best are found where they lie.
    both = lone.unionByName(pairs.select("row_id", "other_id", "a", "c", "oa", "oc", "p", F.lit(True).alias("met"), "open")).repartition("row_id")
    partner = F.max("met").over(Window.partitionBy("row_id", "other_id"))
    cand = (both.withColumn("partner", partner).where((F.col("met") == F.col("partner")) & F.col("open"))
                .select("row_id", "other_id", "a", "c", "oa", "oc", "p"))
    sim = F.col("a") * F.col("oa") + F.col("p")
    if rows.where("c > 0").limit(1).count():
        # The hot part of the pairs that may matter, exactly.
        maps = rows.where("c > 0").select("row_id", "hot")
        cand = (cand.join(reach.select("row_id", "floor"), "row_id").where(high >= F.col("floor") - SLACK)
                    .join(maps, "row_id", "left").join(maps.select(F.col("row_id").alias("other_id"), F.col("hot").alias("ohot")), "other_id", "left"))
        sim += F.expr("if(hot is null or ohot is null, 0D, aggregate(map_entries(hot), 0D, "
                      "(s, e) -> s + e.value * coalesce(try_element_at(ohot, e.key), 0D)))")
    if stats is not None:
        runs = rows.select("a", F.when(F.col("c") > 0, F.col("row_id")).alias("own")).distinct().count()
        stats.update(pairs=met.agg(F.coalesce(F.sum("partners") / 2, F.lit(0)).cast("long")).first()[0], met=pairs.count(), opened=open_.count(), read=read.count(), rows=rows.count(), runs=runs)
    release(cell)
    out = cand.withColumn("sim", sim).select("row_id", "other_id", "sim")
    return _best(out, k)
