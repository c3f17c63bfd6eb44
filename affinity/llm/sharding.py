"""Best-fit-decreasing sharding of documents with indivisible groups.

Equal texts form a group that is never divided.  Groups are packed in levels:

1. Group weights come from one partial aggregate on the text digest, so a hot
   group costs one row per map task.
2. A *parcel* has capacity ``total / (n_shards * parcels_per_shard)``.  Groups at
   least that heavy are parcels of their own; there can be at most
   ``n_shards * parcels_per_shard`` of them.  Lighter groups are dealt to hash
   buckets of ``bucket_rows`` groups and packed best-fit-decreasing into parcels
   inside each bucket; the level repeats on parcels until their number is bounded.
3. The bounded parcel list (``MAX_ITEMS``) is packed best-fit-decreasing into the
   shards.  Items heavier than an even share of what is left get a shard alone;
   the rest share the smallest capacity at which the packing needs no more than
   the remaining shards.

Edge cases: a null text counts as the empty text (size 8, crc 0); an empty table
gives an empty result; repeated rows (same id and text) are separate members of
one group; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import gapless
from affinity.session import materialize

MAX_ITEMS = 65_536
ROW_BYTES = 8


class CapacityTree:
    """Treap of (remaining capacity, bin): balanced in expectation."""

    def __init__(self, seed: int = 7):
        self.root = None
        self.rnd = random.Random(seed)

    @staticmethod
    def _split(node, key):
        """Nodes with keys < key, nodes with keys >= key."""
        if node is None:
            return None, None
        if node[0] < key:
            a, b = CapacityTree._split(node[3], key)
            node[3] = a
            return node, b
        a, b = CapacityTree._split(node[2], key)
        node[2] = b
        return a, node

    @staticmethod
    def _merge(a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = CapacityTree._merge(a[3], b)
            return a
        b[2] = CapacityTree._merge(a, b[2])
        return b

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, [key, self.rnd.random(), None, None]), b)

    def pop_tightest(self, size: int):
        """Remove and return the smallest (remaining, bin) with remaining >= size."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            self.root = a
            return None
        parent, node = None, b
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            b = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(a, b)
        return node[0]


def best_fit(sizes: list[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin of every size (given in decreasing order); a new bin is opened only
    when none fits.  None when more than ``max_bins`` would be needed."""
    tree, out, n = CapacityTree(), [], 0
    for s in sizes:
        found = tree.pop_tightest(s)
        if found is None:
            if max_bins is not None and n == max_bins:
                return None
            found, n = (max(capacity, s), n), n + 1
        tree.add(found[0] - s, found[1])
        out.append(found[1])
    return out


def pack_shards(sizes: list[int], n_shards: int) -> list[int]:
    """Shard of every size (decreasing order), sizes as near equal as the items allow."""
    out, left, total, i = [], n_shards, sum(sizes), 0
    while i < len(sizes) and left > 1 and sizes[i] * left >= total:
        out.append(n_shards - left)                 # heavier than an even share: a shard alone
        total, left, i = total - sizes[i], left - 1, i + 1
    rest = sizes[i:]
    if not rest:
        return out
    low = max(-(-total // left), rest[0])
    step, high = max(1, low // 4096), None
    bad, cap = low - 1, low
    while (found := best_fit(rest, cap, left)) is None:
        bad, cap, step = cap, cap + step, step * 2
    best, high = found, cap
    while high - bad > max(1, low // 8192):          # smallest capacity that still needs <= left bins
        mid = (high + bad) // 2
        found = best_fit(rest, mid, left)
        if found is None:
            bad = mid
        else:
            best, high = found, mid
    return out + [n_shards - left + b for b in best]


def _pack_bucket(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(["weight", "item"], ascending=[False, True])
        bins = best_fit(p["weight"].tolist(), capacity)
        return pd.DataFrame({"item": p["item"].to_numpy(),
                             "parcel": [f"{b}-{k}" for b, k in zip(p["bucket"], bins)],
                             "weight": p["weight"].to_numpy()})
    return run


def _group_parcels(groups: DataFrame, capacity: int, bucket_rows: int, limit: int):
    """(item, parcel) for every group, and the final (parcel, weight) list."""
    spark = groups.sparkSession
    mapping, level = None, 0
    items = groups
    while True:
        light = items.where(F.col("weight") < capacity)
        n = light.count()
        n_buckets = max(1, -(-n // bucket_rows))
        packed = (light.withColumn("bucket", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(n_buckets)))
                       .repartition(int(min(n_buckets, 100_000)), "bucket").groupBy("bucket")
                       .applyInPandas(_pack_bucket(capacity), "item string, parcel string, weight long"))
        packed = packed.withColumn("parcel", F.concat(F.lit(f"{level}-"), "parcel"))
        heavy = items.where(F.col("weight") >= capacity).select("item", F.col("item").alias("parcel"), "weight")
        here = materialize(packed.unionByName(heavy), f"op8-level{level}")
        mapping = here.select("item", "parcel") if mapping is None else (
            mapping.join(here.select(F.col("item").alias("parcel"), F.col("parcel").alias("_next")), "parcel")
                   .select("item", F.col("_next").alias("parcel")))
        items = (here.groupBy(F.col("parcel").alias("item")).agg(F.sum("weight").alias("weight")))
        items = materialize(items, f"op8-items{level}")
        if items.count() <= limit or n_buckets == 1:
            return mapping, items
        level += 1


def shard_documents(docs: DataFrame, n_shards: int = 24, parcels_per_shard: int = 512,
                    bucket_rows: int = 4_000) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): groups of equal texts kept whole."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(raw).cast("long").alias("text_crc32"),
                       F.sha2(raw, 256).alias("item"))
    rows = materialize(rows, "op8-rows")
    groups = materialize(rows.groupBy("item").agg(F.sum("size").alias("weight")), "op8-groups")
    total = groups.agg(F.sum("weight")).first()[0] or 0
    capacity = max(1, -(-total // (n_shards * parcels_per_shard)))
    mapping, items = _group_parcels(groups, capacity, bucket_rows, MAX_ITEMS)
    # Bounded: at most MAX_ITEMS parcels (or one bucket of them) reach the driver.
    final = sorted(((r["weight"], r["item"]) for r in items.toLocalIterator()), key=lambda x: (-x[0], x[1]))
    shards = pack_shards([w for w, _ in final], n_shards) if final else []
    place = spark.createDataFrame([(p, int(s)) for (_, p), s in zip(final, shards)], "parcel string, shard int")
    keyed = mapping.join(F.broadcast(place), "parcel").select("item", "shard")
    placed = rows.join(keyed, "item").select("doc_id", "size", "text_crc32", "shard")
    return gapless(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", "op8-slots")


def query(spark, sf_dir: str) -> DataFrame:
    from affinity.llm.common import table
    return (shard_documents(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
