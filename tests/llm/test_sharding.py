import zlib

import numpy as np
import pytest

from affinity.llm import sharding as S


def linear_best_fit(sizes, capacity):
    """Best fit by scanning all bins."""
    room, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        i = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(max(capacity, s))
        room[i] -= s
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_tree_packs_like_a_scan(seed):
    g = np.random.default_rng(seed)
    sizes = sorted(g.integers(1, 60, 300).tolist(), reverse=True)
    assert S.best_fit(sizes, 100) == linear_best_fit(sizes, 100)


def test_best_fit_gives_up_at_max_bins():
    assert S.best_fit([5, 5, 5], 5, 2) is None


def test_pack_shards_is_near_equal_and_isolates_giants():
    g = np.random.default_rng(1)
    sizes = sorted(g.integers(1, 1000, 4000).tolist() + [3_000_000], reverse=True)
    at = S.pack_shards(sizes, 6)
    load = np.bincount(at, weights=sizes, minlength=6)
    assert sorted(load)[-1] == 3_000_000                    # alone
    rest = sorted(load)[:-1]
    assert rest[-1] - rest[0] <= 0.01 * rest[-1]


def rows_of(spark, docs, **kw):
    return [r.asDict() for r in S.shard_documents(docs, **kw).collect()]


def test_groups_whole_slots_gapless(spark):
    texts = ["a" * (i % 37) + str(i % 50) for i in range(400)] + ["hot text"] * 300 + [None, "", None]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, item string, shard int, size string")
    out = rows_of(spark, docs, n_shards=5, parcels_per_shard=8, bucket_rows=7)
    assert sorted(r["doc_id"] for r in out) == list(range(len(texts)))
    where = {}
    for r in out:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 8 and r["text_crc32"] == zlib.crc32(t.encode())
        where.setdefault(t, set()).add(r["shard"])
    assert all(len(v) == 1 for v in where.values())
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_shares_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    load = {}
    for r in rows_of(spark, docs):
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
    assert set(load) == set(range(24)) and max(load.values()) - min(load.values()) <= 0.02 * max(load.values())


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "t"), (1, "t"), (None, "t")], "doc_id long, text string")
    out = rows_of(spark, docs, n_shards=2)
    assert len(out) == 3 and len({r["shard"] for r in out}) == 1 and sorted(r["slot"] for r in out) == [0, 1, 2]
    assert rows_of(spark, docs.limit(0)) == []
