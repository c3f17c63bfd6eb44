"""Name search by trigrams and the incremental merge of rating changes."""

import os

from affinity.operators import changes, name_index


def test_index_finds_what_ilike_finds(spark, tmp_path):
    names = ["Red Widget", "red widget two", "REDWIDGET", "ab", "100% cotton_shirt", "Étoile", None, "", "aaaa", "x%y_z", "wid"]
    rows = [(e, i, n) for e in ("movie", "cast") for i, n in enumerate(names)] + [("movie", 50 + i, f"Item {i:03d} red") for i in range(40)]
    df = spark.createDataFrame(rows, "entity string, id long, name string")
    path = str(tmp_path / "ix")
    name_index.build_index(df, path)
    for text in ("red", "RED_wid", "wid%two", "%", "", "ab", "étoile", "00% cot", "aaa", "tem 01", "_", "red%03", "nothing here", "x%y"):
        want = df.where(df["name"].ilike(f"%{text}%")).orderBy("id").collect()
        want = sorted(tuple(r) for e in ("movie", "cast") for r in [w for w in want if w["entity"] == e][:10])
        assert sorted(map(tuple, name_index.search(spark, path, text).collect())) == want, text
    assert name_index.candidates(spark, path, "a_b%c") is None            # no three fixed characters
    assert name_index.candidates(spark, path, "ed wid").count() == 4
    plan = name_index.candidates(spark, path, "red")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "snap")
    old = spark.createDataFrame([(m, u, 3.0, None) for m in range(20) for u in range(10)] + [(999, 1, 1.0, "x")],
                                "mov_id long, user_id long, grade double, review string")
    changes.write_snapshot(old, path, 256)
    log = spark.createDataFrame([(1, 1, "update", 5.0, "r", 1, 1), (2, 2, "delete", None, None, 1, 2), (77, 7, "upsert", 4.0, None, 1, 3),
                                 (999, 1, "delete", None, None, 1, 4), (5, 500, "update", 2.0, None, 1, 5)],
                                "mov_id long, user_id long, op string, grade double, review string, ts long, seq long")
    want = sorted(map(tuple, changes.apply_rating_changes(old, log).collect()), key=repr)
    files = lambda: {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs
                     if f.endswith(".parquet") and "part=" in r}
    before = files()
    n = changes.merge_rating_changes(spark, path, log, 256)
    after = files()
    assert sorted(map(tuple, changes.read_snapshot(spark, path).collect()), key=repr) == want
    assert 1 <= n <= 5
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(kept) >= len(before) - n and len(before) > 100
    assert changes.merge_rating_changes(spark, path, log.limit(0), 256) == 0 and files() == after
