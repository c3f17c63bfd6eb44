"""ETL dedupe, integrity checks and the change fold on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from affinity.operators import changes, etl, integrity, lookup


def test_first_by_key_keeps_exactly_first(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 3, "d"), (1, 4, "e")],
                               "k long, pos long, v string")
    got = sorted((r.k, r.v) for r in etl.first_by_key(df, ["k"], ["pos"]).collect())
    assert got == [(1, "a"), (2, "d")]


def test_etl_item_rejects(spark):
    raw = spark.createDataFrame(
        [("A", "1", "en", "81.0", "", "100", "", "", 0), ("B", "x", "en", "90", "", "", "", "", 1),
         ("C", "2", "en", "abc", "", "", "", "", 2), ("A2", "1", "en", "70", "", "", "", "", 3)],
        "title string, id string, original_language string, runtime string, release_date string, "
        "revenue string, poster_path string, overview string, pos long")
    items = etl.etl_item(raw).collect()
    assert [(r.mov_id, r.name, r.runtime, r.revenue, r.overview) for r in items] == [(1, "A", 81, 100, None)]
    rej = sorted((r.pos, r.reason) for r in etl.reject_malformed(raw).collect())
    assert rej == [(1, "bad_id"), (2, "bad_runtime")]


def test_check_null_passes(spark):
    g = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 5.0), (4, 5.5), (5, None)], "k long, grade double")
    tomorrow = dt.date.today() + dt.timedelta(days=1)
    b = spark.createDataFrame([(1, dt.date(1899, 12, 31)), (2, dt.date(1900, 1, 1)), (3, dt.date(1950, 1, 1)),
                               (4, tomorrow), (5, None)], "k long, birthday date")
    v = integrity.check_violations([
        ("rate", "grade", g, ["k"], integrity.grade_in_range()),
        ("user", "birthday", b, ["k"], integrity.birthday_in_range())]).collect()
    assert sorted((r.tbl, r.key) for r in v) == [("rate", "1"), ("rate", "4"), ("user", "1"),
                                                 ("user", "2"), ("user", "4")]


def test_fk_null_passes_and_pk(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 99)], "id long, ref long")
    parent = spark.createDataFrame([(10,)], "ref long")
    v = integrity.fk_violations([("child", child, "ref", parent, "ref")]).collect()
    assert [(r.value, r.n) for r in v] == [("99", 2)]
    pk = integrity.pk_violations({"child": (child, ["ref"])}).collect()
    assert sorted((r.key, r.n) for r in pk) == [("99", 2)]


def test_domain_violations(spark):
    df = spark.createDataFrame([(1, "x" * 256, "u1"), (2, "ok", None)], "id long, name string, username string")
    v = integrity.domain_violations([("u", df, ["id"], "name", False), ("u", df, ["id"], "username", True)])
    assert sorted((r.col, r.rule, r.key) for r in v.collect()) == [("name", "too_long", "1"),
                                                                   ("username", "not_null", "2")]


def test_apply_rating_changes(spark):
    snap = spark.createDataFrame([(1, 1, 3.0, None), (2, 1, 4.0, None), (3, 1, 2.0, "r")],
                                 "mov_id long, user_id long, grade double, review string")
    ts = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        (1, 1, "update", 5.0, "u", ts, 1),                       # existing -> updated
        (2, 1, "delete", None, None, ts, 2), (2, 1, "update", 1.0, "x", ts, 3),  # delete wins
        (4, 1, "update", 2.0, "x", ts, 4),                       # absent: update is a no-op
        (5, 1, "upsert", 1.0, "a", ts, 5), (5, 1, "update", 2.0, "b", ts, 6),    # insert then update
        (6, 1, "upsert", 1.0, "a", ts, 7), (6, 1, "delete", None, None, ts, 8),  # insert then delete
    ], "mov_id long, user_id long, op string, grade double, review string, ts timestamp, seq long")
    got = sorted(tuple(r) for r in changes.apply_rating_changes(snap, log).collect())
    assert got == [(1, 1, 5.0, "u"), (3, 1, 2.0, "r"), (5, 1, 2.0, "b")]


def test_append_new_users(spark):
    existing = spark.createDataFrame([(7, "ann", "Ann")], "user_id long, username string, name string")
    signups = spark.createDataFrame([("bob", "Bob", 5), ("ann", "Ann2", 1), ("cy", "Cy", 2), ("bob", "B2", 9)],
                                    "username string, name string, seq long")
    got = sorted(tuple(r) for r in changes.append_new_users(existing, signups).collect())
    assert got == [(7, "ann", "Ann"), (8, "cy", "Cy"), (9, "bob", "Bob")]


def test_search_wildcards_and_case(spark):
    m = spark.createDataFrame([(1, "Red_Widget"), (2, "red widget"), (3, "100% cotton"), (4, "blue")],
                              "mov_id long, name string")
    empty = spark.createDataFrame([], "cast_id long, name string")
    d = spark.createDataFrame([], "director_id long, name string")
    ids = lambda q: sorted(r.id for r in lookup.search_names(m, empty, d, q).collect())
    assert ids("RED_W") == [1, 2]          # '_' matches any one character
    assert ids("0%c") == [3]               # '%' is a wildcard
    assert ids("BLUE") == [4]


def test_point_lookup_is_pushed_down(spark):
    from affinity.sources import testdata as td
    df = lookup.item_by_id(td.movies(spark, "/root/testdata/sf0.001"), [3, 5])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(p_partkey" in plan
    assert sorted(r.mov_id for r in df.collect()) == [3, 5]


def test_rating_lines_agree_for_every_projection(spark, tmp_path):
    from affinity.sources import files
    p = tmp_path / "r.csv"
    p.write_text("1,10,3.5\n2,10\nx,10,4\n3,11,5.0\n3,y,1\n3,11,4,9\n\n")
    good, bad = files.read_rating_lines(spark, str(p))
    assert sorted(tuple(r) for r in good.collect()) == [(1, 10, 3.5), (3, 11, 5.0)]
    assert good.count() == 2 and sorted(r.mov_id for r in good.select("mov_id").collect()) == [1, 3]
    assert good.select("grade").count() == 2 and bad.count() == 4
    assert sorted(r.bad_line for r in bad.collect()) == ["2,10", "3,11,4,9", "3,y,1", "x,10,4"]


def test_exact_holdout(spark):
    from affinity.operators import ranking
    rows = [(u, m, float(u % 5)) for u in range(40) for m in range(30)] + [(1, 1, 2.0)]
    df = spark.createDataFrame(rows, "user_id long, mov_id long, grade double")
    for n in (0, 1, 137, 1200, 5000):
        train, test = ranking.holdout_exact(df, n)
        assert test.select("user_id", "mov_id").distinct().count() == min(n, 1200)
        assert train.count() + test.count() == len(rows)
        assert train.join(test, ["user_id", "mov_id"]).count() == 0


def test_bad_dates_and_revenues_are_rejected(spark):
    raw = spark.createDataFrame(
        [("A", "1", "en", "81.0", "1995-02-30", "", "", "", 0), ("B", "2", "en", "90", "", "12,5", "", "", 1),
         ("C", "3", "en", "90", "1995-12-17", "7", "", "", 2)],
        "title string, id string, original_language string, runtime string, release_date string, "
        "revenue string, poster_path string, overview string, pos long")
    assert [(r.mov_id, str(r.release_date), r.revenue) for r in etl.etl_item(raw).collect()] == [(3, "1995-12-17", 7)]
    assert sorted((r.pos, r.reason) for r in etl.reject_malformed(raw).collect()) == [(0, "bad_release_date"), (1, "bad_revenue")]


def test_onboarding_folds_first_ratings(spark):
    snap = spark.createDataFrame([(1, 1, 3.0, "r")], "mov_id long, user_id long, grade double, review string")
    users = spark.createDataFrame([(1,), (7,)], "user_id long")
    movies = spark.createDataFrame([(i, f"m{i}") for i in range(30)], "mov_id long, name string")
    got = changes.onboard_user(snap, users, movies, 8).collect()
    new = [r for r in got if r.user_id == 8]
    assert len(got) == 9 and len(new) == 8 and all(1 <= r.grade <= 5 for r in new)


def test_a_table_with_several_references_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    child = spark.createDataFrame([(1, 10), (2, 20), (2, None), (3, 30)], "a long, b long").mapInArrow(count, "a long, b long")
    left, right = spark.createDataFrame([(1,), (3,), (3,)], "k long"), spark.createDataFrame([(10,)], "k long")
    got = integrity.fk_violations([("t", child, "a", left, "k"), ("t", child, "b", right, "k")]).collect()
    assert sorted(tuple(r) for r in got) == [("t", "a", "2", 2), ("t", "b", "20", 1), ("t", "b", "30", 1)]
    assert seen.value == 4
