"""One-pass audit: against the single checks and plain Python, and loads that are refused."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from affinity.operators import audit, integrity
from affinity.operators.audit import Rules
from affinity.sources.files import Catalog


def _tables(spark, seed):
    rnd = random.Random(seed)
    pick = lambda *v: rnd.choice(v)
    parents = [(pick(1, 2, 3, 4, 5, None), pick("a", "b|c", "b", None)) for _ in range(30)]
    # A third of the children hold one value that has no parent.
    kids = [(i // 2, 99 if i % 3 == 0 else pick(1, 2, 7, None), pick("b|c", "zz", None), pick(-1.0, 0.0, 5.0, 5.5, None),
             pick("x" * 255, "y" * 256, None, "")) for i in range(200)]
    return ({"p": spark.createDataFrame(parents, "id int, name string"),
             "c": spark.createDataFrame(kids, "k long, ref long, who string, grade double, note string")}, parents, kids)


RULES = {"p": Rules(("id", "name"), {"pair": ("id", "name")}),
         "c": Rules(("k",), {"key": ("k",)}, (("ref", "p", "id"), ("who", "p", "name")),
                    {"grade": integrity.grade_in_range}, texts=("note",), not_null=("note",))}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_counting(spark, seed):
    tables, parents, kids = _tables(spark, seed)
    got = sorted(tuple(r) for r in audit.audit(spark, tables, RULES).collect())
    text = lambda *v: "|".join(str(x) for x in v if x is not None)
    want = []
    want += [("unique", "p", "pair", text(*k), n) for k, n in collections.Counter(parents).items() if n > 1]
    want += [("unique", "c", "key", str(k), n) for k, n in collections.Counter(r[0] for r in kids).items() if n > 1]
    for col, i, have in (("ref", 1, {p[0] for p in parents}), ("who", 2, {p[1] for p in parents})):
        n = collections.Counter(r[i] for r in kids if r[i] is not None and r[i] not in have)
        want += [("reference", "c", col, str(v), c) for v, c in n.items()]
    bad = [("check", "grade", str(r[0])) for r in kids if r[3] is not None and not 0 <= r[3] <= 5]
    bad += [("not_null", "note", str(r[0])) for r in kids if r[4] is None]
    bad += [("too_long", "note", str(r[0])) for r in kids if r[4] is not None and len(r[4]) > 255]
    want += [(kind, "c", rule, key, n) for (kind, rule, key), n in collections.Counter(bad).items()]
    assert got == sorted(want)


def test_each_table_is_read_once_and_shuffled_once(spark, tmp_path):
    tables, _, _ = _tables(spark, 4)
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    plan = audit.audit(spark, tables, RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1 and "Join" not in plan


def test_empty_tables_and_types(spark):
    empty = {"p": spark.createDataFrame([], "id int, name string"),
             "c": spark.createDataFrame([], "k long, ref long, who string, grade double, note string")}
    assert audit.audit(spark, empty, RULES).count() == 0
    assert audit.audit(spark, {}, {}).collect() == []
    with pytest.raises(TypeError):
        audit.audit(spark, {**empty, "c": empty["c"].withColumn("ref", F.lit("1"))}, RULES)


def _movies(spark, *rows):
    return spark.createDataFrame([(n, i, "en", 1, None, None, None, None) for n, i in rows],
                                 "name string, mov_id long, language string, runtime int, release_date date, "
                                 "revenue long, poster_path string, overview string")


def test_broken_load_keeps_the_old_tables(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))

    def put(load, name, df):
        return load.write(name, df, audit.metrics(audit.LOAD_RULES[name]))

    sites = lambda *ids: spark.createDataFrame([(i,) for i in ids], "web_id string")
    links = lambda *rows: spark.createDataFrame(list(rows), "mov_id long, web_id string")
    with catalog.load() as load:
        put(load, "website", sites("tt1", "tt2"))
        put(load, "movie", _movies(spark, ("a", 1), ("b", 2)))
        put(load, "link", links((1, "tt1"), (2, "tt2")))
        assert load.metrics["movie"] == {"not_null mov_id": 0, "too_long name": 0}
        audit.enforce(load)
    # A later load of parents alone is held against the children that stay.
    with pytest.raises(audit.BrokenRules) as broken:
        with catalog.load() as load:
            put(load, "movie", _movies(spark, ("x" * 256, 1), ("c", 3), ("d", 3), ("e", None)))
            assert load.metrics["movie"] == {"not_null mov_id": 1, "too_long name": 1}
            audit.enforce(load)
    assert broken.value.counts == {("unique", "movie", "primary key"): 2, ("not_null", "movie", "mov_id"): 1,
                                   ("too_long", "movie", "name"): 1, ("reference", "link", "mov_id"): 1}
    assert catalog.version() == 1
    assert sorted(r.mov_id for r in catalog.read("movie").collect()) == [1, 2]
    with catalog.load() as load:
        put(load, "movie", _movies(spark, ("a", 1), ("b", 2), ("c", 3)))
        put(load, "link", links((3, "tt1")).limit(0))
        assert set(load.metrics["link"].values()) <= {0}
        audit.enforce(load)
    assert catalog.version() == 2 and catalog.read("link").count() == 0
