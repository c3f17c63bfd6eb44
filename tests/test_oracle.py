"""Every registered query with an oracle must equal its DuckDB SQL (sf0.001)."""

import math

import pytest

import __spark_entry__ as E
from affinity.plans import oracle, registry

SF_SMALL = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, f"{round(v, 6):.6f}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat()[:19])
    return (1, str(v))


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_query_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle.sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(oracle.sql())))
def test_rows_only_queries_run(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rank", "mov_id", "name", "score", "n"]
