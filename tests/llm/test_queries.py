import pytest

import __spark_entry__ as E
from affinity.llm import queries

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op4": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
            "base_score": "double", "score": "double"},
    "op6": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
            "grown_shard": "int"},
    "op9": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op10": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
             "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op12": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op13": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
             "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
}


def test_names_and_registration():
    assert [n.split("_")[0] for n in sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))] == \
        [f"op{i}" for i in range(1, 14)]
    assert set(queries.queries()) | {"pipeline"} <= set(E.queries())
    assert set(queries.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in queries.queries() if n.split("_")[0] in CONTRACT))
def test_contract_columns(spark, name):
    got = dict(queries.queries()[name](spark, SF).dtypes)
    want = CONTRACT[name.split("_")[0]]
    assert {k: got.get(k) for k in want} == want


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    res = duck.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(res.fetchall(), key=repr)
