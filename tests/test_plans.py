"""Plan properties every registered query must keep (scale guards)."""

import re

import pytest

from affinity.plans import registry

SF = "/root/testdata/sf0.001"
FILE_QUERIES = {"csv_scan", "load_table", "etl_load_all", "etl_load_checked"}   # write files while planning


def _plan(spark, name):
    return registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stage_plans(monkeypatch):
    """Plans of every stage that is written while a query is built."""
    import affinity.session as session
    seen, write = [], session.materialize

    def spy(df, name="stage"):
        if not getattr(df, "_affinity_path", None):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    import sys
    for module in [m for n, m in sys.modules.items() if n.startswith("affinity.") and hasattr(m, "materialize")]:
        monkeypatch.setattr(module, "materialize", spy)
    return seen


@pytest.mark.parametrize("name", ["recommend_user_cf", "recommend_content", "similar_items_facets", "holdout_exact",
                                  "compare_methods", "dense_ids"])
def test_written_stages_hold_no_cross_products(spark, stage_plans, name):
    final = _plan(spark, name)
    assert stage_plans
    for plan in [*stage_plans, final]:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "BatchEvalPython" not in plan


def test_neighbour_pairs_are_computed_once(spark, stage_plans):
    final = _plan(spark, "recommend_user_cf")
    assert sum(bool(re.search(r"HashAggregate\(keys=\[u#\d+L, v#\d+L\], functions=\[sum", p)) for p in [*stage_plans, final]) == 1
    assert not any("FlatMapGroupsInPandas" in p for p in [*stage_plans, final])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - FILE_QUERIES))
def test_no_cross_products_or_row_udfs(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan          # row-at-a-time Python UDF


@pytest.mark.parametrize("name", ["user_top_rated", "items_in_genre", "first_by_key", "etl_item_cast"])
def test_per_key_top_k_has_partial_limit(spark, name):
    plan = _plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_scans_are_pruned(spark):
    plan = _plan(spark, "rating_scan")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_comment" not in s and "l_extendedprice" not in s for s in schemas)
    assert any(s.count(":") <= 4 for s in schemas)


def test_global_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "onboarding_sample")
    assert "TakeOrderedAndProject" in _plan(spark, "search_names")


@pytest.mark.parametrize("name", ["parse_nested", "etl_director", "etl_item_cast", "etl_genre"])
def test_nested_literals_parsed_once(spark, name):
    # One JSON parse and one Python pass per literal column: the fallback must
    # not be copied into the filter Spark infers for explode.
    plan = _plan(spark, name)
    assert plan.count("ArrowEvalPython") == 1
    # raw_movies is a union of clean and dirty rows: one parse in each branch.
    assert plan.count("from_json(") == (2 if name == "etl_genre" else 1)
