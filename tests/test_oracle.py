import pytest

import __spark_entry__ as registry
from tests import oracle

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(registry.core_queries()) == set(registry.core_sql())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.core_queries()))
def test_query_matches_sql(spark, con, name):
    df = registry.core_queries()[name](spark, SF)
    assert oracle.compare(df, con, registry.core_sql()[name]) == []


ORDERED = [
    "count_by_group", "max_by_group", "bucket_high_low", "date_parts", "tenure_months", "join_lookup",
    "group_count_keep_empty", "group_count_rich_suppliers", "join_average", "three_way_join", "three_way_join_plain",
    "three_way_join_large_orders", "distinct_groups_keep_empty", "distinct_groups_large_returns", "shared_project_count",
    "shared_project_large_returns", "cte_group_filter_join", "period_increase", "period_increase_window",
    "top_two_and_overall_rank",
]
# Reports whose SQL has no order of its own, with the columns they are sorted by.
SORTED = {"round_progress": ["user_id", "round_number"], "problem_board": ["user_id", "problem_id"], "user_round_matrix": ["user_id"]}


@pytest.mark.parametrize("name", SORTED)
def test_report_is_sorted(spark, name):
    rows = [tuple(r) for r in registry.core_queries()[name](spark, SF).select(*SORTED[name]).collect()]
    assert rows == sorted(rows)


@pytest.mark.parametrize("name", ORDERED)
def test_order_matches_sql(spark, con, name):
    df, sql = registry.core_queries()[name](spark, SF), registry.core_sql()[name]
    names = [r[0] for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    assert [tuple(r) for r in df.select(*names).collect()] == con.execute(sql).fetchall()
