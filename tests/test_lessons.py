"""The lesson queries on the small teaching tables, with the order of the rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallybook.operators import joins, lessons, ranking

# The teaching tables.
BASIC = [("Alice", "IT", 60000), ("Bob", "HR", 55000), ("Carol", "IT", 65000)]
FILTER = [*BASIC, ("David", "Marketing", 58000)]
GROUP = [*FILTER, ("Eve", "IT", 62000)]
HIRED = [
    ("Alice", 60000, date(2023, 1, 15)),
    ("Bob", 55000, date(2023, 2, 20)),
    ("Carol", 65000, date(2023, 3, 10)),
    ("David", 58000, date(2023, 4, 5)),
]
DEPARTMENTS = [(1, "IT"), (2, "HR"), (3, "Marketing")]
PLACED = [(1, "Alice", 1), (2, "Bob", 2), (3, "Carol", 1), (4, "David", 3)]
PAID = [(1, "Alice", 1, 60000), (2, "Bob", 2, 55000), (3, "Carol", 1, 65000), (4, "David", 3, 58000)]
ASSIGNED = [("Alice", 1, 1), ("Bob", 2, None), ("Carol", 1, 2), ("David", 3, 1)]
ASSIGNED_ALL = [("Alice", 1, 1), ("Bob", 2, 1), ("Carol", 1, 2), ("David", 3, 1)]
PROJECTS = [(1, "Alpha"), (2, "Beta"), (3, "Gamma")]
CTE_PAID = [
    (1, "Alice", 1, 62000), (2, "Bob", 2, 55000), (3, "Carol", 1, 65000), (4, "David", 2, 57000), (5, "Eve", 1, 63000)
]
RANKED = [*CTE_PAID, (6, "Frank", 3, 59000), (7, "Grace", 3, 61000)]
HISTORY = [
    (1, date(2024, 1, 15), 62000), (1, date(2024, 2, 15), 65000), (2, date(2024, 1, 15), 55000),
    (2, date(2024, 2, 15), 55000), (3, date(2024, 1, 15), 58000), (3, date(2024, 2, 15), 61000),
]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def make(spark):
    def _make(data, schema):
        return spark.createDataFrame(data, schema)

    return _make


@pytest.fixture(scope="module")
def dept(make):
    return make(DEPARTMENTS, "id int, dept_name string")


STAFF = "name string, department string, salary int"
PAY = "eid int, name string, dept_id int, salary int"


def test_projection(make):
    t = make(BASIC, STAFF)
    assert rows(lessons.project(t, "name")) == [("Alice",), ("Bob",), ("Carol",)]
    assert rows(lessons.project(t, "name", "department")) == [r[:2] for r in BASIC]
    assert rows(lessons.project(t)) == BASIC


def test_filters(make):
    t = make(FILTER, STAFF)
    assert rows(lessons.filter_equal(t, "department", "IT").select("name")) == [("Alice",), ("Carol",)]
    at_least = lessons.filter_at_least(t, "salary", 60000).select("name", "salary")
    assert rows(at_least) == [("Alice", 60000), ("Carol", 65000)]
    both = lessons.filter_both(t, "department", "IT", "salary", 63000).select("name", "salary")
    assert rows(both) == [("Carol", 65000)]


def test_groups(make):
    t = make(GROUP, STAFF)
    assert rows(lessons.count_by_group(t, "department")) == [("HR", 1), ("IT", 3), ("Marketing", 1)]
    above = rows(lessons.groups_above_average(t, "department", "salary", 60000))
    assert [(d, round(a, 2)) for d, a in above] == [("IT", 62333.33)]
    assert rows(lessons.max_by_group(t, "department", "salary")) == [("IT", 65000), ("Marketing", 58000), ("HR", 55000)]


def test_conditions_and_dates(make):
    t = make(HIRED, "name string, salary int, hire_date date")
    level = lessons.bucket_high_low(t, "salary", 60000, "name", "name", "level").select("name", "salary", "level")
    assert rows(level) == [
        ("Alice", 60000, "High"), ("Bob", 55000, "Low"), ("Carol", 65000, "High"), ("David", 58000, "Low")
    ]
    parts = lessons.date_parts(t, "hire_date", "name").select("name", "year", "month")
    assert rows(parts) == [("Alice", "2023", "01"), ("Bob", "2023", "02"), ("Carol", "2023", "03"), ("David", "2023", "04")]
    stamped = t.withColumn("hire_date", F.col("hire_date").cast("timestamp_ntz"))
    as_of = F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz")
    months = lessons.tenure_months(stamped, "name", "hire_date", as_of, "name").select("name", "months_30d")
    assert rows(months) == [("ALICE", 24.0), ("BOB", 23.0), ("CAROL", 22.0), ("DAVID", 21.0)]


def test_missing_salary_is_low(make):
    t = make([("Zoe", None)], "name string, salary int")
    assert rows(lessons.bucket_high_low(t, "salary", 1, "name", "name").select("level")) == [("Low",)]


def test_joins(make, dept):
    placed = make(PLACED, "eid int, name string, dept_id int")
    named = joins.join_lookup(placed, dept, "dept_id", "id").select("name", "dept_name").orderBy("dept_name", "name")
    assert rows(named) == [("Bob", "HR"), ("Alice", "IT"), ("Carol", "IT"), ("David", "Marketing")]
    four = make([*DEPARTMENTS, (4, "Finance")], "id int, dept_name string")
    counts = joins.group_count_keep_empty(four, placed, "id", "dept_id", "eid").orderBy("dept_name")
    assert rows(counts.select("dept_name", "row_count")) == [("Finance", 0), ("HR", 1), ("IT", 2), ("Marketing", 1)]
    averages = joins.join_average(four, make(PAID, PAY), "id", "dept_id", "salary")
    assert rows(averages.select("dept_name", "avg_value")) == [("IT", 62500.0), ("Marketing", 58000.0), ("HR", 55000.0)]


def test_projects(make, dept):
    projects = make(PROJECTS, "pid int, proj_name string")
    some = make(ASSIGNED, "name string, dept_id int, proj_id int")
    three = joins.three_way_join(some, dept, projects, "dept_id", "id", "proj_id", "pid").orderBy("name")
    assert rows(three.select("name", "dept_name", "proj_name")) == [
        ("Alice", "IT", "Alpha"), ("Bob", "HR", None), ("Carol", "IT", "Beta"), ("David", "Marketing", "Alpha")
    ]
    everyone = make(ASSIGNED_ALL, "name string, dept_id int, proj_id int")
    counts = joins.distinct_groups_keep_empty(projects, everyone, "pid", "proj_id", "dept_id").orderBy("proj_name")
    assert rows(counts.select("proj_name", "group_count")) == [("Alpha", 3), ("Beta", 1), ("Gamma", 0)]
    shared = joins.shared_project_count(dept, everyone, "id", "dept_id", "proj_id")
    assert rows(shared.select("dept_name", "shared_projects")) == [("IT", 1), ("HR", 1), ("Marketing", 1)]


def test_shared_projects_with_nobody_and_repeats(make, dept):
    pairs = make([(1, 1), (1, 1), (2, 1), (2, 2), (2, 2), (None, 1), (1, None)], "dept_id int, proj_id int")
    shared = joins.shared_project_count(dept, pairs, "id", "dept_id", "proj_id")
    assert sorted(rows(shared.select("id", "shared_projects"))) == [(1, 1), (2, 1), (3, 0)]


def test_group_filter(make, dept):
    t = joins.cte_group_filter_join(make(CTE_PAID, PAY), dept, "dept_id", "id", "salary", 60000, "eid")
    assert rows(t.select("name", "dept_name", "salary")) == [
        ("Carol", "IT", 65000), ("Eve", "IT", 63000), ("Alice", "IT", 62000)
    ]


def test_increase(make):
    history = make(HISTORY, "employee_id int, payment_date date, salary int").withColumn("tie", F.col("payment_date"))
    names = make([(1, "Alice"), (2, "Bob"), (3, "Carol")], "id int, name string")
    t = ranking.period_increase(history, names, "employee_id", "payment_date", "tie", "salary", "id")
    assert rows(t.select("name", "payment_date", "previous_value", "salary", "increase_percent")) == [
        ("Carol", date(2024, 2, 15), 58000, 61000, 5.2), ("Alice", date(2024, 2, 15), 62000, 65000, 4.8)
    ]


def test_increase_from_zero_has_no_percentage(make):
    history = make([(1, 1, 0), (1, 2, 5)], "e int, at int, v int").withColumn("tie", F.col("at"))
    t = ranking.period_increase(history, make([(1, "A")], "id int, name string"), "e", "at", "tie", "v", "id")
    assert rows(t.select("v", "increase_percent")) == [(5, None)]


def test_top_two(make, dept):
    t = ranking.top_k_and_overall_rank(make(RANKED, PAY), dept, "dept_id", "id", "salary", 2, "eid", "dept_name")
    assert rows(t.select("name", "dept_name", "salary", "group_rank", "overall_rank")) == [
        ("David", "HR", 57000, 1, 6), ("Bob", "HR", 55000, 2, 7), ("Carol", "IT", 65000, 1, 1),
        ("Eve", "IT", 63000, 2, 2), ("Grace", "Marketing", 61000, 1, 4), ("Frank", "Marketing", 59000, 2, 5),
    ]


def test_empty_inputs(make, dept):
    none = make([], PAY)
    assert rows(joins.group_count_keep_empty(dept, none, "id", "dept_id", "eid").select("row_count")) == [(0,)] * 3
    assert rows(joins.join_average(dept, none, "id", "dept_id", "salary")) == []
    assert rows(ranking.top_k_and_overall_rank(none, dept, "dept_id", "id", "salary", 2, "eid", "dept_name")) == []
    assert rows(joins.cte_group_filter_join(none, dept, "dept_id", "id", "salary", 1, "eid")) == []
    assert rows(lessons.count_by_group(none, "dept_id")) == []
