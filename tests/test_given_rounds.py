"""Windows given as rows: look-up by sweep and by cells, rounds as columns, running numbers, EXISTS."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook.operators import joins, progress
from tallybook.plans import intervals

START = datetime(2024, 3, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def held(points, windows):
    return sorted((p, w) for p, t in points for w, s, e in windows if None not in (t, s, e) and s <= t < e)


def cases():
    rnd = random.Random(5)
    some = [(i, at(rnd.randrange(-50, 4000))) for i in range(300)]
    hot = [(1000 + i, at(700)) for i in range(400)]  # one instant with most points
    gapped = [(1, at(0), at(100)), (2, at(100), at(101)), (3, at(500), at(2000)), (4, None, at(9)), (5, at(9), at(9)), (6, at(9), at(3))]
    crossing = [(i, at(a := rnd.randrange(3000)), at(a + rnd.randrange(900))) for i in range(40)]
    edges = [(5000 + i, at(m)) for i, m in enumerate([0, 99, 100, 101, 499, 500, 1999, 2000])] + [(6000, None)]
    return [(some + hot + edges, gapped), (some + hot + edges, crossing), (some, []), ([], gapped)]


@pytest.mark.parametrize("layout,ranges", [(intervals.SWEEP, None), (intervals.SWEEP, 5), (intervals.CELLS, None)])
@pytest.mark.parametrize("case", range(4))
def test_held_by(spark, layout, ranges, case):
    points, windows = cases()[case]
    p = spark.createDataFrame(points, "point long, t timestamp_ntz")
    w = spark.createDataFrame(windows, "name long, s timestamp_ntz, e timestamp_ntz")
    found = intervals.held_by(p, "t", "point", w, "s", "e", layout, ranges, cell_seconds=3600)
    assert sorted((r["point"], r["name"]) for r in found.collect()) == held(points, windows)


@pytest.mark.parametrize("ranges", [None, 5])
def test_activity_of_many_open_rounds(spark, ranges):
    rnd = random.Random(8)
    log = [(i, rnd.choice([1, 2, 3, 4, 5, 6, 7, None]), at(rnd.randrange(-100, 5000))) for i in range(500)]
    log += [(1000 + i, i % 40, at(700)) for i in range(300)] + [(2000, 1, None), (2001, 9, at(9000))]
    rounds = [(i, at(a := rnd.randrange(4000)), at(a + rnd.choice([-5, 0, 1, 30, 600, 4000]))) for i in range(400)]
    rounds += [(400, None, at(5)), (401, at(5), None), (None, at(0), at(900)), rounds[7], rounds[8], rounds[8]]
    rounds += [(402, at(0), at(50)), (402, at(40), at(90)), (402, at(2000), at(2100))]  # one number, several times
    per = {}
    for n, s, e in rounds:
        inside = [u for _, u, t in log if None not in (n, s, e, t) and s <= t < e]
        so_far, users = per.get(n, (0, set()))
        per[n] = so_far + len(inside), users | {u for u in inside if u is not None}
    want = [(n, s, e, per[n][0], len(per[n][1])) for n, s, e in rounds]
    found = progress.given_round_activity(
        spark.createDataFrame(log, "attempt_id long, user_id long, attempted_at timestamp_ntz"),
        spark.createDataFrame(rounds, "round_number long, starts_at timestamp_ntz, ends_at timestamp_ntz"), ranges=ranges,
    )
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_open_rounds_do_not_multiply_attempts(spark):
    users, open_rounds = 200, 300
    log = spark.range(users * 10).selectExpr("id AS attempt_id", f"id % {users} AS user_id", "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, id % 997) AS attempted_at")
    rounds = spark.range(open_rounds).selectExpr(
        "id AS round_number", "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, id) AS starts_at", "timestamp_ntz'2024-03-02' + make_dt_interval(0, 0, id) AS ends_at"
    )
    written = []
    kept = intervals.written_table

    def counting(df, label):
        table = kept(df, label)
        written.append(table.count())
        return table

    with pytest.MonkeyPatch.context() as patch:
        for module in ("intervals", "ordering"):
            patch.setattr(f"tallybook.plans.{module}.written_table", counting)
        patch.setattr("tallybook.operators.progress.held_by", lambda *_: pytest.fail("attempts are paired with rounds"))
        found = progress.given_round_activity(log, rounds)
        assert found.where("attempts > 0 AND users = 200").count() == open_rounds
    assert max(written) < 10 * (users * 10 + open_rounds * 4)  # 600,000 pairs


def test_rounds_become_columns(spark):
    log = spark.createDataFrame([(1, 1, True), (1, 2, True), (1, 9, True), (2, 1, False), (3, 3, True)], "user_id long, problem_id long, is_correct boolean")
    problems = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "problem_id long, round_number long")
    rounds = spark.createDataFrame([(n,) for n in range(10, 100, 10)], "round_number long")
    found = progress.matrix_of_rounds(log, problems, rounds)
    assert len(found.columns) == 11
    rows = {r["user_id"]: r.asDict() for r in found.collect()}
    assert {u: r["total"] for u, r in rows.items()} == {1: 2, 2: 0, 3: 0}
    assert all(r["total"] == sum(v for k, v in r.items() if k.startswith("round_")) for r in rows.values())


def test_numbers_go_on(spark):
    schema = "attempt_id long, user_id long, problem_id long, attempted_at timestamp_ntz"
    old = spark.createDataFrame([(1, 1, 1, at(0)), (2, 1, 1, at(1)), (3, 2, 1, at(1))], schema)
    new = spark.createDataFrame([(4, 1, 1, at(3)), (5, 1, 1, None), (6, 1, 2, at(2)), (7, 3, 1, at(2))], schema)
    found = {r["attempt_id"]: r["attempt_no"] for r in progress.numbered_onto(new, old).collect()}
    assert found == {5: 3, 4: 4, 6: 1, 7: 1}


def test_exists_needs_no_nested_loop(spark):
    dept = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    pairs = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (2, 8), (None, 8), (3, None)], "d int, p int")
    shared = joins.shared_project_exists(dept, pairs, "id", "d", "p")
    assert [tuple(r) for r in shared.collect()] == [(1, "a", 1), (2, "b", 1), (3, "c", 0)]
    plan = shared._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_newest_attempts_need_no_sort(spark):
    import __spark_entry__ as registry

    for name in ("latest_attempt", "problem_board", "problem_board_told", "attempt_totals"):
        plan = registry.core_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "SortAggregate" not in plan, name


def test_rules_in_one_pass(spark):
    import __spark_entry__ as registry
    from tallybook.operators import quality

    plan = registry.constraint_report(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and plan.count("customer.parquet") == 1 and plan.count("part.parquet") == 1
    t = spark.createDataFrame([(1, "x", 5), (1, None, 6), (None, "x", 5), (2, "x", 9), (2, "x", 9), (3, "y", None)], "a int, b string, c int")
    parent = spark.createDataFrame([(5,), (5,), (None,)], "k int")
    rules = quality.Rules("t", ("a", "b"), (("a",), ("a", "b")), (("c", parent, "k"),))
    assert [tuple(r) for r in quality.table_report(t, rules).collect()] == [
        ("not_null", "t.a", 1), ("not_null", "t.b", 1), ("unique", "t.a", 2), ("unique", "t.a+b", 1), ("foreign_key", "t.c", 3),
    ]
    empty = [r["violations"] for r in quality.table_report(t.limit(0), rules).collect()]
    assert empty == [0] * 5
    assert quality.table_report(t.withColumn("_x", F.lit(1)), rules).count() == 5
