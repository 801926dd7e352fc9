from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.operators import progress
from tallybook.plans.contest import Contest
from tallybook.session import session_settings
from tallybook.sources.tables import attempt_log

CONTEST = Contest(start=datetime(2025, 1, 20))
LOG = (
    "attempt_id bigint, user_id string, problem_id bigint, is_correct boolean, attempted_at timestamp_ntz, "
    "query_text string, result_text string"
)


def at(day, hour=0, minute=0, second=0, micro=0):
    return datetime(2025, 1, day, hour, minute, second, micro)


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [
            (1, "ann", 1, False, at(20, 1), "q1", "r1"),
            (2, "ann", 1, True, at(20, 2), "q2", "r2"),
            (3, "ann", 1, False, at(20, 3), "q3", "r3"),
            (4, "ann", 2, True, at(20, 4), "q4", "r4"),
            (6, "ann", 4, False, at(23, 0), "q6", "r6"),
            (5, "ann", 4, True, at(23, 0), "q5", "r5"),
            (7, "bob", 1, False, at(22, 23, 59, 59, 500000), "q7", "r7"),
            (8, "bob", 1, True, at(23, 0), "q8", "r8"),
            (9, "cyd", 99, True, at(21), "q9", "r9"),
        ],
        LOG,
    )


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("start", [datetime(2025, 1, 20), datetime(2025, 1, 20, 9, 30)])
def test_rounds_are_half_open(spark, start):
    contest = Contest(start=start)
    calendar = {r["round_number"]: r for r in contest.calendar(spark).collect()}
    assert len(calendar) == 7 and calendar[1]["starts_at"] == start
    for n in range(1, 7):
        assert calendar[n]["ends_at"] == calendar[n + 1]["starts_at"]
    moments = []
    for n, r in calendar.items():
        moments += [(r["starts_at"], n), (r["ends_at"], n + 1), (r["ends_at"].replace(microsecond=1), n + 1)]
    moments.append((datetime(2025, 1, 19, 23, 59, 59, 999999), 0))
    df = spark.createDataFrame(moments, "attempted_at timestamp_ntz, want bigint")
    got = progress.assign_rounds(df, contest).collect()
    assert all(r["round_number"] == r["want"] for r in got)
    assert all(contest.round_at(r["attempted_at"]) == r["want"] for r in got)


def test_round_activity(spark, log):
    got = by(progress.round_activity(log, CONTEST), "round_number")
    assert {k: (v["attempts"], v["users"]) for k, v in got.items()} == {(1,): (6, 3), (2,): (3, 2)}


def test_round_state(spark, log):
    got = by(progress.round_state_activity(log, CONTEST, at(22, 23, 59, 59)), "user_id", "round_state")
    assert {k: v["attempts"] for k, v in got.items()} == {
        ("ann", "active"): 4, ("ann", "locked"): 2, ("bob", "active"): 1, ("bob", "locked"): 1, ("cyd", "active"): 1
    }
    closed = by(progress.round_state_activity(log, CONTEST, at(23)), "user_id", "round_state")
    assert closed[("ann", "closed")]["attempts"] == 4


def test_latest_attempt_undoes_a_solve(log):
    got = by(progress.latest_attempt(log), "user_id", "problem_id")
    ann = got[("ann", 1)]
    assert (ann["latest_correct"], ann["completed_at"], ann["last_wrong_query"], ann["last_wrong_result"]) == (
        False, None, "q3", "r3"
    )
    tie = got[("ann", 4)]
    assert (tie["attempt_id"], tie["latest_correct"]) == (6, False)
    bob = got[("bob", 1)]
    assert (bob["latest_correct"], bob["completed_at"], bob["last_wrong_query"]) == (True, at(23), None)


def test_attempt_totals(log):
    got = by(progress.attempt_totals(log), "user_id", "problem_id")
    assert sum(v["attempts"] for v in got.values()) == log.count()
    ann = got[("ann", 1)]
    assert (ann["attempts"], ann["latest_correct"], ann["ever_solved"], ann["first_solved_at"]) == (3, False, True, at(20, 2))


def test_problem_board(spark, log):
    users = spark.createDataFrame([("ann",), ("dan",), ("ann",)], "user_id string")
    board = by(progress.problem_board(users, CONTEST.problems(spark), log, CONTEST), "user_id", "problem_id")
    assert len([k for k in board if k[0] == "ann"]) == len([k for k in board if k[0] == "dan"]) == 21
    assert {k[0] for k in board} == {"ann", "dan"}
    ann = board[("ann", 1)]
    assert (ann["attempts"], ann["ever_solved"], ann["latest_correct"]) == (3, True, False)
    untried = board[("dan", 21)]
    assert (untried["attempts"], untried["ever_solved"], untried["latest_correct"], untried["round_number"]) == (0, False, False, 7)
    assert untried["completed_at"] is untried["last_wrong_query"] is None


def test_round_progress(spark, log):
    users = spark.createDataFrame([("ann",), ("dan",)], "user_id string")
    got = by(
        progress.round_progress(users, CONTEST.problems(spark), log, CONTEST, at(23)), "user_id", "round_number"
    )
    one = got[("ann", 1)]
    assert (one["problems"], one["solved"], one["round_state"]) == (3, 2, "closed")
    assert abs(one["solved_percent"] - 200 / 3) < 1e-9
    assert got[("ann", 2)]["round_state"] == "active" and got[("ann", 3)]["round_state"] == "locked"
    assert [got[("dan", n)]["solved"] for n in range(1, 8)] == [0] * 7
    assert {k[0] for k in got} == {"ann", "dan"} and len(got) == 14


def test_unknown_problem_is_on_no_board(spark, log):
    users = spark.createDataFrame([("cyd",)], "user_id string")
    board = by(progress.problem_board(users, CONTEST.problems(spark), log, CONTEST), "user_id", "problem_id")
    assert len(board) == 21 and ("cyd", 99) not in board


def test_reports_do_not_depend_on_the_session_zone(spark, log):
    def reports():
        calendar, problems = CONTEST.calendar(spark), CONTEST.problems(spark)
        return [
            sorted(map(repr, df.collect()))
            for df in (
                calendar,
                progress.round_activity(log, CONTEST),
                progress.round_state_activity(log, CONTEST, at(23)),
                progress.submission_timeliness(log, problems, calendar),
            )
        ]

    here = reports()
    with session_settings(spark, spark__sql__session__timeZone="America/New_York"):
        assert reports() == here


def test_round_without_problems_has_zero_percent(spark, log):
    users = spark.createDataFrame([("ann",)], "user_id string")
    first = CONTEST.problems(spark).where("round_number = 1")
    got = by(progress.round_progress(users, first, log, CONTEST, at(23)), "user_id", "round_number")
    assert (got[("ann", 7)]["problems"], got[("ann", 7)]["solved_percent"]) == (0, 0.0)


def test_timeliness(spark, log):
    problems, calendar = CONTEST.problems(spark), CONTEST.calendar(spark)
    got = by(progress.submission_timeliness(log, problems, calendar), "round_number")
    # Bob's last half second of round 1 is on time, its end is late; problem 4 opens exactly then.
    assert {k[0]: (v["early"], v["on_time"], v["late"]) for k, v in got.items()} == {1: (0, 5, 1), 2: (0, 2, 0)}
    accepted = progress.accepted_attempts(log, problems, calendar)
    assert sorted(r["attempt_id"] for r in accepted.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_matrix(spark, log):
    got = by(progress.user_round_matrix(log, CONTEST.problems(spark), CONTEST), "user_id")
    assert [got[("ann",)][f"round_{n}"] for n in range(1, 8)] == [2, 1, 0, 0, 0, 0, 0]
    assert (got[("ann",)]["total"], got[("bob",)]["total"], got[("cyd",)]["total"]) == (3, 1, 0)
    for row in got.values():
        assert row["total"] == sum(row[f"round_{n}"] for n in range(1, 8))


def test_graded_log(spark):
    submissions = spark.createDataFrame(
        [(1, "ann", 1, at(20), "good", "x"), (2, "ann", 1, at(21), "bad", "y"), (3, "bob", 2, at(21), "broken", "error")],
        "submission_id bigint, user_id string, problem_id bigint, attempted_at timestamp_ntz, query_text string, result_text string",
    )
    grades = spark.createDataFrame([(1, True), (2, False)], "submission_id bigint, passed boolean")
    got = by(progress.graded_log(submissions, grades), "attempt_id")
    assert [got[(i,)]["is_correct"] for i in (1, 2, 3)] == [True, False, False]
    assert (got[(1,)]["completed_at"], got[(1,)]["last_wrong_query"]) == (at(20), None)
    assert (got[(3,)]["completed_at"], got[(3,)]["last_wrong_query"], got[(3,)]["last_wrong_result"]) == (None, "broken", "error")


def test_empty_log(spark, log):
    none = log.where(F.lit(False))
    assert progress.round_activity(none, CONTEST).count() == 0
    assert progress.latest_attempt(none).count() == 0
    assert progress.user_round_matrix(none, CONTEST.problems(spark), CONTEST).count() == 0
    users = spark.createDataFrame([("ann",)], "user_id string")
    assert progress.problem_board(users, CONTEST.problems(spark), none, CONTEST).count() == 21


def test_event_without_problem_keeps_null(spark):
    events = spark.createDataFrame(
        [(1, at(20), 7, "purchase", 1.0, '{"k": 20}'), (2, at(20), 7, "view", 1.0, None), (3, at(20), 7, "view", 1.0, "{}")],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    )
    log = attempt_log(events, CONTEST)
    assert {r["attempt_id"]: r["problem_id"] for r in log.collect()} == {1: 21, 2: None, 3: None}
    assert progress.accepted_attempts(log, CONTEST.problems(spark), CONTEST.calendar(spark)).count() == 1


def test_missing_times_and_problems_beyond_the_contest(spark):
    log = spark.createDataFrame(
        [(1, 7, 1, True, None, "q", "r"), (2, 7, 101, True, at(20), "q", "r"), (3, 8, 1, False, None, "q", "r")],
        "attempt_id bigint, user_id bigint, problem_id bigint, is_correct boolean, attempted_at timestamp_ntz, "
        "query_text string, result_text string",
    )
    problems = spark.createDataFrame([(1, 1, "easy"), (101, 34, "hard")], "problem_id bigint, round_number bigint, difficulty string")
    rounds = CONTEST.calendar(spark)
    assert progress.submission_timeliness(log, problems, rounds).collect()[0][1:] == (0, 0, 0)
    assert progress.accepted_attempts(log, problems, rounds).count() == 0
    states = {(r[0], r[1]): r[2] for r in progress.round_state_activity(log, CONTEST, at(23)).collect()}
    assert states[(7, None)] == 1 and states[(8, None)] == 1
    users = log.select("user_id")
    board = {(r["user_id"], r["problem_id"]): r for r in progress.problem_board(users, problems, log, CONTEST).collect()}
    assert set(board) == {(7, 1), (7, 101), (8, 1), (8, 101)}
    assert board[(7, 101)]["ever_solved"] and board[(7, 101)]["difficulty"] == "hard"
    done = {(r["user_id"], r["round_number"]): r["solved"] for r in progress.round_progress(users, problems, log, CONTEST, at(23)).collect()}
    assert done[(7, 34)] == 1 and done[(8, 34)] == 0 and (8, 7) in done
