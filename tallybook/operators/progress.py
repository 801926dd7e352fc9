"""Reports over an attempt log, for all users in one job.

A log has one row per attempt: ``attempt_id, user_id, problem_id, is_correct, attempted_at,
query_text, result_text``. Every report first reduces the log to one row per user and problem, or
per user and round, in an aggregate that combines before the shuffle. A user with a third of all
attempts is then a handful of rows.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.functions.numbers import percent
from tallybook.functions.times import moment
from tallybook.plans.contest import Contest
from tallybook.plans.durable import written_table
from tallybook.plans.intervals import SWEEP, counted_in, held_by


def _place_in_time() -> Column:
    """Time, then id, as one number of fixed width, so that aggregates over it need no sort.

    Ids have up to 19 digits; a missing time comes before all others.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("attempted_at"))
    shift = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    moved = F.coalesce(micros, F.lit(-(10**17))).cast("decimal(18,0)") * shift
    return (moved + F.col("attempt_id").cast("decimal(19,0)")).cast("decimal(38,0)")


def _newest(name: str) -> Column:
    """A column of the newest attempt of a group."""
    return F.max_by(name, _place_in_time()).alias(name)


def _outcome(correct: Column) -> list[Column]:
    """What the newest attempt leaves behind; the texts are kept for wrong ones only."""
    return [
        F.coalesce(correct, F.lit(False)).alias("latest_correct"),
        F.when(correct, F.col("attempted_at")).alias("completed_at"),
        F.when(~correct, F.col("query_text")).alias("last_wrong_query"),
        F.when(~correct, F.col("result_text")).alias("last_wrong_result"),
    ]


def _numbers(last: int) -> Column:
    return F.sequence(F.lit(1).cast("bigint"), F.lit(last).cast("bigint"))


def assign_rounds(log: DataFrame, contest: Contest) -> DataFrame:
    """The log with the round each attempt was made in, also beyond the last planned round."""
    return log.withColumn("round_number", contest.round_of_time(F.col("attempted_at")))


def round_activity(log: DataFrame, contest: Contest) -> DataFrame:
    """Attempts and distinct users per round."""
    return (
        assign_rounds(log, contest)
        .groupBy("round_number")
        .agg(F.count(F.lit(1)).alias("attempts"), F.countDistinct("user_id").alias("users"))
    )


def round_state(round_number: Column, contest: Contest, as_of: datetime) -> Column:
    """locked before a round, active in it, closed after it."""
    current = contest.round_at(as_of)
    return (
        F.when(round_number > current, "locked").when(round_number == current, "active")
        .when(round_number < current, "closed")
    )


def round_state_activity(log: DataFrame, contest: Contest, as_of: datetime) -> DataFrame:
    """Attempts per user and state of the round they were made in."""
    state = round_state(F.col("round_number"), contest, as_of)
    return (
        assign_rounds(log, contest)
        .withColumn("round_state", state)
        .groupBy("user_id", "round_state")
        .agg(F.count(F.lit(1)).alias("attempts"))
    )


def _in_rounds(log: DataFrame, rounds: DataFrame, layout: str, ranges: int | None) -> DataFrame:
    """``user_id`` and the round's columns for every attempt in a round; once for each round it lies in."""
    slim = log.select("attempt_id", "user_id", "attempted_at")
    return held_by(slim, "attempted_at", "attempt_id", rounds, "starts_at", "ends_at", layout, ranges)


def _paired_activity(log: DataFrame, windows: DataFrame, layout: str, ranges: int | None) -> DataFrame:
    # Attempts are counted per round and user first, so that a hot round is spread by its users.
    per_user = _in_rounds(log, windows, layout, ranges).groupBy("round_number", "user_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_user.groupBy(F.col("round_number").alias("_round")).agg(
        F.sum("_n").alias("attempts"), F.count("user_id").alias("users")
    )


def _swept_activity(log: DataFrame, windows: DataFrame, ranges: int | None) -> DataFrame:
    time = F.struct("starts_at", "ends_at")
    real = windows.where("round_number IS NOT NULL AND starts_at < ends_at")
    times = real.groupBy("round_number").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(time).alias("_time"), (F.min(time) == F.max(time)).alias("_single")
    )
    times = written_table(times, "times")
    single = times.where("_single").select("round_number", "_copies", "_time.*")
    slim = log.select("attempt_id", "user_id", "attempted_at")
    found = counted_in(slim, "attempted_at", "attempt_id", "user_id", single.select("starts_at", "ends_at"), "starts_at", "ends_at", ranges)
    counted = single.join(found, ["starts_at", "ends_at"]).select(
        F.col("round_number").alias("_round"), (F.col("points") * F.col("_copies")).alias("attempts"), F.col("user_id").alias("users")
    )
    several = times.where("NOT _single").select("round_number")
    if several.isEmpty():
        return counted
    return counted.union(_paired_activity(log, windows.join(several, "round_number", "left_semi"), SWEEP, ranges))


def given_round_activity(
    log: DataFrame, rounds: DataFrame, layout: str = SWEEP, ranges: int | None = None
) -> DataFrame:
    """Attempts and distinct users of every round in a table (``round_number, starts_at, ends_at``).

    Rounds may differ in length, leave gaps and overlap; an attempt counts in each round that holds it. By
    ``sweep`` attempts are never paired with rounds, however many are open at a time; only those of a round number with
    several different times are, as its users are counted over all of them. ``cells`` pairs them all.
    """
    windows = rounds.select("round_number", "starts_at", "ends_at")
    counted = _paired_activity(log, windows, layout, ranges) if layout != SWEEP else _swept_activity(log, windows, ranges)
    none = F.lit(0).cast("bigint")
    return windows.join(counted, F.col("round_number") == F.col("_round"), "left").select(
        "round_number", "starts_at", "ends_at", F.coalesce("attempts", none).alias("attempts"),
        F.coalesce("users", none).alias("users"),
    )


def given_round_state_activity(
    log: DataFrame, rounds: DataFrame, as_of: datetime, layout: str = SWEEP, ranges: int | None = None
) -> DataFrame:
    """Attempts per user and state, as of a time, of the rounds in a table that they were made in."""
    now = moment(as_of)
    state = F.when(now < F.col("starts_at"), "locked").when(now < F.col("ends_at"), "active").otherwise("closed")
    windows = rounds.select("starts_at", "ends_at")
    return (
        _in_rounds(log, windows, layout, ranges).withColumn("round_state", state)
        .groupBy("user_id", "round_state").agg(F.count(F.lit(1)).alias("attempts"))
    )


def _each(users: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    """Every user once with every entry of a one-row list."""
    return users.select("user_id").distinct().select("user_id", F.explode(listed.scalar()).alias(name))


def round_progress(
    users: DataFrame, problems: DataFrame, log: DataFrame, contest: Contest, as_of: datetime
) -> DataFrame:
    """Per listed user and round: state, problems, solved ones and their percentage; by user and round.

    Rounds are the contest's and any more that ``problems`` has. Only correct attempts leave the
    scan; listed users join the solved problems as empty rows, so that one aggregate does it all.
    """
    solved = log.where("is_correct").select("user_id", "problem_id").distinct().join(problems, "problem_id")
    rounds = problems.agg(F.array_union(_numbers(contest.rounds), F.collect_set("round_number")))
    listed = _each(users, rounds, "round_number")
    per_user = (
        solved.select("user_id", "round_number", F.lit(1).alias("_solved"), F.lit(False).alias("_listed"))
        .unionByName(listed.select("user_id", "round_number", F.lit(0).alias("_solved"), F.lit(True).alias("_listed")))
        .groupBy("user_id", "round_number")
        .agg(F.max("_listed").alias("_listed"), F.sum("_solved").alias("solved"))
        .where("_listed")
        .drop("_listed")
    )
    totals = problems.groupBy("round_number").agg(F.count(F.lit(1)).alias("problems"))
    known = F.coalesce(F.col("problems"), F.lit(0).cast("bigint"))
    share = percent(F.col("solved").cast("double"), known.cast("double"))
    return per_user.join(totals, "round_number", "left").select(
        "user_id",
        "round_number",
        round_state(F.col("round_number"), contest, as_of).alias("round_state"),
        known.alias("problems"),
        "solved",
        F.coalesce(share, F.lit(0.0)).alias("solved_percent"),
    ).orderBy("user_id", "round_number")


def latest_attempt(log: DataFrame) -> DataFrame:
    """The newest attempt per user and problem; the higher id wins on equal times.

    The winners' ids come from a hash aggregate over numbers; the texts stay where they are until a semi-join
    with the ids fetches those of the winners.
    """
    winners = log.groupBy("user_id", "problem_id").agg(_newest("attempt_id")).select(F.col("attempt_id").alias("_winner"))
    return log.join(written_table(winners, "winners"), F.col("attempt_id") == F.col("_winner"), "left_semi").select(
        "user_id", "problem_id", "attempt_id", "attempted_at", *_outcome(F.col("is_correct"))
    )


def problem_board(users: DataFrame, problems: DataFrame, log: DataFrame, contest: Contest) -> DataFrame:
    """Every problem for every listed user with the latest state, by user and problem; untried ones
    get defaults. What ``problems`` tells besides (question, difficulty, sample data) comes along.

    All places are added to the log as empty rows, so that one hash aggregate over numbers replaces a cross
    join and an outer join. Texts join at the end, by the ids of newest attempts that were wrong. Unknown
    problems drop out after the aggregate: a filter before it would read the log's JSON twice.
    """
    listed = problems.agg(F.collect_set("problem_id"))
    tries = log.select("user_id", "problem_id", "attempt_id", "attempted_at", "is_correct", F.lit(False).alias("_place"))
    places = _each(users, listed, "problem_id").select(
        "user_id", "problem_id",
        *[F.lit(None).cast(tries.schema[c].dataType).alias(c) for c in ("attempt_id", "attempted_at", "is_correct")],
        F.lit(True).alias("_place"),
    )
    board = (
        tries.unionByName(places)
        .groupBy("user_id", "problem_id")
        .agg(
            F.count("attempt_id").alias("attempts"),
            F.coalesce(F.max("is_correct"), F.lit(False)).alias("ever_solved"),
            *[_newest(c) for c in ("attempt_id", "attempted_at", "is_correct")],
            F.max("_place").alias("_place"),
        )
        .where("_place")
    )
    wrong = log.where("NOT is_correct").select(F.col("attempt_id").alias("_id"), "query_text", "result_text")
    # Written, so that its size tells the planner whether the log must move at all.
    board = written_table(board.drop("_place"), "board")
    asked = board.where("NOT is_correct").select(F.col("attempt_id").alias("_asked"))
    texts = wrong.join(asked, F.col("_id") == F.col("_asked"), "left_semi")
    told = [c for c in ("question", "difficulty", "sample_data") if c in problems.columns]
    return (
        board.join(texts, F.col("attempt_id") == F.col("_id"), "left").join(problems, "problem_id")
        .select("user_id", "problem_id", "round_number", *told, "attempts", "ever_solved", *_outcome(F.col("is_correct")))
        .orderBy("user_id", "problem_id")
    )


def attempt_totals(log: DataFrame) -> DataFrame:
    """Attempts, latest result, ever solved and time of the first solve per user and problem."""
    return (
        log.groupBy("user_id", "problem_id")
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.max_by("is_correct", _place_in_time()).alias("latest_correct"),
            F.max("attempted_at").alias("last_attempt_at"),
            F.max("is_correct").alias("ever_solved"),
            F.min(F.when(F.col("is_correct"), F.col("attempted_at"))).alias("first_solved_at"),
        )
        .select(
            "user_id", "problem_id", "attempts", "latest_correct", "last_attempt_at", "ever_solved", "first_solved_at",
        )
    )


def with_timeliness(log: DataFrame, problems: DataFrame, rounds: DataFrame) -> DataFrame:
    """Each attempt against the window of its problem's round: early, on_time or late."""
    windows = problems.join(rounds, "round_number")
    at = F.col("attempted_at")
    # An attempt without a time is none of the three.
    timing = (
        F.when(at < F.col("starts_at"), "early").when(at >= F.col("ends_at"), "late")
        .when(at >= F.col("starts_at"), "on_time")
    )
    return log.join(windows, "problem_id").withColumn("timing", timing).drop("starts_at", "ends_at")


def submission_timeliness(log: DataFrame, problems: DataFrame, rounds: DataFrame) -> DataFrame:
    """Early, on-time and late attempts per round."""
    timing = F.col("timing")
    return (
        with_timeliness(log, problems, rounds)
        .groupBy("round_number")
        .agg(
            F.count_if(timing == "early").alias("early"),
            F.count_if(timing == "on_time").alias("on_time"),
            F.count_if(timing == "late").alias("late"),
        )
    )


def accepted_attempts(log: DataFrame, problems: DataFrame, rounds: DataFrame) -> DataFrame:
    """Attempts on known problems that came before their round was over.

    Coming early is no reason to be refused.
    """
    return with_timeliness(log, problems, rounds).where(F.col("timing") != "late")


def user_round_matrix(log: DataFrame, problems: DataFrame, contest: Contest) -> DataFrame:
    """One row per user: solved problems in each round, and their total; zeros for none.

    The fixed round list makes the pivot one conditional aggregate.
    """
    tried = log.groupBy("user_id", "problem_id").agg(F.max("is_correct").alias("solved"))
    placed = tried.join(problems, "problem_id", "left")
    hit = F.col("solved") & F.col("round_number").isNotNull()
    rounds = [
        F.count_if(hit & (F.col("round_number") == n)).alias(f"round_{n}") for n in range(1, contest.rounds + 1)
    ]
    return placed.groupBy("user_id").agg(*rounds, F.count_if(hit).alias("total")).orderBy("user_id")


def matrix_of_rounds(log: DataFrame, problems: DataFrame, rounds: DataFrame) -> DataFrame:
    """``user_round_matrix`` with a column for every round of a table, however many, by ``round_number``.

    The total is the sum of the columns: a problem of a round that the table does not have counts in neither.
    Problems solved are counted per user and round before the pivot, which then moves one row for each.
    """
    # One number per round; they become columns, so they must be known beforehand.
    numbers = [r[0] for r in rounds.select("round_number").distinct().orderBy("round_number").collect()]
    solved = log.groupBy("user_id", "problem_id").agg(F.max("is_correct").alias("_solved"))
    known = problems.select("problem_id", "round_number")
    per_round = (
        solved.join(known, "problem_id", "left")
        .groupBy("user_id", "round_number").agg(F.count_if("_solved").alias("_n"))
    )
    wide = per_round.groupBy("user_id").pivot("round_number", numbers).agg(F.sum("_n"))
    columns = [F.coalesce(F.col(f"`{n}`"), F.lit(0).cast("bigint")) for n in numbers]
    total = reduce(lambda a, b: a + b, columns, F.lit(0).cast("bigint"))
    return wide.select(
        "user_id", *[c.alias(f"round_{n}") for c, n in zip(columns, numbers)], total.alias("total")
    ).orderBy("user_id")


def numbered_onto(batch: DataFrame, history: DataFrame) -> DataFrame:
    """New attempts with their running number for user and problem, counted on from ``history``.

    The number of earlier attempts is a correlated scalar subquery on the history's totals; within the batch
    attempts go by time, then id. A user's attempts on one problem in one batch are ranked in one task.
    """
    totals = history.groupBy("user_id", "problem_id").agg(F.count(F.lit(1)).alias("attempts")).alias("_totals")
    same = (F.col("_totals.user_id") == F.col("_new.user_id").outer()) & (
        F.col("_totals.problem_id") == F.col("_new.problem_id").outer()
    )
    earlier = totals.where(same).select(F.max("attempts")).scalar()
    order = Window.partitionBy("user_id", "problem_id").orderBy(F.col("attempted_at").asc_nulls_first(), "attempt_id")
    place = batch.withColumn("_place", F.row_number().over(order)).alias("_new")
    return place.select(
        *batch.columns, (F.coalesce(earlier, F.lit(0)) + F.col("_place")).cast("bigint").alias("attempt_no")
    )


def graded_log(submissions: DataFrame, grades: DataFrame) -> DataFrame:
    """Verdicts put back on their submissions as rows of the attempt log.

    A submission without a verdict failed to run and counts as wrong. Queries and results are
    kept for wrong attempts only.
    """
    joined = submissions.join(grades.select("submission_id", "passed"), "submission_id", "left")
    correct = F.coalesce(F.col("passed"), F.lit(False))
    return joined.select(
        F.col("submission_id").alias("attempt_id"), "user_id", "problem_id", correct.alias("is_correct"),
        "attempted_at",
        F.when(correct, F.col("attempted_at")).alias("completed_at"),
        F.when(~correct, F.col("query_text")).alias("last_wrong_query"),
        F.when(~correct, F.col("result_text")).alias("last_wrong_result"),
    )
