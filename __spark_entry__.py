"""Registered queries, and for each the SQL that must give the same rows."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from tallybook.functions import times  # noqa: E402
from tallybook.functions.times import moment  # noqa: E402
from tallybook.operators import grading, joins, lessons, progress, quality, ranking, text  # noqa: E402
from tallybook.plans import intervals, skew  # noqa: E402
from tallybook.plans.contest import Contest  # noqa: E402
from tallybook.plans.ordering import number_rows  # noqa: E402
from tallybook.session import new_location  # noqa: E402
from tallybook.sources import json_array, problem_file, tables  # noqa: E402
from tallybook.sources.tables import attempt_log, read_table  # noqa: E402
from tallybook.streaming import attempts as streams  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

CONTEST = Contest(start=datetime(2024, 1, 1))
AS_OF = datetime(2024, 1, 10, 12)
TENURE_AS_OF = datetime(2002, 1, 1)
FIRST_YEAR = 1995


def _log(spark: SparkSession, d: str) -> DataFrame:
    return attempt_log(read_table(spark, d, "events"), CONTEST)


def _users(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("user_id").distinct()


# Lesson queries


def project_one(spark, d):
    return lessons.project(read_table(spark, d, "customer"), "c_name")


def project_two(spark, d):
    return lessons.project(read_table(spark, d, "customer"), "c_name", "c_mktsegment")


def project_all(spark, d):
    return lessons.project(read_table(spark, d, "nation"))


def filter_equal(spark, d):
    return lessons.filter_equal(read_table(spark, d, "customer"), "c_mktsegment", "BUILDING").select("c_name")


def filter_at_least(spark, d):
    rows = lessons.filter_at_least(read_table(spark, d, "customer"), "c_acctbal", 5000.0)
    return rows.select("c_name", "c_acctbal")


def filter_both(spark, d):
    rows = lessons.filter_both(read_table(spark, d, "customer"), "c_mktsegment", "BUILDING", "c_acctbal", 5000.0)
    return rows.select("c_name", "c_acctbal")


def bound_parameters(spark, d):
    """Query text with its values bound by place."""
    query = "SELECT c_name, c_acctbal FROM {customer} WHERE c_mktsegment = ? AND c_acctbal >= ?"
    return spark.sql(query, args=["BUILDING", 5000.0], customer=read_table(spark, d, "customer"))


def count_by_group(spark, d):
    return lessons.count_by_group(read_table(spark, d, "customer"), "c_mktsegment", "customers")


def groups_above_average(spark, d):
    return lessons.groups_above_average(
        read_table(spark, d, "customer"), "c_nationkey", "c_acctbal", 4600.0, "avg_acctbal"
    )


def max_by_group(spark, d):
    return lessons.max_by_group(read_table(spark, d, "customer"), "c_nationkey", "c_acctbal", "max_acctbal")


def bucket_high_low(spark, d):
    rows = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return lessons.bucket_high_low(rows, "c_acctbal", 5000.0, "c_name", "c_custkey", "balance_level")


def date_parts(spark, d):
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return lessons.date_parts(rows, "o_orderdate", "o_orderkey")


def tenure_months(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name")
    rows = joins.join_lookup(orders, customers, "o_custkey", "c_custkey").select("o_orderkey", "c_name", "o_orderdate")
    as_of = moment(TENURE_AS_OF)
    return lessons.tenure_months(rows, "c_name", "o_orderdate", as_of, "o_orderkey")


def _nation(spark, d):
    return read_table(spark, d, "nation").select("n_nationkey", "n_name")


def join_lookup(spark, d):
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = joins.join_lookup(customers, _nation(spark, d), "c_nationkey", "n_nationkey")
    return rows.select("c_custkey", "c_name", "n_name").orderBy("n_name", "c_custkey")


def group_count_keep_empty(spark, d):
    counts = joins.group_count_keep_empty(
        _nation(spark, d), read_table(spark, d, "supplier"), "n_nationkey", "s_nationkey", "s_suppkey", "suppliers"
    )
    return counts.orderBy("n_name", "n_nationkey")


def group_count_rich_suppliers(spark, d):
    """With a further condition in the join, so that some nations stay empty."""
    counts = joins.group_count_keep_empty(
        _nation(spark, d), read_table(spark, d, "supplier"), "n_nationkey", "s_nationkey", "s_suppkey", "suppliers",
        on=F.col("s_acctbal") >= 6000.0,
    )
    return counts.orderBy("n_name", "n_nationkey")


def join_average(spark, d):
    return joins.join_average(
        _nation(spark, d), read_table(spark, d, "customer"), "n_nationkey", "c_nationkey", "c_acctbal", "avg_acctbal"
    )


def _customer_orders(spark, d, **options):
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = joins.three_way_join(
        customers, _nation(spark, d), read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        "c_nationkey", "n_nationkey", "c_custkey", "o_custkey", **options,
    )
    return rows.select("c_name", "n_name", "o_orderkey", "o_totalprice").orderBy("c_name", "o_orderkey")


def three_way_join(spark, d):
    return _customer_orders(spark, d)


def three_way_join_plain(spark, d):
    return _customer_orders(spark, d, layout=skew.PLAIN)


def three_way_join_large_orders(spark, d):
    return _customer_orders(spark, d, on=F.col("o_totalprice") >= 450000.0)


def _part_nations(spark, d):
    suppliers = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return joins.join_lookup(read_table(spark, d, "lineitem"), suppliers, "l_suppkey", "s_suppkey")


def _large_return():
    return (F.col("l_quantity") >= 48) & (F.col("l_returnflag") == "R")


def _nations_of_parts(spark, d, on=None):
    parts = read_table(spark, d, "part").select("p_partkey", "p_name")
    counts = joins.distinct_groups_keep_empty(
        parts, _part_nations(spark, d), "p_partkey", "l_partkey", "s_nationkey", "nations", on
    )
    return counts.orderBy("p_name", "p_partkey")


def distinct_groups_keep_empty(spark, d):
    return _nations_of_parts(spark, d)


def distinct_groups_large_returns(spark, d):
    """With a further condition in the join, so that some parts stay empty."""
    return _nations_of_parts(spark, d, _large_return())


def _shared_parts(spark, d, pairs):
    return joins.shared_project_count(
        _nation(spark, d), pairs, "n_nationkey", "s_nationkey", "l_partkey", "shared_parts"
    )


def shared_project_count(spark, d):
    return _shared_parts(spark, d, _part_nations(spark, d))


def shared_project_exists(spark, d):
    return joins.shared_project_exists(
        _nation(spark, d), _part_nations(spark, d), "n_nationkey", "s_nationkey", "l_partkey", "shared_parts"
    )


def shared_project_large_returns(spark, d):
    return _shared_parts(spark, d, _part_nations(spark, d).where(_large_return()))


def cte_group_filter_join(spark, d):
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    rows = joins.cte_group_filter_join(
        customers, _nation(spark, d), "c_nationkey", "n_nationkey", "c_acctbal", 4600.0, "c_custkey"
    )
    return rows.select("c_custkey", "c_name", "n_name", "c_acctbal")


def _increases(spark, d, layout):
    rows = ranking.period_increase(
        read_table(spark, d, "orders"), read_table(spark, d, "customer").select("c_custkey", "c_name"),
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "c_custkey", layout,
    )
    return rows.select("c_name", "o_orderkey", "o_orderdate", "previous_value", "o_totalprice", "increase_percent")


def period_increase(spark, d):
    """Through ranges of the sort order, for customers with any number of orders."""
    return _increases(spark, d, ranking.RANGES)


def period_increase_window(spark, d):
    return _increases(spark, d, ranking.WINDOW)


def top_two_and_overall_rank(spark, d):
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    rows = ranking.top_k_and_overall_rank(
        customers, _nation(spark, d), "c_nationkey", "n_nationkey", "c_acctbal", 2, "c_custkey", "n_name"
    )
    return rows.select("c_custkey", "c_name", "n_name", "c_acctbal", "group_rank", "overall_rank")


# Progress reports


def assign_rounds(spark, d):
    return progress.round_activity(_log(spark, d), CONTEST)


def round_state_activity(spark, d):
    return progress.round_state_activity(_log(spark, d), CONTEST, AS_OF)


def round_progress(spark, d):
    return progress.round_progress(_users(spark, d), CONTEST.problems(spark), _log(spark, d), CONTEST, AS_OF)


def latest_attempt(spark, d):
    return progress.latest_attempt(_log(spark, d))


def problem_board(spark, d):
    return progress.problem_board(_users(spark, d), CONTEST.problems(spark), _log(spark, d), CONTEST)


def attempt_totals(spark, d):
    return progress.attempt_totals(_log(spark, d))


def submission_timeliness(spark, d):
    return progress.submission_timeliness(_log(spark, d), CONTEST.problems(spark), CONTEST.calendar(spark))


def accepted_attempts(spark, d):
    rows = progress.accepted_attempts(_log(spark, d), CONTEST.problems(spark), CONTEST.calendar(spark))
    return rows.select("attempt_id", "user_id", "problem_id", "round_number", "attempted_at", "timing")


def user_round_matrix(spark, d):
    return progress.user_round_matrix(_log(spark, d), CONTEST.problems(spark), CONTEST)


def _given_rounds(spark, d):
    """Rounds as rows, a nation each: of several lengths, with gaps and overlaps."""
    start, key = moment(CONTEST.start), F.col("n_nationkey")
    begins = start + F.make_dt_interval(hours=key * 29)
    return read_table(spark, d, "nation").select(
        key.cast("bigint").alias("round_number"), begins.alias("starts_at"),
        (begins + F.make_dt_interval(hours=(F.col("n_regionkey") + 1) * 17)).alias("ends_at"),
    )


def assign_rounds_given(spark, d):
    return progress.given_round_activity(_log(spark, d), _given_rounds(spark, d))


def assign_rounds_given_cells(spark, d):
    """The same through cells of time, which leaves the log where it is."""
    return progress.given_round_activity(_log(spark, d), _given_rounds(spark, d), intervals.CELLS)


def assign_rounds_many(spark, d):
    """A window per supplier: as many as the data have, many of them open at a time."""
    start = moment(CONTEST.start) + F.make_dt_interval(mins=(F.col("s_suppkey") * 7919 % 43200).cast("int"))
    windows = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("round_number"), start.alias("starts_at"),
        (start + F.make_dt_interval(mins=F.col("s_nationkey") * 37 + 1)).alias("ends_at"),
    )
    return progress.given_round_activity(_log(spark, d), windows)


def round_state_given(spark, d):
    return progress.given_round_state_activity(_log(spark, d), _given_rounds(spark, d), AS_OF)


def submission_timeliness_given(spark, d):
    """Against rounds stored with the application, each problem in a round of its own."""
    folder = new_location(spark, "application")
    tables.reset_application(spark, folder, CONTEST, rounds=_given_rounds(spark, d))
    problems = CONTEST.problems(spark).select("problem_id", F.col("problem_id").alias("round_number"))
    return progress.submission_timeliness(_log(spark, d), problems, tables.read_application(spark, folder, "rounds"))


def user_round_matrix_given(spark, d):
    """A column for every round of a table; problems go to the rounds of nations by number."""
    rounds = _given_rounds(spark, d).where(F.col("round_number") % 3 == 0)
    problems = CONTEST.problems(spark).select("problem_id", (F.col("problem_id") + 3).alias("round_number"))
    return progress.matrix_of_rounds(_log(spark, d), problems, rounds)


def problem_board_told(spark, d):
    """The board with questions, difficulties and sample data, from the tables that have texts."""
    told = (
        CONTEST.problems(spark)
        .join(read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), F.col("problem_id") == F.col("p_partkey"))
        .join(read_table(spark, d, "documents").select("doc_id", "text"), F.col("problem_id") == F.col("doc_id"))
        .select(
            "problem_id", "round_number", F.col("p_name").alias("question"), F.col("p_brand").alias("difficulty"),
            F.col("text").alias("sample_data"),
        )
    )
    return progress.problem_board(_users(spark, d), told, _log(spark, d), CONTEST)


def _loose_log(spark, d):
    """Attempts of which some have no time and some are on problems that no round has."""
    k = F.from_json("props", "k int")["k"]
    events = read_table(spark, d, "events")
    return attempt_log(events, CONTEST).join(
        events.select(F.col("event_id").alias("_event"), k.alias("_k")), F.col("attempt_id") == F.col("_event")
    ).withColumns({
        "problem_id": F.when(F.col("_k") < 95, F.col("_k") % 30 + 1).cast("bigint"),
        "attempted_at": F.when(F.col("_k") % 7 != 0, F.col("attempted_at")),
    }).drop("_event", "_k")


def latest_attempt_loose(spark, d):
    return progress.latest_attempt(_loose_log(spark, d))


def problem_board_loose(spark, d):
    return progress.problem_board(_users(spark, d), CONTEST.problems(spark), _loose_log(spark, d), CONTEST)


def submission_timeliness_loose(spark, d):
    return progress.submission_timeliness(_loose_log(spark, d), CONTEST.problems(spark), CONTEST.calendar(spark))


def numbered_onto(spark, d):
    """Attempts since a day, numbered on from those before."""
    log = _log(spark, d).select("attempt_id", "user_id", "problem_id", "attempted_at")
    day = moment(datetime(2024, 1, 20))
    return progress.numbered_onto(log.where(F.col("attempted_at") >= day), log.where(F.col("attempted_at") < day))


# Grading and preparation


def normalise_cells(spark, d):
    return grading.normalise_cells(read_table(spark, d, "customer"))


def _nation_counts(spark, d):
    ours = read_table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey"))
    theirs = read_table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey"))
    n = F.count(F.lit(1))
    return ours.agg(n.alias("n")), theirs.agg((n * 15).alias("n"))


def result_diff(spark, d):
    return grading.result_diff(*_nation_counts(spark, d))


def result_diff_repeated(spark, d):
    ours = read_table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return grading.result_diff(ours, read_table(spark, d, "supplier").select("s_nationkey"))


def same_rows(spark, d):
    return grading.same_rows(*_nation_counts(spark, d))


def _role_grades(turns, submission="conv_id"):
    """Roles of each conversation, or part of it, against user and assistant in turn."""
    key = turns.select(submission, "turn", F.when(F.col("turn") % 2 == 0, " USER").otherwise("Assistant ").alias("role"))
    return grading.grade_ordered_results(
        grading.long_form(turns, submission, "turn", ["role"]), grading.long_form(key, submission, "turn", ["role"])
    )


def grade_ordered_results(spark, d):
    return _role_grades(read_table(spark, d, "conversations"))


def grade_other_table(spark, d):
    """Balances of each nation's customers against those of its suppliers: fractions with all their digits, of
    results that differ in length, and nations that have neither."""
    def balances(table, nation, key, value):
        rows = read_table(spark, d, table).select(nation, key, (F.floor(F.col(value) / 2500.0) / 3.0).alias("share"))
        numbered = number_rows(rows, [nation], [F.col(key)], "row_no")
        return grading.long_form(numbered, nation, "row_no", ["share"])

    return grading.grade_ordered_results(
        balances("customer", "c_nationkey", "c_custkey", "c_acctbal"),
        balances("supplier", "s_nationkey", "s_suppkey", "s_acctbal"),
        read_table(spark, d, "nation").select(F.col("n_nationkey").alias("submission_id")),
    )


def _submissions(turns, submission):
    hours = (F.col("conv_id") % 500).cast("int")
    return turns.select(
        submission.alias("submission_id"),
        (F.col("conv_id") % 50).alias("user_id"),
        (F.col("conv_id") % CONTEST.problem_count + 1).alias("problem_id"),
        (moment(CONTEST.start) + F.make_dt_interval(hours=hours)).alias("attempted_at"),
        F.col("text").alias("query_text"),
        F.col("role").alias("result_text"),
    )


def graded_log(spark, d):
    """Every turn handed in by itself."""
    place = (F.col("conv_id") * 1000 + F.col("turn")).alias("part")
    turns = read_table(spark, d, "conversations").select("*", place)
    return progress.graded_log(_submissions(turns, F.col("part")), _role_grades(turns, "part"))


def graded_log_first_turn(spark, d):
    """Every conversation handed in as a whole, with the text it starts with."""
    turns = read_table(spark, d, "conversations")
    first = _submissions(turns.where(F.col("turn") == 0), F.col("conv_id"))
    return progress.graded_log(first, _role_grades(turns))


def section_lines(spark, d):
    rows = text.section_lines(read_table(spark, d, "documents"), "doc_id", "text", text.short_title(2))
    return rows.select(
        "doc_id", "section_no", "title", "line_no",
        F.array_join("header", " ").alias("header"), F.array_join("tokens", " ").alias("tokens"),
    )


def section_outline(spark, d):
    return text.section_outline(read_table(spark, d, "documents"), "doc_id", "text", text.short_title(2))


def text_block_rows(spark, d):
    """Customers written as text blocks, one each, and read back as typed rows."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
    line = F.concat_ws("   ", F.col("c_custkey").cast("string"), "c_name", F.coalesce(balance, F.lit("null")))
    blocks = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.concat_ws(
            "\n", F.lit("[data]"), F.lit(f"customers {text.TITLE_MARKER}"), F.lit("id  name   balance"), line,
            F.lit(""), F.lit("[answer]"), F.lit("id  name   balance"), F.lit("--  ----   -------"), line,
        ).alias("block"),
    )
    rows = text.section_lines(blocks, "doc_id", "block")
    return text.typed_rows(
        rows, ["doc_id", "title", "line_no"], {"id": "bigint", "name": "string", "balance": "double"}
    )


def block_tables(spark, d):
    """Orders, four to a text block, as three tables side by side: the cheap ones, all of them and the urgent
    ones; the shorter tables end early, on either side."""
    orders = read_table(spark, d, "orders").select(
        F.floor(F.col("o_orderkey") / 4).alias("block_id"), "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    cells = F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    dear, urgent = F.col("o_totalprice") >= 200000, F.col("o_orderpriority").startswith("1")
    grouped = orders.groupBy("block_id").agg(
        F.sort_array(F.collect_list(F.when(~dear, cells))).alias("a"), F.sort_array(F.collect_list(cells)).alias("b"),
        F.sort_array(F.collect_list(F.when(urgent, cells))).alias("c"),
    )

    def cell(name, field, width, i):
        return F.rpad(F.coalesce(F.get(F.col(name), i)[field].cast("string"), F.lit("")), width, " ")

    def line(i):
        price = F.get(F.col("b"), i)["o_totalprice"].cast("decimal(18,2)").cast("string")
        return F.rtrim(F.concat(
            cell("a", "o_orderkey", 21, i), cell("a", "o_custkey", 45, i), cell("b", "o_orderkey", 21, i), F.rpad(price, 45, " "),
            cell("c", "o_orderkey", 21, i), cell("c", "o_custkey", 20, i),
        ))

    title = "".join(f"{n} {text.TITLE_MARKER}".ljust(64) for n in ("cheap", "all", "urgent")).rstrip()
    heading = "".join(n.ljust(w) for n, w in zip(["id", "customer", "id", "price", "id", "customer"], [21, 45] * 3)).rstrip()
    blocks = grouped.select(
        "block_id",
        F.concat_ws(
            "\n", F.lit("[data]"), F.lit(title), F.lit(heading),
            F.array_join(F.transform(F.sequence(F.lit(0), F.size("b") - 1), line), "\n"),
            F.lit(""), F.lit("[answer]"), F.lit("id  customer"), F.lit("1   2"),
        ).alias("block"),
    )
    rows = text.block_tables(blocks, "block_id", "block")
    return rows.select(
        "block_id", "section_no", "table_no", "title", "line_no", F.array_join("header", " ").alias("header"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def render_rows(spark, d):
    return grading.render_rows(read_table(spark, d, "customer"))


def render_table(spark, d):
    customers = read_table(spark, d, "customer")
    return grading.render_table(customers, [F.col("c_custkey")], ["c_custkey", "c_name", "c_acctbal"])


def json_fields(spark, d):
    events = read_table(spark, d, "events")
    return events.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


def _problem_texts(spark, d):
    """One problem per customer as JSON text, with two rows of test data that mix numbers and text."""
    body = F.concat(
        F.lit('{"id": '), F.col("c_custkey").cast("string"),
        F.lit(', "test_data": {"columns": ["id", "name", "salary"], "data": [['),
        F.col("c_custkey").cast("string"), F.lit(', "'), F.col("c_name"), F.lit('", '),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string"),
        F.lit('], ['), F.col("c_nationkey").cast("string"), F.lit(', "'), F.col("c_mktsegment"), F.lit('", null]]}, '),
        F.lit('"schema": [{"name": "id", "type": "INTEGER"}, {"name": "name", "type": "TEXT"}, '
              '{"name": "salary", "type": "REAL"}]}'),
    )
    texts = read_table(spark, d, "customer").select("c_custkey", body.alias("body"))
    return problem_file.parse_problems(texts, "body", ["c_custkey"])


def json_test_rows(spark, d):
    fields = {"id": "INTEGER", "name": "TEXT", "salary": "REAL"}
    return problem_file.test_rows(_problem_texts(spark, d), ["c_custkey"], fields)


def json_test_cells(spark, d):
    return problem_file.test_cells(_problem_texts(spark, d), ["c_custkey"])


def union_lesson_sets(spark, d):
    """Orders of every year, a set a year."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    rows = ranking.numbered_sets(orders, F.year("o_orderdate") - FIRST_YEAR + 1, ["o_orderdate", "o_orderkey"])
    return rows.select("round_id", "position", "o_orderkey", "o_totalprice")


def union_lesson_sets_of_tables(spark, d):
    """Seven sets from seven tables, stacked and numbered."""
    of = [
        ("region", "r_regionkey", "r_name"), ("nation", "n_nationkey", "n_name"), ("supplier", "s_suppkey", "s_name"),
        ("customer", "c_custkey", "c_name"), ("part", "p_partkey", "p_name"), ("orders", "o_orderkey", "o_orderpriority"),
        ("events", "event_id", "event_type"),
    ]
    sets = {
        i: read_table(spark, d, t).select(F.col(k).cast("bigint").alias("item_id"), F.col(n).alias("item"))
        for i, (t, k, n) in enumerate(of, 1)
    }
    return ranking.union_lesson_sets(sets, ["item", "item_id"]).select("round_id", "position", "item_id", "item")


def _rules(spark, d, customers):
    orders = quality.Rules(
        "orders", not_null=("o_custkey", "o_orderdate"), unique=(("o_orderkey",), ("o_custkey", "o_orderdate")),
        foreign=(("o_custkey", customers, "c_custkey"),),
    )
    parts = quality.Rules("part", unique=(("p_name",),))
    return quality.constraint_report([
        quality.table_report(read_table(spark, d, "orders"), orders), quality.table_report(read_table(spark, d, "part"), parts)
    ])


def constraint_report(spark, d):
    return _rules(spark, d, read_table(spark, d, "customer"))


def constraint_report_creditors(spark, d):
    """Orders must belong to customers without debts, so that some break the rule."""
    return _rules(spark, d, read_table(spark, d, "customer").where(F.col("c_acctbal") >= 0))


# Sources and sinks


def iso_times(spark, d):
    """Times written as ISO text and read back."""
    text = times.iso_text(F.col("ts"))
    return read_table(spark, d, "events").select(
        "event_id", text.alias("ts_text"), times.parse_iso(text).alias("ts_parsed")
    )


def lines_written(spark, d):
    """A rendered table through the text sink."""
    folder = new_location(spark, "lines")
    tables.write_lines(render_table(spark, d), folder)
    return tables.read_lines(spark, folder)


def problem_files(spark, d):
    """A problem per customer in JSON files of up to 1,000, read back."""
    cells = F.array("c_name", F.col("c_acctbal").cast("string"))
    problem = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("question"),
        F.struct(F.array(F.lit("name"), F.lit("balance")).alias("columns"), F.array(cells).alias("data")).alias("test_data"),
        F.array(cells).alias("expected_result"),
    )
    files = (
        read_table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 1000).alias("file"))
        .agg(F.to_json(F.collect_list(problem), {"pretty": "true"}).alias("value"))
    )
    folder = new_location(spark, "problems")
    files.write.partitionBy("file").text(folder)
    problems = problem_file.read_problem_files(spark, folder)
    wanted = F.col("expected_result")[0]
    return problems.select(
        "id", "question", F.array_join("test_data.columns", ",").alias("names"), wanted[0].alias("wanted_name"),
        wanted[1].cast("double").alias("wanted_balance"),
    )


def problem_array(spark, d):
    """A problem per customer, up to 10,000 of them in one JSON array in one file, read back by byte ranges."""
    cells = F.array("c_name", F.col("c_acctbal").cast("string"))
    quoted = F.concat(F.lit('is "'), F.col("c_name"), F.lit('" in [debt}, or \\?'))
    problem = F.struct(
        F.col("c_custkey").alias("id"), quoted.alias("question"),
        F.struct(F.array(F.lit("name"), F.lit("balance")).alias("columns"), F.array(cells).alias("data")).alias("test_data"),
    )
    files = read_table(spark, d, "customer").select(F.floor(F.col("c_custkey") / 10000).alias("file"), "c_custkey", problem.alias("p"))
    edges = files.groupBy("file").agg(F.min("c_custkey").alias("first"), F.max("c_custkey").alias("last"))
    key = F.col("c_custkey")
    lines = files.join(edges, "file").select(
        "file", "c_custkey",
        F.concat(F.when(key == F.col("first"), "[").otherwise(""), F.to_json("p"), F.when(key == F.col("last"), "]").otherwise(",")).alias("value"),
    )
    folder = new_location(spark, "array")
    lines.repartition("file").sortWithinPartitions("file", "c_custkey").select("file", "value").write.partitionBy("file").text(folder)
    problems = json_array.read_json_array(spark, folder, problem_file.PROBLEM)
    return problems.select("id", "question", F.col("test_data.data")[0][1].cast("double").alias("balance"))


def text_blocks_from_files(spark, d):
    """Customers as text blocks in many files, several to a file, read back with where they stood."""
    line = F.concat_ws("   ", F.col("c_custkey").cast("string"), "c_name")
    block = F.concat_ws("\n", F.lit(f"customers {text.TITLE_MARKER}"), F.lit("id  name"), line)
    folder = new_location(spark, "blocks")
    customers = read_table(spark, d, "customer")
    customers.select(F.floor(F.col("c_custkey") / 100).alias("shelf"), "c_custkey", block.alias("value")).repartition(
        "shelf"
    ).sortWithinPartitions("shelf", "c_custkey").select("shelf", "value").write.partitionBy("shelf").option(
        "lineSep", "\n=====\n"
    ).text(folder)
    blocks = tables.read_blocks(spark, folder, "\n=====\n")
    shelf = F.regexp_extract("file", "shelf=([0-9]+)", 1).cast("bigint")
    rows = text.section_lines(blocks.select(F.struct(shelf.alias("shelf"), "block_no").alias("place"), "block"), "place", "block")
    return text.typed_rows(rows, ["place", "line_no"], {"id": "bigint", "name": "string"}).select(
        "place.shelf", "place.block_no", "line_no", "id", "name"
    )


def rows_replaced(spark, d):
    """Customers stored by key; those of one nation are replaced with their balances doubled, and suppliers added."""
    customers = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    suppliers = read_table(spark, d, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal")
    )
    folder = new_location(spark, "keyed")
    tables.write_keyed(customers, folder, ["c_custkey"], 16)
    doubled = customers.where("c_nationkey = 7").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    tables.replace_keyed(doubled.unionByName(suppliers), folder, ["c_custkey"], 16)
    return tables.read_keyed(spark, folder)


def attempts_appended(spark, d):
    """An application filled, started over, and its log appended to in two parts."""
    folder = new_location(spark, "application")
    correct = F.col("is_correct")
    log = _log(spark, d).select(
        "attempt_id", F.col("user_id").cast("string").alias("user_id"), "problem_id", "is_correct", "attempted_at",
        F.when(correct, F.col("attempted_at")).alias("completed_at"),
        F.when(~correct, F.col("query_text")).alias("last_wrong_query"),
        F.when(~correct, F.col("result_text")).alias("last_wrong_result"),
    )
    for parts in ([log], [log.where(correct), log.where(~correct)]):
        tables.reset_application(spark, folder, CONTEST)
        for part in parts:
            tables.append_attempts(part, folder)
    return tables.read_application(spark, folder, "attempts")


# Streams


def stream_attempt_totals(spark, d):
    return streams.stream_attempt_totals(
        spark, lambda: attempt_log(streams.stream_table(spark, d, "events"), CONTEST)
    )


def stream_round_counts(spark, d):
    return streams.stream_round_counts(
        spark, lambda: attempt_log(streams.stream_table(spark, d, "events"), CONTEST), CONTEST
    )


def stream_totals_folded(spark, d):
    """Attempts arriving in many files, a file a batch, with a snapshot after every third batch."""
    folder = new_location(spark, "arrivals")
    events = read_table(spark, d, "events")
    events.repartitionByRange(8, "event_id").write.parquet(f"{folder}/events.parquet")
    return streams.stream_attempt_totals(
        spark, lambda: attempt_log(streams.stream_table(spark, folder, "events", files_per_batch=1), CONTEST), fold_every=3
    )


def stream_late_balance(spark, d):
    """Attempts in files out of the order of time, in rounds that close: what was kept, and what came too late."""
    folder = new_location(spark, "arrivals")
    events = read_table(spark, d, "events")
    events.repartition(6, F.xxhash64("event_id") % 6).write.parquet(f"{folder}/events.parquet")
    counts = streams.stream_closing_rounds(
        spark, lambda: attempt_log(streams.stream_table(spark, folder, "events", files_per_batch=1), CONTEST), CONTEST, "2 days"
    )
    log = _log(spark, d)
    late = counts.late(log.schema).agg(F.count(F.lit(1))).scalar()
    kept = counts.counts().agg(F.sum("attempts")).scalar()
    return counts.seen().agg(F.sum("arrived").alias("arrived")).select(
        "arrived", (kept + late).alias("kept_and_late"), (late > 0).alias("some_late")
    )


_QUERIES = [
    project_one, project_two, project_all, filter_equal, filter_at_least, filter_both, bound_parameters, count_by_group,
    groups_above_average, max_by_group, bucket_high_low, date_parts, tenure_months, join_lookup,
    group_count_keep_empty, group_count_rich_suppliers, join_average, three_way_join, three_way_join_plain,
    three_way_join_large_orders, distinct_groups_keep_empty, distinct_groups_large_returns, shared_project_count,
    shared_project_exists, shared_project_large_returns, cte_group_filter_join, period_increase, period_increase_window, top_two_and_overall_rank,
    assign_rounds, round_state_activity, round_progress, latest_attempt, problem_board, attempt_totals,
    submission_timeliness, accepted_attempts, user_round_matrix,
    assign_rounds_given, assign_rounds_given_cells, assign_rounds_many, round_state_given, submission_timeliness_given,
    user_round_matrix_given, problem_board_told, latest_attempt_loose, problem_board_loose, submission_timeliness_loose,
    numbered_onto,
    normalise_cells, result_diff, result_diff_repeated, same_rows, grade_ordered_results, grade_other_table, graded_log,
    graded_log_first_turn,
    section_lines, section_outline, text_block_rows, block_tables, render_rows, render_table, json_fields, json_test_rows,
    json_test_cells, union_lesson_sets, union_lesson_sets_of_tables, constraint_report, constraint_report_creditors,
    iso_times, lines_written, problem_files, problem_array, text_blocks_from_files, rows_replaced, attempts_appended,
    stream_attempt_totals, stream_round_counts, stream_totals_folded, stream_late_balance,
]


def entry(spark: SparkSession) -> DataFrame:
    """The members of the groups that pass an average, with group names, highest first."""
    return cte_group_filter_join(spark, SMOKE_DIR)


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def _training_data():
    """The module with the training-data queries, where that subpackage and what it needs are installed."""
    try:
        from tallybook.llm import queries as training_data
    except ImportError:
        return None
    return training_data


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = _training_data()
    return core_queries() | (more.queries() if more else {})


# An average as the queries show it.
def _avg(col: str) -> str:
    return f"round(avg({col}), 6)"


def _strip(col: str) -> str:
    return f"trim({col}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


_LOG = """log AS (
    SELECT event_id AS attempt_id, user_id,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 21 + 1 AS problem_id,
           event_type = 'purchase' AS is_correct, ts AS attempted_at,
           props AS query_text, event_type AS result_text
    FROM events)"""

_ROUNDS = """rounds AS (
    SELECT n AS round_number,
           TIMESTAMP '2024-01-01' + to_days(CAST(3 * (n - 1) AS INTEGER)) AS starts_at,
           TIMESTAMP '2024-01-01' + to_days(CAST(3 * n AS INTEGER)) AS ends_at
    FROM generate_series(1, 7) g(n))"""

_PROBLEMS = """problems AS (
    SELECT n AS problem_id, CAST(ceil(n / 3.0) AS BIGINT) AS round_number FROM generate_series(1, 21) g(n))"""

_LATEST = """latest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, problem_id
                                     ORDER BY attempted_at DESC, attempt_id DESC) AS rn
        FROM log) WHERE rn = 1)"""

_TOTALS = f"""
    WITH {_LOG}, {_LATEST}
    SELECT user_id, problem_id, attempts, l.is_correct AS latest_correct,
           l.attempted_at AS last_attempt_at, ever_solved, first_solved_at
    FROM (SELECT user_id, problem_id, count(*) AS attempts, bool_or(is_correct) AS ever_solved,
                 min(CASE WHEN is_correct THEN attempted_at END) AS first_solved_at
          FROM log GROUP BY user_id, problem_id) a
    JOIN latest l USING (user_id, problem_id)"""

_LARGE_RETURN = "WHERE l_quantity >= 48 AND l_returnflag = 'R'"


def _suppliers_of(condition: str = "") -> str:
    return f"""
        SELECT n_nationkey, n_name, count(s_suppkey) AS suppliers
        FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey {condition}
        GROUP BY n_nationkey, n_name ORDER BY n_name, n_nationkey"""


def _orders_of(condition: str = "") -> str:
    return f"""
        SELECT c_name, n_name, o_orderkey, o_totalprice
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON c_custkey = o_custkey {condition}
        ORDER BY c_name, o_orderkey"""


def _pairs(condition: str = "") -> str:
    return f"""pairs AS (
        SELECT DISTINCT l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey {condition})"""


def _nations_sql(condition: str = "") -> str:
    return f"""
        WITH {_pairs(condition)}
        SELECT p_partkey, p_name, count(DISTINCT s_nationkey) AS nations
        FROM part LEFT JOIN pairs ON p_partkey = l_partkey
        GROUP BY p_partkey, p_name ORDER BY p_name, p_partkey"""


def _shared_sql(condition: str = "") -> str:
    return f"""
        WITH {_pairs(condition)},
        shared AS (SELECT * FROM pairs p WHERE EXISTS (
            SELECT 1 FROM pairs q WHERE q.l_partkey = p.l_partkey AND q.s_nationkey <> p.s_nationkey))
        SELECT n_nationkey, n_name, count(DISTINCT l_partkey) AS shared_parts
        FROM nation LEFT JOIN shared ON n_nationkey = s_nationkey
        GROUP BY n_nationkey, n_name ORDER BY shared_parts DESC, n_nationkey"""


def _rules_sql(condition: str = "") -> str:
    return f"""
        SELECT 'not_null' AS rule, 'orders.o_custkey' AS subject,
               count(*) FILTER (WHERE o_custkey IS NULL) AS violations FROM orders
        UNION ALL SELECT 'not_null', 'orders.o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
        UNION ALL SELECT 'unique', 'orders.o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'unique', 'orders.o_custkey+o_orderdate',
               count(*) - count(DISTINCT (o_custkey, o_orderdate)) FROM orders
        UNION ALL SELECT 'unique', 'part.p_name', count(*) - count(DISTINCT p_name) FROM part
        UNION ALL SELECT 'foreign_key', 'orders.o_custkey', count(*) FROM orders
            WHERE o_custkey NOT IN (SELECT c_custkey FROM customer {condition})"""


_INCREASE = """
    WITH steps AS (
        SELECT *, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_value
        FROM orders)
    SELECT c_name, o_orderkey, o_orderdate, previous_value, o_totalprice,
           round((o_totalprice - previous_value) * 100.0 / nullif(previous_value, 0), 1) AS increase_percent
    FROM steps JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice > previous_value ORDER BY increase_percent DESC, o_orderkey"""


def _table_lines() -> str:
    return f"""
        SELECT 'c_custkey | c_name | c_acctbal' AS line
        UNION ALL SELECT repeat('-', 30)
        UNION ALL SELECT {_plain_text('c_custkey')} || ' | ' || c_name || ' | ' || {_plain_text('c_acctbal')} FROM customer"""


_GIVEN = """given AS (
    SELECT CAST(n_nationkey AS BIGINT) AS round_number, TIMESTAMP '2024-01-01' + to_hours(29 * n_nationkey) AS starts_at,
           TIMESTAMP '2024-01-01' + to_hours(29 * n_nationkey + 17 * (n_regionkey + 1)) AS ends_at
    FROM nation)"""

_MANY = """given AS (
    SELECT s_suppkey AS round_number, TIMESTAMP '2024-01-01' + to_minutes(s_suppkey * 7919 % 43200) AS starts_at,
           TIMESTAMP '2024-01-01' + to_minutes(s_suppkey * 7919 % 43200 + s_nationkey * 37 + 1) AS ends_at
    FROM supplier)"""

_LOOSE = """log AS (
    SELECT event_id AS attempt_id, user_id, CASE WHEN k < 95 THEN k % 30 + 1 END AS problem_id,
           event_type = 'purchase' AS is_correct, CASE WHEN k % 7 <> 0 THEN ts END AS attempted_at,
           props AS query_text, event_type AS result_text
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events))"""


def _held_sql(windows: str) -> str:
    return f"""
        WITH {_LOG}, {windows}
        SELECT round_number, starts_at, ends_at, count(attempt_id) AS attempts, count(DISTINCT user_id) AS users
        FROM given LEFT JOIN log ON attempted_at >= starts_at AND attempted_at < ends_at GROUP BY ALL"""


def _latest_sql(log: str) -> str:
    return f"""
        WITH {log}, {_LATEST}
        SELECT user_id, problem_id, attempt_id, attempted_at, is_correct AS latest_correct,
               CASE WHEN is_correct THEN attempted_at END AS completed_at,
               CASE WHEN NOT is_correct THEN query_text END AS last_wrong_query,
               CASE WHEN NOT is_correct THEN result_text END AS last_wrong_result
        FROM latest"""


def _board_sql(log: str, told: str = "", more: str = "") -> str:
    return f"""
        WITH {log}, {_LATEST}, {_PROBLEMS}, users AS (SELECT DISTINCT user_id FROM events),
        totals AS (SELECT user_id, problem_id, count(*) AS attempts, bool_or(is_correct) AS ever_solved
                   FROM log GROUP BY user_id, problem_id)
        SELECT u.user_id, p.problem_id, p.round_number, {told} coalesce(t.attempts, 0) AS attempts,
               coalesce(t.ever_solved, false) AS ever_solved, coalesce(l.is_correct, false) AS latest_correct,
               CASE WHEN l.is_correct THEN l.attempted_at END AS completed_at,
               CASE WHEN NOT l.is_correct THEN l.query_text END AS last_wrong_query,
               CASE WHEN NOT l.is_correct THEN l.result_text END AS last_wrong_result
        FROM users u CROSS JOIN problems p {more}
        LEFT JOIN latest l ON l.user_id = u.user_id AND l.problem_id = p.problem_id
        LEFT JOIN totals t ON t.user_id = u.user_id AND t.problem_id = p.problem_id"""


def _timeliness_sql(log: str, problems: str, rounds: str) -> str:
    return f"""
        WITH {log}, {rounds}, {problems}
        SELECT round_number, count(*) FILTER (WHERE attempted_at < starts_at) AS early,
               count(*) FILTER (WHERE attempted_at >= starts_at AND attempted_at < ends_at) AS on_time,
               count(*) FILTER (WHERE attempted_at >= ends_at) AS late
        FROM log JOIN problems USING (problem_id) JOIN rounds USING (round_number) GROUP BY round_number"""


_ROUND_NO = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(attempted_at AS DATE)) / 3.0) + 1 AS BIGINT)"

_NATION_COUNTS = """a AS (SELECT c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS nationkey, count(*) * 15 AS n FROM supplier GROUP BY 1),
    diff AS (SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
             UNION ALL
             SELECT *, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))"""

_GRADES = """places AS (
    SELECT conv_id AS submission_id, turn,
           lower(trim(role)) = CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END AS agrees
    FROM conversations),
grades AS (
    SELECT submission_id, count(*) AS submitted_rows, count(*) AS expected_rows,
           count(*) FILTER (WHERE NOT agrees) AS mismatches,
           count(*) FILTER (WHERE NOT agrees) = 0 AS passed
    FROM places GROUP BY submission_id)"""

_LINES = f"""split AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
raw AS (SELECT doc_id, unnest(range(1, len(x) + 1)) AS line_no, unnest(x) AS r FROM split),
lines AS (
    SELECT doc_id, line_no, {_strip('r')} AS line,
           string_split_regex({_strip('r')}, '\\s+') AS tokens
    FROM raw),
marked AS (SELECT *, line <> '' AND len(tokens) <= 2 AS is_title FROM lines)"""


def _plain_text(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


def core_sql() -> dict[str, str]:
    money, key, nation = _plain_text("c_acctbal"), _plain_text("c_custkey"), _plain_text("c_nationkey")
    return {
        "project_one": "SELECT c_name FROM customer",
        "project_two": "SELECT c_name, c_mktsegment FROM customer",
        "project_all": "SELECT * FROM nation",
        "filter_equal": "SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
        "filter_at_least": "SELECT c_name, c_acctbal FROM customer WHERE c_acctbal >= 5000",
        "filter_both": """
            SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 5000""",
        "bound_parameters": """
            SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 5000""",
        "count_by_group": """
            SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment ORDER BY c_mktsegment""",
        "groups_above_average": f"""
            SELECT c_nationkey, {_avg('c_acctbal')} AS avg_acctbal FROM customer
            GROUP BY c_nationkey HAVING avg(c_acctbal) >= 4600""",
        "max_by_group": """
            SELECT c_nationkey, max(c_acctbal) AS max_acctbal FROM customer
            GROUP BY c_nationkey ORDER BY max_acctbal DESC, c_nationkey""",
        "bucket_high_low": """
            SELECT c_custkey, c_name, c_acctbal,
                   CASE WHEN c_acctbal >= 5000 THEN 'High' ELSE 'Low' END AS balance_level
            FROM customer ORDER BY c_name, c_custkey""",
        "date_parts": """
            SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
            FROM orders ORDER BY o_orderdate, o_orderkey""",
        "tenure_months": """
            SELECT o_orderkey, upper(c_name) AS c_name, o_orderdate,
                   round(date_diff('second', o_orderdate, TIMESTAMP '2002-01-01') / 86400.0 / 30.0) AS months_30d
            FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY months_30d DESC, o_orderkey""",
        "join_lookup": """
            SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
            ORDER BY n_name, c_custkey""",
        "group_count_keep_empty": _suppliers_of(),
        "group_count_rich_suppliers": _suppliers_of("AND s_acctbal >= 6000"),
        "join_average": f"""
            SELECT n_nationkey, n_name, {_avg('c_acctbal')} AS avg_acctbal
            FROM nation JOIN customer ON n_nationkey = c_nationkey
            GROUP BY n_nationkey, n_name ORDER BY avg_acctbal DESC, n_nationkey""",
        "three_way_join": _orders_of(),
        "three_way_join_plain": _orders_of(),
        "three_way_join_large_orders": _orders_of("AND o_totalprice >= 450000"),
        "distinct_groups_keep_empty": _nations_sql(),
        "distinct_groups_large_returns": _nations_sql(_LARGE_RETURN),
        "shared_project_count": _shared_sql(),
        "shared_project_large_returns": _shared_sql(_LARGE_RETURN),
        "cte_group_filter_join": """
            WITH nation_avg AS (
                SELECT c_nationkey, avg(c_acctbal) AS a FROM customer GROUP BY c_nationkey HAVING avg(c_acctbal) >= 4600)
            SELECT c.c_custkey, c.c_name, n_name, c.c_acctbal
            FROM customer c JOIN nation ON c.c_nationkey = n_nationkey
            JOIN nation_avg a ON c.c_nationkey = a.c_nationkey ORDER BY c.c_acctbal DESC, c.c_custkey""",
        "period_increase": _INCREASE,
        "period_increase_window": _INCREASE,
        "top_two_and_overall_rank": """
            WITH ranked AS (
                SELECT c_custkey, c_name, n_name, c_acctbal,
                       rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS group_rank,
                       rank() OVER (ORDER BY c_acctbal DESC) AS overall_rank
                FROM customer JOIN nation ON c_nationkey = n_nationkey)
            SELECT * FROM ranked WHERE group_rank <= 2 ORDER BY n_name, group_rank, c_custkey""",
        "assign_rounds": f"""
            WITH {_LOG}
            SELECT {_ROUND_NO} AS round_number, count(*) AS attempts, count(DISTINCT user_id) AS users
            FROM log GROUP BY 1""",
        "round_state_activity": f"""
            WITH {_LOG}
            SELECT user_id, CASE WHEN {_ROUND_NO} > 4 THEN 'locked' WHEN {_ROUND_NO} = 4 THEN 'active'
                                 ELSE 'closed' END AS round_state, count(*) AS attempts
            FROM log GROUP BY 1, 2""",
        "round_progress": f"""
            WITH {_LOG}, {_ROUNDS}, {_PROBLEMS}, users AS (SELECT DISTINCT user_id FROM events),
            counted AS (
                SELECT u.user_id, r.round_number, any_value(starts_at) AS starts_at, any_value(ends_at) AS ends_at,
                       count(DISTINCT p.problem_id) AS problems,
                       count(DISTINCT CASE WHEN l.is_correct THEN p.problem_id END) AS solved
                FROM users u CROSS JOIN rounds r
                LEFT JOIN problems p ON p.round_number = r.round_number
                LEFT JOIN log l ON l.problem_id = p.problem_id AND l.user_id = u.user_id
                GROUP BY u.user_id, r.round_number)
            SELECT user_id, round_number,
                   CASE WHEN TIMESTAMP '2024-01-10 12:00:00' < starts_at THEN 'locked'
                        WHEN TIMESTAMP '2024-01-10 12:00:00' < ends_at THEN 'active' ELSE 'closed' END AS round_state,
                   problems, solved,
                   CASE WHEN problems > 0 THEN solved * 100.0 / CAST(problems AS DOUBLE) ELSE 0.0 END AS solved_percent
            FROM counted""",
        "latest_attempt": _latest_sql(_LOG),
        "latest_attempt_loose": _latest_sql(_LOOSE),
        "problem_board": _board_sql(_LOG),
        "problem_board_loose": _board_sql(_LOOSE),
        "problem_board_told": _board_sql(
            _LOG, "p_name AS question, p_brand AS difficulty, d.text AS sample_data,",
            "JOIN part ON p_partkey = p.problem_id JOIN documents d ON d.doc_id = p.problem_id",
        ),
        "attempt_totals": _TOTALS,
        "submission_timeliness": _timeliness_sql(_LOG, _PROBLEMS, _ROUNDS),
        "submission_timeliness_loose": _timeliness_sql(_LOOSE, _PROBLEMS, _ROUNDS),
        "submission_timeliness_given": _timeliness_sql(
            _LOG, "problems AS (SELECT n AS problem_id, n AS round_number FROM generate_series(1, 21) g(n))",
            f"{_GIVEN}, rounds AS (SELECT * FROM given)",
        ),
        "assign_rounds_given": _held_sql(_GIVEN),
        "assign_rounds_given_cells": _held_sql(_GIVEN),
        "assign_rounds_many": _held_sql(_MANY),
        "round_state_given": f"""
            WITH {_LOG}, {_GIVEN}
            SELECT user_id, CASE WHEN TIMESTAMP '2024-01-10 12:00:00' < starts_at THEN 'locked'
                                 WHEN TIMESTAMP '2024-01-10 12:00:00' < ends_at THEN 'active' ELSE 'closed' END AS round_state,
                   count(*) AS attempts
            FROM given JOIN log ON attempted_at >= starts_at AND attempted_at < ends_at GROUP BY 1, 2""",
        "user_round_matrix_given": f"""
            WITH {_LOG}, users AS (SELECT DISTINCT user_id FROM log),
            solved AS (SELECT DISTINCT user_id, problem_id, problem_id + 3 AS round_number FROM log
                       WHERE is_correct AND problem_id % 3 = 0)
            SELECT u.user_id,
                   {', '.join(f'count(*) FILTER (WHERE round_number = {n}) AS round_{n}' for n in range(0, 25, 3))},
                   count(problem_id) AS total
            FROM users u LEFT JOIN solved s ON s.user_id = u.user_id GROUP BY u.user_id""",
        "numbered_onto": f"""
            WITH {_LOG}
            SELECT * FROM (
                SELECT attempt_id, user_id, problem_id, attempted_at,
                       row_number() OVER (PARTITION BY user_id, problem_id ORDER BY attempted_at, attempt_id) AS attempt_no
                FROM log)
            WHERE attempted_at >= TIMESTAMP '2024-01-20'""",
        "shared_project_exists": _shared_sql(),
        "grade_other_table": """
            WITH a AS (SELECT c_nationkey AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n,
                              floor(c_acctbal / 2500) / 3 AS share FROM customer),
            b AS (SELECT s_nationkey AS id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n,
                         floor(s_acctbal / 2500) / 3 AS share FROM supplier),
            places AS (SELECT id, a.n AS x, b.n AS y, coalesce(a.share = b.share, false) AS agrees FROM a FULL JOIN b USING (id, n))
            SELECT n_nationkey AS submission_id, count(x) AS submitted_rows, count(y) AS expected_rows,
                   count(id) FILTER (WHERE NOT agrees) AS mismatches, count(id) FILTER (WHERE NOT agrees) = 0 AS passed
            FROM nation LEFT JOIN places ON id = n_nationkey GROUP BY n_nationkey""",
        "block_tables": """
            WITH o AS (
                SELECT CAST(floor(o_orderkey / 4) AS BIGINT) AS block_id, *, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price
                FROM orders),
            t AS (
                SELECT block_id, 1 AS table_no, 'cheap' AS title, 'id customer' AS header, o_orderkey,
                       o_orderkey || ' ' || o_custkey AS tokens FROM o WHERE o_totalprice < 200000
                UNION ALL SELECT block_id, 2, 'all', 'id price', o_orderkey, o_orderkey || ' ' || price FROM o
                UNION ALL SELECT block_id, 3, 'urgent', 'id customer', o_orderkey, o_orderkey || ' ' || o_custkey FROM o
                WHERE starts_with(o_orderpriority, '1'))
            SELECT block_id, 1 AS section_no, table_no, title,
                   CAST(3 + row_number() OVER (PARTITION BY block_id, table_no ORDER BY o_orderkey) AS INTEGER) AS line_no,
                   header, tokens
            FROM t""",
        "union_lesson_sets_of_tables": """
            WITH sets AS (
                SELECT 1 AS round_id, CAST(r_regionkey AS BIGINT) AS item_id, r_name AS item FROM region
                UNION ALL SELECT 2, n_nationkey, n_name FROM nation UNION ALL SELECT 3, s_suppkey, s_name FROM supplier
                UNION ALL SELECT 4, c_custkey, c_name FROM customer UNION ALL SELECT 5, p_partkey, p_name FROM part
                UNION ALL SELECT 6, o_orderkey, o_orderpriority FROM orders UNION ALL SELECT 7, event_id, event_type FROM events)
            SELECT round_id, row_number() OVER (PARTITION BY round_id ORDER BY item, item_id) AS position, item_id, item FROM sets""",
        "problem_array": """
            SELECT c_custkey AS id, 'is "' || c_name || '" in [debt}, or \\?' AS question, c_acctbal AS balance FROM customer""",
        "text_blocks_from_files": """
            SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS shelf,
                   row_number() OVER (PARTITION BY floor(c_custkey / 100) ORDER BY c_custkey) AS block_no, 3 AS line_no,
                   c_custkey AS id, c_name AS name
            FROM customer""",
        "rows_replaced": """
            SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 7 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM customer
            UNION ALL SELECT -1 - s_suppkey, s_nationkey, s_acctbal FROM supplier""",
        "stream_totals_folded": _TOTALS,
        "stream_late_balance": """
            SELECT count(*) AS arrived, count(*) AS kept_and_late, true AS some_late FROM events""",
        "accepted_attempts": f"""
            WITH {_LOG}, {_ROUNDS}, {_PROBLEMS}
            SELECT attempt_id, user_id, problem_id, round_number, attempted_at,
                   CASE WHEN attempted_at < starts_at THEN 'early' ELSE 'on_time' END AS timing
            FROM log JOIN problems USING (problem_id) JOIN rounds USING (round_number)
            WHERE attempted_at < ends_at""",
        "user_round_matrix": f"""
            WITH {_LOG}, {_PROBLEMS}, users AS (SELECT DISTINCT user_id FROM log),
            solved AS (SELECT DISTINCT user_id, problem_id, round_number
                       FROM log JOIN problems USING (problem_id) WHERE is_correct)
            SELECT u.user_id,
                   {', '.join(f'count(*) FILTER (WHERE round_number = {n}) AS round_{n}' for n in range(1, 8))},
                   count(problem_id) AS total
            FROM users u LEFT JOIN solved s ON s.user_id = u.user_id GROUP BY u.user_id""",
        "normalise_cells": f"""
            SELECT coalesce(lower({_strip(key)}), '') AS c_custkey, coalesce(lower({_strip('c_name')}), '') AS c_name,
                   coalesce(lower({_strip(nation)}), '') AS c_nationkey, coalesce(lower({_strip(money)}), '') AS c_acctbal,
                   coalesce(lower({_strip('c_mktsegment')}), '') AS c_mktsegment
            FROM customer""",
        "result_diff": f"""
            WITH {_NATION_COUNTS}
            SELECT nationkey, n, side, count(*) AS copies FROM diff GROUP BY nationkey, n, side""",
        "result_diff_repeated": """
            WITH a AS (SELECT c_nationkey AS nationkey FROM customer), b AS (SELECT s_nationkey AS nationkey FROM supplier),
            diff AS (SELECT nationkey, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
                     UNION ALL
                     SELECT nationkey, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
            SELECT nationkey, side, count(*) AS copies FROM diff GROUP BY nationkey, side""",
        "same_rows": f"""
            WITH {_NATION_COUNTS} SELECT count(*) = 0 AS equal, count(*) AS differing_rows FROM diff""",
        "grade_ordered_results": f"WITH {_GRADES} SELECT * FROM grades",
        "graded_log": """
            WITH graded AS (
                SELECT *, coalesce(lower(trim(role)) = CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END, false) AS ok
                FROM conversations)
            SELECT conv_id * 1000 + turn AS attempt_id, conv_id % 50 AS user_id, conv_id % 21 + 1 AS problem_id,
                   ok AS is_correct, TIMESTAMP '2024-01-01' + to_hours(conv_id % 500) AS attempted_at,
                   CASE WHEN ok THEN TIMESTAMP '2024-01-01' + to_hours(conv_id % 500) END AS completed_at,
                   CASE WHEN NOT ok THEN text END AS last_wrong_query,
                   CASE WHEN NOT ok THEN role END AS last_wrong_result
            FROM graded""",
        "graded_log_first_turn": f"""
            WITH {_GRADES}
            SELECT conv_id AS attempt_id, conv_id % 50 AS user_id, conv_id % 21 + 1 AS problem_id,
                   passed AS is_correct, TIMESTAMP '2024-01-01' + to_hours(conv_id % 500) AS attempted_at,
                   CASE WHEN passed THEN TIMESTAMP '2024-01-01' + to_hours(conv_id % 500) END AS completed_at,
                   CASE WHEN NOT passed THEN text END AS last_wrong_query,
                   CASE WHEN NOT passed THEN role END AS last_wrong_result
            FROM conversations JOIN grades ON submission_id = conv_id WHERE turn = 0""",
        "section_lines": f"""
            WITH {_LINES},
            placed AS (SELECT *, sum(CAST(is_title AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY line_no) AS section_no
                       FROM marked),
            body AS (SELECT *,
                            min(CASE WHEN NOT is_title AND line <> '' THEN line_no END)
                                OVER (PARTITION BY doc_id, section_no) AS header_no,
                            max(CASE WHEN is_title THEN line END) OVER (PARTITION BY doc_id, section_no) AS title
                     FROM placed WHERE section_no > 0),
            rest AS (SELECT *,
                            max(CASE WHEN line_no = header_no THEN tokens END)
                                OVER (PARTITION BY doc_id, section_no) AS header,
                            sum(CASE WHEN line_no > header_no AND line = '' THEN 1 ELSE 0 END)
                                OVER (PARTITION BY doc_id, section_no ORDER BY line_no) AS blanks
                     FROM body)
            SELECT doc_id, CAST(section_no AS INTEGER) AS section_no, title, CAST(line_no AS INTEGER) AS line_no,
                   array_to_string(header, ' ') AS header, array_to_string(tokens, ' ') AS tokens
            FROM rest
            WHERE line_no > header_no AND blanks = 0 AND len(tokens) = len(header)
              AND regexp_replace(line, '[-\\s]', '', 'g') <> ''""",
        "section_outline": f"""
            WITH {_LINES}
            SELECT doc_id, CAST(count(*) AS INTEGER) AS lines,
                   CAST(sum(CASE WHEN line <> '' THEN len(tokens) ELSE 0 END) AS INTEGER) AS words,
                   CAST(count(*) FILTER (WHERE is_title) AS INTEGER) AS sections
            FROM marked GROUP BY doc_id""",
        "text_block_rows": """
            SELECT c_custkey AS doc_id, 'customers' AS title, 4 AS line_no, c_custkey AS id, c_name AS name,
                   CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
            FROM customer""",
        "render_rows": f"""
            SELECT {key} || ' | ' || c_name || ' | ' || {nation} || ' | ' || {money} || ' | ' || c_mktsegment AS line
            FROM customer""",
        "render_table": _table_lines(),
        "lines_written": _table_lines(),
        "json_fields": "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events",
        "json_test_rows": """
            SELECT c_custkey, 1 AS row_no, c_custkey AS id, c_name AS name, c_acctbal AS salary FROM customer
            UNION ALL
            SELECT c_custkey, 2, c_nationkey, c_mktsegment, NULL FROM customer""",
        "json_test_cells": """
            WITH cells AS (
                SELECT c_custkey, 1 AS row_no, 1 AS col_no, 'id' AS name, 'INTEGER' AS type, c_custkey AS integer_value,
                       CAST(NULL AS DOUBLE) AS real_value, CAST(NULL AS VARCHAR) AS text_value FROM customer
                UNION ALL SELECT c_custkey, 1, 2, 'name', 'TEXT', NULL, NULL, c_name FROM customer
                UNION ALL SELECT c_custkey, 1, 3, 'salary', 'REAL', NULL, c_acctbal, NULL FROM customer
                UNION ALL SELECT c_custkey, 2, 1, 'id', 'INTEGER', c_nationkey, NULL, NULL FROM customer
                UNION ALL SELECT c_custkey, 2, 2, 'name', 'TEXT', NULL, NULL, c_mktsegment FROM customer
                UNION ALL SELECT c_custkey, 2, 3, 'salary', 'REAL', NULL, NULL, NULL FROM customer)
            SELECT * FROM cells""",
        "union_lesson_sets": """
            SELECT CAST(year(o_orderdate) - 1994 AS INTEGER) AS round_id,
                   row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS position,
                   o_orderkey, o_totalprice
            FROM orders""",
        "constraint_report": _rules_sql(),
        "constraint_report_creditors": _rules_sql("WHERE c_acctbal >= 0"),
        "iso_times": """
            SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
                       CASE WHEN date_trunc('second', ts) = ts THEN '' ELSE strftime(ts, '.%f') END AS ts_text,
                   ts AS ts_parsed
            FROM events""",
        "problem_files": """
            SELECT c_custkey AS id, c_name AS question, 'name,balance' AS names, c_name AS wanted_name,
                   c_acctbal AS wanted_balance
            FROM customer""",
        "attempts_appended": f"""
            WITH {_LOG}
            SELECT attempt_id, CAST(user_id AS VARCHAR) AS user_id, problem_id, is_correct, attempted_at,
                   CASE WHEN is_correct THEN attempted_at END AS completed_at,
                   CASE WHEN NOT is_correct THEN query_text END AS last_wrong_query,
                   CASE WHEN NOT is_correct THEN result_text END AS last_wrong_result
            FROM log""",
        "stream_attempt_totals": _TOTALS,
        "stream_round_counts": f"""
            WITH {_LOG}
            SELECT TIMESTAMP '2024-01-01' + to_days(CAST(3 * ({_ROUND_NO} - 1) AS INTEGER)) AS starts_at,
                   TIMESTAMP '2024-01-01' + to_days(CAST(3 * {_ROUND_NO} AS INTEGER)) AS ends_at,
                   count(*) AS attempts
            FROM log GROUP BY 1, 2""",
    }


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    return core_sql() | (more.oracle_sql() if more else {})
