import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.functions import times
from tallybook.operators import text
from tallybook.plans.contest import Contest
from tallybook.sources import problem_file, tables

MARK = text.TITLE_MARKER
BLOCK = "\n".join([
    "[data]", "ignored a b", f"staff {MARK}", "", "name  dept   pay", "Ann   IT     600", "Bob\tHR　null",
    "-- -- --", "too short", "Cyd   IT     n/a", "", "[answer]", "name  dept   pay", "Dan   IT     1",
    f"  depts {MARK}  ", "id", "7", "---", "8\r", f"none {MARK}",
])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, BLOCK), (2, "no table here\nat all"), (3, ""), (4, None)], "id int, body string")


def test_sections_of_a_block(docs):
    got = text.section_lines(docs, "id", "body").orderBy("id", "line_no").collect()
    assert [(r["section_no"], r["title"], r["line_no"], list(r["tokens"])) for r in got] == [
        (1, "staff", 6, ["Ann", "IT", "600"]),
        (1, "staff", 7, ["Bob", "HR", "null"]),
        (1, "staff", 10, ["Cyd", "IT", "n/a"]),
        (2, "depts", 17, ["7"]),
        (2, "depts", 19, ["8"]),
    ]
    assert {r["id"] for r in got} == {1}


def test_typed_rows(docs):
    lines = text.section_lines(docs, "id", "body").where("title = 'staff'")
    got = text.typed_rows(lines, ["line_no"], {"pay": "int", "name": "string", "absent": "int"}).orderBy("line_no")
    assert [tuple(r) for r in got.collect()] == [(6, 600, "Ann", None), (7, None, "Bob", None), (10, None, "Cyd", None)]


def test_outline(spark):
    df = spark.createDataFrame([(1, "One two\n\n three four five \nsix"), (2, "")], "id int, body string")
    got = [tuple(r) for r in text.section_outline(df, "id", "body", text.short_title(2)).orderBy("id").collect()]
    assert got == [(1, 4, 6, 2), (2, 1, 0, 0)]


def test_long_document_is_whole(spark):
    n = 20_000
    body = "\n".join([f"t {MARK}", "a b"] + [f"{i} x" for i in range(n)])
    df = spark.createDataFrame([(1, body)], "id int, body string")
    lines = text.section_lines(df, "id", "body")
    assert tuple(lines.agg(F.count("*"), F.max("line_no"), F.sum(F.col("tokens")[0].cast("long"))).first()) == (
        n, n + 2, n * (n - 1) // 2
    )


PROBLEMS = [
    {
        "id": 5, "question": "who earns enough?", "solution": "SELECT 1",
        "test_data": {"columns": ["id", "name", "pay"], "data": [[1, "Ann", 60.5], [2, "Bob", None], ["x", "Cyd", 7]]},
        "schema": [
            {"name": "id", "type": "INTEGER"}, {"name": "name", "type": "TEXT"}, {"name": "pay", "type": "REAL"},
        ],
        "expected_result": [["Ann", 60.5]],
    },
    {"id": 6, "schema": [{"name": "n", "type": "INTEGER"}], "test_data": {"columns": ["n"], "data": []}},
]


def test_problem_file(spark, tmp_path):
    path = tmp_path / "problems.json"
    path.write_text(json.dumps(PROBLEMS, indent=2))
    problems = problem_file.read_problem_files(spark, str(path))
    assert problems.count() == 2
    assert problems.where("id = 5").first()["expected_result"] == [["Ann", "60.5"]]
    rows = problem_file.test_rows(problems, ["id"], {"pay": "REAL", "name": "TEXT"}).orderBy("row_no").collect()
    assert [tuple(r) for r in rows] == [(5, 1, 60.5, "Ann"), (5, 2, None, "Bob"), (5, 3, 7.0, "Cyd")]
    cells = problem_file.test_cells(problems, ["id"]).orderBy("row_no", "col_no").collect()
    assert [(r["name"], r["integer_value"], r["real_value"], r["text_value"]) for r in cells][:3] == [
        ("id", 1, None, None), ("name", None, None, "Ann"), ("pay", None, 60.5, None)
    ]
    assert [r["integer_value"] for r in cells if r["name"] == "id"] == [1, 2, None]


def test_application_tables(spark, tmp_path):
    folder, contest = str(tmp_path), Contest(start=datetime(2025, 1, 20))
    problems = contest.problems(spark).select(
        "problem_id", "round_number", F.lit("q").alias("question"), F.lit("s").alias("correct_query"),
        F.lit("easy").alias("difficulty"), F.lit(None).cast("string").alias("sample_data"),
    )
    tables.reset_application(spark, folder, contest, problems)
    one = spark.createDataFrame(
        [(1, "ann", 1, True, datetime(2025, 1, 20, 1), datetime(2025, 1, 20, 1), None, None)], tables.ATTEMPTS
    )
    tables.append_attempts(one, folder)
    tables.append_attempts(one.withColumn("attempt_id", F.lit(2).cast("bigint")), folder)
    counts = {n: tables.read_application(spark, folder, n).count() for n in tables.APPLICATION_TABLES}
    assert counts == {"rounds": 7, "problems": 21, "attempts": 2}
    tables.reset_application(spark, folder, contest, problems)
    assert tables.read_application(spark, folder, "attempts").count() == 0


def test_lines_out_and_names_in(spark, tmp_path):
    tables.write_lines(spark.createDataFrame([("a | b",)], "line string"), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a | b"]
    tables.register_tables(spark, "/root/testdata/sf0.001", ["nation", "region"])
    got = spark.sql("SELECT count(*) AS n FROM nation WHERE n_nationkey >= ?", args=[20]).first()
    assert got["n"] == 5 and spark.table("region").count() == 5


def test_times(spark):
    df = spark.createDataFrame([("2025-01-20T23:59:59",), ("2025-01-20 23:59:59",)], "s string")
    parsed = df.select(times.parse_iso(F.col("s")).alias("t"))
    assert {r["t"] for r in parsed.collect()} == {datetime(2025, 1, 20, 23, 59, 59)}
    assert {r[0] for r in parsed.select(times.iso_text(F.col("t"))).collect()} == {"2025-01-20T23:59:59"}
    days = parsed.select(times.days_between(F.lit(datetime(2025, 1, 20)).cast("timestamp_ntz"), F.col("t"))).first()[0]
    assert abs(days - 86399 / 86400) < 1e-12
