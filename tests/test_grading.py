import pytest
from pyspark.sql import functions as F

from tallybook.operators import grading, quality


def verdicts(spark, submitted, expected, submissions=None):
    schema = "submission_id int, row_no int, a string, b string"
    sides = [
        grading.long_form(spark.createDataFrame(s, schema), "submission_id", "row_no", ["a", "b"])
        for s in (submitted, expected)
    ]
    ids = None if submissions is None else spark.createDataFrame([(i,) for i in submissions], "submission_id int")
    return {r["submission_id"]: r["passed"] for r in grading.grade_ordered_results(*sides, ids).collect()}


KEY = [(1, "x", "1"), (2, "y", "2")]
CASES = {
    "equal": (KEY, True),
    "case and space": ([(1, " X\t", "1"), (2, "Y", "2\n")], True),
    "no-break space": ([(1, " x", "1　"), (2, "y", "2")], True),
    "other order": ([(1, "y", "2"), (2, "x", "1")], False),
    "missing row": ([(1, "x", "1")], False),
    "extra row": ([*KEY, (3, "z", "3")], False),
    "other cell": ([(1, "x", "1"), (2, "y", "3")], False),
    "row twice": ([*KEY, (2, "y", "2")], False),
    "nothing": ([], False),
    "inner space": ([(1, "x", "1"), (2, "y ", " 2")], True),
}


def test_grades(spark):
    submitted = [(i, *row) for i, (rows, _) in enumerate(CASES.values()) for row in rows]
    expected = [(i, *row) for i in range(len(CASES)) for row in KEY]
    got = verdicts(spark, submitted, expected)
    assert {name: got[i] for i, name in enumerate(CASES)} == {name: want for name, (_, want) in CASES.items()}


def test_null_equals_empty_text_and_both_empty_passes(spark):
    assert verdicts(spark, [(1, 1, None, "")], [(1, 1, "", None)], submissions=[1, 2]) == {1: True, 2: True}


def test_widths_differ(spark):
    narrow = grading.long_form(spark.createDataFrame([(1, 1, "x")], "s int, r int, a string"), "s", "r", ["a"])
    wide = grading.long_form(spark.createDataFrame([(1, 1, "x", "y")], "s int, r int, a string, b string"), "s", "r", ["a", "b"])
    assert not grading.grade_ordered_results(narrow, wide).first()["passed"]


def test_numbers_as_text(spark):
    df = spark.createDataFrame([(1, 1e7, None), (2, 0.5, " A ")], "i int, x double, s string")
    rounded = grading.normalise_cells(df, scale=2)
    assert [tuple(r) for r in rounded.collect()] == [("1", "10000000.00", ""), ("2", "0.50", "a")]
    assert [tuple(r) for r in grading.normalise_cells(df).collect()] == [("1", "10000000.0", ""), ("2", "0.5", "a")]


def test_no_digit_is_cut(spark):
    values = [3.141, 3.144, 1.0e-5, 123456789.125, float("nan"), float("inf"), None, 1e30]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    texts = [r[0] for r in grading.normalise_cells(df).collect()]
    assert texts == ["3.141", "3.144", "0.00001", "123456789.125", "nan", "infinity", "", "1.0e30"]
    given = spark.createDataFrame([(1, 1, 3.141), (2, 1, 3.141), (2, 2, 1.0)], "s int, n int, x double")
    key = spark.createDataFrame([(1, 1, 3.144), (2, 1, 3.141)], "s int, n int, x double")
    graded = grading.grade_ordered_results(*[grading.long_form(d, "s", "n", ["x"]) for d in (given, key)])
    assert {r.submission_id: (r.mismatches, r.passed) for r in graded.collect()} == {1: (1, False), 2: (1, False)}


def test_result_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "i int, s string")
    b = spark.createDataFrame([(2, None), (1, "x"), (4, "w"), (4, "w")], "j int, t string")
    got = {(r["i"], r["s"], r["side"], r["copies"]) for r in grading.result_diff(a, b).collect()}
    assert got == {(1, "x", "left", 1), (3, "z", "left", 1), (4, "w", "right", 2)}
    assert grading.result_diff(a, a.orderBy(F.desc("i"))).count() == 0
    assert tuple(grading.same_rows(a, a).first()) == (True, 0)
    assert tuple(grading.same_rows(a, b).first()) == (False, 4)


def test_render(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 1.5)], "i int, s string, x double")
    assert sorted(r["line"] for r in grading.render_rows(df, scale=2).collect()) == ["1 | a | 1.50", "2 | b | None"]
    lines = [r["line"] for r in grading.render_table(df, [F.col("i")], scale=2).collect()]
    assert lines == ["i | s | x", "---------", "1 | a | 1.50", "2 | b | None"]
    assert [r["line"] for r in grading.render_table(df.where("i > 9"), [F.col("i")]).collect()] == [grading.NO_ROWS]


def test_constraints(spark):
    t = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (None, None), (1, 7)], "a int, b int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    report = quality.constraint_report([
        quality.not_null_violations(t, "t", ["a", "b"]),
        quality.unique_violations(t, "t", ["a"]),
        quality.unique_violations(t, "t", ["a", "b"]),
        quality.foreign_key_violations(t, "t", "b", parent, "p"),
    ])
    got = {(r["rule"], r["subject"]): r["violations"] for r in report.collect()}
    assert got == {
        ("not_null", "t.a"): 2, ("not_null", "t.b"): 1, ("unique", "t.a"): 2, ("unique", "t.a+b"): 0,
        ("foreign_key", "t.b"): 1,
    }
    empty = quality.unique_violations(t.where("a > 9"), "t", ["a"]).first()
    assert empty["violations"] == 0


@pytest.mark.parametrize("cols", [["i"], None])
def test_normalise_chooses_columns(spark, cols):
    df = spark.createDataFrame([(1, "A")], "i int, s string")
    assert grading.normalise_cells(df, cols).columns == (cols or ["i", "s"])
