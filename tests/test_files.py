"""Arrays in one file, blocks from files, states that change at once, rows replaced by key."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.functions import times
from tallybook.operators import text
from tallybook.plans import versions
from tallybook.plans.contest import Contest
from tallybook.session import session_settings
from tallybook.sources import json_array, problem_file, tables

MARK = text.TITLE_MARKER
TRICKY = ['a"b', "}{", '\\"', "\\", "[]", "x\ny", "é}", '\\\\"}', "", '{"a": [1}', " "]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_by_ranges(spark, tmp_path, indent):
    rnd = random.Random(2)
    problems = [
        {"id": i, "question": rnd.choice(TRICKY), "test_data": {"columns": [rnd.choice(TRICKY)], "data": [[i, rnd.choice(TRICKY), None]]}}
        for i in range(300)
    ]
    path = str(tmp_path / "problems.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(problems, file, indent=indent, ensure_ascii=indent is None)
    with session_settings(spark, spark__sql__files__maxPartitionBytes="2500", spark__sql__files__openCostInBytes="0"):
        assert spark.read.option("lineSep", "}").text(path).select(F.spark_partition_id()).distinct().count() > 5
        found = {r["record_no"]: json.loads(r["record"]) for r in json_array.json_records(spark, path).collect()}
        rows = json_array.read_json_array(spark, path, problem_file.PROBLEM)
        assert [found[i + 1] for i in range(300)] == problems
        assert sorted(rows.collect(), key=str) == sorted(problem_file.read_problem_files(spark, path).collect(), key=str)


@pytest.mark.parametrize("body,want", [("[]", []), ("[ ]\n", []), ("[{}]", ["{}"]), ('[{"a":1},\n{}]', ['{"a":1}', "{}"]), ("", [])])
def test_small_arrays(spark, tmp_path, body, want):
    (tmp_path / "a.json").write_text(body)
    found = json_array.json_records(spark, str(tmp_path / "a.json")).orderBy("record_no").collect()
    assert [r["record"] for r in found] == want


def test_blocks_from_files(spark, tmp_path):
    for name, blocks in (("a", ["x\ny", "", "z"]), ("b", ["q" * 500, "r"])):
        (tmp_path / f"{name}.txt").write_text("\n==\n".join(blocks))
    with session_settings(spark, spark__sql__files__maxPartitionBytes="100", spark__sql__files__openCostInBytes="0"):
        found = tables.read_blocks(spark, str(tmp_path), "\n==\n").collect()
    assert sorted((r["file"][-5], r["block_no"], r["block"]) for r in found) == [
        ("a", 1, "x\ny"), ("a", 2, ""), ("a", 3, "z"), ("b", 1, "q" * 500), ("b", 2, "r"),
    ]
    whole = tables.read_blocks(spark, str(tmp_path)).collect()
    assert sorted(len(r["block"]) for r in whole) == [12, 505] and {r["block_no"] for r in whole} == {1}


BLOCKS = [
    f"[x]\nstaff {MARK}        depts {MARK}\nid  name    dept_id    id  dept\n1   Ann     1          1   IT\n2   Bob     2          2   HR\n3   Cyd     1\n\n[y]\nid  name\n9   no",
    f"a {MARK}    b {MARK}    c {MARK}\nname  dept_id pid  id  dept         id  pname\nAnn   1       1    1   IT           1   Alpha\nBob   1       2    2   Marketing    2   Beta",
    f"l {MARK}   r {MARK}\nid  v     id  w\n1   x     1   p\n          2   q\n--  -     --  -\n          3   r\n  {MARK}\nq r\n1 2\nt {MARK}\na b\n1 2",
    f"only {MARK} other {MARK}\nx y\n1 2", f"{MARK}\na b\n1 2", "", None,
]


def test_tables_side_by_side(spark):
    docs = spark.createDataFrame(list(enumerate(BLOCKS)), "id int, body string")
    found = sorted(
        (r["id"], r["section_no"], r["table_no"], r["title"], r["line_no"], " ".join(r["tokens"]))
        for r in text.block_tables(docs, "id", "body").collect()
    )
    assert found == [
        (0, 1, 1, "staff", 4, "1 Ann 1"), (0, 1, 1, "staff", 5, "2 Bob 2"), (0, 1, 1, "staff", 6, "3 Cyd 1"),
        (0, 1, 2, "depts", 4, "1 IT"), (0, 1, 2, "depts", 5, "2 HR"),
        (1, 1, 1, "a", 3, "Ann 1 1"), (1, 1, 1, "a", 4, "Bob 1 2"), (1, 1, 2, "b", 3, "1 IT"), (1, 1, 2, "b", 4, "2 Marketing"),
        (1, 1, 3, "c", 3, "1 Alpha"), (1, 1, 3, "c", 4, "2 Beta"),
        (2, 1, 1, "l", 3, "1 x"), (2, 1, 2, "r", 3, "1 p"), (2, 1, 2, "r", 4, "2 q"), (2, 1, 2, "r", 6, "3 r"), (2, 3, 1, "t", 12, "1 2"),
        (3, 1, 1, "only", 3, "1"), (3, 1, 2, "other", 3, "2"),
    ]
    assert text.section_lines(docs.where("id = 4"), "id", "body").count() == 0


def test_side_by_side_with_other_white_space(spark):
    block = (
        f" l {MARK}".ljust(70) + f"\u3000r {MARK}\n\x1f\u2003\n" + "\tid\u00a0 \u2003v".ljust(70) + "id\tw\U0001d11e\n"
        + "1\u2009 \U0001d11e\u00e9".ljust(70) + "\u30001 -\u1680\n" + "\u2003--  -".ljust(70) + "-\x1c-\n" + "2 x".ljust(130) + "\n\x0b"
    )
    found = text.block_tables(spark.createDataFrame([(1, block)], "id int, body string"), "id", "body")
    assert sorted((r["table_no"], r["title"], r["line_no"], r["header"], r["tokens"]) for r in found.collect()) == [
        (1, "l", 4, ["id", "v"], ["1", "\U0001d11e\u00e9"]), (1, "l", 6, ["id", "v"], ["2", "x"]),
        (2, "r", 4, ["id", "w\U0001d11e"], ["1", "-"]),
    ]


def test_a_cut_is_computed_once(spark):
    docs = spark.createDataFrame(list(enumerate(BLOCKS)), "id int, body string")
    plan = text.block_tables(docs, "id", "body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count(" AS _starts") == 1
    assert not any("size(transform" in line for line in plan.splitlines() if "Filter" in line)


def test_long_block_side_by_side(spark):
    rows = "\n".join(f"{i:<8}{i + 1:<30}{i:<8}{i % 7}" for i in range(3_000))
    block = f"l {MARK}".ljust(38) + f"r {MARK}\n" + "a".ljust(8) + "b".ljust(30) + "c".ljust(8) + "d\n" + rows
    found = text.block_tables(spark.createDataFrame([(1, block)], "id int, body string"), "id", "body")
    assert [tuple(r) for r in found.groupBy("table_no").count().orderBy("table_no").collect()] == [(1, 3000), (2, 3000)]


def test_a_state_is_whole(spark, tmp_path):
    folder, contest = str(tmp_path), Contest(start=datetime(2025, 1, 20))
    assert versions.current(spark, folder) is None
    with pytest.raises(ValueError):
        tables.read_application(spark, folder, "rounds")
    tables.reset_application(spark, folder, contest)
    reader = tables.read_application(spark, folder, "rounds")
    before = versions.current(spark, folder)
    broken = contest.calendar(spark).withColumn("starts_at", F.raise_error("no").cast("timestamp_ntz"))
    with pytest.raises(Exception):
        tables.reset_application(spark, folder, contest, rounds=broken)
    assert versions.current(spark, folder) == before and tables.read_application(spark, folder, "rounds").count() == 7
    tables.reset_application(spark, folder, contest, rounds=contest.calendar(spark).limit(2))
    assert tables.read_application(spark, folder, "rounds").count() == 2
    assert reader.count() == 7  # one that began before still reads the old state
    assert versions.drop_versions(spark, folder, set()) == 2
    assert tables.read_application(spark, folder, "rounds").count() == 2


def test_rows_are_replaced_by_key(spark, tmp_path):
    folder = str(tmp_path / "t")
    schema = "k int, j string, v int"
    tables.write_keyed(spark.createDataFrame([(i, "a", 0) for i in range(50)] + [(None, None, 0), (None, "a", 0)], schema), folder, ["k", "j"], 8)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    updates = spark.createDataFrame([(3, "a", 1), (3, "b", 2), (None, None, 3)], schema)
    tables.replace_keyed(updates, folder, ["k", "j"], 8)
    found = {(r["k"], r["j"]): r["v"] for r in tables.read_keyed(spark, folder).collect()}
    assert found == {**{(i, "a"): 0 for i in range(50)}, (None, "a"): 0, (3, "a"): 1, (3, "b"): 2, (None, None): 3}
    assert sum(p.exists() and p.stat().st_mtime_ns == t for p, t in untouched.items()) >= 4
    tables.replace_keyed(updates.limit(0), folder, ["k", "j"], 8)
    assert tables.read_keyed(spark, folder).count() == 53


def test_iso_fractions_and_bad_text(spark):
    texts = ["2025-01-20T23:59:59.123456", "2025-01-20T23:59:59.5", "2025-01-20 23:59", "2025-13-20T00:00:00", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(times.parse_iso(F.col("s")).alias("t"))
    at = datetime(2025, 1, 20, 23, 59)
    want = [at.replace(second=59, microsecond=123456), at.replace(second=59, microsecond=500000), at, None, None, None, None]
    assert [r["t"] for r in df.collect()] == want
    assert [r[0] for r in df.select(times.iso_text(F.col("t"))).collect()][:3] == [
        "2025-01-20T23:59:59.123456", "2025-01-20T23:59:59.500000", "2025-01-20T23:59:00",
    ]


def test_columns_are_those_of_the_files(spark, tmp_path):
    spark.createDataFrame([(1, "x", 5)], "n_nationkey int, n_name string, extra int").write.parquet(f"{tmp_path}/nation.parquet")
    assert tables.read_table(spark, str(tmp_path), "nation").columns == ["n_nationkey", "n_name", "extra"]
