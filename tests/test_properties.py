"""Results on random data against a few lines of Python."""

import random
from collections import Counter

import pytest

from tallybook.operators import grading, joins


@pytest.mark.parametrize("seed", range(3))
def test_diff_is_the_difference_of_bags(spark, seed):
    r = random.Random(seed)
    # A third of all rows are copies of one row.
    sides = [
        [("hot", 0) if r.random() < 1 / 3 else (r.choice("abc"), r.choice([None, 1, 2])) for _ in range(r.randrange(120))]
        for _ in range(2)
    ]
    a, b = (spark.createDataFrame(s, "s string, i int") for s in sides)
    left, right = Counter(sides[0]), Counter(sides[1])
    want = {(*k, "left", n) for k, n in (left - right).items()} | {(*k, "right", n) for k, n in (right - left).items()}
    assert {tuple(x) for x in grading.result_diff(a, b).collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_grades_are_list_comparisons(spark, seed):
    r = random.Random(seed)
    ids = list(range(40))
    key = {i: [r.choice(["A", "b", None]) for _ in range(r.randrange(5))] for i in ids}
    sent = {}
    for i in ids:
        rows = [c if r.random() < 0.9 else "x" for c in key[i]]
        if r.random() < 0.2:
            r.shuffle(rows)
        if r.random() < 0.2:
            rows = rows[:-1]
        sent[i] = [c.lower() + " " if c and r.random() < 0.5 else c for c in rows]

    def frame(side):
        flat = [(i, n, c) for i, rows in side.items() for n, c in enumerate(rows)]
        return grading.long_form(spark.createDataFrame(flat, "i int, n int, c string"), "i", "n", ["c"])

    got = grading.grade_ordered_results(frame(sent), frame(key), spark.createDataFrame([(i,) for i in ids], "submission_id int"))

    def plain(rows):
        return [(c or "").lower().strip() for c in rows]

    assert {x["submission_id"]: x["passed"] for x in got.collect()} == {i: plain(sent[i]) == plain(key[i]) for i in ids}


@pytest.mark.parametrize("seed", range(3))
def test_shared_projects(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(6), 0 if r.random() < 1 / 3 else r.randrange(25)) for _ in range(60)]
    depts = spark.createDataFrame([(i, f"d{i}") for i in range(8)], "id int, name string")
    got = joins.shared_project_count(depts, spark.createDataFrame(pairs, "d int, p int"), "id", "d", "p")
    want = {
        d: len({p for e, p in pairs if e == d and any(o != d and q == p for o, q in pairs)}) for d in range(8)
    }
    assert {x["id"]: x["shared_projects"] for x in got.collect()} == want
