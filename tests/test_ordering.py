"""Ranks, numbers and previous values across ranges, against brute force."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tallybook.operators import ranking
from tallybook.plans import ordering, skew


def data(seed, n=400):
    """A third of the rows belong to one key and a third share one value."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if r.random() < 1 / 3 else r.randrange(1, 40)
        value = 7.0 if r.random() < 1 / 3 else (None if r.random() < 0.05 else float(r.randrange(60)))
        out.append((i, None if r.random() < 0.02 else key, r.randrange(50), value))
    return out


SCHEMA = "id int, k int, at int, v double"


def rank_of(value, values):
    if value is None:
        return 1 + sum(v is not None for v in values)
    return 1 + sum(v is not None and v > value for v in values)


@pytest.mark.parametrize("ranges", [1, 3, 13])
def test_overall_rank(spark, ranges):
    d = data(1)
    got = {r["v"]: r["overall_rank"] for r in ordering.overall_rank(spark.createDataFrame(d, SCHEMA), "v", ranges=ranges).collect()}
    values = [x[3] for x in d]
    assert got == {v: rank_of(v, values) for v in set(values)}


@pytest.mark.parametrize("ranges", [1, 3, 13])
def test_number_rows(spark, ranges):
    df = spark.createDataFrame(data(2), SCHEMA)
    got = ordering.number_rows(df, ["k"], [F.col("at"), F.col("id")], ranges=ranges)
    assert got.columns == [*df.columns, "position"]
    plain = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("at", "id")).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("ranges", [1, 3, 13])
def test_previous_value_over_ranges(spark, ranges):
    df = spark.createDataFrame(data(3), SCHEMA)
    got = ordering.previous_value(df, "k", [F.col("at"), F.col("id")], "v", "p", ranges=ranges)
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at", "id")))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("layout", [ranking.WINDOW, ranking.RANGES])
def test_with_previous_both_ways(spark, layout):
    df = spark.createDataFrame(data(4), SCHEMA)
    got = ranking.with_previous(df, "k", "at", "id", "v", "p", layout, ranges=5)
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at", "id")))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_unknown_layouts_are_refused(spark):
    df = spark.createDataFrame(data(5), SCHEMA)
    with pytest.raises(ValueError):
        ranking.with_previous(df, "k", "at", "id", "v", layout="hot")
    with pytest.raises(ValueError):
        skew.left_join(df, df, "k", "k", "hot")


@pytest.mark.parametrize("k", [1, 2, 5])
def test_top_k_keeps_all_ties(spark, k):
    d = [x for x in data(6) if x[1] is not None]
    df = spark.createDataFrame(d, SCHEMA)
    dim = spark.createDataFrame([(i, f"g{i}") for i in range(30)], "gid int, g string")
    got = ranking.top_k_and_overall_rank(df, dim, "k", "gid", "v", k, "id", "g", ranges=4)
    inside = [x for x in d if x[1] < 30]
    everything = [x[3] for x in inside]
    want = set()
    for i, key, _, v in inside:
        place = rank_of(v, [x[3] for x in inside if x[1] == key])
        if place <= k:
            want.add((i, place, rank_of(v, everything)))
    assert {(r["id"], r["group_rank"], r["overall_rank"]) for r in got.collect()} == want


@pytest.mark.parametrize("layout", [ranking.WINDOW, ranking.RANGES])
def test_group_leaders_both_ways(spark, layout):
    d = data(7)
    got = ranking.group_leaders(spark.createDataFrame(d, SCHEMA), "k", "v", 4, "id", layout, ranges=5)
    want = set()
    for _, key, _, v in d:
        place = rank_of(v, [x[3] for x in d if x[1] == key])
        if place <= 4:
            want.add((key, v, place))
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_a_missing_key_can_be_hot(spark):
    d = [(i, None if i % 3 else 1, i % 7, float(i)) for i in range(60)]
    df = spark.createDataFrame(d, SCHEMA)
    got = ranking.with_previous(df, "k", "at", "id", "v", "p", ranges=4)
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at", "id")))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_union_lesson_sets(spark):
    sets = {n: spark.createDataFrame([(f"q{n}{i}", i) for i in range(n)], "q string, i int") for n in (1, 2, 3)}
    got = ranking.union_lesson_sets(sets, ["i", "q"], ranges=3)
    assert sorted((r["round_id"], r["position"], r["q"]) for r in got.collect()) == [
        (1, 1, "q10"), (2, 1, "q20"), (2, 2, "q21"), (3, 1, "q30"), (3, 2, "q31"), (3, 3, "q32")
    ]


def test_numbered_sets(spark):
    df = spark.createDataFrame([(n, i) for n in (1, 2, 3) for i in range(n)], "n int, i int")
    got = ranking.numbered_sets(df, F.col("n") * 10, ["i"], ranges=3)
    assert sorted((r["round_id"], r["position"], r["i"]) for r in got.collect()) == [
        (10, 1, 0), (20, 1, 0), (20, 2, 1), (30, 1, 0), (30, 2, 1), (30, 3, 2)
    ]


@pytest.mark.parametrize("layout", [skew.PLAIN, skew.SPLIT])
def test_left_join_both_ways(spark, layout):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "lk int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (1, "r"), (None, "s"), (None, "t"), (3, "u"), (4, "v")], "rk int, y string")
    got = skew.left_join(left, right, "lk", "rk", layout)
    want = left.join(right, F.col("lk") == F.col("rk"), "left")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.columns == want.columns
