"""Streams over many files give what the batch jobs give."""

import time
from datetime import datetime

import pytest

from tallybook.operators import progress
from tallybook.plans.contest import Contest
from tallybook.sources.tables import attempt_log, read_table
from tallybook.streaming import attempts as streams

CONTEST = Contest(start=datetime(2024, 1, 1))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events as five files that arrive one after the other."""
    folder = str(tmp_path_factory.mktemp("arrivals"))
    events = read_table(spark, SF, "events")
    for i in range(5):
        events.where(f"event_id % 5 = {i}").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def source(spark, folder):
    return lambda: attempt_log(streams.stream_table(spark, folder, "events", files_per_batch=1), CONTEST)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_attempt_totals(spark, parts):
    before = spark.conf.get("spark.sql.session.timeZone")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    got = streams.stream_attempt_totals(spark, source(spark, parts), state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert rows(got) == rows(progress.attempt_totals(attempt_log(read_table(spark, SF, "events"), CONTEST)))
    assert spark.conf.get("spark.sql.session.timeZone") == before


def test_round_counts(spark, parts):
    got = streams.stream_round_counts(spark, source(spark, parts), CONTEST, late_by="60 days")
    batch = progress.round_activity(attempt_log(read_table(spark, SF, "events"), CONTEST), CONTEST)
    start = CONTEST.starts_at
    want = batch.select(
        start(batch.round_number).alias("starts_at"), start(batch.round_number + 1).alias("ends_at"), "attempts"
    )
    assert rows(got) == rows(want)


def test_start_inside_a_day(spark, parts):
    contest = Contest(start=datetime(2024, 1, 2, 6, 30), round_days=2)
    got = streams.stream_round_counts(spark, source(spark, parts), contest, late_by="60 days")
    batch = progress.round_activity(attempt_log(read_table(spark, SF, "events"), contest), contest)
    assert sorted(r["attempts"] for r in got.collect()) == sorted(r["attempts"] for r in batch.collect())


def test_table_of_many_files_and_one_file(spark, tmp_path):
    log = attempt_log(read_table(spark, SF, "events"), CONTEST)
    read_table(spark, SF, "events").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for folder in (str(tmp_path), SF):
        got = streams.stream_attempt_totals(spark, source(spark, folder))
        assert rows(got) == rows(progress.attempt_totals(log))


def test_empty_stream(spark, tmp_path):
    (tmp_path / "events.parquet").mkdir()
    got = streams.stream_attempt_totals(spark, source(spark, str(tmp_path)))
    assert got.count() == 0 and "ever_solved" in got.columns


def arrive(spark, folder, number, moments):
    rows = [(number * 100 + i, at, 1, "view", 0.0, '{"k": 1}') for i, at in enumerate(moments)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    time.sleep(1.1)  # files are taken in the order of their times


def test_goes_on_where_it_ended(spark, tmp_path):
    location, day = f"{tmp_path}/report", datetime(2024, 1, 2)
    arrive(spark, tmp_path, 1, [day, day])
    first = streams.stream_attempt_totals(spark, source(spark, str(tmp_path)), location)
    assert [r["attempts"] for r in first.collect()] == [2]
    arrive(spark, tmp_path, 2, [day])
    for _ in range(2):  # the second time there is nothing new
        again = streams.stream_attempt_totals(spark, source(spark, str(tmp_path)), location)
        assert [r["attempts"] for r in again.collect()] == [3]


def test_late_attempts(spark, tmp_path):
    arrive(spark, tmp_path, 1, [datetime(2024, 1, 20)])
    arrive(spark, tmp_path, 2, [datetime(2024, 1, 20)])
    arrive(spark, tmp_path, 3, [datetime(2024, 1, 1), datetime(2024, 1, 19)])

    def counts(late_by):
        got = streams.stream_round_counts(spark, source(spark, str(tmp_path)), CONTEST, late_by)
        return {r["starts_at"].day: r["attempts"] for r in got.collect()}

    assert counts("1 day") == {19: 3}
    assert counts(None) == {1: 1, 19: 3}


def test_folded_change_log(spark, parts, tmp_path):
    """Folding, going on, and a batch that is done twice change nothing in the report."""
    want = rows(progress.attempt_totals(attempt_log(read_table(spark, SF, "events"), CONTEST)))
    for every in (1, 2, 99):
        location = f"{tmp_path}/{every}"
        got = streams.stream_attempt_totals(spark, source(spark, parts), location, fold_every=every)
        assert rows(got) == want
    batches = sorted(p.name for p in (tmp_path / "1/changes").iterdir())
    assert batches == ["batch_id=4"] and len(list((tmp_path / "1/snapshots").glob("upto-*"))) == 2
    keys = ["user_id", "problem_id"]
    log = streams.ChangeLog(spark, f"{tmp_path}/2", keys, got.schema, 2)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "2/changes").iterdir())
    again = spark.read.parquet(f"{tmp_path}/2/changes/batch_id={last}").select(*got.columns)
    spark.createDataFrame(again.collect(), got.schema).createOrReplaceTempView("again")
    log.save(spark.createDataFrame(again.collect(), got.schema), last)
    assert rows(log.report()) == want


@pytest.mark.parametrize("order", [[1, 20, 2, 25, 19, 3], [25, 20, 19, 3, 2, 1], [1, 2, 3, 19, 20, 25]])
def test_late_and_kept_add_up(spark, tmp_path, order):
    location = f"{tmp_path}/closing"
    for n, day in enumerate(order[:3] + order[3:]):
        arrive(spark, tmp_path, n, [datetime(2024, 1, day), datetime(2024, 1, day, 5)])
    counts = streams.stream_closing_rounds(spark, source(spark, str(tmp_path)), CONTEST, "1 day", location)
    seen = counts.seen().collect()
    late = counts.late(attempt_log(read_table(spark, SF, "events"), CONTEST).schema)
    kept = sum(r["attempts"] for r in counts.counts().collect())
    assert len(seen) == 6 and sum(r["arrived"] for r in seen) == 12 == kept + late.count()
    assert (kept, late.count()) == (sum(r["kept"] for r in seen), sum(r["late"] for r in seen))
    newest, want = 0, 0
    for day in order:  # rounds start on days 1, 4, ..., 25
        want += 2 * ((day - 1) // 3 * 3 + 4 <= newest - 1)
        newest = max(newest, day)
    assert late.count() == want
    again = streams.stream_closing_rounds(spark, source(spark, str(tmp_path)), CONTEST, "1 day", location)
    assert again.seen().count() == 6
