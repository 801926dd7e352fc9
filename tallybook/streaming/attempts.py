"""Attempt reports kept up to date from a stream of attempts.

Each micro-batch writes only the rows that changed, to a folder of its own that a retry replaces. Every
few batches these are folded into a snapshot with the newest row per key, which is put in force at once;
reading then costs one row per key and the few batches since. State is one row per key and lives in
RocksDB, on disk.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tallybook.functions.times import moment
from tallybook.operators.progress import attempt_totals
from tallybook.plans.contest import Contest
from tallybook.plans.versions import current, drop_versions, publish
from tallybook.session import hadoop_path, location_exists, new_location, session_settings
from tallybook.sources.tables import STORED_TABLES

FOLD_EVERY = 16  # batches between two snapshots of a change log
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files, be it one file or a folder that files are added to."""
    reader = spark.readStream.schema(STORED_TABLES[name])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a pattern the path may be a file as well as a folder.
    return reader.parquet(f"{folder}/{name}[.]parquet")


def newest_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last written row of each key, with the batch that wrote it."""
    rest = [c for c in changes.columns if c not in keys and c != "batch_id"]
    # Column by column, as fixed-width values need no sort.
    newest = [F.max_by(c, "batch_id").alias(c) for c in rest]
    return changes.groupBy(*keys).agg(*newest, F.max("batch_id").alias("batch_id"))


class ChangeLog:
    """Changed rows by batch below ``location``, folded into a snapshot after every ``fold_every`` batches.

    Folded batches are deleted one fold later, so that a reader that began before the fold still finds them;
    the same goes for snapshots.
    """

    def __init__(self, spark: SparkSession, location: str, keys: list[str], schema: T.StructType, fold_every: int):
        self.spark, self.location, self.keys, self.fold_every = spark, location, keys, fold_every
        self.schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])

    def _snapshot(self) -> tuple[str | None, int]:
        """The snapshot in force, and the last batch in it."""
        name = current(self.spark, f"{self.location}/snapshots")
        return name, int(name.split("-")[1]) if name else -1

    def _changes(self, after: int) -> DataFrame | None:
        if not location_exists(self.spark, f"{self.location}/changes"):
            return None
        found = self.spark.read.schema(self.schema).parquet(f"{self.location}/changes")
        return found.where(F.col("batch_id") > after)  # a folder a batch, so only new ones are read

    def _rows(self) -> DataFrame | None:
        name, last = self._snapshot()
        changes = self._changes(last)
        if name is None:
            return changes
        rows = self.spark.read.schema(self.schema).parquet(f"{self.location}/snapshots/{name}/rows.parquet")
        return rows if changes is None else rows.unionByName(changes)

    def save(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch; a retry of it replaces what it wrote, also if it had been folded."""
        batch.write.mode("overwrite").parquet(f"{self.location}/changes/batch_id={batch_id}")
        name, last = self._snapshot()
        if batch_id - last >= self.fold_every:
            folded = newest_per_key(self._rows(), self.keys).select(*self.schema.names)
            publish(self.spark, f"{self.location}/snapshots", {"rows": folded}, f"upto-{batch_id}")
            if name is not None:
                drop_versions(self.spark, f"{self.location}/snapshots", {name})
                self._drop_changes(last)

    def _drop_changes(self, last: int) -> None:
        folder, files = hadoop_path(self.spark, f"{self.location}/changes")
        for status in files.listStatus(folder):
            batch = status.getPath().getName().removeprefix("batch_id=")
            if batch.isdigit() and int(batch) <= last:
                files.delete(status.getPath(), True)

    def report(self) -> DataFrame:
        """The newest row of every key."""
        rows = self._rows()
        if rows is None:
            return self.spark.createDataFrame([], self.schema).drop("batch_id")
        return newest_per_key(rows, self.keys).select(*self.schema.names).drop("batch_id")


def _run(spark: SparkSession, query_of: Callable[[], DataStreamWriter], location: str, **settings) -> None:
    """Run a stream over all there is."""
    common = {
        "spark__sql__session__timeZone": "UTC",
        "spark__sql__streaming__stateStore__providerClass": _ROCKSDB,
    }
    with session_settings(spark, **common, **settings):
        writer = query_of().option("checkpointLocation", f"{location}/state").trigger(availableNow=True)
        writer.start().awaitTermination()


def run_available(
    spark: SparkSession, build: Callable[[], DataFrame], keys: list[str], label: str, location: str | None = None,
    state_partitions: int | None = None, fold_every: int = FOLD_EVERY,
) -> DataFrame:
    """Run a stream over all there is, and give the finished report.

    With a ``location`` of its own a stream goes on where its last run ended; without one it
    starts from nothing. Each state partition is a store of its own, kept for good, so their number
    goes by the keys (``state_partitions``), not by the size of the input.
    """
    location = location or new_location(spark, label)
    settings = {"spark__sql__shuffle__partitions": str(state_partitions)} if state_partitions else {}
    log: list[ChangeLog] = []

    def query() -> DataStreamWriter:
        changes = build()
        log.append(ChangeLog(spark, location, keys, changes.schema, fold_every))
        return changes.writeStream.outputMode("update").foreachBatch(log[0].save)

    _run(spark, query, location, **settings)
    return log[0].report()


def stream_attempt_totals(
    spark: SparkSession, attempts: Callable[[], DataFrame], location: str | None = None,
    state_partitions: int | None = None, fold_every: int = FOLD_EVERY,
) -> DataFrame:
    """Totals per user and problem from a stream of attempts."""
    keys = ["user_id", "problem_id"]
    return run_available(
        spark, lambda: attempt_totals(attempts()), keys, "attempt-totals", location, state_partitions, fold_every
    )


def stream_round_counts(
    spark: SparkSession, attempts: Callable[[], DataFrame], contest: Contest, late_by: str | None = None,
    location: str | None = None,
) -> DataFrame:
    """Attempts per round from a stream, however late they come and however files fall into batches.

    State is one row per round, so it is kept for good. With ``late_by`` rounds close, and these are the
    counts of ``stream_closing_rounds``, which tells the late attempts besides.
    """
    if late_by:
        number = F.col("round_number")
        return stream_closing_rounds(spark, attempts, contest, late_by, location).counts().select(
            contest.starts_at(number).alias("starts_at"), contest.starts_at(number + 1).alias("ends_at"), "attempts"
        )
    length = contest.round_days * 86400
    offset = int(contest.start.replace(tzinfo=timezone.utc).timestamp()) % length

    def build() -> DataFrame:
        # Windows need an instant; the zone is UTC while the stream is defined and run.
        at = F.col("attempted_at").cast("timestamp")
        window = F.window("at", f"{length} seconds", startTime=f"{offset} seconds")
        return (
            attempts().select(at.alias("at")).groupBy(window.alias("w"))
            .agg(F.count(F.lit(1)).alias("attempts"))
            .select(
                F.col("w.start").cast("timestamp_ntz").alias("starts_at"),
                F.col("w.end").cast("timestamp_ntz").alias("ends_at"),
                "attempts",
            )
        )

    # Attempts are counted per round before the shuffle: a few rows from each task.
    return run_available(spark, build, ["starts_at", "ends_at"], "round-counts", location, state_partitions=8)


class ClosingCounts:
    """Attempts per round where rounds close, with every attempt that came too late kept aside.

    A round is closed for a batch once an earlier batch held an attempt that is ``late_by`` (as "1 day") or more
    past the round's end. The batch writes its counts per round, its late attempts, and one row of what it saw
    (``arrived``, ``kept``, ``late``, and the newest time), measured while the other two are
    written; each in a folder a retry replaces. What is kept and what is late adds up to what arrived, for any
    layout of batches.
    """

    def __init__(self, spark: SparkSession, location: str, contest: Contest, late_by: str):
        self.spark, self.location, self.contest, self.late_by = spark, location, contest, late_by

    _SEEN = "arrived long, kept long, late long, newest timestamp_ntz, batch_id long"

    def _read(self, name: str, schema) -> DataFrame:
        if not location_exists(self.spark, f"{self.location}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.location}/{name}")

    def save(self, batch: DataFrame, batch_id: int) -> None:
        # One row per batch so far.
        seen = self._read("seen", self._SEEN).where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        round_number = self.contest.round_of_time(F.col("attempted_at"))
        closed = F.lit(False) if seen is None else F.coalesce(
            self.contest.starts_at(round_number + 1) <= moment(seen) - F.expr(f"INTERVAL {self.late_by}"), F.lit(False)
        )
        marked = batch.withColumn("round_number", round_number).withColumn("_late", closed)
        watch = Observation()
        watched = marked.observe(
            watch, F.count(F.lit(1)).alias("arrived"), F.count_if(~F.col("_late")).alias("kept"),
            F.count_if("_late").alias("late"), F.max(F.col("attempted_at").cast("string")).alias("newest"),
        )
        folder = f"batch_id={batch_id}"
        # The batch is read once to count it and once for its late attempts; neither is held.
        # Late ones stay in until they are counted: a plan that turns out empty would observe nothing.
        counts = watched.groupBy("round_number").agg(F.count_if(~F.col("_late")).alias("attempts"))
        counts.write.mode("overwrite").parquet(f"{self.location}/counts/{folder}")
        marked.where("_late").drop("_late").write.mode("overwrite").parquet(f"{self.location}/late/{folder}")
        found = watch.get
        numbers = [F.lit(found[n]).cast("bigint").alias(n) for n in ("arrived", "kept", "late")]
        newest = F.lit(found["newest"]).cast("timestamp_ntz").alias("newest")
        one = self.spark.range(1).select(*numbers, newest)
        one.write.mode("overwrite").parquet(f"{self.location}/seen/{folder}")

    def counts(self) -> DataFrame:
        """``round_number, attempts``: what was kept."""
        found = self._read("counts", "round_number long, attempts long, batch_id long")
        return found.groupBy("round_number").agg(F.sum("attempts").alias("attempts")).where("attempts > 0")

    def late(self, schema: T.StructType) -> DataFrame:
        """The late attempts, with the round they are late for."""
        return self._read("late", T.StructType([*schema.fields, T.StructField("round_number", T.LongType())]))

    def seen(self) -> DataFrame:
        """What each batch saw."""
        return self._read("seen", self._SEEN)


def stream_closing_rounds(
    spark: SparkSession, attempts: Callable[[], DataFrame], contest: Contest, late_by: str, location: str | None = None
) -> ClosingCounts:
    """Run ``ClosingCounts`` over all there is, going on where the last run with the same ``location`` ended."""
    location = location or new_location(spark, "closing-rounds")
    counts = ClosingCounts(spark, location, contest, late_by)
    _run(spark, lambda: attempts().writeStream.foreachBatch(counts.save), location)
    return counts
