"""Parquet tables, the application's own tables, and text output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tallybook.plans.contest import Contest
from tallybook.plans.durable import written_table
from tallybook.plans.versions import current, publish
from tallybook.session import hadoop_path

ROUNDS = T.StructType([
    T.StructField("round_number", T.LongType(), False),
    T.StructField("starts_at", T.TimestampNTZType(), False),
    T.StructField("ends_at", T.TimestampNTZType(), False),
])

PROBLEMS = T.StructType([
    T.StructField("problem_id", T.LongType(), False),
    T.StructField("round_number", T.LongType(), False),
    T.StructField("question", T.StringType(), False),
    T.StructField("correct_query", T.StringType(), False),
    T.StructField("difficulty", T.StringType(), False),
    T.StructField("sample_data", T.StringType(), True),
])

ATTEMPTS = T.StructType([
    T.StructField("attempt_id", T.LongType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("problem_id", T.LongType(), False),
    T.StructField("is_correct", T.BooleanType(), False),
    T.StructField("attempted_at", T.TimestampNTZType(), True),
    T.StructField("completed_at", T.TimestampNTZType(), True),
    T.StructField("last_wrong_query", T.StringType(), True),
    T.StructField("last_wrong_result", T.StringType(), True),
])

APPLICATION_TABLES = {"rounds": ROUNDS, "problems": PROBLEMS, "attempts": ATTEMPTS}


# Columns of the tables as streams take them; a stream must know them before its first file.
STORED_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


_schemas: dict[tuple, T.StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with the columns its files have.

    They are read off a footer once for each state of a table, as its path, time and size tell it, and not
    before every query.
    """
    location = f"{folder}/{name}.parquet"
    path, files = hadoop_path(spark, location)
    status = files.getFileStatus(path)
    state = (location, status.getModificationTime(), status.getLen())
    if state not in _schemas:
        _schemas[state] = spark.read.parquet(location).schema
    return spark.read.schema(_schemas[state]).parquet(location)


def register_tables(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Make tables known by name, so that any query text can be run with ``spark.sql``."""
    for name in names:
        read_table(spark, folder, name).createOrReplaceTempView(name)


def reset_application(
    spark: SparkSession, folder: str, contest: Contest, problems: DataFrame | None = None, rounds: DataFrame | None = None
) -> None:
    """Start over: the rounds anew (the contest's, unless given), the given problems, and an empty attempt log.

    A reader meanwhile sees all tables as they were or all as they are then.
    """
    contents = {name: spark.createDataFrame([], schema) for name, schema in APPLICATION_TABLES.items()}
    contents["rounds"] = contest.calendar(spark) if rounds is None else rounds.select(*ROUNDS.names)
    if problems is not None:
        contents["problems"] = problems.select(*PROBLEMS.names)
    publish(spark, folder, contents)


def _application_folder(spark: SparkSession, folder: str) -> str:
    name = current(spark, folder)
    if name is None:
        raise ValueError(f"no application in {folder}")
    return f"{folder}/{name}"


def append_attempts(attempts: DataFrame, folder: str) -> None:
    """Add attempts to the log; what is there stays."""
    inside = _application_folder(attempts.sparkSession, folder)
    attempts.select(*ATTEMPTS.names).write.mode("append").parquet(f"{inside}/attempts.parquet")


def read_application(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(APPLICATION_TABLES[name]).parquet(f"{_application_folder(spark, folder)}/{name}.parquet")


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_keyed(rows: DataFrame, folder: str, keys: list[str], buckets: int) -> None:
    """A table in ``buckets`` folders by a hash of its keys, so that few of them change with few keys."""
    _bucketed(rows, keys, buckets).write.mode("overwrite").partitionBy("bucket").parquet(folder)


def read_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("bucket")


def replace_keyed(updates: DataFrame, folder: str, keys: list[str], buckets: int) -> None:
    """Put ``updates`` in the place of all rows with their keys; other rows stay, new keys are added.

    Only buckets with an updated key are read and written anew, each replaced as a whole; the others are not
    touched. The new rows are written aside first, so that a failure leaves the table as it was. Keys that
    are NULL are a key like others.
    """
    spark = updates.sparkSession
    fresh = written_table(_bucketed(updates, keys, buckets), "updates")
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    stored = spark.read.parquet(folder)
    known = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    kept = stored.where(F.col("bucket").isin(touched)).join(known, same, "left_anti")
    staged = written_table(kept.unionByName(fresh.select(*stored.columns)), "replaced")
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(folder)


def write_lines(lines: DataFrame, folder: str) -> None:
    """Text lines as text files, in the order of the partitions."""
    lines.write.mode("overwrite").text(folder)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text files as one row per line."""
    return spark.read.text(folder).withColumnRenamed("value", "line")


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range_start"))


def read_blocks(spark: SparkSession, folder: str, separator: str | None = None) -> DataFrame:
    """Text blocks from files, with where they come from: ``file, block_no, block``.

    Without a separator each file is one block. Otherwise a file is read in byte ranges by several tasks and cut
    at the separator; blocks are numbered from 1 in the order of the file, empty ones included.
    """
    if separator is None:
        whole = spark.read.text(folder, wholetext=True)
        return _with_file(whole).select("file", F.lit(1).cast("bigint").alias("block_no"), F.col("value").alias("block"))
    cut = _with_file(spark.read.option("lineSep", separator).text(folder))
    # A range is read in order by one task; where it starts puts the ranges of a file in order.
    placed = written_table(cut.withColumn("_place", F.monotonically_increasing_id()), "blocks")
    pieces = placed.groupBy("file", "range_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("file").alias("_f"), F.col("range_start").alias("_r"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = (F.col("file") == F.col("_f")) & (F.col("range_start") == F.col("_r"))
    return placed.join(written_table(starts, "starts"), same).select(
        "file", (F.col("_place") + F.col("_shift")).alias("block_no"), F.col("value").alias("block")
    )


def attempt_log(events: DataFrame, contest: Contest) -> DataFrame:
    """Events read as attempts: the problem comes from the JSON properties, a purchase is a solve.

    An event without a problem keeps NULL there.
    """
    k = F.from_json("props", "k int")["k"]
    problem = (k % contest.problem_count + 1).cast("bigint")
    return events.select(
        F.col("event_id").alias("attempt_id"),
        "user_id",
        problem.alias("problem_id"),
        (F.col("event_type") == "purchase").alias("is_correct"),
        F.col("ts").alias("attempted_at"),
        F.col("props").alias("query_text"),
        F.col("event_type").alias("result_text"),
    )
