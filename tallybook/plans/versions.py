"""Tables that are replaced as a whole: a reader sees the old state or the new one, never a mixture.

A new state is written to a folder of its own. A small pointer file names the folder in force; it is
replaced by renaming a finished file over it, which file systems do at once. Folders of earlier states
stay until they are dropped, for readers that are still at work on them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallybook.session import hadoop_path, location_exists

_POINTER = "CURRENT"


def current(spark: SparkSession, location: str) -> str | None:
    """The name of the folder in force below ``location``; None before the first one."""
    if not location_exists(spark, f"{location}/{_POINTER}"):
        return None
    return spark.read.text(f"{location}/{_POINTER}").first()["value"]


def _point(spark: SparkSession, location: str, name: str) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    draft, files = hadoop_path(spark, f"{location}/draft-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(name.encode()))
    out.close()
    pointer, _ = hadoop_path(spark, f"{location}/{_POINTER}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft), context.makeQualified(pointer), how)


def publish(spark: SparkSession, location: str, tables: dict[str, DataFrame], label: str = "state") -> str:
    """Write the tables as parquet to a new folder and put it in force; returns its name.

    If a table cannot be written the old state stays in force. ``label`` starts the folder's name.
    """
    name = f"{label}-{uuid.uuid4().hex}"
    for table, rows in tables.items():
        rows.write.parquet(f"{location}/{name}/{table}.parquet")
    _point(spark, location, name)
    return name


def drop_versions(spark: SparkSession, location: str, keep: set[str]) -> int:
    """Delete the states that are neither in force nor among ``keep``; returns how many."""
    folder, files = hadoop_path(spark, location)
    kept, dropped = keep | {current(spark, location)}, 0
    for status in files.listStatus(folder):
        if status.isDirectory() and status.getPath().getName() not in kept:
            dropped += files.delete(status.getPath(), True)
    return dropped
