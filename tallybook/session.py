"""Session building and the one shared folder intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_own_folders: dict[str, str] = {}
_locations: list[str] = []


def shuffle_partitions(input_bytes: int, per_task: int = 192 << 20) -> int:
    """Shuffle partitions that give each task about ``per_task`` bytes of the input.

    AQE merges partitions that turn out small and splits skewed ones, but never adds any, so the
    number is set for the largest shuffle. 100 TB come to about half a million.
    """
    return max(200, -(-input_bytes // per_task))


def build_session(app_name: str = "tallybook", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the library is written for.

    On a cluster leave ``master`` out, and set ``spark.sql.shuffle.partitions`` to
    ``shuffle_partitions`` of the input's size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a new temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="tallybook-")
    return _own_folders[application]


def new_location(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    location = f"{shared_folder(spark)}/tallybook/{label}-{uuid.uuid4().hex}"
    _locations.append(location)
    return location


def hadoop_path(spark: SparkSession, location: str):
    """A path and the file system it lies on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def location_exists(spark: SparkSession, location: str) -> bool:
    path, files = hadoop_path(spark, location)
    return files.exists(path)


def drop_run_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables and stream state this process has written so far.

    Call it when the results that read them are stored; returns how many were there.
    """
    dropped = 0
    while _locations:
        path, files = hadoop_path(spark, _locations.pop())
        dropped += files.delete(path, True)
    return dropped


@contextmanager
def session_settings(spark: SparkSession, **settings):
    """Set SQL settings for a block (dots written as double underscores), then put the old ones back."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
