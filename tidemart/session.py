"""Session defaults and the shared folder that holds written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

LISTING_TASKS = 64
# Driver threads that submit jobs at the same time.
DRIVER_THREADS = 8

T = TypeVar("T")

_local_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every mart relies on.

    On a cluster leave ``master`` unset (spark-submit names it) and size
    ``spark.sql.shuffle.partitions`` to the data; range-partitioned operators
    take their partition count from that setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then gets a
    scratch folder of its own. On a cluster a missing setting is an error,
    because a machine-local folder would be invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    # "local" and "local[n]", but not "local-cluster[...]", whose executors are processes of their own.
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidemart-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder, remembered for ``release_written``."""
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/{app}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(app, []).append(path)
    return path


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Used where a plan must not be evaluated twice with different outcomes (range
    partitioning draws a sample) or where several branches read one expensive
    result. The table survives the loss of any executor, and its true size lets
    Spark choose broadcast joins by itself.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(*jobs: Callable[[], T]) -> list[T]:
    """Run independent driver calls at the same time, so that their Spark jobs overlap.

    At most ``DRIVER_THREADS`` run at once; each inherits the caller's job group, pool and tags.
    """
    if not jobs:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    # Without pinned threads there is nothing to inherit, and no wrapper is given.
    ready = [inherit(job) if callable(inherit) else job for job in jobs]
    with ThreadPoolExecutor(max_workers=min(DRIVER_THREADS, len(jobs))) as pool:
        return list(pool.map(lambda job: job(), ready))


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it knows it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let Spark list many folders in ``LISTING_TASKS`` tasks, unless the session says otherwise.

    Its own default is a task per folder, of which a table by day has thousands.
    """
    setting, default = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"
    if spark.conf.get(setting, default) == default:
        spark.conf.set(setting, str(LISTING_TASKS))


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def release_written(spark: SparkSession) -> int:
    """Delete what this session wrote to the shared folder; returns the number of paths.

    Call it after the results have been saved: lazy frames may still read these tables.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        files, target = file_system(spark, path)
        files.delete(target, True)
    return len(paths)
