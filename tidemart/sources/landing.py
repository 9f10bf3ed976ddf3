"""CSV landing files: header-tolerant reading, writing for hand-over, and staging tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType, TimestampType

from tidemart.schemas import LONG, STRING, columns
from tidemart.session import file_system, in_parallel, list_in_few_tasks, path_exists
from tidemart.sources import versions

DAY = "dt"
# What ingest needs to know about a file; its content is not read.
FILE = columns(path=STRING, modificationTime=TimestampType(), length=LONG, content=BinaryType())
_CSV = {
    "header": "true",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def file_prefix(day: dt.date) -> str:
    """Date prefix of a day's landing file, ``YYYYMMDD_``."""
    return f"{day:%Y%m%d}_"


def day_of(path: str) -> str | None:
    """The day a landing file belongs to, from its ``dt=`` folder or its date prefix."""
    folder = re.search(rf"/{DAY}=(\d{{4}}-\d{{2}}-\d{{2}})/", path)
    if folder:
        return folder[1]
    name = re.match(r"(\d{4})(\d{2})(\d{2})_", path.rsplit("/", 1)[-1])
    return "-".join(name.groups()) if name else None


def day_of_path(path: Column) -> Column:
    """``day_of`` as a column; null where a path names no day."""
    folder = F.regexp_extract(path, rf"/{DAY}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1)
    prefix = F.regexp_extract(path, r"(?:^|/)(\d{8}_)[^/]*$", 1)
    named = F.regexp_replace(prefix, r"^(\d{4})(\d{2})(\d{2})_$", "$1-$2-$3")
    return F.when(folder != "", folder).when(named != "", named)


def day_folder(root: str, day: dt.date | str) -> str:
    return f"{root}/{DAY}={day}"


def name_by_day(spark: SparkSession, root: str, name: str) -> None:
    """Turn the ``dt=`` folders of an export into files named ``YYYYMMDD_...`` beside each other."""
    files, folder = file_system(spark, root)
    for day in [f.getPath() for f in files.listStatus(folder) if f.isDirectory()]:
        prefix = day.getName().removeprefix(f"{DAY}=").replace("-", "")
        parts = [f.getPath() for f in files.listStatus(day) if f.getPath().getName()[0] not in "._"]
        for i, part in enumerate(parts):
            files.rename(part, file_system(spark, f"{root}/{prefix}_{i}_{name}")[1])
        files.delete(day, True)


def landed_files(spark: SparkSession, feed: str) -> DataFrame:
    """path, modificationTime, length and dt of every file below a feed's folder; contents are not read.

    A file that names no day has a null ``dt``. Files whose names begin with a dot or an underscore
    are no data.
    """
    if not path_exists(spark, feed):
        return spark.createDataFrame([], StructType([*FILE.fields[:3], StructField(DAY, StringType())]))
    list_in_few_tasks(spark)
    reader = spark.read.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true")
    files = reader.load(feed).select("path", "modificationTime", "length")
    return files.withColumn(DAY, day_of_path(F.col("path")))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file."""
    files, target = file_system(spark, path)
    stream = files.open(target)
    try:
        java = spark.sparkContext._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def read_csv(
    spark: SparkSession, paths: Sequence[str], with_day: bool = False, multi_line: bool = True
) -> DataFrame:
    """Files of one generation (same header) as strings, selected by name.

    The header is taken from the first path. Spark maps CSV columns by position,
    so every other file's header is checked against it and a mismatch raises
    rather than shifting values. Values are kept as they are or the read fails: a
    row with more or fewer fields than the header raises. Quoted line breaks are
    read with ``multi_line``, which keeps a file in one task; turn it off for large
    exports that have none. ``with_day`` adds the day that each row's file names.
    """
    options = {**_CSV, "multiLine": str(multi_line).lower(), "mode": "FAILFAST"}
    header = spark.read.options(**options).csv(paths[0]).columns
    # Spark gives a column without a name one by its place; the files have none.
    named = ["" if c == f"_c{i}" else c for i, c in enumerate(header)]
    schema = StructType([StructField(c, StringType()) for c in named])
    # Without pruning, so that every field of a row is seen.
    reader = spark.read.options(**options, enforceSchema="false", columnPruning="false").schema(schema)
    rows = reader.csv(list(paths))
    if not with_day:
        return rows.toDF(*header)
    return rows.select("*", day_of_path(F.col("_metadata.file_path"))).toDF(*header, DAY)


def read_generations(
    spark: SparkSession, feed: str, days: Iterable[str] | None = None
) -> list[DataFrame]:
    """One frame per file generation (one header) of a feed, limited to ``days`` where given.

    Files lie anywhere below the feed's folder, in ``dt=YYYY-MM-DD`` folders (the day of the
    file, so a history export is one folder) or named ``YYYYMMDD_...``; one of neither kind
    raises, so none is left out unnoticed. Only the wanted days' files are opened. The frames are kept
    apart because their columns differ; clean them, then union by name.
    """
    files = landed_files(spark, feed)
    lost = files.filter(F.col(DAY).isNull()).select("path").first()
    if lost:
        raise ValueError(f"no day in the name of {lost.path}")
    if days is not None:
        files = files.filter(F.col(DAY).isin(list(days)))
    parent, name = F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.regexp_extract("path", r"[^/]*$", 0)
    inside = F.regexp_extract("path", rf"/({DAY}=\d{{4}}-\d{{2}}-\d{{2}})/", 1) != ""
    places = (
        files.filter("length > 0 AND path NOT RLIKE '/[._][^/]*$'")
        .groupBy(F.when(inside, parent).otherwise(F.concat_ws("/", parent, name)).alias("place"))
        .agg(F.min("path").alias("first"))
    )
    # Bounded by the calendar: folders of a day, or one file of a day each.
    found = sorted((r["place"], r["first"]) for r in places.collect())
    headers = in_parallel(*[lambda path=path: first_line(spark, path) for _, path in found])
    generations: dict[str | None, list[str]] = {}
    for (place, _), header in zip(found, headers):
        generations.setdefault(header, []).append(place)
    # Listing many folders takes a Spark job per generation.
    return in_parallel(*[lambda held=held: read_csv(spark, held, with_day=True) for held in generations.values()])


def union_generations(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a generation lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_csv_days(df: DataFrame, root: str, spread: str) -> str:
    """Write one CSV folder per day.

    Rows are range-partitioned by day and ``spread``, so a heavy day becomes
    several files of ordinary size and light days share a task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(tasks, DAY, spread)
    placed.write.mode("overwrite").options(**_CSV).partitionBy(DAY).csv(root)
    return root


def write_csv(df: DataFrame, root: str) -> str:
    df.write.mode("overwrite").options(**_CSV).csv(root)
    return root


def stage_days(
    df: DataFrame, path: str, by_day: bool = True, days: Iterable[str] | None = None
) -> None:
    """Replace the staged days that ``df`` contains and leave every other day alone.

    ``days`` are emptied if ``df`` has no rows for them. All days change at once, when the
    write is done; until then, and if it fails, readers see the old ones. Loading a day again
    gives the same table, where an append would repeat it.
    Rows read from daily folders (``by_day``) already lie together and are
    written where they were read, without a shuffle. Rows in any other order are
    rebalanced first, which gathers a day into few files and splits a day too
    heavy for one task.
    """
    versions.replace_parts(df if by_day else df.hint("rebalance", DAY), path, DAY, days or ())


def staged_days(spark: SparkSession, path: str) -> list[str]:
    """The days a staged table holds rows of."""
    return sorted(versions.latest(spark, path).parts)


def read_staged(
    spark: SparkSession, path: str, schema: StructType, days: Iterable[str] | None = None
) -> DataFrame:
    """A staged table with its ``dt`` column. Filters on ``dt`` prune folders; folders outside ``days``
    are not even listed."""
    return versions.read_table(spark, path, schema, DAY, days)
