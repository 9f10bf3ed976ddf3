"""Daily staged ingest: by date, by backfill range, or by whatever files have arrived."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.operators.cleaning import clean_log
from tidemart.schemas import conform
from tidemart.session import write_shared
from tidemart.sources.landing import (
    DAY,
    FILE,
    day_of_path,
    landed_files,
    read_generations,
    read_staged,
    stage_days,
    staged_days,
    union_generations,
)
from tidemart.sources.versions import latest, read_table, replace_all

Clean = Callable[[DataFrame], DataFrame]


def catch_up_days(today: dt.date, back: int = 8) -> list[str]:
    """The days from ``back`` days ago to yesterday."""
    return [(today - dt.timedelta(days=n)).isoformat() for n in range(back, 0, -1)]


def _on_time(rows: DataFrame, ts: str | None) -> DataFrame:
    """Rows whose day by ``ts`` is later than their file's day raise."""
    if ts is None or ts not in rows.columns:
        return rows
    late = F.to_date(ts) > F.to_date(DAY)
    unfit = F.raise_error(F.concat(F.lit("a row is later than its file's day "), F.col(DAY)))
    return rows.withColumn(DAY, F.when(late, unfit).otherwise(F.col(DAY)))


def ingest_days(
    spark: SparkSession,
    feed: str,
    staging: str,
    schema: StructType,
    days: Sequence[str] | None = None,
    clean: Clean = clean_log,
    ts: str | None = "date_time",
) -> bool:
    """Clean the landing files of ``days`` (all if None) and replace those days in staging.

    Days are complete when they are replaced: every generation contributes its
    files, and a wanted day without rows (its files hold none, or are gone) is
    emptied. A file of no day raises, as does a row dated by ``ts`` after its file's day (readers
    of staging rely on that); None asks for no such check. Returns whether there was anything to
    load or to empty.
    """
    frames = read_generations(spark, feed, days)
    if frames:
        cleaned = [conform(_on_time(clean(f), ts), schema, DAY) for f in frames]
        stage_days(union_generations(cleaned), staging, days=days)
        return True
    gone = sorted(set(days or ()) & set(staged_days(spark, staging)))
    if gone:
        stage_days(read_staged(spark, staging, schema).limit(0), staging, days=gone)
    return bool(gone)


def ingest_bulk(log: DataFrame, staging: str, schema: StructType, ts: str = "date_time") -> None:
    """Stage a cleaned history export that is not split by day."""
    rows = conform(log, schema, F.to_date(F.col(ts)).cast("string").alias(DAY))
    stage_days(rows, staging, by_day=False)


def _days_of(files: DataFrame) -> list[str]:
    """The days of listed files; one of no day raises. Bounded by the calendar."""
    lost = files.filter(F.col(DAY).isNull()).select("path").first()
    if lost:
        raise ValueError(f"no day in the name of {lost.path}")
    return sorted(r[DAY] for r in files.select(DAY).distinct().collect())


def ingest_arrivals(
    spark: SparkSession,
    feed: str,
    staging: str,
    schema: StructType,
    checkpoint: str,
    clean: Clean = clean_log,
    ts: str | None = "date_time",
) -> None:
    """Stage every day whose files changed since the last run.

    The feed's files are listed with their time and length (their content is not read) and
    compared with the list kept in ``checkpoint``. A day with a new, rewritten or removed
    file, however old, is read in full and replaced, so a run repeated after a failure
    leaves the same table. A file that belongs to no day raises. ``stream_arrivals`` is the
    cheaper way for feeds whose files are only ever added.
    """
    now = write_shared(landed_files(spark, feed), "feed-files")
    last = latest(spark, checkpoint)
    before = read_table(spark, checkpoint, now.schema, version=last)
    same = ["path", "modificationTime", "length"]
    touched = now.join(before, same, "left_anti").unionByName(before.join(now, same, "left_anti"))
    days = _days_of(touched)
    if days:
        ingest_days(spark, feed, staging, schema, days, clean, ts)
    replace_all(now, checkpoint)


def stream_arrivals(
    spark: SparkSession,
    feed: str,
    staging: str,
    schema: StructType,
    checkpoint: str,
    clean: Clean = clean_log,
    ts: str | None = "date_time",
    files_per_batch: int = 1000,
) -> None:
    """Stage the days of all files that arrived since the last run, as a bounded file stream.

    The stream's checkpoint remembers the files by name; those not seen yet go through in
    batches of ``files_per_batch``, and the run ends with the last of them. A batch replaces its
    days in full, so one that is repeated after a failure leaves the same table. Files
    rewritten under their names and removed ones are no arrivals: ``ingest_arrivals`` finds those.
    """

    def stage(batch: DataFrame, _: int) -> None:
        days = _days_of(batch.withColumn(DAY, day_of_path(F.col("path"))))
        if days:
            ingest_days(batch.sparkSession, feed, staging, schema, days, clean, ts)

    # A file counts however old it is; without the option those a week older than the newest are passed over.
    options = {"recursiveFileLookup": "true", "maxFilesPerTrigger": str(files_per_batch), "maxFileAge": "36500d"}
    files = spark.readStream.format("binaryFile").schema(FILE).options(**options).load(feed)
    query = (
        files.select("path")
        .writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
