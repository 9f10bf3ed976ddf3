"""Committed versions: failures midway, readers beside writers, competing writers, vacuum."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators.skew import join_back
from tidemart.sources import versions
from tidemart.sources.landing import read_staged, stage_days
from tidemart.sources.tables import append_rows, read_or_empty, save_mart

ROW = schemas.columns(id=schemas.LONG, note=schemas.STRING)


def rows(spark, day, ids, note="a"):
    return spark.createDataFrame([(i, note, day) for i in ids], "id long, note string, dt string")


def held(spark, path, **options):
    return sorted((r.dt, r.id, r.note) for r in read_staged(spark, path, ROW, **options).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    stage_days(rows(spark, "2024-01-01", [1, 2]).union(rows(spark, "2024-01-02", [3])), path)
    return path


def failing(spark, day):
    """Rows of which all but the last are written before the job fails."""
    unfit = F.when(F.col("id") == 99, F.raise_error(F.lit("lost midway"))).otherwise(F.col("id"))
    return rows(spark, day, [*range(10, 99), 99], "new").repartition(8, "id").withColumn("id", unfit.cast("long"))


def test_failed_job_leaves_the_old_table(spark, table):
    before, version = held(spark, table), versions.latest(spark, table)
    with pytest.raises(Exception, match="lost midway"):
        stage_days(failing(spark, "2024-01-01"), table)
    with pytest.raises(Exception, match="lost midway"):
        stage_days(failing(spark, "2024-01-03"), table, days=["2024-01-02"])
    assert held(spark, table) == before and versions.latest(spark, table) == version
    # What the failed jobs left behind is cleared, and only that.
    stage_days(rows(spark, "2024-01-03", [7]), table)
    assert versions.vacuum(spark, table, keep=2) == 0
    assert versions.vacuum(spark, table, keep=2, older_than=0) == 2
    assert held(spark, table) == [*before, ("2024-01-03", 7, "a")]


def test_failed_mart_and_append_leave_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "mart")
    save_mart(rows(spark, "x", [1]), path, ROW)
    append_rows(rows(spark, "x", [2]), path, ROW)
    for write in (save_mart, append_rows):
        with pytest.raises(Exception, match="lost midway"):
            write(failing(spark, "x"), path, ROW)
    assert sorted(r.id for r in read_or_empty(spark, path, ROW).collect()) == [1, 2]
    # Rebuilt from itself: the old version is read while the new one is written.
    save_mart(read_or_empty(spark, path, ROW).filter("id = 2"), path, ROW)
    assert [r.id for r in read_or_empty(spark, path, ROW).collect()] == [2]


def test_all_days_change_at_once_and_old_frames_stay(spark, table):
    old = read_staged(spark, table, ROW)
    stage_days(rows(spark, "2024-01-02", [4]), table, days=["2024-01-01", "2024-01-02"])
    assert held(spark, table) == [("2024-01-02", 4, "a")]
    assert sorted(r.id for r in old.collect()) == [1, 2, 3]
    first = versions.version_of(spark, table, 1)
    again = versions.read_table(spark, table, ROW, "dt", version=first)
    assert sorted(r.id for r in again.collect()) == [1, 2, 3]


def test_version_cut_off_is_passed_over(spark, table, tmp_path):
    before = held(spark, table)
    (tmp_path / "table" / "_versions" / "00000002.json").write_text('{"parts": {"2024-01-0')
    assert versions.latest(spark, table).number == 1 and held(spark, table) == before
    stage_days(rows(spark, "2024-01-01", [5]), table)
    assert versions.latest(spark, table).number == 3
    assert held(spark, table) == [("2024-01-01", 5, "a"), ("2024-01-02", 3, "a")]
    text = json.loads((tmp_path / "table" / "_versions" / "00000003.json").read_text())
    assert sorted(text["parts"]) == ["2024-01-01", "2024-01-02"]


def test_writers_of_other_days_both_count(spark, table):
    jobs = [
        threading.Thread(target=stage_days, args=(rows(spark, f"2024-02-{n:02d}", [n]), table)) for n in range(1, 7)
    ]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert [d for d, _, _ in held(spark, table)] == ["2024-01-01"] * 2 + ["2024-01-02"] + [f"2024-02-{n:02d}" for n in range(1, 7)]
    assert versions.latest(spark, table).number == 7


def test_only_wanted_days_are_opened(spark, table):
    stage_days(rows(spark, "2024-01-03", [8]), table)
    some = read_staged(spark, table, ROW, days=["2024-01-02", "2030-01-01"])
    assert {f.split("/dt=")[1].split("/")[0] for f in some.inputFiles()} == {"2024-01-02"}
    assert read_staged(spark, table, ROW, days=[]).collect() == []
    assert read_staged(spark, table + "-none", ROW).collect() == []


def test_null_days_and_odd_values_are_kept(spark, tmp_path):
    path = str(tmp_path / "odd")
    stage_days(rows(spark, None, [1]).union(rows(spark, "2024-01-01", [2])), path)
    assert {r.id: r.dt for r in read_staged(spark, path, ROW).collect()} == {1: None, 2: "2024-01-01"}
    stage_days(rows(spark, None, [3]), path)
    assert {r.id for r in read_staged(spark, path, ROW).collect()} == {2, 3}


def test_vacuum_keeps_what_versions_name(spark, table):
    for n in range(4):
        stage_days(rows(spark, "2024-01-01", [n]), table)
    with pytest.raises(ValueError):
        versions.vacuum(spark, table, keep=0)
    assert versions.vacuum(spark, table, keep=1, older_than=0) == 3
    assert held(spark, table) == [("2024-01-01", 3, "a"), ("2024-01-02", 3, "a")]
    assert versions.version_of(spark, table, 4) is None


def test_join_back_keeps_hubs_where_they_are(spark, plan_of):
    data = [(None if i % 7 == 0 else i % 5 if i % 2 else 0, i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, v int")
    totals = df.groupBy("k").agg(F.max("v").alias("m"), F.count(F.lit(1)).alias("n"))
    most = {}
    for k, v in data:
        most[k] = max(most.get(k, v), v)
    want = sorted([(k, v, most[k]) for k, v in data], key=repr)
    for hot_rows in (10_000, 100, 40, 0):
        got = join_back(df, totals, ["k"], "n", hot_rows)
        assert sorted([tuple(r) for r in got.select("k", "v", "m").collect()], key=repr) == want
    assert "BroadcastHashJoin" in plan_of(join_back(df, totals, ["k"], "n", 100))
