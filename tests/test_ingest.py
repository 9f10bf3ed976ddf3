"""Landing files and staging: header generations, reruns, late files, arrivals."""

import datetime as dt
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators.cleaning import clean_log
from tidemart.plans import retail
from tidemart.plans.daily_load import load_day, load_days, load_fact, read_retention, rebuild_retention
from tidemart.session import fresh_path, release_written, shared_folder
from tidemart.sources import versions
from tidemart.sources.landing import day_of, file_prefix, name_by_day, read_csv, read_staged, staged_days
from tidemart.sources.tables import read_or_empty, save_mart
from tidemart.streaming.ingest import (
    catch_up_days,
    ingest_arrivals,
    ingest_bulk,
    ingest_days,
    stream_arrivals,
)

COLUMNS = (
    "date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,quantity,"
    "payment_amount"
)
TARGET = schemas.USER_ORDER_LOG
DIMS = {"d_city": schemas.DIM_CITY, "d_item": schemas.DIM_ITEM, "d_customer": schemas.DIM_CUSTOMER}


def land(folder: Path, generation: str, day: str, lines, name="part-0.csv"):
    """Write one file of a generation: ``plain`` or ``status`` (with index, id and status)."""
    path = folder / generation / f"dt={day}"
    path.mkdir(parents=True, exist_ok=True)
    header = COLUMNS if generation == "plain" else f",id,{COLUMNS},status"
    (path / name).write_text("\n".join([header, *lines]) + "\n")


def row(day, amount, status=None, number=0):
    base = f'{day} 00:00:00,1,"City, North",7,Ann,"Lee ""L""",3,ring,2,{amount}'
    return base if status is None else f"{number},{number},{base},{status}"


def amounts(spark, staging):
    staged = read_staged(spark, staging, TARGET).select("dt", "payment_amount").collect()
    return sorted((r.dt, float(r.payment_amount)) for r in staged)


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    land(folder, "plain", "2024-01-01", [row("2024-01-01", "5.00"), row("2024-01-01", "6.00")])
    land(
        folder, "status", "2024-01-02",
        [row("2024-01-02", "7.00", "refunded", 1), row("2024-01-02", "8.00", "", 2)],
    )
    return folder


def test_generations_meet_by_name(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    assert ingest_days(spark, str(feed), staging, TARGET)
    assert amounts(spark, staging) == [
        ("2024-01-01", 5.0), ("2024-01-01", 6.0), ("2024-01-02", -7.0), ("2024-01-02", 8.0),
    ]
    one = read_staged(spark, staging, TARGET).filter("payment_amount = 8").first()
    assert (one.city_name, one.last_name, one.customer_id) == ("City, North", 'Lee "L"', 7)
    assert one.payment_amount == Decimal("8.00") and one.date_time == dt.datetime(2024, 1, 2)


def test_reruns_change_nothing(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    ingest_days(spark, str(feed), staging, TARGET)
    before = amounts(spark, staging)
    ingest_days(spark, str(feed), staging, TARGET, ["2024-01-02"])
    ingest_days(spark, str(feed), staging, TARGET)
    assert amounts(spark, staging) == before
    assert ingest_days(spark, str(feed), staging, TARGET, ["2030-01-01"]) is False


def test_changed_day_is_replaced_alone(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    ingest_days(spark, str(feed), staging, TARGET)
    land(feed, "status", "2024-01-02", [row("2024-01-02", "9.00", "shipped", 1)])
    ingest_days(spark, str(feed), staging, TARGET, ["2024-01-02"])
    assert amounts(spark, staging) == [("2024-01-01", 5.0), ("2024-01-01", 6.0), ("2024-01-02", 9.0)]


def test_arrivals_and_late_files(spark, feed, tmp_path):
    staging, state = str(tmp_path / "staging"), str(tmp_path / "state")
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    assert len(amounts(spark, staging)) == 4
    # A late file for a day already staged, and a new day.
    land(feed, "plain", "2024-01-01", [row("2024-01-01", "1.00")], "late.csv")
    land(feed, "status", "2024-01-03", [row("2024-01-03", "2.00", "shipped", 5)])
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    assert amounts(spark, staging) == [
        ("2024-01-01", 1.0), ("2024-01-01", 5.0), ("2024-01-01", 6.0),
        ("2024-01-02", -7.0), ("2024-01-02", 8.0), ("2024-01-03", 2.0),
    ]
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    assert len(amounts(spark, staging)) == 6


def test_old_rewritten_and_removed_files_are_seen(spark, feed, tmp_path):
    staging, state = str(tmp_path / "staging"), str(tmp_path / "state")
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    # A new day's file that is a month old.
    land(feed, "plain", "2023-11-30", [row("2023-11-30", "3.00")])
    old = feed / "plain" / "dt=2023-11-30" / "part-0.csv"
    month_ago = old.stat().st_mtime - 30 * 86_400
    os.utime(old, (month_ago, month_ago))
    # A file rewritten under its own name.
    land(feed, "plain", "2024-01-01", [row("2024-01-01", "99.00")])
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    assert amounts(spark, staging) == [
        ("2023-11-30", 3.0), ("2024-01-01", 99.0), ("2024-01-02", -7.0), ("2024-01-02", 8.0),
    ]
    old.unlink()
    land(feed, "status", "2024-01-02", [])
    ingest_arrivals(spark, str(feed), staging, TARGET, state)
    assert amounts(spark, staging) == [("2024-01-01", 99.0)]
    (feed / "plain" / "stray.csv").write_text(COLUMNS + "\n")
    with pytest.raises(ValueError, match="stray"):
        ingest_arrivals(spark, str(feed), staging, TARGET, state)


def test_files_named_by_day(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    name = file_prefix(dt.date(2024, 1, 3)) + "user_order_log.csv"
    (feed / "plain" / name).write_text("\n".join([COLUMNS, row("2024-01-03", "4.00")]) + "\n")
    assert day_of(f"x/{name}") == "2024-01-03" and day_of("x/other.csv") is None
    ingest_days(spark, str(feed), staging, TARGET, ["2024-01-03"])
    assert amounts(spark, staging) == [("2024-01-03", 4.0)]
    ingest_arrivals(spark, str(feed), staging, TARGET, str(tmp_path / "state"))
    assert len(amounts(spark, staging)) == 5


def entry_points(spark, feed, tmp_path):
    """Each way of taking in the whole feed, as a call."""
    state, stream = str(tmp_path / "list"), str(tmp_path / "stream")
    return [
        lambda staging: ingest_days(spark, str(feed), staging, TARGET),
        lambda staging: ingest_arrivals(spark, str(feed), staging, TARGET, state),
        lambda staging: stream_arrivals(spark, str(feed), staging, TARGET, stream),
    ]


def test_files_are_found_wherever_they_lie(spark, feed, tmp_path):
    """Beside the generations, nested below them, and several headers in one folder tree."""
    (feed / "20240103_orders.csv").write_text("\n".join([COLUMNS, row("2024-01-03", "4.00")]) + "\n")
    land(feed / "g1" / "sub", "plain", "2024-01-04", [row("2024-01-04", "5.50")])
    deep = feed / "plain" / "dt=2024-01-01" / "more"
    deep.mkdir()
    (deep / "b.csv").write_text("\n".join([COLUMNS, row("2024-01-01", "6.50")]) + "\n")
    (feed / "g1" / "20240105_inc.csv").write_text("\n".join([f",id,{COLUMNS},status", row("2024-01-05", "7.50", "refunded", 4)]) + "\n")
    (feed / "20240106_empty.csv").write_text("")
    (feed / "plain" / "_SUCCESS").write_text("")
    want = [
        ("2024-01-01", 5.0), ("2024-01-01", 6.0), ("2024-01-01", 6.5), ("2024-01-02", -7.0), ("2024-01-02", 8.0),
        ("2024-01-03", 4.0), ("2024-01-04", 5.5), ("2024-01-05", -7.5),
    ]
    for i, take_in in enumerate(entry_points(spark, feed, tmp_path)):
        take_in(str(tmp_path / f"staging{i}"))
        assert amounts(spark, str(tmp_path / f"staging{i}")) == want
    one = str(tmp_path / "one")
    ingest_days(spark, str(feed), one, TARGET, ["2024-01-03", "2024-01-04"])
    assert amounts(spark, one) == [("2024-01-03", 4.0), ("2024-01-04", 5.5)]


def test_files_of_no_day_raise(spark, feed, tmp_path):
    (feed / "plain" / "orders.csv").write_text(COLUMNS + "\n")
    for i, take_in in enumerate(entry_points(spark, feed, tmp_path)):
        with pytest.raises(Exception, match="no day in the name of .*orders.csv"):
            take_in(str(tmp_path / f"staging{i}"))
        assert staged_days(spark, str(tmp_path / f"staging{i}")) == []


def test_rows_after_their_file_raise_everywhere(spark, feed, tmp_path):
    land(feed, "plain", "2024-01-04", [row("2024-01-05", "1.00")])
    for i, take_in in enumerate(entry_points(spark, feed, tmp_path)):
        with pytest.raises(Exception, match="later than its file"):
            take_in(str(tmp_path / f"staging{i}"))
    assert ingest_days(spark, str(feed), str(tmp_path / "unchecked"), TARGET, ts=None)


def test_export_renamed_by_day(spark, feed, tmp_path):
    name_by_day(spark, str(feed / "plain"), "orders.csv")
    assert [f.name for f in (feed / "plain").iterdir() if f.is_file() and f.suffix == ".csv"] == ["20240101_0_orders.csv"]
    ingest_days(spark, str(feed), str(tmp_path / "staging"), TARGET)
    assert len(amounts(spark, str(tmp_path / "staging"))) == 4


def test_stream_goes_on_where_it_failed(spark, feed, tmp_path):
    """A batch that fails midway is taken again; days staged before stay, and nothing is doubled."""
    for n in range(3, 8):
        land(feed, "plain", f"2024-01-{n:02d}", [row(f"2024-01-{n:02d}", f"{n}.00")])
    staging, state, calls = str(tmp_path / "staging"), str(tmp_path / "state"), []

    def breaks(df):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost midway")
        return clean_log(df)

    with pytest.raises(Exception, match="lost midway"):
        stream_arrivals(spark, str(feed), staging, TARGET, state, clean=breaks, files_per_batch=2)
    assert 0 < len(staged_days(spark, staging)) < 7
    stream_arrivals(spark, str(feed), staging, TARGET, state, files_per_batch=2)
    whole = str(tmp_path / "whole")
    ingest_days(spark, str(feed), whole, TARGET)
    assert amounts(spark, staging) == amounts(spark, whole)
    # A new file, a month old, of a day already staged.
    land(feed, "plain", "2024-01-01", [row("2024-01-01", "1.00")], "late.csv")
    old = feed / "plain" / "dt=2024-01-01" / "late.csv"
    os.utime(old, (old.stat().st_mtime - 30 * 86_400,) * 2)
    number = versions.latest(spark, staging).number
    stream_arrivals(spark, str(feed), staging, TARGET, state)
    assert ("2024-01-01", 1.0) in amounts(spark, staging) and len(amounts(spark, staging)) == 10
    stream_arrivals(spark, str(feed), staging, TARGET, state)
    assert versions.latest(spark, staging).number == number + 1


def test_emptied_day_is_emptied(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    ingest_days(spark, str(feed), staging, TARGET)
    land(feed, "status", "2024-01-02", [])
    assert ingest_days(spark, str(feed), staging, TARGET, ["2024-01-02"])
    assert [d for d, _ in amounts(spark, staging)] == ["2024-01-01", "2024-01-01"]


def test_csv_values_are_kept_or_rejected(spark, tmp_path):
    def read(text, **options):
        (tmp_path / "x.csv").write_text(text)
        return [tuple(r) for r in read_csv(spark, [str(tmp_path / "x.csv")], **options).select("b").collect()]

    assert read('a,b\n1,"x\ny"\n2,z\n') == [("x\ny",), ("z",)]
    assert read('a,b\n1,"x"\n', multi_line=False) == [("x",)]
    for bad in ("1,2,3", "1"):
        with pytest.raises(Exception, match="(?i)malformed|reading"):
            read(f"a,b\n{bad}\n")


def test_bulk_history_then_increment(spark, feed, tmp_path):
    staging = str(tmp_path / "staging")
    lines = [row(f"2023-12-{d:02d}", "1.00") for d in (30, 31)]
    (tmp_path / "history.csv").write_text("\n".join([COLUMNS, *lines]) + "\n")
    history = clean_log(read_csv(spark, [str(tmp_path / "history.csv")]))
    ingest_bulk(history, staging, TARGET)
    ingest_days(spark, str(feed), staging, TARGET, ["2024-01-01"])
    assert [d for d, _ in amounts(spark, staging)] == [
        "2023-12-30", "2023-12-31", "2024-01-01", "2024-01-01",
    ]


def test_mixed_headers_raise(spark, feed):
    odd = feed / "plain" / "dt=2024-01-01" / "part-1.csv"
    odd.write_text(f"extra,{COLUMNS}\n1,{row('2024-01-01', '5.00')}\n")
    paths = [str(feed / "plain" / "dt=2024-01-01" / "part-0.csv"), str(odd)]
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, paths).collect()


def test_bad_value_raises(spark, feed, tmp_path):
    land(feed, "plain", "2024-01-05", [row("2024-01-05", "five")])
    with pytest.raises(Exception, match="(?i)cast"):
        ingest_days(spark, str(feed), str(tmp_path / "s"), TARGET, ["2024-01-05"])


def test_day_names():
    assert file_prefix(dt.date(2024, 3, 9)) == "20240309_"
    days = catch_up_days(dt.date(2024, 3, 9))
    assert (days[0], days[-1], len(days)) == ("2024-03-01", "2024-03-08", 8)


def test_shared_folder_and_release(spark):
    path = fresh_path(spark, "x")
    assert path.startswith(shared_folder(spark))
    spark.range(3).write.parquet(path)
    assert release_written(spark) >= 1
    assert not Path(path.removeprefix("file:")).exists()


def test_mart_rebuild_overwrites(spark, tmp_path):
    path = str(tmp_path / "mart")
    target = schemas.columns(id=schemas.INT)
    save_mart(spark.range(5), path, target)
    save_mart(spark.range(2).withColumn("other", F.lit(1)), path, target)
    table = read_or_empty(spark, path, target)
    assert table.dtypes == [("id", "int")] and table.count() == 2


def test_daily_load_end_to_end(spark, feed, tmp_path):
    home = str(tmp_path / "warehouse")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    calendar = spark.createDataFrame([(20240101, days[0])], "date_id int, date_actual date")

    def load():
        for day in days:
            load_day(spark, str(feed), home, calendar, day)
        rebuild_retention(spark, home)

    def tables():
        frames = {n: read_or_empty(spark, f"{home}/mart/{n}", s) for n, s in DIMS.items()}
        frames["f_sales"] = read_staged(spark, f"{home}/mart/f_sales", schemas.SALES_FACT)
        frames["f_customer_retention"] = read_retention(spark, home)
        return {n: sorted(map(str, df.collect())) for n, df in frames.items()}

    load()
    first = tables()
    assert {n: len(rows) for n, rows in first.items()} == {
        "d_city": 1, "d_item": 1, "d_customer": 1, "f_sales": 4, "f_customer_retention": 2,
    }
    load()
    assert tables() == first
    land(feed, "plain", "2024-01-01", [row("2024-01-01", "1.00").replace(",3,ring", ",4,bolt")], "late.csv")
    load_days(spark, str(feed), home, calendar, ["2024-01-01"])
    later = tables()
    assert len(later["f_sales"]) == 5 and len(later["d_item"]) == 2
    assert later["d_city"] == first["d_city"]
    # A history export: its older rows reach the fact by a backfill, once however often it runs.
    old = [row("2023-12-30", "3.00"), row("2023-12-31", "4.00"), row("2023-12-31", "4.00")]
    land(feed, "plain", "2023-12-31", old, "history.csv")
    load_day(spark, str(feed), home, calendar, dt.date(2023, 12, 31))
    assert len(tables()["f_sales"]) == 7
    for _ in range(2):
        load_fact(spark, home, calendar, dt.date(2023, 12, 1), dt.date(2023, 12, 31))
        assert len(tables()["f_sales"]) == 8
    # A day corrected to empty loses its fact rows.
    land(feed, "status", "2024-01-02", [])
    load_day(spark, str(feed), home, calendar, dt.date(2024, 1, 2))
    assert len(tables()["f_sales"]) == 6
    # A row later than its file's day is refused.
    land(feed, "plain", "2024-01-04", [row("2024-01-05", "1.00")])
    with pytest.raises(Exception, match="later than its file"):
        load_day(spark, str(feed), home, calendar, dt.date(2024, 1, 4))


def test_staged_day_filter_prunes_folders(spark, feed, tmp_path, plan_of):
    staging = str(tmp_path / "staging")
    ingest_days(spark, str(feed), staging, TARGET)
    plan = plan_of(read_staged(spark, staging, TARGET).filter(F.col("dt") == "2024-01-02"))
    assert "PartitionFilters: [isnotnull(dt" in plan


def _weekly(spark, home):
    return sorted(map(str, read_retention(spark, home).collect()))


def test_weekly_mart_reads_only_touched_weeks(spark, feed, tmp_path, monkeypatch):
    """Increments, late rows, an emptied day and a backfill: equal to the full rebuild each time."""
    home = str(tmp_path / "warehouse")
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    # The calendar lacks a day, whose rows then have no period.
    dated = [(int(f"{day(n):%Y%m%d}"), day(n)) for n in range(-40, 30) if n != 5]
    calendar = spark.createDataFrame(dated, "date_id int, date_actual date")
    for n in range(2, 16):
        land(feed, "plain", str(day(n)), [row(str(day(n)), f"{n}.00"), row(str(day(n)), "1.00").replace(",7,Ann", f",{n % 3},Bo")])
    load_days(spark, str(feed), home, calendar, [str(day(n)) for n in range(16)])
    read = []
    weekly = retail.customer_retention_weekly

    def watched(fact, *args, **options):
        read.append(sorted({day_of(f) for f in fact.inputFiles()}))
        return weekly(fact, *args, **options)

    monkeypatch.setattr(retail, "customer_retention_weekly", watched)

    def step(touched, days=None):
        made = rebuild_retention(spark, home)
        assert made == touched
        if days is not None:
            assert read[-1] == days
        grown = _weekly(spark, home)
        fact = read_staged(spark, f"{home}/mart/f_sales", schemas.SALES_FACT)
        assert grown == sorted(map(str, weekly(fact).collect()))

    step(["20241", "20242", "20243", "none"])
    assert rebuild_retention(spark, home) == []
    parts = versions.latest(spark, f"{home}/mart/f_customer_retention").parts
    # A late file in the second week.
    land(feed, "plain", str(day(8)), [row(str(day(8)), "50.00")], "late.csv")
    load_day(spark, str(feed), home, calendar, day(8))
    step(["20242"], [str(day(n)) for n in range(7, 14)])
    after = versions.latest(spark, f"{home}/mart/f_customer_retention").parts
    assert {p for p in after if after[p] != parts[p]} == {"20242"}
    # An emptied day in the third week, then the day without a period.
    land(feed, "plain", str(day(15)), [])
    load_day(spark, str(feed), home, calendar, day(15))
    step(["20243"], [str(day(14))])
    land(feed, "plain", str(day(5)), [])
    load_day(spark, str(feed), home, calendar, day(5))
    step(["none"], [])
    assert "none" not in versions.latest(spark, f"{home}/mart/f_customer_retention").parts
    # History by a backfill; another kind of period recomputes all.
    land(feed, "plain", "2023-12-31", [row("2023-12-20", "3.00"), row("2023-12-31", "4.00")], "history.csv")
    load_day(spark, str(feed), home, calendar, dt.date(2023, 12, 31))
    load_fact(spark, home, calendar, dt.date(2023, 12, 1), dt.date(2023, 12, 30))
    step(["202351", "202352"], ["2023-12-20", "2023-12-31"])
    # The five ISO weeks are made and the three periods of the other kind that differ are emptied.
    assert len(rebuild_retention(spark, home, iso_period=True)) == 8
    assert len(read_retention(spark, home).collect()) == 5
    versions.vacuum(spark, f"{home}/mart/f_sales", keep=1, older_than=0)
    load_day(spark, str(feed), home, calendar, day(9))
    versions.vacuum(spark, f"{home}/mart/f_sales", keep=1, older_than=0)
    # The version the mart was made from is gone.
    assert len(rebuild_retention(spark, home, iso_period=True)) == 5
