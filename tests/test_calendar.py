import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from curbair.functions import names, times
from curbair.operators import spines
from curbair.operators.measurements import look_back
from curbair.operators.organise import dataset_name
from curbair.sources.catalogue import file_catalogue

CATALOGUE = {
    "2025": {"12": [{"type": "yellow", "url": " http://h/y_2025-12.parquet "},
                    {"type": "green", "url": "http://h/g_2025-12.parquet"}]},
    "2026": {"02": [{"type": "yellow", "url": "http://h/y_2026-02.parquet"}]},
}


@pytest.fixture
def files(spark, tmp_path):
    path = tmp_path / "links.json"
    path.write_text(json.dumps(CATALOGUE, indent=1))
    return file_catalogue(spark, str(path))


@pytest.mark.parametrize("days, spine, listed, urls", [
    (7, ["2026-02"], ["2026-02"], ["http://h/y_2026-02.parquet"]),
    (80, ["2025-12", "2026-01", "2026-02"], ["2025-12", "2026-02"],
     ["http://h/y_2025-12.parquet", "http://h/y_2026-02.parquet"]),
])
def test_month_spine_and_work_list(spark, files, days, spine, listed, urls):
    request = spark.sql(f"select date_sub(date'2026-02-22', {days}) as since, date'2026-02-22' as until")
    months = spines.month_spine(request, "since", "until")
    assert [r[0] for r in rows(months, "year_month")] == spine
    assert [r[0] for r in rows(spines.available_months(months, files), "year_month")] == listed
    work = spines.work_list(months, files, ["yellow"])
    assert [r[0] for r in rows(work, "url")] == urls
    done = work.select("source_file")
    assert spines.work_list(months, files, ["yellow"], done).isEmpty()
    assert spines.work_list(months, files).count() >= len(urls)


@pytest.mark.parametrize("start, end, compatible", [
    (datetime(2025, 11, 15), datetime(2026, 3, 10, 23, 59, 59), [
        ("2025-11_to_2025-12", datetime(2025, 11, 15), datetime(2025, 12, 31)),
        ("2026-01_to_2026-02", datetime(2026, 1, 1), datetime(2026, 2, 28)),
        ("2026-03_to_2026-03", datetime(2026, 3, 1), datetime(2026, 3, 10, 23, 59, 59))]),
    (datetime(2025, 12, 20), datetime(2026, 1, 5, 23, 59, 59), [
        ("2025-12_to_2026-01", datetime(2025, 12, 20), datetime(2026, 1, 5, 23, 59, 59))]),
])
def test_period_spine(spark, start, end, compatible):
    request = spark.createDataFrame([(start, end)], "since timestamp_ntz, until timestamp_ntz")
    columns = ("period_name", "period_start", "period_end")
    assert rows(spines.period_spine(request, "since", "until", True), *columns) == compatible
    fixed = rows(spines.period_spine(request, "since", "until"), *columns)
    assert [r[0] for r in fixed] == [r[0] for r in compatible]
    assert all(a[2] == b[1] for a, b in zip(fixed, fixed[1:]))
    assert fixed[-1][2] == datetime(end.year, end.month, end.day + 1)


def test_uncovered_ranges(spark):
    periods = spark.createDataFrame(
        [("p", date(2026, 1, 1), date(2026, 1, 11))], "period_name string, period_start date, period_end date")
    covered = spark.createDataFrame(
        [(date(2025, 12, 1), date(2026, 1, 3)), (date(2026, 1, 5), date(2026, 1, 7))],
        "period_start date, period_end date")
    assert rows(spines.uncovered_ranges(periods, covered)) == [
        ("p", date(2026, 1, 3), date(2026, 1, 5)), ("p", date(2026, 1, 7), date(2026, 1, 11))]


def test_part_days_are_wanted_but_do_not_cover(spark):
    schema = "period_name string, period_start timestamp_ntz, period_end timestamp_ntz"
    periods = spark.createDataFrame([("p", datetime(2026, 1, 1, 6), datetime(2026, 1, 4, 12))], schema)
    covered = spark.createDataFrame(
        [("a", datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 12)), ("b", datetime(2026, 1, 2, 12), datetime(2026, 1, 4))], schema)
    assert rows(spines.uncovered_ranges(periods, covered)) == [
        ("p", date(2026, 1, 1), date(2026, 1, 3)), ("p", date(2026, 1, 4), date(2026, 1, 5))]


def test_hourly_spine_keeps_values_of_null_keys(spark):
    df = spark.createDataFrame([(None, datetime(2026, 1, 1, 0), 1.0), (None, datetime(2026, 1, 1, 2), 2.0)],
                               "k string, datetime_hour timestamp_ntz, v double")
    assert sorted((r.datetime_hour.hour, r.v) for r in spines.hourly_spine(df, ["k"]).collect()) == [(0, 1.0), (1, None), (2, 2.0)]


def test_hourly_spine_fills_gaps(spark):
    df = spark.createDataFrame([("a", datetime(2026, 1, 1, 0), 1.0), ("a", datetime(2026, 1, 1, 3), 2.0),
                                ("b", datetime(2026, 1, 1, 5), 3.0), ("b", None, 4.0)],
                               "k string, datetime_hour timestamp_ntz, v double")
    assert [(r[0], r[2]) for r in rows(spines.hourly_spine(df, ["k"]), "k", "datetime_hour", "v")] == [
        ("a", 1.0), ("a", None), ("a", None), ("a", 2.0), ("b", 3.0)]


@pytest.mark.parametrize("text, expected", [
    ("2026-01-01T00:27:58Z", datetime(2026, 1, 1, 0, 27, 58)),
    ("2026-01-01 00:27:58", datetime(2026, 1, 1, 0, 27, 58)),
    ("2026-01-01", datetime(2026, 1, 1)),
    ("20260101002758", datetime(2026, 1, 1, 0, 27, 58)),
    ("1/15/2026 10:05:00 PM", datetime(2026, 1, 15, 22, 5)),
    ("01/15/2026 22:05", datetime(2026, 1, 15, 22, 5)),
    ("2026/01/15 22:05:00", datetime(2026, 1, 15, 22, 5)),
    ("13/40/2026", None), ("n/a", None), ("bad", None), ("", None), (None, None), ("2026-13-01", None),
])
def test_lenient_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.lenient_time(F.col("t"))).first()[0] == expected


def test_offset_is_honoured_for_zoned_times(spark):
    df = spark.createDataFrame([("2026-01-01T00:00:00-05:00",)], "t string")
    assert df.select(times.lenient_time(F.col("t"), "timestamp").cast("string")).first()[0] == "2026-01-01 05:00:00"


def test_bounds():
    assert times.utc_bound("2026-01-01T00:00:00Z") == times.utc_bound(datetime(2026, 1, 1))
    assert times.utc_bound("x") is None and times.utc_bound(None) is None


def test_names(spark):
    df = spark.createDataFrame([("http://h/a.b/green_2026-01.tar.parquet",)], "u string")
    got = df.select(
        names.base_name(F.col("u")), names.with_suffix(names.base_name(F.col("u")), ".csv"),
        names.taxi_type_of(names.base_name(F.col("u"))), names.part_of(F.col("u"), ".", 9),
        names.contains_folded(F.col("u"), "GREEN"), names.two_digits(F.lit(3)),
    ).first()
    assert tuple(got) == ("green_2026-01.tar.parquet", "green_2026-01.tar.csv", "green", None, True, "03")
    mixed = spark.createDataFrame([("yellow_green.csv",), ("evergreen_1.csv",)], "n string")
    assert [r[0] for r in mixed.select(names.taxi_type_of(F.col("n"))).collect()] == ["yellow", ""]


def test_look_back(spark):
    low, high = look_back(F.lit("2026-02-22").cast("date"), 7)
    assert tuple(spark.range(1).select(low, high).first()) == (date(2026, 2, 15), date(2026, 2, 23))


def test_dataset_name():
    assert dataset_name("taxi_data", "20260101", "20260131", "20260201_000000") == \
        "taxi_data_20260101_20260131_20260201_000000"
