import json
from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from curbair.operators import impute as imputing
from curbair.operators import measurements as ops
from curbair.operators import joins, organise, partials
from curbair.sources.catalogue import station_pages

PAGES = [
    {"id": 7, "name": "A", "timezone": "America/New_York",
     "coordinates": {"latitude": 40.7, "longitude": -73.9},
     "sensors": [
         {"id": "70", "parameter": {"id": 2, "name": "pm25", "units": "ug/m3", "display_name": "PM2.5"},
          "measurements": [
              {"period": {"datetimeFrom": {"utc": "2026-01-01T00:00:00Z", "local": "2025-12-31T19:00:00-05:00"}},
               "parameter": {"name": "pm25", "units": "ug/m3"}, "value": 4.0},
              {"period": {"datetimeFrom": {"utc": "2026-01-01T00:30:00Z", "local": "2025-12-31T19:30:00-05:00"}},
               "parameter": {"name": "pm25", "units": "ug/m3"}, "value": None}]},
         {"id": "71", "parameter": {"id": 3, "name": "no2", "units": "ppm", "display_name": "NO2"},
          "measurements": []}]},
    {"id": 8, "name": "B", "timezone": "America/New_York", "coordinates": None, "sensors": []},
]
FX4 = [
    (7, "pm25", 4.0, "2026-01-01T00:00:00Z"), (7, "pm25", None, "2026-01-01T00:30:00Z"),
    (7, "pm25", 8.0, "2026-01-01T00:59:59Z"), (7, "pm25", 5.0, "2026-01-01T01:00:00Z"),
    (7, "no2", None, "2026-01-01T00:10:00Z"), (7, "pm25", 1.0, "2025-12-31T23:59:59Z"),
    (7, "pm25", 2.0, "2026-01-01T23:59:59Z"), (7, "pm25", 9.0, ""),
]
LOW, HIGH = "2026-01-01T00:00:00Z", "2026-01-01T23:59:59Z"


@pytest.fixture
def flat(spark):
    df = spark.createDataFrame(FX4, "location_id bigint, parameter string, value double, datetimeUtc string")
    return df.withColumn("unit", F.lit("u"))


def test_flatten(spark, tmp_path):
    path = tmp_path / "pages.json"
    path.write_text(json.dumps(PAGES))
    for multi_line in (True, False):
        out = ops.flatten_stations(station_pages(spark, str(path), multi_line=multi_line))
        got = rows(out, "location_id", "parameter", "value", "country_iso", "isMobile",
                   "isMonitor", "owner_name", "provider", "latitude", "unit")
        assert got == [("7", "pm25", 4.0, "", False, False, "", "", 40.7, "ug/m3"),
                       ("7", "pm25", None, "", False, False, "", "", 40.7, "ug/m3")]
    assert len(out.columns) == 15


def test_time_filter_and_report(flat):
    kept = ops.filter_time_range(flat, "datetimeUtc", LOW, HIGH)
    assert kept.count() == 7
    report = ops.time_range_report(flat, "datetimeUtc", LOW, HIGH).first().asDict()
    assert report == {"total": 8, "filtered_out": 1, "kept": 7, "without_time": 1}
    assert ops.filter_time_range(flat, "datetimeUtc", "nonsense", HIGH).count() == 8


def test_hourly(flat):
    hourly = ops.hourly_statistics(ops.filter_time_range(flat, "datetimeUtc", LOW, HIGH))
    got = rows(hourly.withColumn("h", F.date_format("datetime_hour", "yyyy-MM-dd HH")),
               "h", "parameter", "value_mean", "value_min", "value_max", "value_count")
    assert got == [
        ("2026-01-01 00", "no2", None, None, None, 0),
        ("2026-01-01 00", "pm25", 6.0, 4.0, 8.0, 2),
        ("2026-01-01 01", "pm25", 5.0, 5.0, 5.0, 1),
        ("2026-01-01 23", "pm25", 2.0, 2.0, 2.0, 1),
        (None, "pm25", 9.0, 9.0, 9.0, 1),
    ]


def test_hourly_ignores_nan_and_fills_attributes(spark):
    df = spark.createDataFrame(
        [("a", float("nan"), LOW, None), ("a", 3.0, LOW, None)],
        "location_id string, value double, datetimeUtc string, latitude double")
    r = ops.hourly_statistics(df).first()
    assert (r.value_mean, r.value_count, r.latitude) == (3.0, 1, 0.0)


def test_hourly_keys_by_presence(spark):
    df = spark.createDataFrame([("a", None, 1.0, LOW)],
                               "location_id string, unit string, value double, datetimeUtc string")
    assert "unit" in ops.hourly_statistics(df).columns
    assert "unit" not in ops.hourly_statistics(df, drop_all_null=True).columns
    with pytest.raises(ValueError):
        ops.hourly_statistics(df.drop("location_id", "unit"))


def test_hourly_keeps_zoneless_hours(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist on this day in the session zone
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' as datetimeUtc, 1.0D as value, 'a' as unit")
        assert ops.hourly_statistics(df).first()[0] == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hourly_combines_before_the_shuffle(flat):
    plan = plan_of(ops.hourly_statistics(flat))
    assert "partial_avg" in plan and plan.count("Exchange") == 1


def test_parts_merge_to_the_same_statistics(flat, tmp_path, spark):
    path = str(tmp_path / "parts")
    late = F.col("datetimeUtc") < "2026-01-01T00:30:00Z"
    partials.add_increment(flat.filter(~late), path, "1")
    partials.add_increment(flat.filter(late), path, "2")
    partials.add_increment(flat.filter(late), path, "2")
    whole = ops.hourly_statistics(flat)
    assert rows(partials.read_increments(spark, path).select(whole.columns)) == rows(whole)
    packed = str(tmp_path / "packed")
    partials.compact_increments(spark, path, packed, "1-2")
    assert rows(partials.read_increments(spark, packed).select(whole.columns)) == rows(whole)


def test_bbox_and_values(spark):
    df = spark.createDataFrame([(-74.0, 40.5, "a"), (0.0, 0.0, "b"), (-75.5, 40.0, "c")],
                               "longitude double, latitude double, k string")
    assert rows(ops.filter_bbox(df, (-74.0, 40.5, -73.0, 41.0)), "k") == [("a",)]
    assert rows(ops.filter_bbox(df, (-180, -90, 180, 90), drop_origin=True), "k") == [("a",), ("c",)]
    assert rows(ops.filter_values(df, k=["a", "b"], latitude=None), "k") == [("a",), ("b",)]


FX5 = [("pm25", 7, 0.0, 0), ("pm25", 7, None, 0), ("pm25", 7, 4.0, 3), ("pm25", 7, -2.0, 1),
       ("no2", 8, 0.0, 0), ("no2", 8, None, 0)]


def test_impute(spark):
    df = spark.createDataFrame(FX5, "parameter string, location_id int, value_mean double, value_count int")
    filled = imputing.impute(df, ["parameter", "location_id"])
    assert rows(filled) == sorted([
        ("pm25", 7, 1.0, 2.0), ("pm25", 7, 1.0, 2.0), ("pm25", 7, 4.0, 3.0), ("pm25", 7, -2.0, 1.0),
        ("no2", 8, 0.0, 0.0), ("no2", 8, 0.0, 0.0),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    profile = rows(imputing.missing_profile(df, ["parameter"], ["value_mean"]))
    assert profile == [("no2", "value_mean", 1, 1, 0.0), ("pm25", "value_mean", 1, 1, 1.0)]


def test_impute_treats_nan_as_missing_and_null_keys_as_a_group(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0), ("a", 0.0), ("a", 5.0)], "k string, value double")
    assert rows(imputing.impute(df, ["k"])) == [("a", 5.0), ("a", 5.0), (None, 2.0), (None, 2.0)]
    kept = imputing.impute(df, ["k"], zero_is_missing=False)
    assert rows(kept.filter("k = 'a'")) == [("a", 0.0), ("a", 5.0)]


def test_impute_beyond_the_broadcast_limit(spark, monkeypatch):
    data = [("hot", float(i % 4)) for i in range(400)] + [(None, 0.0), (None, 3.0)]
    data += [(f"k{i}", float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(data, "k string, value double")
    near = rows(imputing.impute(df, ["k"]))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_KEYS", 10)
    far = imputing.impute(df, ["k"])
    assert "Union" in plan_of(far) and rows(far) == near


def test_impute_moves_no_rows(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.createDataFrame(FX5, "parameter string, location_id int, value_mean double, value_count int").write.parquet(path)
    plan = plan_of(imputing.impute(spark.read.parquet(path), ["parameter", "location_id"]))
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_organise_views(flat):
    hourly = ops.hourly_statistics(ops.filter_time_range(flat, "datetimeUtc", LOW, HIGH))
    hourly = hourly.filter("datetime_hour is not null")
    assert rows(organise.time_extent(hourly)) == [("20260101", "20260101")]
    assert rows(organise.stations_per_parameter(hourly)) == [("no2", 1), ("pm25", 1)]
    assert rows(organise.rows_per_partition(hourly)) == [("no2", 7, 1), ("pm25", 7, 3)]
    fact = organise.organised_fact(hourly)
    assert len(fact.columns) == 8
    assert ("20260101000000",) in rows(fact, "datetime_hour")


def test_station_with_two_names_gives_two_rows(spark):
    head = ("location_id int, location_name string, timezone string, latitude double, longitude double, "
            "country_iso string, isMobile boolean, isMonitor boolean")
    rest = ("t", 1.0, None, "", False, False)
    df = spark.createDataFrame([(7, "A", *rest), (7, "A", *rest), (7, "B", *rest)], head)
    assert organise.station_dimension(df).count() == 2


def test_sensor_extent(flat):
    got = {r.parameter: r for r in ops.sensor_extent(flat, ["parameter"]).collect()}
    assert got["pm25"].measurements == 7
    assert got["pm25"].first_time == datetime(2025, 12, 31, 23, 59, 59)


def test_time_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("select timestamp_ntz'2026-01-01 00:00:00' t, 1 v").write.parquet(path)
    plan = plan_of(ops.filter_time_range(spark.read.parquet(path), "t", LOW, HIGH))
    assert "Or(IsNull(t)" in plan or "PushedFilters: [Or(IsNull" in plan


def test_page_scan_is_lean(spark, tmp_path):
    path, landed = tmp_path / "pages.json", str(tmp_path / "landed")
    path.write_text(json.dumps(PAGES))
    station_pages(spark, str(path), complete=True).write.parquet(landed)
    lean = ops.flatten_stations(station_pages(spark, landed, "parquet"))
    assert "datetimeTo" not in plan_of(lean) and "display_name" not in plan_of(lean)
    whole = ops.flatten_stations(station_pages(spark, landed, "parquet", complete=True))
    assert rows(lean) == rows(whole) and lean.count() == 2
