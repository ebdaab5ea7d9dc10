import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from curbair.operators import quality, trips, unions
from curbair.operators.conform import ConformError, conform
from curbair.schemas import GREEN, YELLOW

HEAD = ("VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
        "passenger_count double, trip_distance double, PULocationID int, DOLocationID int, extra string")
T1, T2 = "2026-01-01 01:00:00", "2026-01-01 01:10:00"
NAN = float("nan")
FX1 = [
    (1, "2026-01-01 00:27:58", "2026-01-01 00:40:00", 1.0, 2.5, 4, 261, "x"),
    (2, T1, T2, 1.0, 0.0, 4, 261, "x"),
    (3, T1, T2, 1.0, -1.0, 4, 261, "x"),
    (4, T1, T2, 1.0, NAN, 4, 261, "x"),
    (5, T1, T2, None, 2.0, 4, 261, "x"),
    (6, T1, T2, 0.0, 2.0, 4, 261, "x"),
    (7, T1, T1, 1.0, 2.0, 4, 261, "x"),
    (8, "2026-01-01 02:00:00", T1, 1.0, 2.0, 4, 261, "x"),
    (9, "bad", T1, 1.0, 2.0, 4, 261, "x"),
    (10, T1, T2, 1.0, 2.0, 0, 261, "x"),
    (11, T1, T2, 1.0, 2.0, 4, None, "x"),
    (12, T1, T2, 2.0, 0.1, 264, 265, "x"),
    (13, "bad", None, 0.0, 0.0, 0, 0, "x"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(FX1, HEAD)


def test_clean_keeps_valid_rows_and_columns(raw):
    cleaned = trips.clean_trips(raw, YELLOW)
    assert cleaned.columns == list(YELLOW.columns)
    assert rows(cleaned, "VendorID", YELLOW.pickup) == [(1, "20260101002758"), (12, "20260101010000")]


def test_clean_is_idempotent_on_stamped_output(raw):
    once = trips.clean_trips(raw, YELLOW)
    assert rows(trips.clean_trips(once, YELLOW)) == rows(once)


def test_reject_reasons(raw):
    report = quality.clean_report(raw, YELLOW).first().asDict()
    assert report == {
        "rows_in": 13, "rows_kept": 2, "rejected_distance": 4, "rejected_passengers": 2,
        "rejected_unparseable_time": 1, "rejected_time_order": 2, "rejected_location": 2,
    }


def test_kept_plus_rejected_is_input(raw):
    r = quality.clean_report(raw, YELLOW).first().asDict()
    assert r["rows_kept"] + sum(v for k, v in r.items() if k.startswith("rejected")) == r["rows_in"]


def test_without_passenger_count(spark):
    df = spark.createDataFrame([(1, T1, T2, 2.0, 4, 5)],
                               "VendorID int, lpep_pickup_datetime string, lpep_dropoff_datetime string, "
                               "trip_distance double, PULocationID int, DOLocationID int")
    cleaned = trips.clean_trips(df, GREEN)
    assert len(cleaned.columns) == 6 and cleaned.count() == 1


def test_one_time_column_passes_unchanged(spark):
    df = spark.createDataFrame([("whatever", 2.0), (T1, 0.0)], "lpep_pickup_datetime string, trip_distance double")
    assert rows(trips.clean_trips(df, GREEN)) == [("whatever", 2.0)]


def test_missing_distance_fails(spark):
    df = spark.createDataFrame([(1,)], "VendorID int")
    with pytest.raises(ConformError, match="trip_distance"):
        trips.clean_trips(df, YELLOW)


def test_no_known_column_fails(spark):
    with pytest.raises(ConformError):
        trips.clean_trips(spark.createDataFrame([(1, 2)], "foo int, bar int"), YELLOW)


def test_yellow_file_with_green_times_drops_them(spark):
    df = spark.createDataFrame([(T1, T2, 1.0)],
                               "lpep_pickup_datetime string, lpep_dropoff_datetime string, trip_distance double")
    assert trips.clean_trips(df, YELLOW).columns == ["trip_distance"]


def test_conform_order_and_cast(spark):
    df = spark.createDataFrame([("7", "x", 1)], "b string, c string, a int")
    out = conform(df, {"a": "bigint", "b": "int", "z": "string"})
    assert out.dtypes == [("a", "bigint"), ("b", "int")]
    assert rows(conform(df, {"c": "int"})) == [(None,)]


def test_number_checks_reach_the_scan(spark, tmp_path, raw):
    path = str(tmp_path / "trips")
    raw.write.parquet(path)
    plan = plan_of(trips.clean_trips(spark.read.parquet(path), YELLOW))
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "extra" not in plan
    assert "Exchange" not in plan


def test_merge_order_and_columns(spark):
    a = spark.createDataFrame([(1, "20260103000000", "x")], f"k int, {YELLOW.pickup} string, a string")
    b = spark.createDataFrame([(2, "20260101000000", "y")], f"k int, {YELLOW.pickup} string, b string")
    c = spark.createDataFrame([(3, None)], f"k int, {YELLOW.pickup} string")
    merged = unions.merge_trips([a, b, c, a], YELLOW)
    assert merged.columns == ["k", YELLOW.pickup, "a", "b"]
    assert [r[0] for r in merged.collect()] == [2, 1, 1, 3]


def test_merge_fails_on_malformed_pickup(spark):
    df = spark.createDataFrame([(1, "2026"), (2, "20260101000000")], f"k int, {YELLOW.pickup} string")
    with pytest.raises(Exception, match="(?i)parse|timestamp"):
        unions.merge_trips([df], YELLOW).collect()


def test_sort_spreads_copies_over_partitions(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(20000).select(F.lit(1).alias("k"), F.lit("same").alias("v")).write.parquet(path)
    with_limits = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_limits.items():
        spark.conf.set(key, value)
    try:
        sizes = [r[0] for r in unions.spread_sort(spark.read.parquet(path), ["k"])
                 .groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for key in with_limits:
            spark.conf.unset(key)
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 2


def test_merge_measurements_prefers_hour_over_date(spark):
    df = spark.createDataFrame(
        [("2026-01-02", "2026-01-01T00:00:00Z"), ("2026-01-01", "2026-01-02T00:00:00Z")],
        "date string, datetimeUtc string")
    assert [r[0] for r in unions.merge_measurements([df]).collect()] == ["2026-01-02", "2026-01-01"]
    plain = spark.createDataFrame([(2,), (1,)], "x int")
    assert rows(unions.merge_measurements([plain])) == [(1,), (2,)]


def test_union_type_drift(spark):
    a = spark.createDataFrame([(1,)], "x bigint")
    b = spark.createDataFrame([(2.5,)], "x double")
    assert rows(unions.union_all([a, b], {"x": "double"})) == [(1.0,), (2.5,)]
    assert rows(unions.distinct_rows(unions.union_all([a, a]))) == [(1,)]


def test_merge_options(spark):
    df = spark.createDataFrame([(1, "20260101000000"), (1, "20260101000000"), (2, "20260102000000")],
                               f"k int, {YELLOW.pickup} string")
    assert unions.merge_trips([df], YELLOW, dedup_keys=[]).count() == 2
    assert unions.merge_trips([df], YELLOW, dedup_keys=["k"]).count() == 2
    day = ("2026-01-02T00:00:00Z", "2026-01-02T23:59:59Z")
    assert rows(unions.merge_trips([df], YELLOW, date_range=day), "k") == [(2,)]
    plain = spark.createDataFrame([(1,), (1,)], "x int")
    assert unions.merge_measurements([plain], dedup_keys=[]).count() == 1
