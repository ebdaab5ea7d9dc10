import json
import os
from datetime import date, datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_measurements import HIGH, LOW, PAGES

from curbair.operators.measurements import hourly_statistics
from curbair.operators.quality import page_completeness, status_totals
from curbair.plans import manifest as log
from curbair.plans import measurements as air, trips as taxi
from curbair.plans.runs import run_measurements, run_together, run_trips
from curbair.schemas import GREEN, YELLOW
from curbair.streaming.hourly import closed_hours, measurement_stream
from curbair.streaming.trips import clean_arrivals, trip_stream

HEADER = ["VendorID", "{}_pickup_datetime", "{}_dropoff_datetime", "passenger_count", "trip_distance",
          "PULocationID", "DOLocationID"]
GOOD = "{},2026-01-0{} 01:00:00,2026-01-0{} 02:00:00,1,2.5,4,5"
BAD = "{},2026-01-0{} 01:00:00,2026-01-0{} 02:00:00,1,0,4,5"


def trip_file(folder, name, *days, extra=""):
    os.makedirs(folder, exist_ok=True)
    kind = "lpep" if name.startswith("green") else "tpep"
    head = ",".join(HEADER).format(kind, kind)
    lines = [GOOD.format(d, d, d) for d in days] + [BAD.format(9, 9, 9)]
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([head + extra, *[line + (",q" if extra else "") for line in lines]]) + "\n")


def test_merge_takes_files_with_one_time_column(spark, tmp_path):
    raw, out, man = (str(tmp_path / n) for n in ("raw", "clean", "manifest"))
    trip_file(raw, "yellow_a.csv", 2)
    trip_file(raw, "yellow_b.csv", 1)
    spark.read.option("header", True).csv(f"{raw}/yellow_a.csv").drop(YELLOW.dropoff).coalesce(1).write.option(
        "header", True).csv(f"{raw}/yellow_lone.csv")
    assert set(taxi.clean_files(spark, raw, out, man, "r1").status.values()) == {"done"}
    merged = taxi.merge_files(spark, out, str(tmp_path / "merged"), "20260101", "20260131", "r1")
    got = spark.read.parquet(merged["yellow"])
    assert sorted(got.columns) == sorted(YELLOW.columns)
    assert [(r[YELLOW.pickup][:8], r[YELLOW.dropoff] is None) for r in got.collect() if r.VendorID == 2] == [
        ("20260102", False), ("20260102", True)] and got.count() >= 3


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_incremental_clean_and_merge(spark, tmp_path, fmt):
    raw, out, man = (str(tmp_path / n) for n in ("raw", "clean", "manifest"))
    trip_file(raw, "green_2026-01.csv", 3, 1)
    trip_file(raw, "yellow_2026-01.csv", 2, extra=",tip")
    first = taxi.clean_files(spark, raw, out, man, "r1", fmt=fmt)
    assert first.status == {"green_2026-01.csv": "done", "yellow_2026-01.csv": "done"}
    counts = {(r.source_file, r.metric): r.value for f in first.reports for r in f.collect()}
    assert counts["green_2026-01.csv", "rows_in"] == 3 and counts["green_2026-01.csv", "rows_kept"] == 2
    assert counts["yellow_2026-01.csv", "rejected_distance"] == 1

    assert taxi.clean_files(spark, raw, out, man, "r2", fmt=fmt).status == {}
    trip_file(raw, "yellow_2026-02.csv", 1)
    trip_file(raw, "purple_2026-02.csv", 1)
    assert taxi.clean_files(spark, raw, out, man, "r3", fmt=fmt).status == {"yellow_2026-02.csv": "done"}

    merged = taxi.merge_files(spark, out, str(tmp_path / "merged"), "20260101", "20260131", "r3", fmt)
    assert merged["yellow"].endswith("taxi_data_20260101_20260131_r3/yellow_tripdata_merged")
    reader = spark.read if fmt == "parquet" else spark.read.option("header", True)
    got = [tuple(r) for r in reader.format(fmt).load(merged["yellow"])
           .select(F.col("VendorID").cast("int"), YELLOW.pickup).collect()]
    assert got == [(1, "20260101010000"), (2, "20260102010000")]
    green = reader.format(fmt).load(merged["green"]).select(F.col("VendorID").cast("int"), GREEN.dropoff)
    assert [tuple(r) for r in green.collect()] == [(1, "20260101020000"), (3, "20260103020000")]

    full = taxi.clean_files(spark, raw, str(tmp_path / "full"), str(tmp_path / "m2"), "r4", incremental=False, fmt=fmt)
    assert len(full.status) == 3
    trip_file(raw, "green_2026-01.csv")  # no valid row left: a full run clears its old output
    taxi.clean_files(spark, raw, str(tmp_path / "again"), str(tmp_path / "m3"), "r5", incremental=False, fmt=fmt)
    taxi.clean_files(spark, raw, str(tmp_path / "full2"), str(tmp_path / "m4"), "r6", fmt=fmt)
    trip_file(raw, "yellow_2026-01.csv")
    taxi.clean_files(spark, raw, str(tmp_path / "full2"), str(tmp_path / "m4"), "r7", incremental=False, fmt=fmt)
    assert [r[0] for f in taxi.cleaned_frames(spark, str(tmp_path / "full2"), YELLOW, fmt)
            for r in rows(f, F.col("VendorID").cast("int"))] == [1]

    for spec in (GREEN, YELLOW):
        a, b = (taxi.cleaned_frames(spark, o, spec, fmt) for o in (out, str(tmp_path / "full")))
        assert [rows(f) for f in a] == [rows(f) for f in b]


def test_failed_files_do_not_stop_others(spark, tmp_path):
    raw, out, man = (str(tmp_path / n) for n in ("raw", "clean", "manifest"))
    trip_file(raw, "green_1.csv", 1)
    for name, text in (("green_2.csv", "VendorID\n1\n"), ("yellow_3.parquet", "junk"), ("yellow_4.csv", "foo\n1\n")):
        open(os.path.join(raw, name), "w").write(text)
    status = taxi.clean_files(spark, raw, out, man, "r1").status
    assert status == {"green_1.csv": "done", "green_2.csv": "failed", "yellow_3.parquet": "failed", "yellow_4.csv": "failed"}
    totals = rows(status_totals(log.read_manifest(spark, man)), "status", "files")
    assert totals == [("done", 1), ("failed", 3)]
    again = taxi.clean_files(spark, raw, out, man, "r2").status
    assert "green_1.csv" not in again and len(again) == 3


def test_measurement_run(spark, tmp_path):
    pages = tmp_path / "pages.json"
    pages.write_text("\n".join(json.dumps(p) for p in PAGES))
    hourly, man = str(tmp_path / "hourly"), str(tmp_path / "man")
    air.land_hourly(spark, str(pages), hourly, "2026-01_to_2026-01", LOW, HIGH, "r", man)
    done = log.finished(log.read_manifest(spark, man), air.DATASET).first()
    assert done.range_start.replace(tzinfo=timezone.utc) == datetime(2026, 1, 1, tzinfo=timezone.utc)

    run = air.organise_hourly(spark, air.read_hourly(spark, hourly), str(tmp_path / "out"), "r")
    assert run.folder.endswith("air_data_20260101_20260101_r")
    fact = spark.read.option("header", True).csv(run.facts).first().asDict()
    assert fact["datetime_hour"] == "20260101000000" and float(fact["value_mean"]) == 4.0
    assert fact["location_id"] == "7" and fact["parameter_p"] == "pm25"
    assert spark.read.option("header", True).csv(run.stations).count() == 1
    assert {r.metric: r.value for r in run.report.collect()}["rows"] == 1.0

    merged = air.merge_hourly(spark, hourly, str(tmp_path / "merged"), man)
    assert spark.read.parquet(merged).count() == 1


def test_empty_run_raises(spark, tmp_path):
    df = spark.createDataFrame([], "datetime_hour timestamp, parameter string, location_id string")
    with pytest.raises(air.EmptyResult):
        air.organise_hourly(spark, df, str(tmp_path), "r")


def test_organise_many_files(spark, tmp_path):
    head = ("source_file string, datetime_hour timestamp_ntz, location_id string, parameter string, unit string, "
            "value_mean double, value_min double, value_max double, value_count bigint, location_name string, "
            "timezone string, latitude double, longitude double, country_iso string, isMobile boolean, isMonitor boolean")
    tail = (1.0, 1.0, 1.0, 1, "n", "t", 1.0, 2.0, "", False, False)
    df = spark.createDataFrame([
        ("a.csv", datetime(2026, 1, 1), "7", "pm25", "u", *tail),
        ("a.csv", datetime(2026, 1, 2), "7", None, "u", *tail),
        ("b.csv", datetime(2026, 3, 1), "7", "no2", "u", *tail)], head)
    paths = air.organise_files(df, str(tmp_path), "r", fmt="parquet")
    assert rows(spark.read.parquet(paths["extents"])) == [("a.csv", "20260101", "20260102"), ("b.csv", "20260301", "20260301")]
    facts = spark.read.parquet(paths["facts"])
    assert rows(facts, "source_file_p", "parameter_p", "datetime_hour") == [
        ("a.csv", "pm25", "20260101000000"), ("b.csv", "no2", "20260301000000")]
    assert spark.read.option("header", True).csv(paths["location_mapping"]).count() == 2


def test_impute_version(spark, tmp_path):
    df = spark.createDataFrame(
        [("h", "7", "pm25", "u", 0.0, 1.0, 2.0, 1.0), ("h", "7", "pm25", "u", 4.0, None, 2.0, 0.0)],
        "datetime_hour string, location_id string, parameter string, unit string, value_mean double, "
        "value_min double, value_max double, value_count double")
    from curbair.sources.sinks import write_by_group
    source, out = str(tmp_path / "v1"), str(tmp_path / "v2")
    write_by_group(df, source, air.GROUP)
    profile = air.impute_version(spark, source, out)
    assert profile.filter("column_name = 'value_mean'").first().zeros == 1
    got = spark.read.option("header", True).csv(out).select("value_mean", "value_min", "value_count")
    assert sorted(tuple(map(float, r)) for r in got.collect()) == [(4.0, 1.0, 1.0), (4.0, 1.0, 1.0)]


def test_run_together_raises_after_all_ended():
    ended = []

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_together(a=fail, b=lambda: ended.append(1))
    assert ended == [1]
    assert run_together(a=lambda: 1, b=lambda: 2) == {"a": 1, "b": 2}


def test_run_id():
    assert log.new_run_id(datetime(2026, 3, 31, 14, 30, 22)) == "20260331_143022"


def test_stream_cleans_each_file_once(spark, tmp_path):
    raw, out, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))
    schema = ", ".join(f"{c.format('lpep')} {'string' if 'time' in c else 'double'}" for c in HEADER)
    counts = []
    for step in ([("green_1.csv", 1), ("green_2.csv", 2), ("yellow_1.csv", 5)], [], [("green_3.csv", 3)]):
        for name, day in step:
            trip_file(raw, name, day)
        clean_arrivals(trip_stream(spark, raw, GREEN, schema), GREEN, out, progress).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts == [2, 2, 3]
    man = str(tmp_path / "man")
    taxi.clean_files(spark, raw, str(tmp_path / "batch"), man, "r")
    batch = taxi.cleaned_frames(spark, str(tmp_path / "batch"), GREEN)[0]
    assert rows(spark.read.parquet(out).select(batch.columns)) == rows(batch)


def test_closed_hours_equal_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "datetimeUtc timestamp, location_id string, value double"
    batches = [
        [("2026-01-01 00:10:00", "a", 1.0), ("2026-01-01 01:10:00", "a", 5.0)],
        [("2026-01-01 00:50:00", "a", 3.0), ("2026-01-01 02:30:00", "b", 7.0)],
        [("2026-01-01 09:00:00", "z", 0.0)],
    ]
    for batch in batches:
        df = spark.createDataFrame(batch, "t string, location_id string, value double")
        df.select(F.col("t").cast("timestamp").alias("datetimeUtc"), "location_id", "value") \
            .coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        closed_hours(stream, ["location_id"], "2 hours").writeStream.format("parquet") \
            .option("path", out).option("checkpointLocation", str(tmp_path / "cp")) \
            .trigger(availableNow=True).start().awaitTermination()
    whole = hourly_statistics(spark.read.schema(schema).parquet(source), keys=["location_id"])
    closed = whole.filter("datetime_hour < timestamp'2026-01-01 07:00:00'")
    assert rows(spark.read.parquet(out).select(closed.columns)) == rows(closed)


def test_malformed_rows_go_to_quarantine(spark, tmp_path):
    raw, out, man, bad = (str(tmp_path / n) for n in ("raw", "clean", "manifest", "bad"))
    trip_file(raw, "green_1.csv", 1)
    with open(os.path.join(raw, "green_1.csv"), "a") as f:
        f.write("x,2026-01-01 01:00:00,2026-01-01 02:00:00,1,2.5,4,5\n")
    result = taxi.clean_files(spark, raw, out, man, "r", quarantine=bad)
    assert spark.read.parquet(f"{out}/green").count() == 1
    held = spark.read.parquet(f"{bad}/green").collect()
    assert [(r.source_file, r["_corrupt_record"][:2]) for r in held] == [("green_1.csv", "x,")]
    counts = {r.metric: r.value for r in result.reports[0].collect()}
    assert counts["rows_in"] == 2


def test_whole_runs(spark, tmp_path):
    raw, work, output = (str(tmp_path / n) for n in ("raw", "work", "out"))
    trip_file(raw, "yellow_2026-01.csv", 2, 1)
    pages = tmp_path / "pages" / "period=2026-01_to_2026-02"
    pages.mkdir(parents=True)
    (pages / "1.json").write_text(json.dumps(PAGES[0]))
    days = (date(2026, 1, 1), date(2026, 2, 10))

    def both(run_id):
        return run_together(
            taxi=lambda: run_trips(spark, raw, f"{work}/taxi", output, *days, run_id),
            air=lambda: run_measurements(spark, str(tmp_path / "pages"), f"{work}/air", output, *days, run_id))

    done = both("r1")
    assert [r.VendorID for r in spark.read.parquet(done["taxi"]["yellow"]).collect()] == [1, 2]
    assert spark.read.option("header", True).csv(done["air"].facts).count() == 1
    (pages / "1.json").write_text("")  # covered: not read again
    again = both("r2")
    assert spark.read.option("header", True).csv(again["air"].facts).count() == 1
    assert again["air"].folder.endswith("_r2")


def station_page(*times):
    page = json.loads(json.dumps(PAGES[0]))
    sensor = next(s for s in page["sensors"] if s["measurements"])
    like = sensor["measurements"][0]
    page["sensors"] = [sensor]
    sensor["measurements"] = []
    for at in times:
        one = json.loads(json.dumps(like))
        one["period"]["datetimeFrom"]["utc"], one["value"] = at, 1.0
        sensor["measurements"].append(one)
    return json.dumps(page) + "\n"


@pytest.mark.parametrize("requests", [
    # one period name for both, and different names for the same months
    [((2026, 1, 1), (2026, 2, 10)), ((2026, 1, 20), (2026, 2, 28))],
    [((2026, 1, 1), (2026, 1, 31)), ((2026, 1, 20), (2026, 2, 10))],
])
def test_overlapping_requests_hold_every_hour_once(spark, tmp_path, requests):
    at = ["2026-01-03T05:00:00Z", "2026-01-25T05:00:00Z", "2026-02-05T05:00:00Z", "not a time"]
    for name in ("2026-01_to_2026-01", "2026-01_to_2026-02"):
        (tmp_path / "pages" / f"period={name}").mkdir(parents=True)
        (tmp_path / "pages" / f"period={name}" / "1.json").write_text(station_page(*at))
    work = str(tmp_path / "work")
    for number, (start, end) in enumerate(requests):
        run_measurements(spark, str(tmp_path / "pages"), work, str(tmp_path / "out"), date(*start), date(*end), f"r{number}")
    landed = air.read_hourly(spark, f"{work}/hourly", f"{work}/manifest").filter("datetime_hour is not null")
    assert rows(landed.select(F.date_format("datetime_hour", "MM-dd").alias("d"), "value_count")) == [
        ("01-03", 1), ("01-25", 1), ("02-05", 1)]
    # what a broken run wrote without recording it is not read
    os.makedirs(f"{work}/hourly/period=x/range=1_2")
    landed.coalesce(1).write.mode("overwrite").parquet(f"{work}/hourly/period=x/range=a_b")
    assert air.read_hourly(spark, f"{work}/hourly", f"{work}/manifest").filter("datetime_hour is not null").count() == 3


@pytest.mark.parametrize("text", [station_page("2026-01-03T05:00:00Z")[:-20], json.dumps(PAGES[0], indent=1), ""])
def test_unreadable_or_empty_pages_are_not_done(spark, tmp_path, text):
    folder = tmp_path / "pages" / "period=2026-01_to_2026-01"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(text)
    work = str(tmp_path / "work")
    with pytest.raises(Exception, match="MALFORMED|no measurements"):
        run_measurements(spark, str(tmp_path / "pages"), work, str(tmp_path / "out"), date(2026, 1, 1), date(2026, 1, 31), "r")
    assert log.finished(log.read_manifest(spark, f"{work}/manifest"), air.DATASET).count() == 0


def test_page_completeness(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 2), ("b", 1, 3), ("b", 1, 3)],
                               "sensor_id string, page int, expected_pages int")
    assert rows(page_completeness(df)) == [("a", 2, 2, True), ("b", 3, 1, False)]


def test_page_stream(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps(PAGES[0]))
    flat = measurement_stream(spark, str(pages), files_per_batch=1)
    assert dict(flat.dtypes)["datetimeUtc"] == "timestamp"
    flat.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")) \
        .trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out), "location_id", "value") == [("7", 4.0), ("7", None)]


def test_damaged_file_costs_its_own_rows_only(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    raw = tmp_path / "raw"
    raw.mkdir()
    one = {"trip_distance": [1.0] * 5000, "VendorID": list(range(5000))}
    for name in ("green_1.parquet", "green_2.parquet"):
        pq.write_table(pa.table(one), raw / name, compression="none", use_dictionary=False)
    body = bytearray((raw / "green_2.parquet").read_bytes())
    body[4:400] = b"\xff" * 396  # page header destroyed, footer intact
    (raw / "green_2.parquet").write_bytes(bytes(body))
    status = taxi.clean_files(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "m"), "r").status
    assert status == {"green_1.parquet": "done", "green_2.parquet": "failed"}
    assert spark.read.parquet(str(tmp_path / "out" / "green")).count() == 5000


def test_rows_without_a_time_are_landed_once(spark, tmp_path):
    """Two landings with different periods, from input without a period column."""
    flat = spark.createDataFrame(
        [(datetime(2026, 1, 3, 5), "7", 1.0), (datetime(2026, 3, 4, 5), "7", 2.0), (None, "7", 9.0)],
        "datetimeUtc timestamp_ntz, location_id string, value double")
    hourly, man = str(tmp_path / "hourly"), str(tmp_path / "man")
    for name, first, end in (("a", date(2026, 1, 1), date(2026, 2, 1)), ("b", date(2026, 3, 1), date(2026, 4, 1))):
        ranges = spark.createDataFrame([(name, first, end)], "period_name string, range_start date, range_end date")
        air.land_days(flat, hourly, ranges, name, man)
    landed = air.read_hourly(spark, hourly, man)
    assert sorted((str(r.datetime_hour)[:7], r.value_count) for r in landed.collect()) == [
        ("2026-01", 1), ("2026-03", 1), ("None", 1)]
    # what no manifest holds is not merged
    landed.limit(1).write.parquet(f"{hourly}/period=x/range=broken")
    merged = air.merge_hourly(spark, hourly, str(tmp_path / "merged"), man)
    assert spark.read.parquet(merged).count() == 3


def test_one_damaged_file_of_many_costs_few_jobs():
    from pyspark.errors import PySparkException

    from curbair.sources.sinks import halving
    jobs, done = [], set()
    bad = {"f700"}

    def job(some):
        jobs.append(len(some))
        if bad & set(some):
            raise PySparkException("damaged")
        done.update(some)

    members = [f"f{i}" for i in range(1000)]
    assert halving(job, members) == {"f700": "damaged"}
    assert done == set(members) - bad and len(jobs) <= 2 * 10 + 1 and sum(jobs) <= 3 * 1000
    bad |= {"f3", "f4"}
    jobs.clear()
    assert set(halving(job, members)) == bad and len(jobs) <= 3 * 21
    assert halving(job, []) == {}
