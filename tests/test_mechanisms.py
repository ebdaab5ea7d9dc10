"""Extent index, intervals, gaps, increments, sorted sets, lag blocks and stream parts."""

import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from test_measurements import PAGES

from curbair.analysis import relation
from curbair.analysis.demand import demand_lattice
from curbair.operators import impute as imputing, intervals, spines
from curbair.operators.measurements import filter_bbox, filter_time_range, hourly_statistics
from curbair.operators.partials import read_increments
from curbair.plans import sorted_set
from curbair.sources import extents
from curbair.streaming.hourly import write_parts

T0 = datetime(2026, 1, 1)


# extents

def readings(spark, days=40):
    data = [(T0 + timedelta(hours=h), f"s{h % 5}", float(h % 90), float(h // 24), float(h)) for h in range(24 * days)]
    return spark.createDataFrame(data, "datetimeUtc timestamp_ntz, location_id string, longitude double, latitude double, value double")


def test_a_range_opens_few_files(spark, tmp_path):
    folder, index = str(tmp_path / "in +1"), str(tmp_path / "index")
    whole = readings(spark)
    whole.repartitionByRange(40, "datetimeUtc").write.parquet(folder)
    scan = extents.parquet_rows(spark)
    files = len(whole.sparkSession.read.parquet(folder).inputFiles())
    assert files == 40 and extents.update_index(spark, folder, index, scan) == 40
    assert extents.update_index(spark, folder, index, scan) == 0
    start, end, box = "2026-01-10T00:00:00Z", "2026-01-11T12:00:00Z", (5.0, 9.0, 40.0, 9.0)
    assert extents.matching_files(spark, folder, index, start, end).count() <= 4
    assert extents.matching_files(spark, folder, index, box=box).count() <= 4
    assert extents.matching_files(spark, folder, index).count() == 40
    got = extents.read_range(spark, folder, index, scan, start, end, box)
    assert len(got.inputFiles()) <= 4
    assert rows(got) == rows(filter_bbox(filter_time_range(whole, "datetimeUtc", start, end), box)) != []
    none = extents.read_range(spark, folder, index, scan, "2030-01-01", "2030-01-02")
    assert none.columns == whole.columns and none.count() == 0

    # new files, also ones the index does not know, and rows without a time belong to every range
    whole.limit(1).withColumn("datetimeUtc", F.lit(None).cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)
    assert extents.read_range(spark, folder, index, scan, "2030-01-01", "2030-01-02").count() == 1
    assert extents.update_index(spark, folder, index, scan) == 1
    assert extents.read_range(spark, folder, index, scan, "2030-01-01", "2030-01-02").count() == 1
    assert extents.matching_files(spark, folder, index, start, end).count() <= 5


def test_extents_of_pages(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for i in range(6):
        page = json.loads(json.dumps(PAGES[0]))
        for sensor in page["sensors"]:
            for m in sensor.get("measurements") or []:
                m["period"]["datetimeFrom"]["utc"] = f"2026-0{i + 1}-05T05:00:00Z"
        (folder / f"{i}.json").write_text(json.dumps(page) + "\n")
    (folder / "empty.json").write_text("")
    index, scan = str(tmp_path / "index"), extents.page_rows(spark)
    assert extents.update_index(spark, str(folder), index, scan) == 6  # a file of no bytes is not listed
    assert extents.matching_files(spark, str(folder), index, "2026-03-01", "2026-03-31").count() == 1
    got = extents.read_range(spark, str(folder), index, scan, "2026-03-01", "2026-03-31")
    every = scan([str(folder)]).drop(extents.FILE)
    assert rows(got) == rows(filter_time_range(every, "datetimeUtc", "2026-03-01", "2026-03-31")) != []


# intervals

def covered_minutes(data):
    out = {}
    for key, a, b in data:
        if a is not None and b is not None:
            out.setdefault(key, set()).update(range(a, b))
    return out


def as_intervals(minutes):
    out, ordered = [], sorted(minutes)
    for m in ordered:
        if out and out[-1][1] == m:
            out[-1][1] = m + 1
        else:
            out.append([m, m + 1])
    return [tuple(x) for x in out]


def at(minute):
    return None if minute is None else datetime(2025, 12, 30) + timedelta(minutes=minute)


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_interval_union_and_difference(spark, bucket):
    rng = random.Random(5)

    def some(n, length):
        return [("ab"[rng.randrange(2)], x, x + rng.randint(-5, length)) for x in (rng.randrange(8000) for _ in range(n))]

    wanted, covered = some(12, 4000) + [("a", None, 5), ("b", 7, None), ("a", 0, 0)], some(60, 200)
    frame = lambda data: spark.createDataFrame([(k, at(a), at(b)) for k, a, b in data], "k string, s timestamp_ntz, e timestamp_ntz")
    minutes = covered_minutes(wanted)
    got = intervals.interval_union(frame(wanted), ["k"], "s", "e", bucket)
    assert rows(got) == sorted((k, at(a), at(b)) for k, m in minutes.items() for a, b in as_intervals(m))
    taken = covered_minutes(covered)
    everywhere = set().union(*taken.values())
    got = intervals.interval_difference(frame(wanted), frame(covered).drop("k"), ["k"], (), "s", "e", bucket)
    assert rows(got) == sorted((k, at(a), at(b)) for k, m in minutes.items() for a, b in as_intervals(m - everywhere))
    got = intervals.interval_difference(frame(wanted), frame(covered), ["k"], ["k"], "s", "e", bucket)
    assert rows(got) == sorted((k, at(a), at(b)) for k, m in minutes.items() for a, b in as_intervals(m - taken.get(k, set())))
    none = intervals.interval_difference(frame(wanted), frame(covered).limit(0), ["k"], ["k"], "s", "e", bucket)
    assert rows(none) == rows(intervals.interval_union(frame(wanted), ["k"], "s", "e", bucket))


def equal_starts():
    """Intervals of which many begin at the same minute, the longest first, last and between."""
    rng = random.Random(7)
    data = [("a", 0, 2), ("a", 10, 20), ("a", 10, 13), ("b", 0, 2), ("b", 10, 13), ("b", 10, 20), ("b", 10, 20)]
    for start in range(100, 8000, 40):
        data += [(k, start, start + rng.randint(1, 45)) for k in "ab" for _ in range(rng.randint(1, 4))]
    return data


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_interval_union_with_equal_starts(spark, bucket):
    data = equal_starts()
    want = sorted((k, at(a), at(b)) for k, m in covered_minutes(data).items() for a, b in as_intervals(m))
    for order in (data, data[::-1]):
        frame = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in order], "k string, s timestamp_ntz, e timestamp_ntz")
        for given in (frame.coalesce(1), frame.repartition(3, "e")):
            assert rows(intervals.interval_union(given, ["k"], "s", "e", bucket)) == want
    # and without a key, in dates
    days = spark.sql("select date'2026-01-01' + s as s, date'2026-01-01' + e as e from values (0, 1), (3, 9), (3, 4), (3, 4), (40, 80), (40, 41) as t (s, e)")
    day = lambda n: T0.date() + timedelta(days=n)
    assert rows(intervals.interval_union(days, (), "s", "e", bucket)) == [(day(0), day(1)), (day(3), day(9)), (day(40), day(80))]


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_interval_union_in_zones_that_set_clocks_at_midnight(spark, bucket):
    zoneless = spark.sql("""
        select to_timestamp_ntz(s) as s, to_timestamp_ntz(e) as e from values
          ('1999-03-30 00:00:00', '1999-04-02 00:00:00'), ('1999-04-01 00:00:00', '1999-04-01 01:00:00'),
          ('1999-04-01 12:00:00', '1999-04-01 13:00:00'), ('2000-04-01 00:00:00', '2000-04-01 00:30:00') as t (s, e)""")
    # seconds after 2009-11-01 02:30 UTC, which is midnight there; a minute later it is 23:01 of the day before
    instants = spark.sql("""
        select timestamp_seconds(1257042600 + s) as s, timestamp_seconds(1257042600 + e) as e
        from values (-90000, -5), (30, 1800), (900, 1200), (1200, 2700), (2700, 2710), (9000, 12600) as t (s, e)""")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Damascus")  # no midnight on 1 April 1999 and 2000
        assert rows(intervals.interval_union(zoneless, (), "s", "e", bucket)) == [
            (datetime(1999, 3, 30), datetime(1999, 4, 2)), (datetime(2000, 4, 1), datetime(2000, 4, 1, 0, 30))]
        spark.conf.set("spark.sql.session.timeZone", "America/St_Johns")
        seconds = [(F.unix_seconds(c) - 1257042600).alias(c) for c in "se"]
        got = rows(intervals.interval_union(instants, (), "s", "e", bucket), *seconds)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(got) == [(-90000, -5), (30, 2710), (9000, 12600)]


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_interval_difference_with_equal_starts(spark, bucket):
    frame = lambda data: spark.createDataFrame([(k, at(a), at(b)) for k, a, b in data], "k string, s timestamp_ntz, e timestamp_ntz").coalesce(1)
    wanted, covered = [("a", 0, 9000), ("b", 0, 9000)], equal_starts()
    taken = covered_minutes(covered)
    want = sorted((k, at(a), at(b)) for k in "ab" for a, b in as_intervals(set(range(9000)) - taken[k]))
    for order in (covered, covered[::-1]):
        assert rows(intervals.interval_difference(frame(wanted), frame(order), ["k"], ["k"], "s", "e", bucket)) == want
    # the other way round, the wanted ones begin together
    got = intervals.interval_difference(frame(covered), frame([("a", 1, 5000)]).drop("k"), ["k"], (), "s", "e", bucket)
    assert rows(got) == sorted((k, at(a), at(b)) for k in "ab" for a, b in as_intervals(taken[k] - set(range(1, 5000))))


# gaps

def test_gaps_and_spine(spark):
    hours = [0, 1, 1, 5, 6, 30, 800, 801, 1700]
    data = [(k, T0 + timedelta(hours=h), float(h)) for k in ("a", None) for h in hours] + [("b", T0, 1.0), ("a", None, 2.0)]
    df = spark.createDataFrame(data, "k string, datetime_hour timestamp_ntz, v double")
    expected = [(T0 + timedelta(hours=a + 1), T0 + timedelta(hours=b), b - a - 1)
                for a, b in ((1, 5), (6, 30), (30, 800), (801, 1700))]
    for block in (1, 3, 31):
        got = spines.series_gaps(df, ["k"], block_days=block)
        assert rows(got) == sorted([(k, *g) for k in ("a", None) for g in expected], key=lambda r: (tuple((v is None, str(v)) for v in r)))
    spine = spines.hourly_spine(df, ["k"])
    assert spine.columns == ["k", "datetime_hour", "v"] and spine.count() == 2 * 1702 + 1
    assert spine.filter("v is not null").count() == 2 * len(hours) + 1
    assert "Join" not in plan_of(spine)


# increments of means

def test_means_from_increments_equal_a_full_pass(spark, tmp_path):
    rng = random.Random(2)
    data = [(rng.choice(["x", "y", None]), rng.choice([None, 0.0, float("nan"), 1.5, 4.0]), rng.choice([None, 0, 3])) for _ in range(300)]
    df = spark.createDataFrame(data + [("lone", 0.0, None)], "k string, value_a double, value_b int")
    path = str(tmp_path / "parts")
    for i, part in enumerate(df.randomSplit([1.0, 1.0, 1.0], 3)):
        imputing.add_mean_increment(part, path, f"i{i}", ["k"])
        imputing.add_mean_increment(part, path, f"i{i}", ["k"])  # again: replaced, not added
    means = imputing.read_means(spark, path)
    near = lambda d: rows(d.withColumns({c: F.round(c, 9) for c in ("value_a", "value_b")}))
    assert near(imputing.impute(df, ["k"], means=means)) == near(imputing.impute(df, ["k"]))
    new = spark.createDataFrame([("unseen", None, None), ("x", None, None)], df.schema)
    filled = {r.k: r.value_a for r in imputing.impute(new, ["k"], means=means).collect()}
    assert filled["unseen"] == 0.0 and filled["x"] > 0


# sorted sets

def test_taking_in_rewrites_touched_ranges_only(spark, tmp_path):
    path = str(tmp_path / "set")
    rng = random.Random(9)
    schema = "at timestamp_ntz, v int"
    first = spark.createDataFrame([(T0 + timedelta(minutes=rng.randrange(100_000)), i) for i in range(3000)], schema)
    sorted_set.create(first, path, "at", 70)
    assert len(sorted_set.take_in(first, path, "at", "r1")) == 70
    low, high = T0 + timedelta(minutes=40_000), T0 + timedelta(minutes=41_000)
    more = spark.createDataFrame([(low + timedelta(minutes=i), -i) for i in range(1000)] + [(None, 7)], schema)
    # what a run that broke before its record has left is replaced
    more.withColumn("range", F.lit(3)).write.partitionBy("range").parquet(f"{path}/data/version=r2")
    touched = sorted_set.take_in(more, path, "at", "r2")
    assert len(touched) <= 4 and touched[-1] == 69
    whole = first.unionByName(more)
    assert rows(sorted_set.read_sorted(spark, path, "at")) == rows(whole)
    part = sorted_set.read_sorted(spark, path, "at", low, high)
    assert rows(part) == rows(whole.filter(F.col("at").between(low, high)))
    assert all("version=r" in f for f in part.inputFiles()) and len({f.split("range=")[1].split("/")[0] for f in part.inputFiles()}) <= 4
    with pytest.raises(ValueError, match="taken in"):
        sorted_set.take_in(more, path, "at", "r2")
    assert sorted_set.clear_superseded(spark, path) == len(touched)
    files = sorted(sorted_set.read_sorted(spark, path, "at").inputFiles(),
                   key=lambda f: (int(f.split("range=")[1].split("/")[0]), f.rsplit("/", 1)[1]))
    ordered = [r["at"] for f in files for r in spark.read.parquet(f).collect()]
    assert ordered == sorted(ordered, key=lambda t: (t is None, t or T0)) and len(ordered) == 4001
    assert sorted_set.take_in(more.limit(0), path, "at", "r3") == []


def test_sorted_set_of_one_key_and_of_text_borders(spark, tmp_path):
    same = spark.createDataFrame([(5, i) for i in range(50)] + [(None, 1)], "k bigint, v int")
    path = str(tmp_path / "one")
    sorted_set.create(same, path, "k", 8)
    sorted_set.take_in(same, path, "k", "a")
    assert rows(sorted_set.read_sorted(spark, path, "k")) == rows(same)
    assert sorted_set.read_sorted(spark, path, "k", 5, 5).count() == 50
    with pytest.raises(ValueError):
        sorted_set.choose_borders(same, "k", 0)


# lags

def test_lag_blocks_equal_lags_with_gaps_and_places(spark):
    rng = random.Random(4)
    hours = sorted(rng.sample(range(2000), 700))
    demand = spark.createDataFrame([(p, T0 + timedelta(hours=h), rng.choice([None, *range(50)])) for p in "uv" for h in hours],
                                   "place string, datetime_hour timestamp_ntz, trips int")
    air = spark.createDataFrame([(p, q, T0 + timedelta(hours=h), rng.random() * 9) for p in "uv" for q in ("no2", "o3")
                                 for h in rng.sample(range(2000), 500)],
                                "place string, parameter string, datetime_hour timestamp_ntz, value_mean double")
    near = lambda d: rows(d.filter("hours > 0").select("parameter", "lag_hours", F.round("correlation", 9), "hours"))
    expected = near(relation.lag_correlation(demand, air, 30, places=["place"]))
    for block in (30, 168, 744):
        got = relation.lag_correlation_blocks(demand, air, 30, places=["place"], block_hours=block)
        assert near(got) == expected
    with pytest.raises(Exception, match="more than one row"):
        relation.lag_correlation_blocks(demand, air.unionByName(air), 3, places=["place"]).collect()
    with pytest.raises(ValueError):
        relation.lag_correlation_blocks(demand, air, 3)


# scales

def test_lattice_sums_agree(spark):
    trips = spark.createDataFrame([(T0 + timedelta(hours=7 * i), i % 4) for i in range(200)] + [(None, 1)],
                                  "pickup_ts timestamp_ntz, PULocationID int")
    zones = spark.createDataFrame([(0, "B", "z0"), (1, "B", "z1"), (2, "C", "z0")], "LocationID int, Borough string, Zone string")
    got = demand_lattice(trips, zones).groupBy("time_unit", "place_level").agg(F.sum("trips").alias("n"), F.count("*").alias("r")).collect()
    assert len(got) == 9 and {r.n for r in got} == {201}
    assert {(r.time_unit, r.place_level): r.r for r in got}["month", "all"] == 3


# streams

def test_replayed_batches_and_late_rows_are_exact(spark, tmp_path):
    source, parts = str(tmp_path / "in"), str(tmp_path / "parts")
    schema = "datetimeUtc timestamp, location_id string, value double"
    steps = [[("2026-01-05 09:10:00", "a", 1.0)], [("2026-01-01 00:10:00", "a", 5.0), (None, "b", 2.0)], [("2026-01-05 09:50:00", "a", 4.0)]]

    def stream(progress):
        for step in steps:
            df = spark.createDataFrame(step, "t string, location_id string, value double")
            df.select(F.col("t").cast("timestamp").alias("datetimeUtc"), "location_id", "value").coalesce(1).write.mode("append").parquet(source)
            found = spark.readStream.schema(schema).parquet(source)
            write_parts(found, parts, progress, ["location_id"]).awaitTermination()

    progress = tmp_path / "progress"
    stream(str(progress))
    whole = hourly_statistics(spark.read.schema(schema).parquet(source), keys=["location_id"])
    assert rows(read_increments(spark, parts).select(whole.columns)) == rows(whole)
    # the last commit is lost, as in a crash after the write: the batch runs again
    last = sorted((progress / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    for f in (last, last.with_name(f".{last.name}.crc")):
        f.unlink(missing_ok=True)
    write_parts(spark.readStream.schema(schema).parquet(source), parts, str(progress), ["location_id"]).awaitTermination()
    assert rows(read_increments(spark, parts).select(whole.columns)) == rows(whole)
