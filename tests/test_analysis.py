import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import plan_of, rows
from hypothesis import given, settings, strategies as st

from curbair.analysis import demand, relation

T0 = datetime(2026, 1, 1)


@pytest.mark.parametrize("group_rows", [5, 40, 200_000])
def test_upper_cut_equals_percent_rank(spark, group_rows):
    random.seed(5)
    values = {g: [random.choice([1, 1, 1, 2, 3, random.randint(0, 400)]) for _ in range(n)]
              for g, n in (("a", 700), ("b", 31), ("c", 1))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double")
    for share in (0.0, 0.8, 1.0):
        cuts = dict(rows(relation.upper_cut(df, "v", share, ["g"], 8, group_rows)))
        for g, vs in values.items():
            arr = np.sort(np.array(vs, dtype=float))
            less = np.searchsorted(arr, arr, side="left")
            rank = less / (len(arr) - 1) if len(arr) > 1 else np.zeros(1)
            kept = sum(1 for v in arr if cuts[g] is None or v > cuts[g])
            assert kept == int((rank >= share - 1e-12).sum()), (g, share)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.sampled_from([0.25, 0.8]))
def test_upper_cut_without_groups(spark, values, share):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    cut = relation.upper_cut(df, "v", share, pieces=4, group_rows=3).first()[0]
    k = max(math.ceil(share * (len(values) - 1)), 1)
    assert cut == (sorted(values)[k - 1])


def test_moving_average_over_block_borders(spark):
    random.seed(7)
    hours = sorted(random.sample(range(24 * 100), 1500))
    data = [("s", T0 + timedelta(hours=h), float(random.randint(0, 50))) for h in hours]
    df = spark.createDataFrame(data, "k string, datetime_hour timestamp_ntz, v double")
    known = {d[1]: d[2] for d in data}
    got = relation.moving_average(df, ["k"], "v", hours=24, block_days=2).collect()
    assert len(got) == hours[-1] - hours[0] + 1
    for r in got:
        window = [known[t] for t in (r.datetime_hour - timedelta(hours=i) for i in range(24)) if t in known]
        want = sum(window) / len(window) if window else None
        assert (r.moving_mean is None) == (want is None)
        assert want is None or abs(r.moving_mean - want) < 1e-9
    seen = relation.moving_average(df, ["k"], "v", hours=24, block_days=2, fill_gaps=False).collect()
    everywhere = {r.datetime_hour: r.moving_mean for r in got}
    assert len(seen) == len(data)
    assert all(abs(everywhere[r.datetime_hour] - r.moving_mean) < 1e-9 for r in seen)
    with pytest.raises(ValueError):
        relation.moving_average(df, ["k"], "v", hours=49, block_days=2)


def test_lag_is_in_hours_not_rows(spark):
    trips = [(T0 + timedelta(hours=h), h * h % 17) for h in range(60) if h % 7]
    air = [(T0 + timedelta(hours=h + 3), "no2", float(t)) for (_, t), h in
           zip(trips, [h for h in range(60) if h % 7])]
    d = spark.createDataFrame(trips, "datetime_hour timestamp_ntz, trips int")
    a = spark.createDataFrame(air, "datetime_hour timestamp_ntz, parameter string, value_mean double")
    got = {r.lag_hours: r for r in relation.lag_correlation(d, a, 5).collect()}
    assert got[3].correlation == pytest.approx(1.0) and got[3].hours == len(trips)
    assert all(abs(r.correlation) < 0.9 for k, r in got.items() if k != 3)
    assert "Window" not in plan_of(relation.lag_correlation(d, a, 5))


def test_demand_by_place_does_not_meet_all_readings(spark):
    trips = spark.createDataFrame([(T0, z) for z in range(3)], "pickup_ts timestamp_ntz, PULocationID int")
    air = spark.createDataFrame(
        [(T0, s, "no2", 1.0) for s in range(4)],
        "datetime_hour timestamp_ntz, PULocationID int, parameter string, value_mean double")
    places = demand.hourly_demand(trips)
    for call in (relation.demand_air, relation.demand_air_correlation):
        with pytest.raises(ValueError, match="PULocationID"):
            call(places, air)
    with pytest.raises(ValueError, match="PULocationID"):
        relation.lag_correlation(places, air, 2)
    assert relation.demand_air(places, air, ("PULocationID", "datetime_hour")).count() == 3


def test_zones_by_id_on_both_ends(spark):
    zones = spark.createDataFrame([(56, "Q", "Corona"), (57, "Q", "Corona")], "LocationID int, Borough string, Zone string")
    trips = spark.createDataFrame([(56, 57), (57, 1)], "PULocationID bigint, DOLocationID bigint")
    got = demand.attach_zones(trips, zones)
    assert rows(got, "PULocationID", "pickup_zone", "dropoff_zone") == [(56, "Corona", "Corona"), (57, "Corona", None)]


def test_demand_scales(spark):
    trips = spark.createDataFrame(
        [(T0, 1), (T0 + timedelta(minutes=59), 1), (T0 + timedelta(hours=1), 1), (T0, 2)],
        "pickup_ts timestamp_ntz, PULocationID int")
    hourly = demand.hourly_demand(trips)
    assert rows(hourly, "PULocationID", "trips") == [(1, 1), (1, 2), (2, 1)]
    assert rows(demand.demand_by_unit(hourly, "month")) == [(T0, 1, 3), (T0, 2, 1)]
    zones = spark.createDataFrame([(1, "B", "Z1"), (2, "B", "Z2")], "LocationID int, Borough string, Zone string")
    got = rows(demand.demand_rollup(trips, zones), "at_borough", "at_zone", "trips")
    assert got == [("B", "Z1", 3), ("B", "Z2", 1), ("B", None, 4), (None, None, 4)]


def test_hotspots(spark):
    cells = [(T0 + timedelta(hours=h), "no2", h, float(h % 50)) for h in range(100)]
    df = spark.createDataFrame(cells, "datetime_hour timestamp_ntz, parameter string, trips int, value_mean double")
    got = relation.hotspots(df, 0.9, 3, order=["datetime_hour"]).collect()
    assert [r.trips for r in got] == [99, 98, 97]
    assert sorted(r.trips for r in relation.hotspots(df, 0.9).collect()) == [95, 96, 97, 98, 99]
