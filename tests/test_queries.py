"""Registered queries against their SQL, on the smallest given tables."""

import glob
import math
import os
import re

import duckdb
import pytest
from conftest import DATA, plan_of

import __spark_entry__ as contract
from curbair.queries import ORACLE, QUERIES
from curbair.sources.staging import shared_folder

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows):
    return sorted((tuple(normal(v) for v in r) for r in rows),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


def shared(spark):
    return re.sub("^file:/+", "/", shared_folder(spark))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = ordered(df.select(columns).collect())
    names = ", ".join(f'"{c}"' for c in columns)
    result = duck.execute(f"select {names} from ({ORACLE[name]}) oracle")
    assert got == ordered(result.fetchall())


# the smallest tables hold no two of their ranges that begin at the same hour
@pytest.mark.parametrize("name", ["uncovered_hours", "covered_hours"])
def test_query_equals_sql_on_larger_tables(spark, name):
    folder = DATA.replace("sf0.001", "sf0.01")
    df = QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{folder}/orders.parquet'")
    want = con.execute(f"select {', '.join(df.columns)} from ({ORACLE[name]}) oracle").fetchall()
    assert ordered(df.collect()) == ordered(want)


def test_organised_stations_come_with_every_fact(spark, tmp_path):
    # 120 groups of a day, station and parameter: by bytes AQE would give them all to one task
    tables, before = str(tmp_path), set(os.listdir(shared(spark)))
    spark.range(120).selectExpr(
        "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(int(id % 2)) as ts", "id as user_id", "'view' as event_type",
        "double(id) as value").write.parquet(f"{tables}/events.parquet")
    spark.range(100).selectExpr(
        "id as c_custkey", "concat('n', id) as c_name", "'m' as c_mktsegment", "double(id) as c_acctbal",
        "int(id % 7) as c_nationkey").write.parquet(f"{tables}/customer.parquet")
    found = QUERIES["organised_stations"](spark, tables)
    assert ordered(found.collect()) == ordered((f"day_2024010{1 + i % 2}", str(i), f"n{i}") for i in range(100))
    (made,) = (n for n in set(os.listdir(shared(spark))) - before if n.startswith("organised-"))
    parts = glob.glob(f"{shared(spark)}/{made}/air_data_run/facts/source_file_p=*/parameter_p=view/location_id_p=*/part-*")
    assert len(parts) == 100 and len({os.path.basename(p).split("-")[1] for p in parts}) > 1


def test_landed_pages_take_little_disk(spark, tmp_path):
    before = set(os.listdir(shared(spark)))
    spark.range(3000).selectExpr(
        "id as l_suppkey", "int(id % 7) as l_linenumber", "double(id % 50) as l_quantity", "id * 1.5D as l_extendedprice",
        "(id % 11) / 100D as l_discount", "(id % 9) / 100D as l_tax", "'R' as l_returnflag", "'O' as l_linestatus",
        "timestamp_ntz'1995-01-01 00:00:00' as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["landed_pages"](spark, str(tmp_path))
    values = [(str(i), v) for i in range(3000) for v in (i % 50, i * 1.5, i % 11 / 100, i % 9 / 100) if v]
    assert ordered(found.select("location_id", "value").collect()) == ordered(values)
    (made,) = (n for n in set(os.listdir(shared(spark))) - before if n.startswith("pages-"))
    pages = glob.glob(f"{shared(spark)}/{made}/part-*")
    assert sum(os.path.getsize(p) for p in pages) < 100 * 3000  # a page is about 1000 bytes


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "datetime_hour" and df.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "incremental_clean", "organised_layout", "csv_roundtrip", "convert_parquet", "hourly_incremental",
    "hourly_closed"}))
def test_plans_have_no_python_and_no_cartesian(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan
