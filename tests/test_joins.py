import pandas as pd
import pytest
from conftest import plan_of, rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from curbair.operators import joins
from curbair.sources.staging import staged


def frames(spark, fact, dim):
    return (spark.createDataFrame(fact, "k int, v int"), spark.createDataFrame(dim, "k int, name string"))


FACT = [(1, i) for i in range(50)] + [(2, 100), (3, 101), (None, 102), (9, 103)] + [(None, i) for i in range(40)]
DIM = [(1, "one"), (2, "two"), (3, "three")]


def brute(fact, dim, how):
    names = dict(dim)
    out = [(k, v, names.get(k) if k is not None else None) for k, v in fact]
    return [r for r in out if how == "left" or r[2] is not None]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False, None])
def test_lookup_join_forms_agree(spark, how, small):
    fact, dim = frames(spark, FACT, DIM)
    got = joins.lookup_join(fact, dim, ["k"], how=how, small=small)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows(got) == sorted(brute(FACT, DIM, how), key=key)


@pytest.mark.parametrize("small", [True, False])
def test_semi_and_anti_forms_agree(spark, small):
    fact, dim = frames(spark, FACT, DIM)
    listed = {k for k, _ in DIM}
    for how, wanted in (("left_semi", True), ("left_anti", False)):
        got = joins.lookup_join(fact, dim, ["k"], how=how, small=small)
        assert got.columns == ["k", "v"]
        assert got.count() == sum((k in listed) == wanted for k, _ in FACT)
    with pytest.raises(ValueError):
        joins.lookup_join(fact, dim, ["k"], how="full")


def test_null_safe_lookup_matches_null_keys(spark):
    fact, dim = frames(spark, FACT, [*DIM, (None, "none")])
    for small in (True, False):
        got = joins.lookup_join(fact, dim, ["k"], how="inner", null_safe=True, small=small)
        assert got.filter("k is null and name = 'none'").count() == 41


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), min_size=1, max_size=30))
def test_shuffled_form_is_whole(spark, fact):
    df = spark.createDataFrame(fact, "k int, v int")
    dim = spark.createDataFrame(DIM, "k int, name string")
    got = joins.lookup_join(df, dim, ["k"], small=False)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows(got) == sorted(brute(fact, DIM, "left"), key=key)


def test_hot_keys_are_few_and_complete(spark):
    counts = spark.createDataFrame([("a", 900), ("b", 60), ("c", 40)], "k string, n int")
    assert rows(joins.hot_keys(counts, ["k"], "n", share=10)) == [("a",)]
    assert rows(joins.hot_keys(counts, ["k"], "n", share=20)) == [("a",), ("b",)]


def test_large_lookup_is_not_broadcast_whole(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = frames(spark, [(i, i) for i in range(3000)] + [(1, i) for i in range(2000)],
                           [(i, str(i)) for i in range(3000)])
        got = joins.lookup_join(staged(fact), staged(dim), ["k"], small=False)
        assert "SortMergeJoin" in plan_of(got) or "ShuffledHashJoin" in plan_of(got)
        assert got.count() == 5000 and got.filter("name is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int")
    assert joins.measured_bytes(df) == 2 * 16 * 2 + 3
    assert joins.fits_broadcast(df) and not joins.fits_broadcast(df, limit=10)
    nested = df.select(F.array("i").alias("a"))
    assert joins.measured_bytes(nested) > 32


def test_known_ids(spark):
    fact, dim = frames(spark, FACT, DIM)
    wanted = dim.filter("k < 3").union(dim.filter("k < 3"))
    assert joins.known_ids(fact, wanted, "k", require_known=False).count() == 51
    asked = spark.createDataFrame([(i,) for i in range(1, 20)], "k int")
    with pytest.raises(LookupError, match="unknown k"):
        joins.known_ids(fact, asked, "k")
    known = {r.k for r in fact.select("k").collect()}
    assert {r.k for r in joins.unknown_ids(fact, asked, "k").collect()} == set(range(1, 20)) - known


def test_lookup_join_refuses_shared_columns(spark):
    fact, dim = frames(spark, FACT, DIM)
    with pytest.raises(ValueError, match="rename"):
        joins.lookup_join(fact, dim.withColumn("v", F.lit(1)), ["k"])


def test_known_ids_beyond_the_limit(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    fact, dim = frames(spark, FACT, DIM)
    got = joins.known_ids(fact, dim, "k", require_known=False)
    assert got.columns == ["k", "v"] and got.count() == 52


def test_unprocessed(spark):
    inputs = spark.createDataFrame(pd.DataFrame({"source_file": ["green_2026-01.csv", "yellow_2026-01.csv"]}))
    done = spark.createDataFrame(pd.DataFrame({"source_file": ["green_2026-01.csv"] * 2}))
    assert rows(joins.unprocessed(inputs, done)) == [("yellow_2026-01.csv",)]
