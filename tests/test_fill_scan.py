"""The prefix-scan forward fill: any bucket type, null keys, one timestamp for all rows, keys that
span partitions, values of any type; one scan of the input."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from courtline.operators import forward_fill, label_markers, minute_bucket
from courtline.operators.fill import period_from_markers

SCHEMA = "id long, k string, k2 double, ts timestamp_ntz, b double, s string, d decimal(12,2), a array<int>, t timestamp_ntz"


def brute(rows, keys, order, values):
    """{id: filled values}: rows as dicts, None sorts first."""
    rank = lambda r: tuple((r[o] is not None, r[o]) for o in order)
    last, out = {}, {}
    for r in sorted(rows, key=rank):
        g = tuple(r[k] for k in keys)
        for v in values:
            if r[v] is not None:
                last[g, v] = r[v]
        out[r["id"]] = tuple(last.get((g, v)) for v in values)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    maybe = lambda v: v if rng.random() < 0.15 else None
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice(["x"] * 6 + ["y", None, ""]), rng.choice([1.0, None]), base if i % 2 else base + dt.timedelta(minutes=rng.randint(0, 30)),
             rng.choice([1.0, 9.0, 10.0, 100.0, None]), maybe(f"s{i}"), maybe(decimal.Decimal(i) / 4), maybe([i, i + 1]), maybe(base + dt.timedelta(seconds=i)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df, [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("bucket, order", [("b", ["b", "ts", "id"]), ("ts", ["ts", "id"])])
def test_any_bucket_orders_as_itself(data, bucket, order):
    df, rows = data
    values = ["s", "d", "a", "t"]
    got = forward_fill(df, ["k", "k2"], ["ts", "id"], values, bucket=F.col(bucket), suffix="_f").collect()
    assert {r.id: tuple(r[f"{v}_f"] for v in values) for r in got} == brute(rows, ["k", "k2"], order, values)
    assert sorted(r.asDict()["id"] for r in got) == list(range(3000))


def test_decimal_bucket_and_double_carry_by_value(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 9.0, 7.0), (3, 10.0, None)], "id long, b double, v double").repartition(3)
    for b in (F.col("b"), F.col("b").cast("decimal(10,1)"), F.col("b").cast("string").cast("double")):
        assert {r.id: r.v for r in forward_fill(df.withColumn("k", F.lit(1)), ["k"], ["b", "id"], ["v"], bucket=b).collect()}[3] == 7.0


def test_one_key_with_one_timestamp_is_split(spark, monkeypatch):
    """All rows of one key and timestamp: they are dealt over the partitions, by the id that ends the order."""
    n = 4000
    df = spark.range(n).select("id", F.lit(1).alias("k"), F.lit(dt.datetime(2024, 1, 1)).alias("ts"), F.when(F.col("id") % 1500 == 700, F.col("id")).alias("v"))
    out = forward_fill(df, ["k"], ["ts", "id"], ["v"], bucket=minute_bucket("ts"))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < n / 3
    want = [None if i < 700 else (i - 700) // 1500 * 1500 + 700 for i in range(n)]
    assert [r.v for r in out.orderBy("id").collect()] == want


def test_keys_that_span_many_partitions_without_a_value(spark):
    rows = [(i, "a" if i < 10 else "b" if i < 2900 else "c", 1.0 if i in (5, 11, 2901) else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = {r.id: r.v for r in forward_fill(df, ["k"], ["id"], ["v"], bucket=F.col("id")).collect()}
    assert got[10] is None and got[4] is None and got[2900] is None
    assert all(got[i] == 1.0 for i in range(11, 2900))


def test_no_rows_and_nan_keys(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert forward_fill(none, ["k"], ["ts", "id"], ["s"], bucket=F.col("ts")).collect() == []
    nan = spark.createDataFrame([(1, float("nan"), 4.0), (2, float("nan"), None), (3, 0.0, 2.0), (4, -0.0, None)], "id long, k double, v double")
    assert {r.id: r.v for r in forward_fill(nan, ["k"], ["id"], ["v"], bucket=F.col("id")).collect()} == {1: 4.0, 2: 4.0, 3: 2.0, 4: 2.0}


def test_markers_are_carried_by_the_scan(data):
    df, rows = data
    conds = [(F.col("s").endswith("7"), "seven"), (F.col("s").endswith("3"), "three")]
    got = period_from_markers(df, ["k"], ["ts", "id"], conds, "p", bucket=minute_bucket("ts")).collect()
    plain = period_from_markers(df, ["k"], ["ts", "id"], conds, "p").collect()
    assert sorted((r.id, r.p) for r in got) == sorted((r.id, r.p) for r in plain)
    assert label_markers(conds) is not None


def test_one_scan_one_exchange_and_no_join_by_key(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    out = forward_fill(ev, ["user_id"], ["ts", "event_id"], ["v"], bucket=minute_bucket("ts"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert plan.count("rangepartitioning") == 2      # the exchange and where it is read again
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 1
