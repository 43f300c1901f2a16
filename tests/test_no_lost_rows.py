"""Cases that once lost or changed rows: stream batches, store commits, fills with null keys,
replace of a partitioned table, empty lists, lexicons with case twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtline.operators import forward_fill, lockstep_explode, minute_bucket
from courtline.operators.sentiment import score_sentiment
from courtline.session import scratch_path
from courtline.sinks import TableStore, write_mode


def test_fill_with_null_keys_equals_the_plain_window(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(u, None if i == 3 else t + dt.timedelta(minutes=i), i, float(i) if i in (0, 4) else None)
            for u in (None, 1, 2) for i in range(8)]
    df = spark.createDataFrame(rows, "u long, ts timestamp, id long, v double")
    plain, bucketed = (sorted(map(tuple, forward_fill(df, ["u"], ["ts", "id"], ["v"], bucket=b).select("u", "id", "v").collect()), key=str)
                       for b in (None, minute_bucket("ts")))
    assert plain == bucketed


def test_lockstep_explode_keeps_rows_with_empty_lists(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"]), (2, [], []), (3, None, None), (4, [1], [])], "id int, x array<int>, y array<string>")
    good, bad = lockstep_explode(df, ["x", "y"])
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 1, "a"), (1, 2, "b"), (2, None, None), (3, None, None)]
    assert [r.id for r in bad.collect()] == [4]


def test_replace_leaves_nothing_of_a_partitioned_table(spark):
    path = scratch_path(spark, "replace")
    for p in ("b", "a"):
        write_mode(spark.createDataFrame([(1, p)], "n int, p string"), path, "replace", partition_by=["p"])
    assert [r.p for r in spark.read.parquet(path).collect()] == ["a"]


def test_lexicon_with_case_twins(spark):
    df = spark.createDataFrame([(1, "a good day")], "id int, text string")
    one, two = (score_sentiment(df, "id", "text", spark.createDataFrame(rows, "token string, valence double")).collect()
                for rows in ([("good", 1.9)], [("good", 1.9), ("Good", 1.9)]))
    assert one == two


def test_store_keeps_its_bucket_count_and_refuses_two_batches(spark):
    root, ts = scratch_path(spark, "store-count"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    first = TableStore(spark, root, buckets=4)
    first.stage_upsert("t", spark.range(100).withColumn("v", F.lit(0)), ["id"], ts)
    with pytest.raises(ValueError):
        first.stage_upsert("t", spark.range(3).withColumn("v", F.lit(0)), ["id"], ts)
    first.commit("a")
    again = TableStore(spark, root, buckets=7)
    again.stage_upsert("t", spark.range(20).withColumn("v", F.lit(1)), ["id"], ts)
    again.commit("b")
    got = TableStore(spark, root).read("t")
    assert (got.count(), got.select("id").distinct().count(), got.where("v = 1").count()) == (100, 100, 20)
    again.stage_append("s", spark.range(0))
    assert not [r for r in again.pending.rows if r[1] == "s"]
