"""CSV / JSON / table scans with declared schemas; schedule check on a date (J3)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from courtline.operators import exists_on
from courtline.session import scratch_path
from courtline.sinks import TableStore
from courtline.sources import read_csv, read_json, read_table

SCHED_SCHEMA = ("start_time string, away_team string, home_team string, date string, "
                "proper_date date")
API_SCHEMA = ("game_date date, day_name string, start_time string, avg_team_rank int, "
              "home_team string, home_moneyline_raw int, away_team string, "
              "away_moneyline_raw int")


def test_csv_duplicate_keys_upsert_once(spark, fixtures_dir):
    df = read_csv(spark, os.path.join(fixtures_dir, "schedule_upsert.csv"), SCHED_SCHEMA)
    assert df.count() == 4
    store = TableStore(spark, scratch_path(spark, "t-sched"), buckets=2)
    store.stage_upsert("schedule", df, ["away_team", "home_team", "proper_date"],
                       F.lit(dt.datetime(2025, 10, 20)).cast("timestamp_ntz"))
    store.commit("r1")
    assert store.read("schedule").count() == 3        # same game twice -> one row


def test_json_schedule_lookup(spark, fixtures_dir):
    games = read_json(spark, os.path.join(fixtures_dir, "schedule_api.json"), API_SCHEMA,
                      multiline=True)
    assert games.where(F.col("home_moneyline_raw").isNull()).count() == 1
    days = spark.createDataFrame([(dt.date(2025, 10, 21),), (dt.date(2025, 10, 22),)],
                                 "game_date date")
    with_games = exists_on(days, games, ["game_date"]).collect()
    assert [r.game_date for r in with_games] == [dt.date(2025, 10, 21)]


def test_projected_table_scan(spark, sf_dir):
    df = read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"])
    assert df.columns == ["o_orderkey", "o_totalprice"]
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.where("o_totalprice > 1000").explain()
    plan = buf.getvalue()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
