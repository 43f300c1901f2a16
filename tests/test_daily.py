"""A whole daily run on landed fixture pages: gating, isolation, one atomic publish,
archive, rerun idempotence, and a multi-date backfill."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtline.operators.sentiment import seed_lexicon
from courtline.plans import datasets as D
from courtline.plans.daily import Landing, backfill, run_day
from courtline.plans.run import FeatureFlags, failure_digest
from courtline.session import scratch_path
from courtline.sinks import TableStore, read_archive
from courtline.sources.forum import COMMENT_SCHEMA, POST_SCHEMA
from site_pages import SITE, box_page, landed_pages, pbp_page

RUN = D.RunParams(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6, 0), 2026)
FLAGS = {"season": 1, "playoffs": 0, "stats": 1, "boxscores": 1, "opp_stats": 1,
         "injuries": 1, "player_adv_stats": 1, "transactions": 1, "adv_stats": 1,
         "shooting_stats": 1, "odds": 1, "pbp": 1, "schedule": 1, "player_contracts": 0,
         "reddit_posts": 1, "reddit_comments": 1}


@pytest.fixture(scope="module")
def landing(spark):
    pages = spark.createDataFrame(landed_pages(), "page_id long, url string, html string")
    posts = spark.createDataFrame(
        [(i, f"t{i}", i, f"id{i}", f"https://x/{i}", f"/r/nba/comments/id{i}/", 1, "")
         for i in range(1, 4)], POST_SCHEMA)
    url = "https://www.reddit.com/r/nba/comments/id1/"
    comments = spark.createDataFrame(
        [(url, "c1", None, 0, "alice", "great win", 3, None, None, "false", False),
         (url, "c2", None, 1, "bob", "bad loss", 1, None, None, "false", False)],
        COMMENT_SCHEMA)
    return Landing(pages, posts, comments, seed_lexicon(spark))


def test_run_day_publishes_and_isolates(spark, landing):
    store = TableStore(spark, scratch_path(spark, "t-daily"), buckets=4)
    archive = scratch_path(spark, "t-daily-archive")
    metrics = run_day(spark, landing, RUN, store, FeatureFlags(FLAGS), archive_root=archive)
    m = {r.dataset: r for r in metrics.collect()}
    assert m["player_contracts"].status == "disabled"
    assert m["boxscores"].rows == 5 and m["pbp"].status == "written"
    assert m["odds"].rows == 4 and m["reddit_comments"].rows == 2
    assert m["schedule"].rows == 3                  # all fixture games are after the run date
    assert store.read("bbref_player_boxscores").count() == 5
    assert store.read("bbref_player_stats_snapshot").count() == 3
    assert store.read("bbref_player_contracts") is None
    assert read_archive(spark, archive, "boxscores").count() == 5
    # rerun of the same day: upserts are idempotent, snapshots append a second segment
    run_day(spark, landing, RUN, store, FeatureFlags(FLAGS))
    assert store.read("bbref_player_boxscores").count() == 5
    assert store.read("bbref_player_pbp").count() == 10
    assert store.read("bbref_player_stats_snapshot").count() == 6
    assert failure_digest(metrics).first()["n_errors"] == 0
    assert store.read("run_metrics").count() == 2 * metrics.count()   # one set per run


def test_missing_flag_fails_only_that_dataset(spark, landing):
    flags = dict(FLAGS)
    del flags["odds"]
    store = TableStore(spark, scratch_path(spark, "t-daily-flag"), buckets=2)
    m = {r.dataset: r for r in run_day(spark, landing, RUN, store, FeatureFlags(flags),
                                       only=["odds", "injuries"]).collect()}
    assert m["odds"].status == "failed" and "not found" in m["odds"].error
    assert m["injuries"].status == "written"


def test_backfill_many_dates(spark):
    pages = []
    for i, day in enumerate([29, 30]):
        pages.append((2 * i, f"{SITE}/friv/dailyleaders.fcgi?month=01&day={day}&year=2024",
                      box_page()))
        pages.append((2 * i + 1, f"{SITE}/boxscores/pbp/202401{day}0BOS.html",
                      pbp_page("NYK", "BOS")))
    land = Landing(spark.createDataFrame(pages, "page_id long, url string, html string"))
    store = TableStore(spark, scratch_path(spark, "t-backfill"), buckets=2)
    backfill(spark, land, [dt.date(2024, 1, 29), dt.date(2024, 1, 30)], store,
             FeatureFlags(FLAGS))
    box = store.read("bbref_player_boxscores")
    assert sorted(r.d for r in box.select(F.to_date("date").alias("d")).distinct().collect()) \
        == [dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    assert store.read("bbref_player_pbp").count() == 10      # BOS game on both dates
