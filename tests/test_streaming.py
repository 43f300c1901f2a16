"""The file-source stream runs each micro-batch through the staged daily run, once."""

import datetime as dt

from courtline.plans.run import FeatureFlags
from courtline.session import scratch_path
from courtline.sinks import TableStore
from courtline.streaming.ingest import PAGE_LANDING_SCHEMA, fixed_run, start_page_ingest
from site_pages import SITE, box_page, injuries_page

FLAGS = FeatureFlags({"boxscores": 1, "injuries": 1, "pbp": 1, "stats": 0, "opp_stats": 0,
                      "player_adv_stats": 0, "transactions": 0, "adv_stats": 0,
                      "shooting_stats": 0, "odds": 0, "schedule": 0, "player_contracts": 0,
                      "season": 0, "playoffs": 0})


def test_stream_ingest_available_now(spark):
    landing = scratch_path(spark, "t-landing")
    store_root = scratch_path(spark, "t-stream-store")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    run = fixed_run(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6))
    spark.createDataFrame([(1, f"{SITE}/friv/dailyleaders.fcgi?month=01&day=30&year=2024",
                            box_page())], PAGE_LANDING_SCHEMA).write.parquet(f"{landing}/a")
    q = start_page_ingest(spark, f"{landing}/*", store_root, ckpt, FLAGS, run)
    q.awaitTermination(300)
    store = TableStore(spark, store_root)
    assert store.read("bbref_player_boxscores").count() == 5
    # a second landing file: only the new page is processed by the next run
    spark.createDataFrame([(2, f"{SITE}/friv/injuries.fcgi", injuries_page())],
                          PAGE_LANDING_SCHEMA).write.parquet(f"{landing}/b")
    q = start_page_ingest(spark, f"{landing}/*", store_root, ckpt, FLAGS, run)
    q.awaitTermination(300)
    assert store.read("bbref_player_injuries").count() == 2
    assert store.read("bbref_player_boxscores").count() == 5
