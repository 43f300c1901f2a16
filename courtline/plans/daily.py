"""One daily run (or a backfill over many dates): gate, build, stage, publish, archive.

    metrics = run_day(spark, landing, run, store, flags)

* every dataset is gated by its feature flag and isolated: a failure becomes a ``failed``
  metrics row and the others go on;
* each dataset is staged once into the :class:`TableStore` (keyed upsert, change-only
  upsert or snapshot append per its contract), then all of them are published with one
  manifest write;
* published datasets are archived as date-partitioned parquet;
* rows that cannot load (odds whose lists do not line up, unreadable dates) go to the table
  ``set_aside`` with their dataset and a reason, out of the same write that stages the others;
* a dataset whose columns or types are not those of its contract fails before it is staged;
* the returned metrics table (dataset, status, rows, seconds, error, set_aside) is the run's record;
  ``failure_digest`` turns it into the alert text.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions import schedule_months, ts_ntz_lit
from courtline.operators import require_types, union_all_by_name
from courtline.operators.aside import REASON, ROW, stage_aside
from courtline.plans import datasets as D
from courtline.plans.run import METRICS_SCHEMA, FeatureFlags
from courtline.plans.warehouse import CONTRACTS, OUTPUT_SCHEMAS
from courtline.session import scratch_path
from courtline.sinks import TableStore, write_archive

log = logging.getLogger(__name__)


@dataclass
class Landing:
    """Inputs landed for the run."""
    pages: DataFrame                       # (page_id, url, html)
    posts: DataFrame | None = None         # forum posts (sources.forum.POST_SCHEMA)
    comments: DataFrame | None = None      # flat comments (sources.forum.COMMENT_SCHEMA)
    lexicon: DataFrame | None = None       # (token, valence); comments need it
    related: DataFrame | None = None       # pages that joins may need beyond ``pages``


def _builders(spark: SparkSession, landing: Landing, run: D.RunParams, flags: FeatureFlags):
    """dataset -> zero-argument builder of its DataFrame (lazy; dependencies shared)."""
    pages = landing.pages
    months = schedule_months(flags.get("season") or 0, flags.get("playoffs") or 0)
    box = D.boxscores(pages, run)
    every = landing.related if landing.related is not None else pages
    posts = (D.reddit_posts(landing.posts, run) if landing.posts is not None else None)

    def comments():
        if landing.lexicon is None:
            raise ValueError("comments are scored with a lexicon: land one")
        return D.reddit_comments(landing.comments, posts, landing.lexicon, run)

    b = {
        "stats": lambda: D.player_stats(pages, run),
        "boxscores": lambda: box,
        "opp_stats": lambda: D.opp_stats(pages, run),
        "injuries": lambda: D.injuries(pages, run),
        "player_adv_stats": lambda: D.player_adv_stats(pages, run),
        "transactions": lambda: D.transactions_marked(pages, run),
        "team_adv_stats": lambda: D.team_adv_stats(pages, run),
        "shooting_stats": lambda: D.shooting_stats(pages, run),
        "odds": lambda: D.odds_marked(pages, run),
        "pbp": lambda: D.pbp(every, D.boxscores(every, run), run),
        "schedule": lambda: D.schedule_marked(pages, run, months),
        "player_contracts": lambda: D.player_contracts(pages, run),
    }
    if posts is not None:
        b["reddit_posts"] = lambda: posts
        if landing.comments is not None:
            b["reddit_comments"] = comments
    return b


def run_day(spark: SparkSession, landing: Landing, run: D.RunParams, store: TableStore,
            flags: FeatureFlags, archive_root: str | None = None,
            only: list[str] | None = None, run_id: str | None = None,
            all_or_nothing: bool = False) -> DataFrame:
    """``all_or_nothing``: a failed dataset publishes nothing and raises, so the caller's input is
    not taken as done (a stream's micro-batch)."""
    builders = _builders(spark, landing, run, flags)
    ts = ts_ntz_lit(run.run_ts)
    metrics, staged, asides = [], [], []
    for name, build in builders.items():
        if only and name not in only:
            continue
        c = CONTRACTS[name]
        t0 = time.time()
        try:
            if not flags.enabled(c.flag):
                metrics.append((name, c.flag, run.run_date, "disabled", 0, 0.0, None, 0))
                continue
            df, aside = build(), 0
            if REASON in df.columns:
                df, bad, _, aside = stage_aside(df, scratch_path(spark, f"aside-{name}"))
                if aside:
                    asides.append(bad.select(F.lit(name).alias("dataset"), F.lit(run.run_date).alias("run_date"),
                                             F.col(REASON).alias("reason"), ROW))
            require_types(df, OUTPUT_SCHEMAS[name])
            if c.mode == "upsert":
                n = store.stage_upsert(c.table, df, list(c.keys), ts,
                                       compare_cols=list(c.compare_cols) or None,
                                       null_safe_keys=c.null_safe_keys,
                                       order_col=None)
            else:
                n = store.stage_append(c.table, df.withColumn("run_date", F.lit(run.run_date)))
            staged.append(name)
            metrics.append((name, c.flag, run.run_date, "written" if n else "empty", n,
                            round(time.time() - t0, 2), None, aside))
        except Exception as e:  # isolate; the dataset is simply not published
            log.error("dataset %s failed: %s", name, e)
            metrics.append((name, c.flag, run.run_date, "failed", 0,
                            round(time.time() - t0, 2), f"{type(e).__name__}: {e}", 0))
    if all_or_nothing and (failed := [f"{m[0]}: {m[6]}" for m in metrics if m[3] == "failed"]):
        store.abort()
        raise RuntimeError("; ".join(failed))
    metrics_df = spark.createDataFrame(metrics, METRICS_SCHEMA)
    store.stage_append("run_metrics", metrics_df)          # published with the datasets
    if asides:
        store.stage_append("set_aside", union_all_by_name(asides))
    store.commit(run_id or f"run-{run.run_date.isoformat()}", run.run_ts)
    if archive_root:   # the day's batch of each published dataset, not the whole table
        for name in staged:
            batch = store.staged_batch(CONTRACTS[name].table)
            if batch is not None and (done := write_archive(batch, archive_root, name, run.run_date)).status == "failed":
                metrics.append((f"{name} (archive)", CONTRACTS[name].flag, run.run_date, "failed", 0, 0.0, done.error, 0))
        metrics_df = spark.createDataFrame(metrics, METRICS_SCHEMA)
    return metrics_df


def backfill(spark: SparkSession, landing: Landing, dates: list[dt.date], store: TableStore,
             flags: FeatureFlags, run_ts: dt.datetime | None = None) -> DataFrame:
    """Box scores and play-by-play for many game dates in one job: the landing holds the
    pages of every date, each page carries its own date, one commit publishes all."""
    run = D.RunParams(run_date=max(dates) + dt.timedelta(days=1),
                      run_ts=run_ts or dt.datetime.combine(max(dates), dt.time(23, 59)))
    return run_day(spark, landing, run, store, flags, only=["boxscores", "pbp"])
