"""Run orchestration: feature-flag gate, failure isolation, run metrics, backfill dates.

Spark is lazy, so a dataset that "fails" usually fails when it is written, not when it is
planned.  ``run_datasets`` therefore isolates both steps: planning errors and write errors
turn into a ``failed`` status row and the other datasets go on.  Row counts are observed
during the write itself (no extra pass).
"""

from __future__ import annotations

import datetime as dt
import logging
import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# The flags the warehouse is seeded with (flag, is_enabled).
DEFAULT_FLAGS = [
    ("season", 1), ("playoffs", 1), ("pbp", 1), ("twitter", 1), ("reddit_posts", 1),
    ("reddit_comments", 1), ("boxscores", 1), ("injuries", 1), ("transactions", 1),
    ("stats", 1), ("adv_stats", 1), ("opp_stats", 1), ("odds", 1), ("schedule", 1),
    ("shooting_stats", 1), ("fake", 0), ("player_adv_stats", 1), ("player_contracts", 1),
]

FLAG_SCHEMA = T.StructType([T.StructField("flag", T.StringType()),
                            T.StructField("is_enabled", T.IntegerType())])

METRICS_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("status", T.StringType()),    # written | empty | disabled | failed
    T.StructField("rows", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("set_aside", T.LongType()),   # rows read that could not load
])


def flags_table(spark: SparkSession, rows: Sequence[tuple[str, int]] = DEFAULT_FLAGS
                ) -> DataFrame:
    return spark.createDataFrame(list(rows), FLAG_SCHEMA)


class FeatureFlags:
    """Flags loaded once per run (a small config table, collected to the driver)."""

    def __init__(self, flags: dict[str, int]):
        self.flags = dict(flags)

    @classmethod
    def load(cls, flags_df: DataFrame) -> FeatureFlags:
        return cls({r["flag"]: r["is_enabled"] for r in flags_df.collect()})

    def get(self, flag: str) -> int | None:
        return self.flags.get(flag)

    def enabled(self, flag: str) -> bool:
        """1 -> run, 0 -> skip; a flag that does not exist is an error."""
        v = self.get(flag)
        if v is None:
            raise ValueError(f"{flag!r} not found in the flag table ({len(self.flags)} flags)")
        return bool(v)


def gate(df: DataFrame, flags: FeatureFlags, flag: str) -> DataFrame:
    """The dataset itself, or a typed empty frame when its flag is off."""
    return df if flags.enabled(flag) else df.limit(0)


def gate_relational(datasets: DataFrame, flags_df: DataFrame) -> DataFrame:
    """Relational form of the gate over a ``(dataset, flag, ...)`` table: rows whose flag is
    off are marked disabled; an unknown flag shows up as ``missing``."""
    j = datasets.join(flags_df, "flag", "left")
    return j.withColumn("gate", F.when(F.col("is_enabled").isNull(), F.lit("missing"))
                        .when(F.col("is_enabled") == 1, F.lit("enabled"))
                        .otherwise(F.lit("disabled")))


@dataclass
class DatasetSpec:
    name: str
    flag: str
    build: Callable[[], DataFrame]


def run_datasets(spark: SparkSession, specs: Sequence[DatasetSpec], flags: FeatureFlags,
                 run_date: dt.date, write: Callable[[str, DataFrame], None] | None = None
                 ) -> DataFrame:
    """Gate, build and write each dataset in isolation; return the run-metrics table.

    ``write(name, df)`` defaults to executing the plan without storing it."""
    write = write or (lambda name, df: df.write.format("noop").mode("overwrite").save())
    rows = []
    for s in specs:
        t0 = time.time()
        try:
            if not flags.enabled(s.flag):
                rows.append((s.name, s.flag, run_date, "disabled", 0, 0.0, None, 0))
                continue
            obs = Observation(f"rows_{s.name}")
            df = s.build().observe(obs, F.count(F.lit(1)).alias("rows"))
            write(s.name, df)
            n = int(obs.get.get("rows", 0))
            rows.append((s.name, s.flag, run_date, "written" if n else "empty", n,
                         round(time.time() - t0, 2), None, 0))
        except Exception as e:  # isolate the failure, go on with the others
            log.error("dataset %s failed: %s", s.name, e)
            rows.append((s.name, s.flag, run_date, "failed", 0, round(time.time() - t0, 2),
                         f"{type(e).__name__}: {e}", 0))
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def failure_digest(metrics: DataFrame) -> DataFrame:
    """Failed datasets of a run as ``dataset: error`` lines plus their count (small: one
    row per dataset of the run)."""
    failed = metrics.where(F.col("status") == "failed")
    return failed.agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.concat_ws("\n", F.sort_array(F.collect_list(
            F.concat(F.col("dataset"), F.lit(": "), F.col("error"))))).alias("digest"))


def alert_text(metrics: DataFrame, run_date: dt.date) -> str | None:
    """The alert message for a run: ``None`` when nothing failed, else the failure count
    and one ``dataset: error`` line per failure.  Built from the one-row digest, so only
    that row reaches the driver; sending it is left to the caller."""
    row = failure_digest(metrics).first()
    if not row or not row["n_errors"]:
        return None
    head = f"{row['n_errors']} errors during ingestion on {run_date.isoformat()}:"
    return f"{head}\n{row['digest']}"


_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def backfill_dates(dates: Sequence[str]) -> list[dt.date]:
    """Validate ``YYYY-MM-DD`` run dates for a backfill (all of them run in one job)."""
    out = []
    for d in dates:
        if not _DATE_RE.match(d):
            raise ValueError(f"invalid date {d!r}, expected YYYY-MM-DD")
        out.append(dt.date.fromisoformat(d))
    return out
