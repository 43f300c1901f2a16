"""Mode writes (fail/replace/append) and the date-partitioned parquet archive."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


@dataclass
class WriteResult:
    target: str
    status: str          # written | empty | failed
    rows: int = 0
    error: str | None = None


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_mode(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
               partition_by: list[str] | None = None, overwrite: str = "static") -> WriteResult:
    """Write with ``fail``/``replace``/``append`` semantics.  ``replace`` leaves nothing of the old
    table, or with ``overwrite="dynamic"`` only the partitions that are not written.  An empty frame is a no-op;
    a failure is logged and reported in the result instead of raised.  The row count is
    observed during the write (no second pass)."""
    try:
        if df.isEmpty():
            log.info("%s is empty, not writing", path)
            return WriteResult(path, "empty")
        counted, obs = _counted(df, "write_rows")
        w = counted.write.mode(MODES.get(mode, mode)).format(fmt).option("partitionOverwriteMode", overwrite)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
        rows = int(obs.get.get("rows", 0))
        log.info("wrote %d rows to %s", rows, path)
        return WriteResult(path, "written", rows)
    except Exception as e:  # isolate: the run goes on, the failure is reported
        log.error("write to %s failed: %s", path, e)
        return WriteResult(path, "failed", error=str(e))


def archive_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/validated"


def write_archive(df: DataFrame, root: str, name: str, run_date: dt.date) -> WriteResult:
    """Archive one dataset for one run date under
    ``{root}/{name}/validated/year=YYYY/month=MM/run_date=YYYY-MM-DD/``.

    A same-day rerun replaces only that day's partition (dynamic partition overwrite); an
    empty frame is a no-op; errors are reported, not raised."""
    d = F.lit(run_date)
    staged = df.withColumns({
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MM"),
        "run_date": F.date_format(d, "yyyy-MM-dd"),
    })
    return write_mode(staged, archive_path(root, name), "replace",
                      partition_by=["year", "month", "run_date"], overwrite="dynamic")


def read_archive(spark, root: str, name: str) -> DataFrame:
    """Read an archive back; ``year``/``month``/``run_date`` stay strings (``month=01``)."""
    prev = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled", None)
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        return spark.read.parquet(archive_path(root, name))
    finally:
        if prev is not None:
            spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", prev)
