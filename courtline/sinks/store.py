"""A versioned table store on plain parquet: keyed upserts, snapshot appends, and an atomic
multi-table publish through one manifest write.

Layout under ``root``::

    <table>/_cl_version=<seq>/_cl_bucket=<b>/part-*.parquet   data written by commit <seq>
    _manifest/seq=<seq>/part-*.json                          one row per (table, bucket)

Keyed tables are hash-bucketed on their key (``pmod(xxhash64(keys), buckets)``).  An upsert
reads and rewrites only the buckets its batch touches; untouched buckets keep pointing at
the files of older versions (copy-on-write per bucket), so a daily batch costs what it
touches, not the size of the table.  Snapshot tables only ever add segments.

Staging writes each dataset once (the batch to a staging table, then its merged buckets to
a new version directory); a commit then writes one manifest directory.  Readers resolve the
newest manifest row per (table, bucket), so they see either all tables of a commit or none
of them, and a dataset that fails while staging never reaches the manifest.  Single writer per store (the daily run); concurrent writers are not
coordinated.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.operators.change import changed_rows, dedup_batch, merge_keyed

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("kind", T.StringType()),      # bucket | segment | reset
    T.StructField("bucket", T.IntegerType()),
    T.StructField("path", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("committed_at", T.StringType()),
])


@dataclass
class Pending:
    """Work staged for one commit: data already written, not yet published."""
    seq: int | None = None
    rows: list[tuple] = field(default_factory=list)      # manifest rows to publish
    touched: dict[str, list[int]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)  # batch rows per table


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.pending = Pending()
        self.batches: dict[str, str] = {}   # table -> files of its latest staged batch
        # single writer: what this store last published is what the manifest says, so the
        # next sequence number and each table's live files are cached until our next commit
        self._next_seq: int | None = None
        self._live_cache: dict[str, list] = {}

    # ------------------------------------------------------------------ manifest
    def _manifest(self) -> DataFrame | None:
        path = f"{self.root}/_manifest"
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).json(path)
        except AnalysisException as e:      # any other error must not pass for an empty store
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _live(self, table: str) -> list:
        """Paths of a table's live files: the newest file set of each bucket plus every
        segment since the last full replacement.  Resolved in Spark; only the result, bounded
        by the bucket count plus the live segments, reaches the driver."""
        if table in self._live_cache:
            return self._live_cache[table]
        rows = self._resolve_live(table)
        self._live_cache[table] = rows
        return rows

    def _resolve_live(self, table: str) -> list:
        m = self._manifest()
        if m is None:
            return []
        m = m.where(F.col("table") == table)
        reset = m.where(F.col("kind") == "reset").agg(F.max("seq").alias("s")).first()["s"]
        if reset is not None:
            m = m.where(F.col("seq") >= reset)
        buckets = (m.where(F.col("kind") == "bucket").groupBy("bucket")
                   .agg(F.max_by("path", "seq").alias("path"), F.lit("bucket").alias("kind")))
        segments = m.where(F.col("kind").isin("segment", "reset")).select("bucket", "path",
                                                                          "kind")
        return buckets.unionByName(segments).collect()

    def has_run(self, run_id: str) -> bool:
        """Was a commit with this run id published (idempotent replays)?"""
        m = self._manifest()
        return m is not None and m.where(F.col("run_id") == run_id).limit(1).count() > 0

    def next_seq(self) -> int:
        if self._next_seq is not None:
            return self._next_seq
        m = self._manifest()
        if m is None:
            return 0
        top = m.agg(F.max("seq").alias("s")).first()["s"]
        return 0 if top is None else int(top) + 1

    # ------------------------------------------------------------------ reads
    def read(self, table: str, schema: T.StructType | None = None,
             buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Current contents of a table (optionally only some buckets); ``None`` (or an empty
        frame of ``schema``) when it was never published."""
        live = self._live(table)
        if buckets is not None:
            want = set(buckets)
            live = [r for r in live if r.kind != "bucket" or r.bucket in want]
        paths = [r.path for r in live]
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        df = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
        return df.drop("_cl_version", "_cl_bucket")

    # ------------------------------------------------------------------ staged writes
    def _seq(self) -> int:
        if self.pending.seq is None:
            self.pending.seq = self.next_seq()
        return self.pending.seq

    def _version_path(self, table: str) -> str:
        return f"{self.root}/{table}/_cl_version={self._seq():010d}"

    def _write_counted(self, df: DataFrame, path: str, partition_by: str | None = None) -> int:
        """Write unpublished files.  ``overwrite``: the directory belongs to this commit
        only, so a staging step re-run after a failure replaces its own partial output."""
        obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        if partition_by:
            # without this every shuffle partition writes one file per bucket it holds
            # (partitions x buckets small files); AQE rebalances so each bucket gets files of
            # the advisory size, and a hot bucket is still split over several tasks
            df = df.hint("rebalance", partition_by)
        w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        return int(obs.get.get("n", 0))

    def stage_upsert(self, table: str, batch: DataFrame, keys: Sequence[str], run_ts: Column,
                     order_col: str | None = None, compare_cols: Sequence[str] | None = None,
                     null_safe_keys: bool = False) -> int:
        """Stage an upsert of ``batch`` (deduplicated on ``keys``: the last ``order_col``
        wins, or without one the largest row, so reruns are deterministic).

        The batch is computed once and written to a staging table (cutting its lineage),
        then only the buckets it touches are read, merged and rewritten.  With
        ``compare_cols`` only new or changed rows are applied (``modified_at`` is left alone
        on unchanged rows).  Returns the number of batch rows; nothing is visible to readers
        before :meth:`commit`."""
        if order_col:
            batch = dedup_batch(batch, keys, order_col)
        else:   # no order given: keep one row per key deterministically (largest row)
            cols = batch.columns
            batch = (batch.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in cols]))
                                              .alias("_b")).select("_b.*"))
        self._once(table)
        self._keep_bucket_count()
        batch = batch.withColumn("_cl_bucket", bucket_of(keys, self.buckets))
        staged = f"{self.root}/_staging/{self._seq():010d}/{table}"
        n = self._write_counted(batch, staged)
        self.pending.counts[table] = n
        self.batches[table] = staged
        if n == 0:
            return 0
        batch = self.spark.read.parquet(staged)
        touched = sorted(r[0] for r in batch.select("_cl_bucket").distinct().collect())
        target = self.read(table, buckets=touched)
        if target is not None:
            target = target.withColumn("_cl_bucket", bucket_of(keys, self.buckets))
            if compare_cols:
                batch = changed_rows(batch, target, keys, compare_cols, null_safe_keys)
        else:
            stamp = T.TimestampNTZType()
            target = (batch.limit(0)
                      .withColumn("created_at", F.lit(None).cast(stamp))
                      .withColumn("modified_at", F.lit(None).cast(stamp)))
        merged = merge_keyed(target, batch, list(keys) + ["_cl_bucket"], run_ts,
                             null_safe_keys=null_safe_keys)
        path = self._version_path(table)
        self._write_counted(merged, path, partition_by="_cl_bucket")
        seq = self._seq()
        for b in touched:
            self.pending.rows.append((seq, table, "bucket", b, f"{path}/_cl_bucket={b}"))
        self.pending.touched[table] = touched
        return n

    def _once(self, table: str) -> None:
        if table in self.pending.counts:
            raise ValueError(f"{table} is already staged in this commit; union its batches first")

    def _keep_bucket_count(self) -> None:
        """The store's bucket count is that of its first commit, whatever it is opened with."""
        m = self._manifest()
        if m is not None and (r := m.where(F.col("kind") == "buckets").agg(F.max("bucket").alias("n")).first()["n"]) is not None:
            self.buckets = int(r)
        elif not any(r[2] == "buckets" for r in self.pending.rows):
            self.pending.rows.append((self._seq(), "", "buckets", self.buckets, ""))

    def stage_append(self, table: str, df: DataFrame) -> int:
        """Stage a snapshot append (a new segment; nothing existing is rewritten)."""
        return self._stage_segment(table, df, "segment")

    def stage_replace(self, table: str, df: DataFrame) -> int:
        """Stage a full replacement (all older buckets and segments retired)."""
        return self._stage_segment(table, df, "reset")

    def _stage_segment(self, table: str, df: DataFrame, kind: str) -> int:
        self._once(table)
        path = self._version_path(table)
        n = self._write_counted(df, path)
        self.pending.counts[table] = n
        if not n and kind == "segment":
            return 0
        self.batches[table] = path
        self.pending.rows.append((self._seq(), table, kind, None, path))
        return n

    # ------------------------------------------------------------------ publish
    def commit(self, run_id: str, committed_at: dt.datetime | None = None) -> int:
        """Publish everything staged since the last commit with one manifest write (the
        data is already in place).  Returns the commit sequence number."""
        seq = self._seq()
        committed = (committed_at or dt.datetime(1970, 1, 1)).isoformat()
        rows = [(*r, run_id, committed) for r in self.pending.rows]
        if rows:
            (self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write
             .mode("errorifexists").json(f"{self.root}/_manifest/seq={seq:010d}"))
            self._next_seq = seq + 1
            for t in {r[1] for r in rows}:
                self._live_cache.pop(t, None)
        self.pending = Pending()
        return seq

    def staged_batch(self, table: str) -> DataFrame | None:
        """The rows a table received in its latest staging (the day's batch)."""
        path = self.batches.get(table)
        if path is None:
            return None
        return self.spark.read.parquet(path).drop("_cl_bucket")

    def abort(self) -> None:
        """Forget staged work (its files stay unreferenced)."""
        self.pending = Pending()
