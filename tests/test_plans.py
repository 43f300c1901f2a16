"""Physical-plan properties the design relies on at scale, asserted on explain() output."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from courtline.operators import (
    changed_rows,
    exists_on,
    first_nonnull_per_group,
    forward_fill,
    keep_last_per_key,
)
from courtline.sources import table_rows


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def test_keyed_ops_aggregate_map_side(spark, sf_dir):
    ev = events(spark, sf_dir)
    for df in (keep_last_per_key(ev, ["user_id"], ["ts", "event_id"]),
               first_nonnull_per_group(ev, ["user_id"], F.struct("ts", "event_id"),
                                       ["value", "props"])):
        p = plan(df)
        assert "partial_max_by" in p                      # combined before the exchange
        assert "Window" not in p


def test_bucketed_fill_never_windows_a_whole_key(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("v", F.when(F.col("event_type") == "purchase",
                                                      F.col("value")))
    p = plan(forward_fill(ev, ["user_id"], ["ts", "event_id"], ["v"], bucket=F.to_date("ts")))
    # rows are dealt by range of key and order; the only window runs over one summary row a partition
    assert "rangepartitioning" in p
    windows = re.findall(r"Window \[(.*?)\], \[", p)
    assert windows and all("_ff_local" in w and "value" not in w for w in windows)
    assert "partial_max_by" not in p and "SortMergeJoin" not in p


def test_change_detection_reads_only_keys_and_compared_columns(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    p = plan(changed_rows(o.select("o_orderkey", "o_totalprice", "o_orderstatus"), o,
                          ["o_orderkey"], ["o_totalprice"]))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<o_orderkey:bigint,o_totalprice:double>" in schemas


def test_semi_join_reduces_the_right_side_first(spark, sf_dir):
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.to_date("l_shipdate").alias("d")).distinct()
    sched = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.to_date("o_orderdate").alias("d"))
    p = plan(exists_on(days, sched, ["d"]))
    assert "LeftSemi" in p
    assert p.count("HashAggregate(keys=[d") >= 4          # both sides deduplicated map-side


def test_extraction_runs_where_the_pages_are(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(16)
    p = plan(table_rows(pages, tables=[0]))
    assert "Python" not in p and "MapInArrow" not in p
    # no extra exchange is added when the input already has enough partitions
    assert p.count("Exchange") == 1
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_pages_are_read_once(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(16)
    optimized = table_rows(pages, tables=[0])._jdf.queryExecution().optimizedPlan().toString()
    # no filter put before an explode parses the page, or lays out its rows, a second time
    assert not [line for line in optimized.splitlines() if "Filter" in line and ("transform(" in line or "aggregate(" in line)]


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _ClusterSession:
    """A session on a cluster master with no checkpoint dir (no SparkContext view)."""

    conf = _Conf({"spark.master": "yarn"})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_cluster_without_checkpoint_dir_is_an_error():
    import pytest

    from courtline.session import checkpoint_root

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_ClusterSession())
