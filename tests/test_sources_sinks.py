"""Scans (HTML tables/lists, logs) and sinks (mode writes, archive, keyed store)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from courtline.session import scratch_path
from courtline.sinks import TableStore, read_archive, write_archive, write_mode
from courtline.sources import list_items, read_log_lines, table_rows
from html_reference import parse_lists, parse_tables

BOOK_PAGE = """<html><body>
<table><tr><th>Game</th></tr><tr><td>Today, 7:30 BOS NYK</td></tr></table>
<table><thead><tr><th>Game</th><th><img alt="FanDuel">FD</th><th><img alt="DraftKings">DK</th>
</tr></thead><tbody><tr><td>x</td><td>-110</td><td>+100</td></tr>
<tr><td>y</td><td>-105</td><td></td></tr></tbody></table></body></html>"""


def test_table_parser_structure():
    rows = parse_tables("""<script>var s="<table><td>";</script>
      <table><tr><th colspan="2">A</th><th rowspan="2">B</th></tr>
      <tr><td>1<td>2</tr><tr><td>x &amp; y</td><td>z</td><td>w</td></tr></table>""")
    cells = {(t, r): [c[1] for c in cs] for t, r, _s, cs in rows}
    assert cells[(0, 0)] == ["A", "A", "B"]
    assert cells[(0, 1)] == ["1", "2", "B"]          # rowspan carried down, unclosed td
    assert cells[(0, 2)] == ["x & y", "z", "w"]


def test_sportsbook_column_lookup(spark):
    pages = spark.createDataFrame([(1, BOOK_PAGE)], "page_id long, html string")
    rows = table_rows(pages, tables=[1], locate_alt=("DraftKings", 1))
    body = rows.where(F.col("section") == "tbody").orderBy("row_idx")
    got = [r["v"] for r in body.select(F.get("cells", F.col("alt_col")).alias("v")).collect()]
    assert got == ["+100", ""]
    missing = table_rows(pages, tables=[1], locate_alt=("Caesars", 1))
    assert {r["alt_col"] for r in missing.collect()} == {None}


def test_list_scan():
    html = """<ul class="page_index"><li><span>October 1, 2024</span><p>Trade A</p>
      <p>Trade B</li><li><span>?</span><p>Waived C</p></li><li></li></ul>
      <ul><li>not in the index</li></ul>"""
    got = parse_lists(html, "page_index")
    assert [(d, items) for _u, _i, d, items, _t, _h in got] == [
        ("October 1, 2024", ["Trade A", "Trade B"]), ("?", ["Waived C"]), (None, [])]


def test_list_scan_on_driver_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    items = list_items(pages)
    assert items.count() > 0
    assert items.where(F.col("text").isNull()).count() == 0


def test_log_failures(spark, fixtures_dir):
    lines = read_log_lines(spark, os.path.join(fixtures_dir, "run.log"))
    failed = lines.where(F.col("errors").contains("Failed"))
    assert failed.count() == 3


def test_write_modes(spark):
    path = scratch_path(spark, "t-modes")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert write_mode(df.limit(0), path, "append").status == "empty"
    assert write_mode(df, path, "fail").rows == 2
    assert write_mode(df, path, "fail").status == "failed"
    assert write_mode(df, path, "append").status == "written"
    assert spark.read.parquet(path).count() == 4
    assert write_mode(df, path, "replace").rows == 2
    assert spark.read.parquet(path).count() == 2


def test_archive_partitions_stay_strings(spark):
    root = scratch_path(spark, "t-archive")
    df = spark.createDataFrame([(1,), (2,)], "id long")
    write_archive(df, root, "box", dt.date(2024, 1, 5))
    write_archive(df.limit(1), root, "box", dt.date(2024, 1, 6))
    write_archive(df, root, "box", dt.date(2024, 1, 6))      # rerun replaces only that day
    back = read_archive(spark, root, "box")
    types = {f.name: f.dataType.simpleString() for f in back.schema.fields}
    assert types["month"] == "string" and types["year"] == "string"
    assert sorted((r["month"], r["run_date"]) for r in back.select("month", "run_date")
                  .distinct().collect()) == [("01", "2024-01-05"), ("01", "2024-01-06")]
    assert back.count() == 4


def test_store_upsert_and_atomic_publish(spark):
    store = TableStore(spark, scratch_path(spark, "t-store"), buckets=4)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    a = spark.createDataFrame([("curry", "2025-26", 59), ("embiid", "2025-26", 55)],
                              "player string, season string, salary long")
    store.stage_upsert("contracts", a, ["player", "season"], ts(t1))
    store.stage_append("stats_snapshot", spark.createDataFrame([(1,)], "n long"))
    store.commit("r1")
    b = spark.createDataFrame([("curry", "2025-26", 60), ("embiid", "2025-26", 55),
                               ("durant", "2025-26", 54)], "player string, season string, "
                                                           "salary long")
    n = store.stage_upsert("contracts", b, ["player", "season"], ts(t2),
                           compare_cols=["salary"])
    assert n == 3
    # staged (data written) but not committed: readers still see the first commit
    assert store.read("contracts").count() == 2
    store.stage_append("stats_snapshot", spark.createDataFrame([(2,)], "n long"))
    store.commit("r2")
    got = {r["player"]: (r["salary"], r["created_at"], r["modified_at"])
           for r in store.read("contracts").collect()}
    assert got == {"curry": (60, t1, t2), "embiid": (55, t1, t1), "durant": (54, t2, t2)}
    assert store.read("stats_snapshot").count() == 2


def test_store_failed_stage_is_never_published(spark):
    store = TableStore(spark, scratch_path(spark, "t-abort"), buckets=2)
    ok = spark.createDataFrame([(1, "a")], "k long, v string")
    store.stage_upsert("t", ok, ["k"], F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    store.commit("r1")
    bad = spark.range(3).select(F.col("id").alias("k"),
                                F.assert_true(F.col("id") < 0).cast("string").alias("v"))
    with pytest.raises(Exception):
        store.stage_upsert("t", bad, ["k"], F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz"))
    store.abort()
    assert store.read("t").count() == 1


def test_store_reads_only_touched_buckets(spark):
    store = TableStore(spark, scratch_path(spark, "t-buckets"), buckets=8)
    base = spark.range(200).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    store.stage_upsert("t", base, ["k"], F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    store.commit("r1")
    one = spark.createDataFrame([(7, "w")], "k long, v string")
    store.stage_upsert("t", one, ["k"], F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz"))
    assert len(store.pending.touched["t"]) == 1
    store.commit("r2")
    t = store.read("t")
    assert t.count() == 200 and t.where("k = 7").first()["v"] == "w"


@pytest.mark.parametrize("bad", ["2024-1-5", "20240105", "yesterday"])
def test_backfill_dates_validate(bad):
    from courtline.plans.run import backfill_dates
    with pytest.raises(ValueError):
        backfill_dates([bad])


def test_store_replace_retires_older_files(spark):
    root = scratch_path(spark, "t-replace")
    store = TableStore(spark, root, buckets=2)
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "n long")
    store.stage_append("snap", rows(1, 2))
    store.commit("r1")
    store.stage_append("snap", rows(3))
    store.commit("r2")
    store.stage_replace("snap", rows(10))
    store.commit("r3")
    store.stage_append("snap", rows(11))
    store.commit("r4")
    for s in (store, TableStore(spark, root, buckets=2)):   # cached and resolved from disk
        assert sorted(r.n for r in s.read("snap").collect()) == [10, 11]
    # a keyed table replaced after upserts: older buckets are retired too
    ts = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    store.stage_upsert("k", spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"),
                       ["k"], ts)
    store.commit("r5")
    store.stage_replace("k", spark.createDataFrame([(3, "c")], "k long, v string"))
    store.commit("r6")
    fresh = TableStore(spark, root, buckets=2)
    assert [(r.k, r.v) for r in fresh.read("k").collect()] == [(3, "c")]
