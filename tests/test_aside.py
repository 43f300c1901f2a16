"""Side output: every row read is loaded or set aside with a reason, counted by the write that stages both."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from courtline.operators import require_types
from courtline.operators.aside import REASON, lockstep_marked, set_aside, stage_aside
from courtline.operators.quality import QualityError
from courtline.plans import datasets as D
from courtline.plans.daily import Landing, run_day
from courtline.plans.run import FeatureFlags
from courtline.session import scratch_path
from courtline.sinks import TableStore
from site_pages import SITE, landed_pages

RUN = D.RunParams(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6, 0), 2026)


def test_lockstep_marked(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, ["a"], [1, 2]), (3, [], []), (4, None, None), (5, None, [7])],
                               "id long, x array<string>, y array<long>")
    got = sorted(((r.id, r.x, r.y, r[REASON]) for r in lockstep_marked(df, ["x", "y"]).collect()), key=str)
    bad = "lists differ in length"
    assert got == [(1, "a", 1, None), (1, "b", 2, None), (2, None, None, bad), (3, None, None, None), (4, None, None, None), (5, None, None, bad)]
    row = lockstep_marked(df, ["x", "y"]).where("id = 5").first()["row"]
    assert json.loads(row) == {"id": 5, "x": None, "y": [7]}


def test_first_reason_stays_and_null_is_not_ok(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id long, v long")
    d = set_aside(df, F.col("v") > 0, "not positive", ["id"])
    d = set_aside(d, F.col("id") < 3, "late", ["id", "v"])
    assert {r.id: r[REASON] for r in d.collect()} == {1: None, 2: "not positive", 3: "not positive"}
    assert json.loads(d.where("id = 2").first()["row"]) == {"id": 2}


@pytest.mark.parametrize("ids", [[], [1, 2], [-1], [1, -1, -2, 3]])
def test_staged_once_and_counted(spark, ids):
    df = set_aside(spark.createDataFrame([(i,) for i in ids], "id long"), F.col("id") > 0, "negative", ["id"])
    good, bad, n_good, n_bad = stage_aside(df, scratch_path(spark, "t-aside"))
    assert sorted(r.id for r in good.collect()) == sorted(i for i in ids if i > 0) and good.columns == ["id"]
    assert sorted(r.id for r in bad.collect()) == sorted(i for i in ids if i < 0)
    assert (n_good, n_bad) == (good.count(), bad.count())


def test_contract_types(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    assert require_types(df, ["name string", "id bigint"]) is df
    for contract in (["id int", "name string"], ["id bigint"], ["id bigint", "name string", "x date"]):
        with pytest.raises(QualityError):
            require_types(df, contract)


def test_run_keeps_what_it_cannot_load(spark):
    """An unreadable schedule date and a line that does not line up: the rest loads, both are counted and kept."""
    page = ("<table><thead><tr><th>Date</th><th>Start (ET)</th><th>Visitor/Neutral</th><th>Home/Neutral</th></tr></thead><tbody>"
            "<tr><th>Sat, Nov 1, 2025</th><td>7:00p</td><td>Boston Celtics</td><td>Utah Jazz</td></tr>"
            "<tr><th>Smarch 5, 2025</th><td>7:00p</td><td>Miami Heat</td><td>Chicago Bulls</td></tr></tbody></table>")
    rows = [r for r in landed_pages() if "odds" in r[1]] + [(900, f"{SITE}/leagues/NBA_2026_games-november.html", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    store = TableStore(spark, scratch_path(spark, "t-aside-run"), buckets=2)
    flags = FeatureFlags({"season": 1, "playoffs": 0, "odds": 1, "schedule": 1})
    m = {r.dataset: r for r in run_day(spark, Landing(pages), RUN, store, flags, only=["odds", "schedule"]).collect()}
    assert (m["odds"].status, m["odds"].rows, m["odds"].set_aside) == ("written", 4, 1)
    assert (m["schedule"].status, m["schedule"].rows, m["schedule"].set_aside) == ("written", 1, 1)
    kept = {r.dataset: r for r in store.read("set_aside").collect()}
    assert kept["schedule"].reason == "unreadable date" and json.loads(kept["schedule"].row)["date"] == "Smarch 5, 2025"
    assert kept["odds"].reason == "lists differ in length"
