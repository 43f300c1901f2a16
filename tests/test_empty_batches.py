"""A batch without a page of an enabled dataset is empty; a page without the gated column still fails."""

import datetime as dt

import pytest

from courtline.operators.quality import QualityError
from courtline.plans import datasets as D
from courtline.streaming.ingest import PAGE_LANDING_SCHEMA
from site_pages import SITE, injuries_page, landed_pages

RUN = D.RunParams(run_date=dt.date(2024, 1, 31), run_ts=dt.datetime(2024, 1, 31, 6, 0), season_year=2024)


def test_no_page_is_empty_and_a_bad_page_fails(spark):
    other = spark.createDataFrame([(1, f"{SITE}/friv/injuries.fcgi", injuries_page())], PAGE_LANDING_SCHEMA)
    assert D.odds(other, RUN)[0].isEmpty() and D.player_contracts(other, RUN).isEmpty()
    urls = {i: u for i, u, _p in landed_pages()}
    bare = spark.createDataFrame([(i, u, "<html><table><tr><td>x</td></tr></table></html>") for i, u in urls.items()], PAGE_LANDING_SCHEMA)
    for build in (D.odds, D.player_contracts):
        with pytest.raises(QualityError):
            build(bare, RUN)
