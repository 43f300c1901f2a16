"""The 14 datasets on landed fixture pages: columns, row counts and the values each cleaning
rule decides."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtline.operators.quality import QualityError
from courtline.operators.sentiment import seed_lexicon
from courtline.plans import datasets as D
from courtline.sources.forum import COMMENT_SCHEMA, POST_SCHEMA
from site_pages import landed_pages

RUN = D.RunParams(run_date=dt.date(2024, 1, 31), run_ts=dt.datetime(2024, 1, 31, 6, 0),
                  season_year=2026)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(landed_pages(), "page_id long, url string, html string").cache()


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_player_stats(pages):
    df = D.player_stats(pages, RUN)
    assert "awards" not in df.columns and df.columns[-1] == "scrape_date"
    got = by(df, "player")
    assert set(got) == {"Nikola Jokic", "Luka Doncic", "Gary Payton II"}
    assert got["Luka Doncic"]["pts"] == 33.1 and got["Gary Payton II"]["pts"] is None


def test_boxscores_and_status(spark, pages):
    box = D.boxscores(pages, RUN)
    got = by(box, "player")
    assert len(got) == 5
    assert (got["Devin Booker"]["team"], got["Devin Booker"]["opponent"]) == ("PHX", "BKN")
    assert got["Jalen Brunson"]["location"] == "A" and got["Jayson Tatum"]["location"] == "H"
    assert got["Davis Bertans"]["pts"] is None
    assert got["Jayson Tatum"]["date"] == dt.datetime(2024, 1, 30)
    sched = spark.createDataFrame([(dt.date(2024, 1, 29),), (dt.date(2024, 1, 30),)],
                                  "proper_date date")
    st = by(D.boxscore_status(box, sched, [dt.date(2024, 1, 28), dt.date(2024, 1, 29),
                                           dt.date(2024, 1, 30)]), "game_date")
    assert st[dt.date(2024, 1, 30)]["status"] == "loaded"
    assert st[dt.date(2024, 1, 29)]["status"] == "not available yet"
    assert st[dt.date(2024, 1, 28)]["status"] == "no games"


def test_pbp(pages):
    box = D.boxscores(pages, RUN)
    p = D.pbp(pages, box, RUN)
    rows = sorted((r.hometeam, r.awayteam, r.timequarter, r.numberperiod, r.scoreaway,
                   r.scorehome, r.marginscore) for r in p.collect())
    assert {(r[0], r[1]) for r in rows} == {("BOS", "NYK"), ("PHX", "BKN")}
    bos = [r for r in rows if r[0] == "BOS"]
    assert len(bos) == 5                  # headers and score-less plays removed
    assert ("BOS", "NYK", "11:20.0", "1st Quarter", 2.0, 3.0, 1.0) in bos
    assert ("BOS", "NYK", "10:45.0", "2nd Quarter", 3.0, 3.0, 0.0) in bos
    assert all(r[4] is not None for r in rows)      # filled forward, zero before the first
    assert set(p.columns) >= {"date", "scrape_date", "numberperiod", "descriptionplayhome"}


def test_opp_and_team_adv(pages):
    opp = by(D.opp_stats(pages, RUN), "team")
    assert set(opp) == {"Boston Celtics", "Miami Heat*"}
    assert opp["Boston Celtics"]["fg_percent_opp"] == 0.447
    adv = D.team_adv_stats(pages, RUN)
    got = by(adv, "team")
    assert set(got) == {"Boston Celtics", "Utah Jazz"}
    assert got["Boston Celtics"]["index"] == 0 and got["Utah Jazz"]["index"] == 1
    assert got["Utah Jazz"]["attendance"] == 780000.0
    assert not any(c.startswith("bby") for c in adv.columns)


def test_injuries_and_player_adv(pages):
    inj = D.injuries(pages, RUN)
    assert sorted(r.player for r in inj.collect()) == ["Kelly Oubre", "Nikola Jokic"]
    adv = by(D.player_adv_stats(pages, RUN), "player")
    assert set(adv) == {"Tyrese Maxey", "Robert Williams"}
    assert adv["Tyrese Maxey"]["mp"] == 1610.0


def test_transactions(pages):
    t = D.transactions(pages, RUN).collect()
    got = sorted((r.date, r.transaction or "") for r in t)
    assert got == [(dt.datetime(2024, 10, 1), "The Jazz traded C to the Nets."),
                   (dt.datetime(2025, 10, 21), "The Celtics waived B."),
                   (dt.datetime(2025, 10, 21), "The Lakers signed A to a 10-day contract."),
                   (dt.datetime(2025, 10, 22), "")]


def test_shooting_first_nonnull_by_minutes(pages):
    s = by(D.shooting_stats(pages, RUN), "player")
    assert set(s) == {"Kevin Porter", "Jusuf Nurkic"}
    assert s["Kevin Porter"]["avg_shot_distance"] == "14.1"    # the 1500-minute row
    assert s["Jusuf Nurkic"]["heaves_makes"] == "9.0"
    assert "mp" not in s["Kevin Porter"].asDict()


def test_odds(pages):
    odds, bad = D.odds(pages, RUN)
    got = by(odds, "team")
    assert set(got) == {"BOS", "NYK", "BKN", "LAL"}
    assert (got["BOS"]["spread"], got["BOS"]["moneyline"], got["BOS"]["total"]) == \
        ("+3.5", 120, "221.5")
    assert got["BKN"]["spread"] == "-1.0" and got["BKN"]["total"] == "215.5"
    assert got["NYK"]["datetime1"] == dt.datetime(2024, 1, 31, 7, 30)
    assert bad.count() == 1


def test_schedule(pages):
    months = ["october", "november", "december"]
    all_games = D.schedule(pages, RUN, months, include_past_games=True)
    assert all_games.count() == 3
    run = D.RunParams(dt.date(2025, 10, 25), dt.datetime(2025, 10, 25, 6))
    upcoming = D.schedule(pages, run, months).collect()
    assert [(r.away_team, r.proper_date) for r in upcoming] == [
        ("Boston Celtics", dt.date(2025, 11, 1))]
    st = by(D.schedule_month_status(pages, months), "month")
    assert st["december"]["status"] == "skipped" and st["october"]["status"] == "loaded"
    assert D.schedule(pages, RUN, []).count() == 0


def test_contracts(pages):
    c = by(D.player_contracts(pages, RUN), "player")
    assert set(c) == {"Stephen Curry", "Joel Embiid", "Kevin Durant", "Nikola Jokic"}
    assert c["Stephen Curry"]["season_salary"] == 59606817     # first in page order
    assert c["Kevin Durant"]["season"] == "2025-26"
    with pytest.raises(QualityError):
        D.player_contracts(pages, D.RunParams(RUN.run_date, RUN.run_ts, season_year=2040))


def test_forum_posts_and_comments(spark):
    raw_posts = spark.createDataFrame(
        [(i, f"title {i}", 10 * i, f"id{i}", f"https://x/{i}", f"/r/nba/comments/id{i}/", 3,
          "body") for i in range(1, 31)], POST_SCHEMA)
    posts = D.reddit_posts(raw_posts, RUN)
    assert posts.count() == 27
    url = "https://www.reddit.com/r/nba/comments/id1/"
    raw_c = spark.createDataFrame([
        (url, "c1", None, 0, "alice", "what a great game", 5, None, "fan", "false", False),
        (url, "c2", "c1", 1, "alice", "what a great game", 9, None, "fan", "1700000000", False),
        (url, "c3", None, 2, "None", "deleted", 1, None, None, "false", False),
        (url, "c4", None, 3, None, "no author", 1, None, None, "false", False),
        (url, "c5", None, 4, "bob", "not good at all", 2, None, None, "false", False),
        (url, "c6", None, 5, None, None, None, None, None, None, True),
        ("https://www.reddit.com/r/nba/comments/id99/", "c7", None, 0, "carl", "bad", 1,
         None, None, "false", False)], COMMENT_SCHEMA)
    c = by(D.reddit_comments(raw_c, posts, seed_lexicon(spark), RUN), "author")
    assert set(c) == {"alice", "bob"}
    assert c["alice"]["score"] == 9 and c["alice"]["edited"] == 1
    assert c["alice"]["sentiment"] == 1 and c["bob"]["compound"] < 0
    assert len(c["alice"]["md5_pk"]) == 32


def test_header_drift_fails_the_dataset(spark):
    from site_pages import stats_page
    page = stats_page().replace("<th>Pos</th>", "<th>Position</th>", 1)
    pages = spark.createDataFrame([(1, "https://x/leagues/NBA_2026_per_game.html", page)],
                                  "page_id long, url string, html string")
    with pytest.raises(QualityError):
        D.player_stats(pages, RUN)


def test_output_schemas_follow_the_contract(spark, pages):
    from courtline.plans.warehouse import OUTPUT_SCHEMAS
    box = D.boxscores(pages, RUN)
    posts = D.reddit_posts(spark.createDataFrame([], POST_SCHEMA), RUN)
    built = {
        "stats": D.player_stats(pages, RUN), "boxscores": box,
        "opp_stats": D.opp_stats(pages, RUN), "injuries": D.injuries(pages, RUN),
        "player_adv_stats": D.player_adv_stats(pages, RUN),
        "transactions": D.transactions(pages, RUN),
        "team_adv_stats": D.team_adv_stats(pages, RUN),
        "shooting_stats": D.shooting_stats(pages, RUN), "odds": D.odds(pages, RUN)[0],
        "reddit_posts": posts,
        "reddit_comments": D.reddit_comments(spark.createDataFrame([], COMMENT_SCHEMA), posts,
                                             seed_lexicon(spark), RUN),
        "pbp": D.pbp(pages, box, RUN), "schedule": D.schedule(pages, RUN, ["october"]),
        "player_contracts": D.player_contracts(pages, RUN)}
    assert set(built) == set(OUTPUT_SCHEMAS)
    for name, df in built.items():
        assert [f"{n} {t}" for n, t in df.dtypes] == OUTPUT_SCHEMAS[name], name
