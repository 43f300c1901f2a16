"""The 14 daily datasets as Spark plans over landed inputs.

Every builder takes the landed ``pages(page_id, url, html)`` table (all pages of the day, or
of many days for a backfill), selects its own pages by url, extracts rows with
``mapInArrow`` and does the rest with built-in expressions.  Builders return lazy
DataFrames; failures surface when the run writes them (see ``plans.run``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions import (
    accent_fold,
    clean_names,
    currency_to_long,
    date_time_to_ts,
    extract_first,
    extract_tokens_joined,
    first_token,
    html_cell_text,
    map_values,
    md5_key,
    parse_long_date,
    parse_weekday_date,
    replace_all,
    season_label,
    spread_filter,
    ts_ntz_lit,
)
from courtline.functions.text import TEAM_CODE_MAP
from courtline.operators import (
    any_present,
    contains,
    distinct_rows,
    exists_on,
    fill_zero,
    first_nonnull_per_group,
    forward_fill,
    keep_first_per_key,
    keep_last_per_key,
    label_markers,
    natural_join,
    not_equal_keep_null,
    not_in_keep_null,
    present,
    split_fixed,
    starts_with,
)
from courtline.operators.aside import REASON, ROW, kept_aside, loading, lockstep_marked, set_aside
from courtline.operators.quality import QualityError
from courtline.operators.sentiment import score_sentiment
from courtline.plans import warehouse as W
from courtline.sources import list_items, table_rows
from courtline.sources.forum import comments_of_posts, posts, reading_order

# Warehouse code -> stats-site code, for building play-by-play page keys (the
# home team is carried onto the page rows, so no mapping back is needed).
WAREHOUSE_TO_SITE = [("PHX", "PHO"), ("CHA", "CHO"), ("BKN", "BRK")]
# Fixed value: replacement for an unreadable transaction date.
BAD_DATE_PATCH = "October 1, 2024"


@dataclass(frozen=True)
class RunParams:
    run_date: dt.date                 # the day being loaded ("today" of the run)
    run_ts: dt.datetime
    season_year: int = 2026

    @property
    def game_date(self) -> dt.date:   # box scores and play-by-play load yesterday
        return self.run_date - dt.timedelta(days=1)


# ------------------------------------------------------------------ helpers
def pages_of(pages: DataFrame, dataset: str) -> DataFrame:
    return pages.where(F.col("url").rlike(W.CONTRACTS[dataset].url_pattern))


def _body(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("body_idx").isNotNull())


def cell(i: int | Column) -> Column:
    return F.get(F.col("cells"), i)


def cell_named(name: str) -> Column:
    """Cell under the header whose last level is ``name`` (null when absent)."""
    last = F.transform(F.col("header"), lambda h: F.get(h, F.size(h) - 1))
    return F.get(F.col("cells"), F.array_position(last, F.lit(name)).cast("int") - 1)


def text(c: Column) -> Column:
    """A table reader's text: trimmed, inner runs collapsed, empty -> null."""
    return html_cell_text(c)


def num(c: Column, thousands: bool = False) -> Column:
    """Strict numeric: '' is null, junk fails the dataset (ANSI cast)."""
    t = F.nullif(F.trim(c), F.lit(""))
    if thousands:
        t = F.regexp_replace(t, ",", "")
    return t.cast("double")


def fold_name(c: Column) -> Column:
    return clean_names(accent_fold(c))


def check_header(rows: DataFrame, expected: list[str], offset: int = 0,
                 lower: bool = False) -> None:
    """Fail when a page's header row does not carry the expected names in the expected
    positions (schema drift would otherwise shift every column).  One small aggregate over
    the header rows of the day's pages; only a boolean reaches the driver."""
    h = F.slice(F.col("cells"), offset + 1, len(expected))
    if lower:
        h = F.transform(h, lambda x: F.lower(F.trim(x)))
    hdr = rows.where(F.col("row_idx") == 0).select(h.alias("h"))
    ok = hdr.agg(F.bool_and(F.col("h") == F.array(*[F.lit(x) for x in expected]))
                 .alias("ok")).first()["ok"]
    if ok is False:
        raise QualityError("page header does not match the expected columns")


def _lit_date(d: dt.date) -> Column:
    return F.lit(d)


# ------------------------------------------------------------------ D-stats
def player_stats(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = table_rows(pages_of(pages, "stats"), tables=[0])
    check_header(rows, W.STATS_COLUMNS, offset=1, lower=True)
    data = rows.where(F.col("row_idx") > 0)
    cols = {n: F.get("td_cells", i) for i, n in enumerate(W.STATS_COLUMNS)}
    d = data.select(*[c.alias(n) for n, c in cols.items()])
    d = d.where(F.col("player").isNotNull())                       # rows without <td>
    d = d.withColumn("pts", num(F.col("pts")))
    d = d.withColumn("player", accent_fold("player"))
    return d.drop("awards").withColumn("scrape_date", _lit_date(run.run_date))


# ------------------------------------------------------------------ D-box (+ J3 status)
def boxscores(pages: DataFrame, run: RunParams) -> DataFrame:
    """Box scores of every daily-leaders page landed (one per game date; a backfill lands
    many).  The game date comes from the page url, else the run's game date."""
    bp = pages_of(pages, "boxscores")
    url_date = F.try_to_timestamp(F.concat_ws(
        "-", *[F.regexp_extract("url", rf"{k}=([0-9]+)", 1) for k in ("year", "month", "day")]),
        F.lit("yyyy-M-d"))
    bp = bp.withColumn("game_date", F.coalesce(url_date.cast("date"), F.lit(run.game_date)))
    rows = table_rows(bp, tables=[0], carry=["game_date"])
    check_header(rows, W.BOX_HEADER, offset=1)
    data = rows.where(F.col("row_idx") > 0)
    d = data.select("page_id", "game_date", *[F.get("td_cells", i).alias(n)
                                              for i, n in enumerate(W.BOX_COLUMNS)])
    d = d.withColumns({c: num(F.col(c)) for c in W.BOX_NUMERIC})
    d = d.withColumn("date", F.col("game_date").cast("timestamp_ntz")).drop("game_date")
    d = d.withColumn("location", F.when(F.col("location").eqNullSafe("@"), F.lit("A"))
                     .otherwise(F.lit("H")))
    d = d.withColumns({c: map_values(c, TEAM_CODE_MAP) for c in ("team", "opponent")})
    d = d.where(F.col("player").isNotNull()).withColumn("player", accent_fold("player"))
    return d.drop("page_id").withColumn("scrape_date", _lit_date(run.run_date))


def boxscore_status(box: DataFrame, schedule: DataFrame, game_dates: list[dt.date]
                    ) -> DataFrame:
    """Per requested game date, why it has or lacks box scores: ``loaded``, ``not
    available yet`` (games were scheduled) or ``no games``.  Joins on the date, no
    driver-side branching."""
    days = box.sparkSession.createDataFrame([(d,) for d in game_dates], "game_date date")
    counts = (box.select(F.col("date").cast("date").alias("game_date"))
              .groupBy("game_date").agg(F.count(F.lit(1)).alias("rows")))
    sched = schedule.select(F.col("proper_date").alias("game_date"))
    scheduled = exists_on(days, sched, ["game_date"]).withColumn("scheduled", F.lit(True))
    s = days.join(counts, "game_date", "left").join(scheduled, "game_date", "left")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    return s.select("game_date", rows.alias("rows"),
                    F.when(rows > 0, F.lit("loaded"))
                    .when(F.coalesce(F.col("scheduled"), F.lit(False)),
                          F.lit("not available yet"))
                    .otherwise(F.lit("no games")).alias("status"))


# ------------------------------------------------------------------ D-opp
def opp_stats(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = _body(table_rows(pages_of(pages, "opp_stats"), tables=[5]))
    d = rows.select(*[text(cell_named(h)).alias(c) for h, c in W.OPP_COLUMNS.items()])
    d = d.where(not_equal_keep_null("team", "League Average"))
    d = d.withColumns({c: num(F.col(c), thousands=True) for c in list(W.OPP_COLUMNS.values())[1:]})
    return d.withColumn("scrape_date", _lit_date(run.run_date))


# ------------------------------------------------------------------ D-inj
def injuries(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = _body(table_rows(pages_of(pages, "injuries"), tables=[0]))
    d = rows.select(text(cell_named("Player")).alias("player"),
                    text(cell_named("Team")).alias("team"),
                    text(cell_named("Update")).alias("date"),
                    text(cell_named("Description")).alias("description"))
    d = d.withColumn("scrape_date", _lit_date(run.run_date))
    d = d.withColumn("player", fold_name(F.col("player")))
    return distinct_rows(d)


# ------------------------------------------------------------------ D-padv
def player_adv_stats(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = _body(table_rows(pages_of(pages, "player_adv_stats"), tables=[0]))
    # header rows repeated inside the body would fail the numeric casts: drop them first
    rows = rows.where(not_equal_keep_null(text(cell(1)), "Player"))
    d = rows.select(*[(text(cell(i)) if n in W.PLAYER_ADV_TEXT else
                       num(text(cell(i)), thousands=True)).alias(n)
                      for i, n in enumerate(W.PLAYER_ADV_COLUMNS)])
    d = d.withColumn("player", fold_name(F.col("player")))
    return distinct_rows(d)


# ------------------------------------------------------------------ D-trans
def transactions(pages: DataFrame, run: RunParams) -> DataFrame:
    return loading(transactions_marked(pages, run))


def transactions_marked(pages: DataFrame, run: RunParams) -> DataFrame:
    """A day whose date cannot be read is set aside with its moves: it has no key to load under."""
    items = list_items(pages_of(pages, "transactions"), ul_class="page_index")
    d = items.where(present("date")).select("date", F.explode_outer("items").alias("transaction"))
    day = parse_long_date(F.regexp_replace("date", r"\?", BAD_DATE_PATCH))
    d = set_aside(d, day.isNotNull(), "unreadable date", ["date", "transaction"])
    d = d.withColumns({"date": day.cast("timestamp_ntz"), "scrape_date": _lit_date(run.run_date)})
    return distinct_rows(d.select("date", "transaction", "scrape_date", REASON, ROW))


# ------------------------------------------------------------------ D-tadv
def team_adv_stats(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = _body(table_rows(pages_of(pages, "team_adv_stats"), tables=[10]))
    named = rows.select("page_id", "body_idx", *[
        text(cell(i + 1)).alias(n) for i, n in enumerate(W.TEAM_ADV_COLUMNS)])
    d = named.drop("bby1", "bby2", "bby3")
    d = d.where(not_equal_keep_null("team", "League Average"))
    d = d.withColumn("team", F.regexp_replace("team", r"\*", ""))
    # ``index`` keeps each row's original position in the table body (filtered rows leave
    # gaps, they are not renumbered) - exactly the extractor's body_idx, no window needed
    d = d.withColumn("index", F.col("body_idx").cast("long"))
    numeric = [c for c in W.TEAM_ADV_COLUMNS if c not in W.TEAM_ADV_TEXT and
               not c.startswith("bby")]
    d = d.withColumns({c: num(F.col(c), thousands=True) for c in numeric})
    out = ["index", *[c for c in W.TEAM_ADV_COLUMNS if not c.startswith("bby")]]
    return d.select(*out).withColumn("scrape_date", _lit_date(run.run_date))


# ------------------------------------------------------------------ D-shoot
def shooting_stats(pages: DataFrame, run: RunParams) -> DataFrame:
    rows = _body(table_rows(pages_of(pages, "shooting_stats"), tables=[0]))
    d = rows.select("page_id", "row_idx", *[text(cell(i)).alias(n)
                                            for i, n in W.SHOOTING_POSITIONS.items()])
    d = d.where(not_equal_keep_null("player", "Player"))
    d = d.withColumn("mp", num(F.col("mp"), thousands=True))
    values = [n for n in W.SHOOTING_POSITIONS.values() if n not in ("player", "mp")]
    # per column, the first non-null value in order of minutes played (highest first,
    # unknown minutes last, page order breaking ties)
    rank = F.struct(F.col("mp").isNotNull(), F.coalesce("mp", F.lit(0.0)),
                    -F.col("page_id"), -F.col("row_idx"))
    d = first_nonnull_per_group(d, ["player"], rank, values)
    d = d.withColumn("player", fold_name(F.col("player")))
    return d.withColumns({"scrape_date": _lit_date(run.run_date),
                          "scrape_ts": ts_ntz_lit(run.run_ts)})


# ------------------------------------------------------------------ D-odds
def odds(pages: DataFrame, run: RunParams) -> tuple[DataFrame, DataFrame]:
    """Today's lines of one sportsbook.  Returns ``(odds, quarantined)``: rows whose team,
    spread and moneyline lists do not line up are set aside, the rest load."""
    marked = odds_marked(pages, run)
    return loading(marked), kept_aside(marked).select(ROW)


def odds_marked(pages: DataFrame, run: RunParams) -> DataFrame:
    """Today's lines of one sportsbook and, marked, those that cannot load."""
    rows = _body(table_rows(pages_of(pages, "odds"), tables=[0, 1, 2],
                            locate_alt=(W.SPORTSBOOK, 1)))
    book = F.get(F.col("cells"), F.col("alt_col"))
    # the sportsbook column must exist and hold data (one aggregate, a boolean to the driver)
    found = rows.agg(F.bool_or(book.isNotNull() & (F.trim(book) != "")).alias("ok")).first()
    # (a batch without such a page is an empty dataset, not a failed one)
    if not found["ok"] and not pages_of(pages, "odds").isEmpty():
        raise QualityError(f"No data in the {W.SPORTSBOOK} column")
    t = rows.select("page_id", "table_idx", "body_idx", F.get("cells", 0).alias("first"),
                    book.alias("book"))
    t0 = t.where("table_idx = 0").select("page_id", "body_idx", F.col("first").alias("datetime1"),
                                         F.col("book").alias("moneyline"))
    t1 = t.where("table_idx = 1").select("page_id", "body_idx", F.col("book").alias("spread"))
    t2 = t.where("table_idx = 2").select("page_id", "body_idx", F.col("book").alias("total"))
    o = t0.join(t1, ["page_id", "body_idx"], "left").join(t2, ["page_id", "body_idx"], "left")
    ws = r"(?U)\s+"
    # today's games (whitespace collapsing cannot change this test, so it runs first)
    o = o.where(F.col("datetime1").isNotNull() & (F.col("datetime1") != "FINAL")
                & contains("datetime1", "Today"))
    o = o.select(
        F.regexp_replace("datetime1", ws, " ").alias("datetime1"),
        F.regexp_replace("spread", ws, " ").alias("spread"),
        F.regexp_replace("moneyline", ws, " ").alias("moneyline"),
        extract_first("total", r"(?iU)o\s+([\d.]+)").alias("total"))
    o = o.withColumn("datetime1", F.regexp_replace("datetime1", r"(?U)Today,\s*", ""))
    o = o.withColumn("spread", spread_filter(F.replace(F.col("spread"), F.lit("PK"),
                                                       F.lit("-1.0"))))
    o = o.select("total", first_token("datetime1").alias("time"),
                 F.split(extract_tokens_joined("datetime1"), " ").alias("team"),
                 F.split("spread", " ").alias("spread"),
                 F.split(F.trim("moneyline"), ws).alias("moneyline"))
    d = lockstep_marked(o, ["team", "spread", "moneyline"])
    ml = F.regexp_replace(F.trim("moneyline"), r"\+", "")
    d = set_aside(d, ml.rlike(r"^-?[0-9]+$"), "moneyline is no number", o.columns)
    return d.select(
        map_values(F.trim("team"), {"BK": "BKN"}).alias("team"),
        F.trim("spread").alias("spread"), "total",
        F.when(F.col(REASON).isNull(), ml).cast("int").alias("moneyline"), _lit_date(run.run_date).alias("date"),
        date_time_to_ts(_lit_date(run.run_date), F.col("time")).alias("datetime1"), REASON, ROW)


def games_today(odds_df: DataFrame) -> DataFrame:
    """Number of games behind the odds rows (two team rows per game)."""
    return odds_df.agg(F.floor(F.count(F.lit(1)) / 2).cast("long").alias("games"))


# ------------------------------------------------------------------ D-posts / D-comm
def reddit_posts(raw_posts: DataFrame, run: RunParams) -> DataFrame:
    return posts(raw_posts, run.run_date, run.run_ts)


def reddit_comments(raw_comments: DataFrame, post_df: DataFrame, lexicon: DataFrame,
                    run: RunParams, drop_deleted: bool = True, legacy_edited: bool = False
                    ) -> DataFrame:
    """Comments of the posts, flat or from flattened trees; of equal (author, comment, url) the
    best scored stays, among those the last in reading order."""
    c = comments_of_posts(raw_comments, post_df)
    c = c.select("author", F.col("body").alias("comment"), "score", "url",
                 F.col("author_flair_css_class").alias("flair1"),
                 F.col("author_flair_text").alias("flair2"), "edited", reading_order(c).alias("place"))
    c = c.where(not_equal_keep_null("author", "None"))
    if drop_deleted:
        c = c.where(F.col("author").isNotNull())
    else:   # the source keeps real nulls and spells them "None" afterwards
        c = c.withColumn("author", F.coalesce("author", F.lit("None")))
    c = keep_last_per_key(c, ["author", "comment", "url"], ["score", "place"])
    scored = score_sentiment(c, ["author", "comment", "url"], "comment", lexicon)
    out = c.join(scored, ["author", "comment", "url"], "inner")
    edited = (F.lit(1) if legacy_edited else
              F.when(F.coalesce(F.col("edited"), F.lit("false")).isin("false", "False", "0"),
                     0).otherwise(1))
    return out.select(
        "comment", "score", "url", "author", "flair1", "flair2", edited.alias("edited"),
        _lit_date(run.run_date).cast("string").alias("scrape_date"),
        F.lit(run.run_ts.isoformat(sep=" ")).alias("scrape_ts"),
        "compound", "neg", "neu", "pos", F.col("sentiment").cast("long").alias("sentiment"),
        md5_key("author", "comment", "url").alias("md5_pk"))


# ------------------------------------------------------------------ D-pbp
def pbp(pages: DataFrame, box: DataFrame, run: RunParams) -> DataFrame:
    """Play-by-play of every game in ``box`` (any number of dates): page keys are built from
    the home teams, one equi-join to the landed pages replaces the per-game fetch loop."""
    home = (box.where(F.col("location") == "H").select("team", "date").dropDuplicates()
            .where(F.col("team").isNotNull()))
    home = home.withColumn("site_team", replace_all("team", WAREHOUSE_TO_SITE))
    keys = home.select(
        F.col("date").cast("date").alias("game_date"), F.col("team").alias("HomeTeam"),
        F.concat(F.date_format("date", "yyyyMMdd"), F.lit("0"), F.col("site_team"))
        .alias("page_key"))
    away = (box.where(F.col("location") == "A")
            .select(F.col("team").alias("AwayTeam"), F.col("opponent").alias("HomeTeam"),
                    F.col("date").cast("date").alias("game_date"))
            .dropDuplicates().na.drop())
    game_pages = pages_of(pages, "pbp").withColumn(
        "page_key", F.regexp_extract("url", r"/boxscores/pbp/([0-9]{8}0[A-Z]{3})", 1))
    game_pages = game_pages.join(keys, "page_key", "inner")
    rows = table_rows(game_pages, tables=[0], carry=["game_date", "HomeTeam"])
    rows = rows.where(F.col("body_idx").isNotNull())
    d = rows.select("page_id", "row_idx", "game_date", "HomeTeam",
                    *[text(cell(i)).alias(n) for i, n in enumerate(W.PBP_COLUMNS)])
    hs = F.col("homescore")
    markers = [(contains(hs, "Jump ball:") & contains("timequarter", "12:00.0"), "1st Quarter")]
    markers += [(contains(hs, m), label) for m, label in W.PERIOD_MARKERS]
    d = d.withColumn("numberperiod", label_markers(markers))
    d = forward_fill(d, ["page_id"], ["row_idx"], ["numberperiod"])    # one game: bounded
    d = d.where(not_in_keep_null("timequarter", W.PBP_HEADER_ROWS))
    d = natural_join(d, away)
    d = d.select("*", *split_fixed("score", "-", ["scoreaway", "scorehome"]))
    d = d.withColumns({c: F.col(c).try_cast("double") for c in ("scoreaway", "scorehome")})
    d = forward_fill(d, ["page_id"], ["row_idx"], ["scoreaway", "scorehome"])
    d = fill_zero(d, ["scoreaway", "scorehome"])
    d = d.withColumn("marginscore", F.col("scorehome") - F.col("scoreaway"))
    d = d.where(any_present("awayscore", "homescore"))
    return d.select(*W.PBP_COLUMNS, "numberperiod", F.col("HomeTeam").alias("hometeam"),
                    F.col("AwayTeam").alias("awayteam"), "scoreaway", "scorehome",
                    "marginscore", F.col("game_date").alias("date"),
                    _lit_date(run.run_date).alias("scrape_date"))


# ------------------------------------------------------------------ D-sched (+ R5 status)
def schedule(pages: DataFrame, run: RunParams, months: list[str],
             include_past_games: bool = False) -> DataFrame:
    return loading(schedule_marked(pages, run, months, include_past_games))


def schedule_marked(pages: DataFrame, run: RunParams, months: list[str],
                    include_past_games: bool = False) -> DataFrame:
    """Games of the wanted months and, marked, rows whose date cannot be read."""
    if not months:
        return _empty_schedule(pages)
    wanted = "|".join(months)
    month_pages = pages_of(pages, "schedule").where(
        F.col("url").rlike(rf"_games-({wanted})\.html"))
    rows = _body(table_rows(month_pages, tables=[0]))
    d = rows.select(*[text(cell_named(h)).alias(c) for h, c in W.SCHEDULE_COLUMNS.items()])
    d = d.where(F.col("date").isNotNull())
    d = d.withColumn("proper_date", parse_weekday_date("date"))
    d = set_aside(d, F.col("proper_date").isNotNull(), "unreadable date", list(W.SCHEDULE_COLUMNS.values()))
    if not include_past_games:
        d = d.where((F.col("proper_date") >= _lit_date(run.run_date)) | F.col("proper_date").isNull())
    return d


def schedule_month_status(pages: DataFrame, months: list[str]) -> DataFrame:
    """Per requested month: ``loaded`` or ``skipped`` (no page, or a page without rows)."""
    spark = pages.sparkSession
    req = spark.createDataFrame([(m,) for m in months], "month string")
    found = (pages_of(pages, "schedule")
             .select(F.regexp_extract("url", r"_games-([a-z]+)\.html", 1).alias("month"))
             .distinct())
    return req.join(found.withColumn("present", F.lit(True)), "month", "left").select(
        "month", F.when(F.col("present"), F.lit("loaded")).otherwise(F.lit("skipped"))
        .alias("status"))


def _empty_schedule(pages: DataFrame) -> DataFrame:
    return pages.sparkSession.createDataFrame(
        [], "date string, start_time string, away_team string, home_team string, "
            "proper_date date, aside_reason string, row string")


# ------------------------------------------------------------------ D-contr
def player_contracts(pages: DataFrame, run: RunParams) -> DataFrame:
    season = season_label(run.season_year)
    rows = _body(table_rows(pages_of(pages, "player_contracts"), tables=[0]))
    # the season column must exist on the page (schema drift fails the dataset)
    has = rows.agg(F.bool_or(F.array_contains(
        F.transform("header", lambda h: F.get(h, F.size(h) - 1)), season)).alias("ok")).first()
    if not has["ok"] and not pages_of(pages, "player_contracts").isEmpty():
        raise QualityError(f"contracts page has no salaries for {season}")
    d = rows.select("page_id", "row_idx", text(cell_named("Player")).alias("player"),
                    text(cell_named("Rk")).alias("rk"), text(cell_named(season)).alias("sal"))
    d = d.where(not_equal_keep_null("player", "Player") & not_equal_keep_null("rk", "Rk"))
    d = d.where(F.col("sal").isNotNull() & starts_with("sal", "$"))
    d = d.select("page_id", "row_idx", fold_name(F.col("player")).alias("player"),
                 F.lit(season).alias("season"), currency_to_long("sal").alias("season_salary"))
    d = keep_first_per_key(d, ["player"], ["page_id", "row_idx"])
    return d.select("player", "season", "season_salary")
