"""Registered queries for the scalar, filter, dedup and row-expansion operators.

The driver tables hold no sports data, so the string shapes the pipelines clean (odds
lines, team codes, dates as text, salaries) are rendered from the whole tables inside the
query and cleaned back; every row of the input goes through the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions import (
    accent_fold,
    clean_names,
    currency_to_long,
    date_time_to_ts,
    extract_first,
    extract_tokens_joined,
    first_token,
    map_values,
    md5_key,
    parse_long_date,
    parse_weekday_date,
    replace_all,
    schedule_months,
    season_type,
    spread_filter,
    zero_pad,
)
from courtline.functions.text import TEAM_CODE_MAP
from courtline.operators import (
    any_present,
    contains,
    distinct_rows,
    explode_keep_empty,
    keep_first_per_key,
    lockstep_explode,
    not_equal_keep_null,
    present,
    starts_with,
    union_all_by_name,
)
from courtline.plans.catalog import RUN_DATE, table

# The 30 team codes of the stats site, alphabetical.
SITE_TEAM_CODES = ["ATL", "BOS", "BRK", "CHI", "CHO", "CLE", "DAL", "DEN", "DET", "GSW",
                   "HOU", "IND", "LAC", "LAL", "MEM", "MIA", "MIL", "MIN", "NOP", "NYK",
                   "OKC", "ORL", "PHI", "PHO", "POR", "SAC", "SAS", "TOR", "UTA", "WAS"]
# Warehouse code -> stats-site code (the reverse of TEAM_CODE_MAP), applied as
# substring replacements when building page keys.
SITE_CODE_PAIRS = [("PHX", "PHO"), ("CHA", "CHO"), ("BKN", "BRK")]
# Fixed value: landing prefix of forum post links.
FORUM_BASE = "https://www.reddit.com"
# Fixed value: replacement for an unreadable transaction date.
BAD_DATE_PATCH = "October 1, 2024"
MONTH_NUMBER = {"january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
                "july": 7, "august": 8, "september": 9, "october": 10, "november": 11,
                "december": 12}

_CODES_SQL = "[" + ", ".join(f"'{c}'" for c in SITE_TEAM_CODES) + "]"


def _code(idx: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in SITE_TEAM_CODES]), idx)


# ---------------------------------------------------------------- S1 accent fold
def ascii_fold(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    return docs.select("doc_id", accent_fold("text").alias("folded"))


# ---------------------------------------------------------------- S2 name cleaning
# Suffixes attached to rendered names, so every cleaning rule is exercised.
_RENDER_SUFFIXES = [" Jr.", " III", " II", " IV", " Sr.", ""]


def name_clean(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    suffix = F.get(F.array(*[F.lit(s) for s in _RENDER_SUFFIXES]),
                   (F.col("c_custkey") % len(_RENDER_SUFFIXES)).cast("int"))
    raw = F.concat(F.col("c_name"), suffix)
    return cust.select("c_custkey", raw.alias("raw_name"),
                       clean_names(accent_fold(raw)).alias("player"))


# ---------------------------------------------------------------- A3 distinct rows
def distinct_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(table(spark, sf, "documents").select("text", "lang"))


# ---------------------------------------------------------------- A4 keep first by key
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return keep_first_per_key(docs, ["text"], ["doc_id"])


# ---------------------------------------------------------------- S12 md5 key
def md5_key_q(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", md5_key("role", "text", "conv_id").alias("md5_pk"))


# ---------------------------------------------------------------- S11 S5 spread filter
def _odds_raw(li: DataFrame) -> DataFrame:
    """Odds-table strings rendered from lineitem rows: a game line, spreads, moneylines
    and totals as they appear on a sportsbook page."""
    q = F.col("l_quantity").cast("long")
    n = F.col("l_linenumber").cast("long")
    away = _code((F.col("l_orderkey") % 30).cast("int"))
    home = _code(((F.col("l_orderkey") + n) % 30).cast("int"))
    time = F.concat((n + 5).cast("string"), F.lit(":"),
                    F.lpad(((F.col("l_partkey") % 4) * 15).cast("string"), 2, "0"))
    game = F.concat(time, F.lit(" "), away, F.lit(" "), home)
    datetime1 = (F.when(F.col("l_linestatus") == "O", F.concat(F.lit("Today, "), game))
                 .when(F.col("l_returnflag") == "A", F.lit("FINAL"))
                 .otherwise(F.concat(F.lit("Tomorrow, "), game)))
    spread = (F.when((F.col("l_returnflag") == "R") & (n == 1), F.lit("PK -110 PK -110"))
              .otherwise(F.concat(F.lit("+"), (n * 2).cast("string"), F.lit(".5 -"),
                                  (100 + q).cast("string"), F.lit(" -"),
                                  (n * 2).cast("string"), F.lit(".5 "), q.cast("string"))))
    moneyline = F.concat(F.lit("+"), (100 + n * 10).cast("string"), F.lit(" -"),
                         (100 + q * 3).cast("string"))
    total = F.concat(F.when(F.col("l_returnflag") == "N", F.lit("u ")).otherwise(F.lit("O ")),
                     (200 + n).cast("string"), F.lit(".5 -110"))
    return li.select("l_orderkey", "l_linenumber", datetime1.alias("datetime1"),
                     spread.alias("spread_raw"), moneyline.alias("moneyline_raw"),
                     total.alias("total_raw"))


_ODDS_RAW_SQL = f"""
  li AS (
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_partkey,
           CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS BIGINT) AS n
    FROM lineitem),
  raw AS (
    SELECT l_orderkey, l_linenumber,
      CASE WHEN l_linestatus = 'O' THEN 'Today, ' || g
           WHEN l_returnflag = 'A' THEN 'FINAL'
           ELSE 'Tomorrow, ' || g END AS datetime1,
      CASE WHEN l_returnflag = 'R' AND n = 1 THEN 'PK -110 PK -110'
           ELSE '+' || CAST(n * 2 AS VARCHAR) || '.5 -' || CAST(100 + q AS VARCHAR) || ' -'
                || CAST(n * 2 AS VARCHAR) || '.5 ' || CAST(q AS VARCHAR) END AS spread_raw,
      '+' || CAST(100 + n * 10 AS VARCHAR) || ' -' || CAST(100 + q * 3 AS VARCHAR)
        AS moneyline_raw,
      CASE WHEN l_returnflag = 'N' THEN 'u ' ELSE 'O ' END || CAST(200 + n AS VARCHAR)
        || '.5 -110' AS total_raw
    FROM (SELECT *,
            CAST(n + 5 AS VARCHAR) || ':' || lpad(CAST((l_partkey % 4) * 15 AS VARCHAR), 2, '0')
            || ' ' || {_CODES_SQL}[(l_orderkey % 30) + 1] || ' '
            || {_CODES_SQL}[((l_orderkey + n) % 30) + 1] AS g
          FROM li))"""

_SPREAD_SQL = """array_to_string(list_filter(string_split_regex(trim({c}), '\\s+'), lambda t:
      (substr(t, 1, 1) IN ('+', '-') AND coalesce(TRY_CAST(substr(t, 2) AS DOUBLE) <= 25, false))
      OR (regexp_full_match(t, '[0-9]+')
          AND coalesce(TRY_CAST(t AS DECIMAL(38,0)) <= 25, false))), ' ')"""


def spread_filter_q(spark: SparkSession, sf: str) -> DataFrame:
    raw = _odds_raw(table(spark, sf, "lineitem", spread=True))
    pk = F.replace(F.col("spread_raw"), F.lit("PK"), F.lit("-1.0"))
    return raw.select("l_orderkey", "l_linenumber", "spread_raw",
                      spread_filter(pk).alias("spread"))


# ---------------------------------------------------------------- S8 A7 S9 token extract
def token_extract(spark: SparkSession, sf: str) -> DataFrame:
    raw = _odds_raw(table(spark, sf, "lineitem", spread=True))
    return raw.select(
        "l_orderkey", "l_linenumber",
        extract_tokens_joined("datetime1").alias("team"),
        first_token(F.regexp_replace("datetime1", r"(?U)Today,\s*", "")).alias("time"),
        extract_first("total_raw", r"(?iU)o\s+([\d.]+)").alias("total"))


# ---------------------------------------------------------------- D-odds composition
def odds_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Today's odds lines: filter today's games, clean spreads, split the game line into
    teams and time, explode teams/spreads/moneylines in lock step (rows whose lists differ
    in length are quarantined), type the moneyline and build the tip-off timestamp."""
    raw = _odds_raw(table(spark, sf, "lineitem", spread=True))
    ws = r"(?U)\s+"
    # today's games only; collapsing whitespace cannot create or remove "Today" nor make
    # a value equal "FINAL", so the filter runs first, on the raw text, and the regexes
    # below run once per kept row
    raw = raw.where(F.col("datetime1").isNotNull() & (F.col("datetime1") != "FINAL")
                    & contains("datetime1", "Today"))
    o = raw.select(
        "l_orderkey", "l_linenumber",
        F.regexp_replace("datetime1", ws, " ").alias("datetime1"),
        F.regexp_replace("spread_raw", ws, " ").alias("spread"),
        F.regexp_replace("moneyline_raw", ws, " ").alias("moneyline"),
        extract_first("total_raw", r"(?iU)o\s+([\d.]+)").alias("total"))
    o = o.withColumn("datetime1", F.regexp_replace("datetime1", r"(?U)Today,\s*", ""))
    o = o.withColumn("spread", spread_filter(F.replace(F.col("spread"), F.lit("PK"),
                                                       F.lit("-1.0"))))
    o = o.select(
        "l_orderkey", "l_linenumber", "total",
        first_token("datetime1").alias("time"),
        F.split(extract_tokens_joined("datetime1"), " ").alias("team"),
        F.split(F.col("spread"), " ").alias("spread"),
        F.split(F.col("moneyline"), " ").alias("moneyline"))
    good, _quarantined = lockstep_explode(o, ["team", "spread", "moneyline"])
    return good.select(
        "l_orderkey", "l_linenumber",
        map_values(F.trim("team"), {"BK": "BKN"}).alias("team"),
        F.trim("spread").alias("spread"), "total",
        F.regexp_replace(F.trim("moneyline"), r"\+", "").cast("int").alias("moneyline"),
        F.lit(RUN_DATE).alias("date"),
        date_time_to_ts(F.lit(RUN_DATE), F.col("time")).alias("datetime1"))


# ---------------------------------------------------------------- S15 F6 currency
def currency_cast(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    cents = F.floor(F.col("l_extendedprice") * 100)
    raw = F.concat(F.when(F.col("l_returnflag") != "N", F.lit("$")).otherwise(F.lit("")),
                   F.format_number(cents, 0))
    d = li.select("l_orderkey", "l_linenumber", raw.alias("salary_raw"))
    d = d.where(starts_with("salary_raw", "$"))
    return d.withColumn("season_salary", currency_to_long("salary_raw"))


# ---------------------------------------------------------------- S16 S17 S18 S19 S13 dates
def date_parse(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", spread=True)
    long_raw = F.when(F.col("o_orderstatus") == "P", F.lit("?")).otherwise(
        F.date_format("o_orderdate", "MMMM d, yyyy"))
    wk_raw = F.date_format("o_orderdate", "EEE, MMM d, yyyy")
    t_raw = F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":"),
                     F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"))
    d = o.select("o_orderkey", long_raw.alias("date_raw"), wk_raw.alias("weekday_raw"),
                 t_raw.alias("time_raw"))
    d = d.withColumn("proper_date",
                     parse_long_date(F.regexp_replace("date_raw", r"\?", BAD_DATE_PATCH)))
    d = d.withColumn("weekday_date", parse_weekday_date("weekday_raw"))
    return d.select(
        "o_orderkey", "date_raw", "proper_date", "weekday_date",
        date_time_to_ts("weekday_date", "time_raw").alias("game_ts"),
        F.concat(F.year("weekday_date").cast("string"), F.lit("-"),
                 zero_pad(F.month("weekday_date"))).alias("year_month"),
        F.date_sub("weekday_date", 1).alias("day_before"),
        F.date_format("weekday_date", "yyyyMMdd").alias("ymd"))


# ---------------------------------------------------------------- S20 season type
def season_type_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    game_date = F.date_add(F.lit("2025-01-01").cast("date"), F.dayofyear("o_orderdate") - 1)
    return o.select("o_orderkey", game_date.alias("game_date"),
                    season_type(game_date).alias("season_type"))


# ---------------------------------------------------------------- S3 S4 C2 team codes
def team_code_map(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    team_raw = _code((F.col("c_custkey") % 30).cast("int"))
    opp_raw = _code(((F.col("c_custkey") + F.col("c_nationkey") + 1) % 30).cast("int"))
    loc_raw = (F.when(F.col("c_acctbal") < 0, F.lit("@"))
               .when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
               .otherwise(F.lit("")))
    d = c.select("c_custkey", map_values(team_raw, TEAM_CODE_MAP).alias("team"),
                 map_values(opp_raw, TEAM_CODE_MAP).alias("opponent"),
                 F.when(loc_raw.eqNullSafe("@"), F.lit("A")).otherwise(F.lit("H"))
                 .alias("location"))
    return d.withColumn("site_team", replace_all("team", SITE_CODE_PAIRS))


# ---------------------------------------------------------------- C2 two-branch selects
def home_away(spark: SparkSession, sf: str) -> DataFrame:
    """Two-branch selects with their null rules: ``@`` means away and anything else -
    including a missing marker - home; a positive score sets a flag; an edit marker other
    than false sets ``edited``."""
    ev = table(spark, sf, "events")
    marker = (F.when(F.col("event_type") == "click", F.lit("@"))
              .when(F.col("event_type") == "view", F.lit(None).cast("string"))
              .otherwise(F.lit("vs")))
    edited_raw = F.when(F.col("event_type") == "error", F.lit("false")).otherwise(
        F.col("ts").cast("string"))
    return ev.select(
        "event_id",
        F.when(marker.eqNullSafe("@"), F.lit("A")).otherwise(F.lit("H")).alias("location"),
        F.when(F.col("value") - 50 > 0, 1).otherwise(0).alias("positive"),
        F.when(edited_raw == "false", 0).otherwise(1).alias("edited"))


# ---------------------------------------------------------------- F1-F12 null and header rows
def nulls_and_headers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    body = c.select(
        F.col("c_custkey").alias("row_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("player"),
        F.col("c_mktsegment").alias("team"),
        F.when(F.col("c_nationkey") == 0, F.lit("None"))
        .when(F.col("c_nationkey") != 1, F.col("c_name")).alias("author"))
    headers = n.select((-1 - F.col("n_nationkey")).cast("long").alias("row_id"),
                       F.lit("Player").alias("player"), F.lit("Tm").alias("team"),
                       F.lit("Player").alias("author"))
    league = n.select((-100 - F.col("n_nationkey")).cast("long").alias("row_id"),
                      F.lit(None).cast("string").alias("player"),
                      F.lit("League Average").alias("team"),
                      F.lit(None).cast("string").alias("author"))
    rows = union_all_by_name([body, headers, league])
    rows = rows.where(not_equal_keep_null("player", "Player")
                      & not_equal_keep_null("team", "League Average"))
    return rows.select(
        "row_id", "player", "team", "author",
        F.col("player").isNotNull().alias("f1_not_null"),
        present("player").alias("f4_present"),
        starts_with("player", "Customer#0000001").alias("f6_prefix"),
        any_present("player", "author").alias("f8_either"),
        not_equal_keep_null("author", "None").alias("f10_not_deleted"),
        contains("team", "BUILD").alias("f12_contains"))


# ---------------------------------------------------------------- U1 S21 R5 month union
def month_union(spark: SparkSession, sf: str) -> DataFrame:
    months = schedule_months(1, 0)
    o = table(spark, sf, "orders")
    # one scan with an IN filter instead of one scan per month page
    d = o.where(F.month("o_orderdate").isin([MONTH_NUMBER[m] for m in months]))
    return d.select("o_orderkey",
                    F.lower(F.date_format("o_orderdate", "MMMM")).alias("month_name"),
                    F.to_date("o_orderdate").alias("proper_date"))


# ---------------------------------------------------------------- U2 explode keeping empties
def explode_outer_q(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("line"))
    return explode_keep_empty(docs, "line", pos_col="line_no")


# ---------------------------------------------------------------- U3 lock-step explode
def lockstep_explode_q(spark: SparkSession, sf: str) -> DataFrame:
    raw = _odds_raw(table(spark, sf, "lineitem", spread=True))
    d = raw.select("l_orderkey", "l_linenumber",
                   F.split(extract_tokens_joined("datetime1"), " ").alias("team"),
                   F.split(spread_filter(F.replace(F.col("spread_raw"), F.lit("PK"),
                                                   F.lit("-1.0"))), " ").alias("spread"),
                   F.split("moneyline_raw", " ").alias("moneyline"))
    good, _bad = lockstep_explode(d, ["team", "spread", "moneyline"])
    return good


# ---------------------------------------------------------------- T3 S14 top posts
def top_posts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    top = docs.orderBy(F.col("n_chars").desc(), F.col("doc_id")).limit(27)
    return top.withColumn("reddit_url", F.concat(F.lit(FORUM_BASE + "/r/"), F.col("source"),
                                                 F.lit("/comments/"),
                                                 F.col("doc_id").cast("string")))


QUERIES = {
    "ascii_fold": ascii_fold,
    "name_clean": name_clean,
    "distinct_rows": distinct_rows_q,
    "dedup_keep_first": dedup_keep_first,
    "md5_key": md5_key_q,
    "spread_filter": spread_filter_q,
    "token_extract": token_extract,
    "odds_lines": odds_lines,
    "currency_cast": currency_cast,
    "date_parse": date_parse,
    "season_type": season_type_q,
    "team_code_map": team_code_map,
    "home_away": home_away,
    "nulls_and_headers": nulls_and_headers,
    "month_union": month_union,
    "explode_outer": explode_outer_q,
    "lockstep_explode": lockstep_explode_q,
    "top_posts": top_posts,
}

_SUFFIX_SQL = "[" + ", ".join(f"'{s}'" for s in _RENDER_SUFFIXES) + "]"
_TEAMS_SQL = ("array_to_string(regexp_extract_all(datetime1, '\\b([A-Z]{2,3})\\b', 1), ' ')")

ORACLE = {
    "ascii_fold": """
SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS folded
FROM documents
""",
    "name_clean": f"""
WITH r AS (SELECT c_custkey, c_name || {_SUFFIX_SQL}[(c_custkey % 6) + 1] AS raw_name FROM customer)
SELECT c_custkey, raw_name,
  replace(replace(replace(replace(replace(
    regexp_replace(strip_accents(raw_name), '[^\\x00-\\x7F]', '', 'g'),
    ' Jr.', ''), ' Sr.', ''), ' III', ''), ' II', ''), ' IV', '') AS player
FROM r
""",
    "distinct_rows": "SELECT DISTINCT text, lang FROM documents",
    "dedup_keep_first": """
SELECT doc_id, text, lang, source FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""",
    "md5_key": """
SELECT conv_id, turn,
  md5(coalesce(role, 'None') || coalesce(text, 'None') || coalesce(CAST(conv_id AS VARCHAR), 'None'))
    AS md5_pk
FROM conversations
""",
    "spread_filter": "WITH" + _ODDS_RAW_SQL + f"""
SELECT l_orderkey, l_linenumber, spread_raw,
  {_SPREAD_SQL.format(c="replace(spread_raw, 'PK', '-1.0')")} AS spread
FROM raw
""",
    "token_extract": "WITH" + _ODDS_RAW_SQL + f"""
SELECT l_orderkey, l_linenumber, {_TEAMS_SQL} AS team,
  string_split_regex(trim(regexp_replace(datetime1, 'Today,\\s*', '', 'g')), '\\s+')[1] AS time,
  nullif(regexp_extract(total_raw, 'o\\s+([\\d.]+)', 1, 'i'), '') AS total
FROM raw
""",
    "odds_lines": "WITH" + _ODDS_RAW_SQL + f""",
  o AS (
    SELECT l_orderkey, l_linenumber,
      regexp_replace(regexp_replace(datetime1, '\\s+', ' ', 'g'), 'Today,\\s*', '', 'g') AS dt1,
      {_SPREAD_SQL.format(c="replace(regexp_replace(spread_raw, '\\s+', ' ', 'g'), 'PK', '-1.0')")}
        AS spread,
      regexp_replace(moneyline_raw, '\\s+', ' ', 'g') AS moneyline,
      nullif(regexp_extract(total_raw, 'o\\s+([\\d.]+)', 1, 'i'), '') AS total
    FROM raw
    WHERE datetime1 IS NOT NULL AND datetime1 <> 'FINAL' AND datetime1 LIKE '%Today%'),
  l AS (
    SELECT l_orderkey, l_linenumber, total,
      string_split_regex(trim(dt1), '\\s+')[1] AS time,
      string_split(array_to_string(regexp_extract_all(dt1, '\\b([A-Z]{{2,3}})\\b', 1), ' '), ' ')
        AS team,
      string_split(spread, ' ') AS spread,
      string_split(moneyline, ' ') AS moneyline
    FROM o),
  z AS (
    SELECT l_orderkey, l_linenumber, total, time,
      unnest(team) AS team, unnest(spread) AS spread, unnest(moneyline) AS moneyline
    FROM l WHERE len(team) = len(spread) AND len(spread) = len(moneyline))
SELECT l_orderkey, l_linenumber,
  CASE trim(team) WHEN 'BK' THEN 'BKN' ELSE trim(team) END AS team,
  trim(spread) AS spread, total,
  CAST(replace(trim(moneyline), '+', '') AS INTEGER) AS moneyline,
  DATE '2024-01-31' AS date,
  try_strptime('2024-01-31 ' || time, '%Y-%m-%d %H:%M') AS datetime1
FROM z
""",
    "currency_cast": """
WITH d AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag <> 'N' THEN '$' ELSE '' END
      || format('{:,}', CAST(floor(l_extendedprice * 100) AS BIGINT)) AS salary_raw
  FROM lineitem)
SELECT l_orderkey, l_linenumber, salary_raw,
  CAST(regexp_replace(salary_raw, '[$,]', '', 'g') AS BIGINT) AS season_salary
FROM d WHERE starts_with(salary_raw, '$')
""",
    "date_parse": """
WITH d AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN '?' ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_raw,
    strftime(o_orderdate, '%a, %b %-d, %Y') AS weekday_raw,
    CAST(o_orderkey % 24 AS VARCHAR) || ':' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0')
      AS time_raw
  FROM orders),
p AS (
  SELECT *,
    CAST(try_strptime(regexp_replace(date_raw, '\\?', 'October 1, 2024', 'g'), '%B %d, %Y') AS DATE)
      AS proper_date,
    CAST(try_strptime(regexp_replace(weekday_raw, '^\\s*[A-Za-z]+,\\s*', ''), '%b %d, %Y') AS DATE)
      AS weekday_date
  FROM d)
SELECT o_orderkey, date_raw, proper_date, weekday_date,
  try_strptime(strftime(weekday_date, '%Y-%m-%d') || ' ' || time_raw, '%Y-%m-%d %H:%M') AS game_ts,
  CAST(year(weekday_date) AS VARCHAR) || '-' || lpad(CAST(month(weekday_date) AS VARCHAR), 2, '0')
    AS year_month,
  weekday_date - 1 AS day_before,
  strftime(weekday_date, '%Y%m%d') AS ymd
FROM p
""",
    "season_type": """
WITH d AS (SELECT o_orderkey, DATE '2025-01-01' + CAST(dayofyear(o_orderdate) - 1 AS INTEGER)
                    AS game_date FROM orders)
SELECT o_orderkey, game_date,
  CASE WHEN game_date < DATE '2025-04-15' THEN 'Regular Season'
       WHEN game_date >= DATE '2025-04-16' AND game_date < DATE '2025-04-21' THEN 'Play-In'
       ELSE 'Playoffs' END AS season_type
FROM d
""",
    "team_code_map": f"""
WITH r AS (
  SELECT c_custkey,
    {_CODES_SQL}[(c_custkey % 30) + 1] AS team_raw,
    {_CODES_SQL}[((c_custkey + c_nationkey + 1) % 30) + 1] AS opp_raw,
    CASE WHEN c_acctbal < 0 THEN '@' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE '' END AS loc_raw
  FROM customer),
m AS (
  SELECT c_custkey,
    CASE team_raw WHEN 'PHO' THEN 'PHX' WHEN 'CHO' THEN 'CHA' WHEN 'BRK' THEN 'BKN'
         ELSE team_raw END AS team,
    CASE opp_raw WHEN 'PHO' THEN 'PHX' WHEN 'CHO' THEN 'CHA' WHEN 'BRK' THEN 'BKN'
         ELSE opp_raw END AS opponent,
    CASE WHEN loc_raw IS NOT DISTINCT FROM '@' THEN 'A' ELSE 'H' END AS location
  FROM r)
SELECT *, replace(replace(replace(team, 'PHX', 'PHO'), 'CHA', 'CHO'), 'BKN', 'BRK') AS site_team
FROM m
""",
    "home_away": """
SELECT event_id,
  CASE WHEN (CASE WHEN event_type = 'click' THEN '@' WHEN event_type = 'view' THEN NULL
                  ELSE 'vs' END) IS NOT DISTINCT FROM '@' THEN 'A' ELSE 'H' END AS location,
  CASE WHEN value - 50 > 0 THEN 1 ELSE 0 END AS positive,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS edited
FROM events
""",
    "nulls_and_headers": """
WITH rows AS (
  SELECT c_custkey AS row_id, CASE WHEN c_acctbal >= 0 THEN c_name END AS player,
         c_mktsegment AS team,
         CASE WHEN c_nationkey = 0 THEN 'None' WHEN c_nationkey <> 1 THEN c_name END AS author
  FROM customer
  UNION ALL
  SELECT CAST(-1 - n_nationkey AS BIGINT), 'Player', 'Tm', 'Player' FROM nation
  UNION ALL
  SELECT CAST(-100 - n_nationkey AS BIGINT), NULL, 'League Average', NULL FROM nation)
SELECT row_id, player, team, author,
  player IS NOT NULL AS f1_not_null,
  coalesce(player IS NOT NULL AND player <> '', false) AS f4_present,
  coalesce(starts_with(player, 'Customer#0000001'), false) AS f6_prefix,
  (player IS NOT NULL OR author IS NOT NULL) AS f8_either,
  author IS DISTINCT FROM 'None' AS f10_not_deleted,
  coalesce(contains(team, 'BUILD'), false) AS f12_contains
FROM rows
WHERE player IS DISTINCT FROM 'Player' AND team IS DISTINCT FROM 'League Average'
""",
    "month_union": """
SELECT o_orderkey, lower(monthname(o_orderdate)) AS month_name, CAST(o_orderdate AS DATE) AS proper_date
FROM orders WHERE month(o_orderdate) IN (10, 11, 12, 1, 2, 3, 4)
""",
    "explode_outer": """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
SELECT doc_id, CAST(unnest(range(0, len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
FROM s
""",
    "lockstep_explode": "WITH" + _ODDS_RAW_SQL + f""",
  l AS (
    SELECT l_orderkey, l_linenumber,
      string_split({_TEAMS_SQL}, ' ') AS team,
      string_split({_SPREAD_SQL.format(c="replace(spread_raw, 'PK', '-1.0')")}, ' ') AS spread,
      string_split(moneyline_raw, ' ') AS moneyline
    FROM raw)
SELECT l_orderkey, l_linenumber, unnest(team) AS team, unnest(spread) AS spread,
       unnest(moneyline) AS moneyline
FROM l WHERE len(team) = len(spread) AND len(spread) = len(moneyline)
""",
    "top_posts": """
SELECT doc_id, source, n_chars,
  'https://www.reddit.com/r/' || source || '/comments/' || CAST(doc_id AS VARCHAR) AS reddit_url
FROM documents ORDER BY n_chars DESC, doc_id LIMIT 27
""",
}
