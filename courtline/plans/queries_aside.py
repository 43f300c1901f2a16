"""Registered queries for the side output: what loads and what is set aside, from one staged write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions import extract_tokens_joined, parse_long_date, spread_filter
from courtline.operators.aside import REASON, ROW, lockstep_marked, set_aside, stage_aside
from courtline.plans.catalog import table
from courtline.plans.queries_text import _ODDS_RAW_SQL, _SPREAD_SQL, _TEAMS_SQL, BAD_DATE_PATCH, _odds_raw
from courtline.session import scratch_path


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Odds lines, exploded in lock step, those whose lists do not line up marked."""
    raw = _odds_raw(table(spark, sf, "lineitem", spread=True))
    lists = raw.select("l_orderkey", "l_linenumber",
                       F.split(extract_tokens_joined("datetime1"), " ").alias("team"),
                       F.split(spread_filter(F.replace(F.col("spread_raw"), F.lit("PK"), F.lit("-1.0"))), " ").alias("spread"),
                       F.split("moneyline_raw", " ").alias("moneyline"))
    return lockstep_marked(lists, ["team", "spread", "moneyline"])


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as long text, some unknown (patched) and some misspelt, unreadable ones marked."""
    raw = F.when(F.col("o_orderkey") % 97 == 0, F.lit("Smarch 5, 1996")).when(
        F.col("o_orderstatus") == "P", F.lit("?")).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    d = table(spark, sf, "orders").select("o_orderkey", raw.alias("date_raw"))
    d = d.withColumn("proper_date", parse_long_date(F.regexp_replace("date_raw", r"\?", BAD_DATE_PATCH)))
    return set_aside(d, F.col("proper_date").isNotNull(), "unreadable date", ["o_orderkey", "date_raw"])


def _both(marked: DataFrame, name: str) -> DataFrame:
    good, aside, _, _ = stage_aside(marked, _path(marked, name))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(aside.withColumnRenamed(REASON, "reason").drop(ROW))


def _path(marked: DataFrame, name: str) -> str:
    return scratch_path(marked.sparkSession, f"aside-{name}")


def lines_set_aside(spark: SparkSession, sf: str) -> DataFrame:
    return _both(_lines(spark, sf), "lines")


def dates_set_aside(spark: SparkSession, sf: str) -> DataFrame:
    return _both(_dates(spark, sf), "dates")


def set_aside_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows loaded and set aside per input, as the staging writes observed them."""
    rows = [(name, *stage_aside(marked, _path(marked, name))[2:])
            for name, marked in (("lines", _lines(spark, sf)), ("dates", _dates(spark, sf)))]
    return spark.createDataFrame(rows, "dataset string, loaded long, set_aside long")


QUERIES = {"lines_set_aside": lines_set_aside, "dates_set_aside": dates_set_aside, "set_aside_counts": set_aside_counts}

_LINES_SQL = _ODDS_RAW_SQL + f""",
  l AS (
    SELECT l_orderkey, l_linenumber, string_split({_TEAMS_SQL}, ' ') AS team,
      string_split({_SPREAD_SQL.format(c="replace(spread_raw, 'PK', '-1.0')")}, ' ') AS spread,
      string_split(moneyline_raw, ' ') AS moneyline
    FROM raw),
  lines AS (
    SELECT l_orderkey, l_linenumber, unnest(team) AS team, unnest(spread) AS spread,
      unnest(moneyline) AS moneyline, CAST(NULL AS VARCHAR) AS reason
    FROM l WHERE len(team) = len(spread) AND len(spread) = len(moneyline)
    UNION ALL
    SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, 'lists differ in length'
    FROM l WHERE len(team) <> len(spread) OR len(spread) <> len(moneyline))"""
_DATES_SQL = f"""
  r AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'Smarch 5, 1996' WHEN o_orderstatus = 'P' THEN '?'
        ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_raw
    FROM orders),
  dates AS (
    SELECT *, CAST(try_strptime(replace(date_raw, '?', '{BAD_DATE_PATCH}'), '%B %d, %Y') AS DATE) AS proper_date,
      CASE WHEN try_strptime(replace(date_raw, '?', '{BAD_DATE_PATCH}'), '%B %d, %Y') IS NULL THEN 'unreadable date' END AS reason
    FROM r)"""
ORACLE = {
    "lines_set_aside": "WITH" + _LINES_SQL + "\nSELECT * FROM lines",
    "dates_set_aside": "WITH" + _DATES_SQL + "\nSELECT * FROM dates",
    "set_aside_counts": "WITH" + _LINES_SQL + "," + _DATES_SQL + """
SELECT 'lines' AS dataset, count(*) FILTER (WHERE reason IS NULL) AS loaded, count(reason) AS set_aside FROM lines
UNION ALL SELECT 'dates', count(*) FILTER (WHERE reason IS NULL), count(reason) FROM dates""",
}
