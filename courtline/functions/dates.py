"""Date parsing and calendar rules as Column expressions (plus two driver-side helpers that
only turn run parameters into literals)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season-type boundaries (the rule is marked deprecated upstream but still
# defines the labels).  Before the first date: regular season; from the second (inclusive)
# to the third (exclusive): play-in; everything else, including the gap day, playoffs.
REGULAR_SEASON_END = dt.date(2025, 4, 15)
PLAY_IN_START = dt.date(2025, 4, 16)
PLAY_IN_END = dt.date(2025, 4, 21)

# Schedule months by phase, in load order.
REGULAR_SEASON_MONTHS = ["october", "november", "december", "january", "february", "march",
                         "april"]
PLAYOFF_MONTHS = ["april", "may", "june"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_ntz_lit(v: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal built from the wall-clock text, so neither the driver's nor
    the session's time zone can shift it."""
    return F.to_timestamp_ntz(F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")))


def parse_long_date(c: str | Column) -> Column:
    """``October 1, 2024`` -> DATE (null when it does not parse)."""
    return F.try_to_timestamp(_col(c), F.lit("MMMM d, yyyy")).cast("date")


def parse_weekday_date(c: str | Column) -> Column:
    """``Tue, May 16, 2022`` -> DATE.  Spark cannot parse a weekday name, so it is stripped
    first; a wrong weekday is therefore accepted, as in the source data."""
    no_weekday = F.regexp_replace(_col(c), r"^\s*[A-Za-z]+,\s*", "")
    return F.try_to_timestamp(no_weekday, F.lit("MMM d, yyyy")).cast("date")


def date_time_to_ts(date_col: str | Column, time_col: str | Column) -> Column:
    """DATE + ``H:mm`` -> TIMESTAMP_NTZ (``9:30`` and ``20:30`` both parse; junk -> null)."""
    s = F.concat(F.date_format(_col(date_col), "yyyy-MM-dd"), F.lit(" "), _col(time_col))
    return F.try_to_timestamp(s, F.lit("yyyy-MM-dd H:mm")).cast("timestamp_ntz")


def season_label(end_year: int) -> str:
    """``2026`` -> ``2025-26`` (run parameter, driver side)."""
    return f"{end_year - 1}-{str(end_year)[-2:]}"


def season_type(c: str | Column) -> Column:
    """Season phase of a date."""
    d = _col(c).cast("date")
    return (F.when(d < F.lit(REGULAR_SEASON_END), F.lit("Regular Season"))
            .when((d >= F.lit(PLAY_IN_START)) & (d < F.lit(PLAY_IN_END)), F.lit("Play-In"))
            .otherwise(F.lit("Playoffs")))


def schedule_months(season_flag: int, playoff_flag: int) -> list[str]:
    """Months to load from the two feature flags (driver-side list of run parameters)."""
    if not season_flag:
        return []
    return list(PLAYOFF_MONTHS if playoff_flag else REGULAR_SEASON_MONTHS)
