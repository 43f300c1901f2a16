"""Join operators.

No broadcast hints on data without a size bound: ``spark.sql.autoBroadcastJoinThreshold``
broadcasts a side whose estimated size is under the threshold, and AQE re-plans from the
real shuffle sizes, falling back to a sort-merge join beyond them.  Hints are used only for
sides bounded by construction (a literal lookup table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner equi-join on every column name the two sides share (pandas ``merge()`` with no
    ``on``); left rows without a partner disappear."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("natural join needs at least one shared column")
    return left.join(right, shared, "inner")


def exists_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
              negate: bool = False) -> DataFrame:
    """Rows of ``left`` with (or, ``negate``, without) a partner in ``right``: a semi/anti
    join, never duplicating ``left`` rows.

    ``right`` is first reduced to its distinct keys (a partial aggregate before the
    shuffle), so a key held by a third of ``right`` costs one row, not a skewed partition;
    the reduced side is usually small enough for AQE to broadcast."""
    return left.join(right.select(*keys).distinct(), list(keys),
                     "left_anti" if negate else "left_semi")


def page_key(date_col: str | Column, team_col: str | Column) -> Column:
    """Per-game page key ``YYYYMMDD0TEAM`` built from the game date and home team."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    t = F.col(team_col) if isinstance(team_col, str) else team_col
    return F.concat(F.date_format(d, "yyyyMMdd"), F.lit("0"), t)


def lookup_by_key(requests: DataFrame, table: DataFrame, request_key: Column,
                  table_key: str) -> DataFrame:
    """The dependent lookup loop (one fetch per request) as a single equi-join: derive the
    key on each request row and join the keyed table once."""
    r = requests.withColumn("_lookup_key", request_key)
    return r.join(table, r["_lookup_key"] == table[table_key], "inner").drop("_lookup_key")
