"""Keep-best-per-key and distinct operators.

All of them are hash aggregates with ``max_by``/``min_by``, so Spark combines map-side
before the shuffle: a key holding a third of all rows still sends one partial row per map
task, never the whole group to one task.  (A ``row_number()`` window would sort the entire
hot group in a single task.)

Row order is explicit: callers pass the columns that decide "first"/"last" plus a unique
tie-breaker (``row_idx`` from the extractor, or a natural id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def order_key(asc: Sequence[str | Column] = (), desc: Sequence[str | Column] = ()) -> Column:
    """A null-free struct whose natural order is: ``asc`` ascending, then ``desc``
    descending, nulls always ranked lowest.  Used as the ordering of ``max_by``/``min_by``.
    Numeric columns only for ``desc`` (they are negated)."""
    fields = []
    i = 0
    for c in _cols(asc):
        fields += [c.isNotNull().alias(f"n{i}"), F.coalesce(c, F.lit(0)).alias(f"v{i}")]
        i += 1
    for c in _cols(desc):
        fields += [c.isNotNull().alias(f"n{i}"), F.coalesce(-c, F.lit(0)).alias(f"v{i}")]
        i += 1
    return F.struct(*fields)


def keep_last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                      drop_null_keys: bool = True) -> DataFrame:
    """One row per key: the row ranked highest by ``order`` (ascending sort, take the tail).

    ``order`` must end with a unique tie-breaker.  Null keys are dropped, as a pandas
    group-by does."""
    if drop_null_keys:
        df = df.where(_all_not_null(keys))
    cols = df.columns
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*_cols(order)))
    return df.groupBy(*keys).agg(best.alias("_best")).select("_best.*")


def keep_first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                       drop_null_keys: bool = False) -> DataFrame:
    """One row per key: the first in ``order`` (page order).  Null keys form one group,
    as ``drop_duplicates(subset=...)`` does, unless ``drop_null_keys``."""
    if drop_null_keys:
        df = df.where(_all_not_null(keys))
    cols = df.columns
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*_cols(order)))
    return df.groupBy(*keys).agg(best.alias("_best")).select("_best.*")


def first_nonnull_per_group(df: DataFrame, keys: Sequence[str], rank: Column,
                            value_cols: Sequence[str]) -> DataFrame:
    """Per group and *per column*, the first non-null value when rows are ranked by
    ``rank`` (highest first).  This is a column-wise pick, not "the first row": two
    columns of one output row may come from different input rows.  Null keys dropped."""
    df = df.where(_all_not_null(keys))
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in value_cols]
    return df.groupBy(*keys).agg(*aggs)


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate removal (nulls equal).  With ``subset`` the surviving row of a group
    is arbitrary; use :func:`keep_first_per_key` when the choice matters."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (uniqueness check before publishing)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
