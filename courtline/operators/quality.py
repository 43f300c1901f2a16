"""Quality gates: required columns, non-empty columns, quarantine of bad rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A dataset failed a gate; the run isolates it (see ``plans.run``)."""


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail when a required column is missing (schema check on the driver, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise QualityError(f"required column(s) not found: {missing}")
    return df


def require_types(df: DataFrame, contract: Sequence[str]) -> DataFrame:
    """Fail when the columns or their types are not those of ``contract`` ("name type" pairs, in any
    order; schema check on the driver, no job)."""
    have = {f"{f.name} {f.dataType.simpleString()}" for f in df.schema}
    if have != set(contract):
        raise QualityError(f"columns that differ from the contract: {sorted(have ^ set(contract))}")
    return df


def any_non_null(df: DataFrame, col: str) -> Column:
    """Aggregate expression: does the column hold at least one value?"""
    return F.bool_or(F.col(col).isNotNull())


def require_non_empty_column(df: DataFrame, col: str) -> DataFrame:
    """Fail when a column holds no value at all.  One partial-aggregate job."""
    if not df.select(F.count(F.col(col)).alias("n")).first()["n"]:
        raise QualityError(f"no data in column {col}")
    return df


def quarantine(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad) rows by a predicate; a null predicate counts as bad."""
    ok = F.coalesce(ok, F.lit(False))
    return df.where(ok), df.where(~ok)
