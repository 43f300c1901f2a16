"""Row predicates with the null rules of the source pipelines.

A pandas ``query('c != "x"')`` keeps rows where ``c`` is missing; SQL ``c != 'x'`` drops
them.  These helpers spell out which one is meant.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_equal_keep_null(c: str | Column, value: str) -> Column:
    """``c != value`` that keeps null rows (repeated header rows, aggregate rows)."""
    return ~_col(c).eqNullSafe(F.lit(value))


def not_in_keep_null(c: str | Column, values: Sequence[str]) -> Column:
    """``c`` not among ``values``; null rows kept."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def present(c: str | Column) -> Column:
    """Not null and not the empty string."""
    return _col(c).isNotNull() & (_col(c) != F.lit(""))


def any_present(*cols: str | Column) -> Column:
    """At least one of the columns is not null."""
    return reduce(lambda a, b: a | b, [_col(c).isNotNull() for c in cols])


def starts_with(c: str | Column, prefix: str) -> Column:
    """Prefix test where a null value is false."""
    return F.coalesce(_col(c).startswith(prefix), F.lit(False))


def contains(c: str | Column, needle: str) -> Column:
    """Case-sensitive substring test where a null value is false."""
    return F.coalesce(_col(c).contains(needle), F.lit(False))
