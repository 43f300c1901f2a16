"""Row expansion: explode, lock-step explode, split into fixed columns, union by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_keep_empty(df: DataFrame, col: str, pos_col: str | None = None) -> DataFrame:
    """One row per list element; an empty or null list keeps its row with a null element
    (``explode`` would lose it).  ``pos_col`` adds the element position."""
    others = [c for c in df.columns if c != col]
    if pos_col:
        return df.select(*others, F.posexplode_outer(col).alias(pos_col, col))
    return df.select(*others, F.explode_outer(col).alias(col))


def lockstep_explode(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Explode several list columns together, element i with element i.

    Rows whose lists differ in length cannot be zipped faithfully (``arrays_zip`` would pad
    with nulls); they are returned separately as quarantined rows instead of failing the
    whole dataset.  A row whose lists are all empty (or all null) is kept with null elements.
    Returns ``(exploded, quarantined)``; every input row is in exactly one of them."""
    sizes = [F.coalesce(F.size(c), F.lit(-1)) for c in cols]
    same = reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes[1:]], F.lit(True))
    others = [c for c in df.columns if c not in cols]
    # one generator over the projected arrays: a mismatched row zips to null and yields
    # nothing.  (A separate size filter would be pushed below the projection and make the
    # optimizer evaluate every array expression twice.)
    z = F.arrays_zip(*[F.col(c) for c in cols])
    z = F.explode(F.when(same, F.when(sizes[0] > 0, z).otherwise(F.array(F.get(z, 0))))).alias("_z")
    zipped = df.select(*others, z).select(*others, *[F.col(f"_z.{c}").alias(c) for c in cols])
    bad = df.where(~same)
    return zipped, bad


def split_fixed(c: str | Column, sep_regex: str, names: Sequence[str]) -> list[Column]:
    """Split on the first ``len(names)-1`` separators into named columns (missing parts
    are null)."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col, sep_regex, len(names))
    return [F.get(parts, i).alias(n) for i, n in enumerate(names)]


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL matching columns by name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
