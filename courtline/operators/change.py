"""Change detection and keyed merge (the logic of a keyed upsert).

Both are equi-joins on the table key.  Keys are unique on both sides (batches are
de-duplicated on the key first, the target is unique by construction), so a hot key value
cannot multiply rows; the sort-merge join is balanced by hash partitioning and AQE splits
any oversized partition.  Nothing is broadcast here: neither side has a size bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], rkeys: Sequence[str],
              null_safe: bool) -> Column:
    eqs = [(left[k].eqNullSafe(right[r]) if null_safe else left[k] == right[r])
           for k, r in zip(keys, rkeys)]
    return reduce(lambda a, b: a & b, eqs)


def changed_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str],
                 compare_cols: Sequence[str], null_safe_keys: bool = True) -> DataFrame:
    """Rows of ``incoming`` that are new or differ from ``existing`` in ``compare_cols``.

    * new: no matching key (the first compared column of the match is null);
    * changed: for any compared column ``a != b``, where a null on either side - null
      against null too - counts as changed.
    Keys match null-safely by default (a null key matches a null key).  Only keys and
    compared columns of ``existing`` are read."""
    if not compare_cols:
        raise ValueError("compare_cols must not be empty")
    ex_cols = [*keys, *compare_cols]
    ex = existing.select(*[F.col(c).alias(f"_ex_{c}") for c in ex_cols])
    cond = _key_cond(incoming, ex, keys, [f"_ex_{k}" for k in keys], null_safe_keys)
    joined = incoming.join(ex, cond, "left")
    is_new = F.col(f"_ex_{compare_cols[0]}").isNull()
    changed = reduce(lambda a, b: a | b, [
        F.coalesce(F.col(c) != F.col(f"_ex_{c}"), F.lit(True)) for c in compare_cols])
    return joined.where(is_new | changed).select(*incoming.columns)


def dedup_batch(batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key in a batch: the last by ``order_col`` wins (map-side combined)."""
    cols = batch.columns
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col))
    return batch.groupBy(*keys).agg(best.alias("_b")).select("_b.*")


def merge_keyed(target: DataFrame, batch: DataFrame, keys: Sequence[str], run_ts: Column,
                created_col: str = "created_at", modified_col: str = "modified_at",
                null_safe_keys: bool = False) -> DataFrame:
    """The table after an upsert of ``batch`` into ``target``.

    Keys in the batch insert or overwrite every non-key column; keys only in the target keep
    their row.  ``created_at`` is kept for existing keys and stamped for new ones;
    ``modified_at`` is stamped for every key the batch touched.  ``batch`` must already be
    unique on ``keys`` (see :func:`dedup_batch`).  A target column missing from the batch
    becomes null on touched rows, as the batch row is written whole."""
    value_cols = [c for c in target.columns if c not in keys and c not in (created_col,
                                                                           modified_col)]
    b = batch.select(*[F.col(c).alias(f"_b_{c}") for c in batch.columns],
                     F.lit(True).alias("_b_present"))
    cond = _key_cond(target, b, keys, [f"_b_{k}" for k in keys], null_safe_keys)
    j = target.join(b, cond, "full_outer")
    present = F.coalesce(F.col("_b_present"), F.lit(False))
    out = []
    for k in keys:
        out.append(F.when(present, F.col(f"_b_{k}")).otherwise(target[k]).alias(k))
    for c in value_cols:
        src = F.col(f"_b_{c}") if c in batch.columns else F.lit(None)
        out.append(F.when(present, src).otherwise(target[c])
                   .cast(target.schema[c].dataType).alias(c))
    out.append(F.coalesce(target[created_col], run_ts).alias(created_col))
    out.append(F.when(present, run_ts).otherwise(target[modified_col]).alias(modified_col))
    return j.select(*out)
