"""Forward fill within ordered groups, and period labels carried forward from marker rows.

``forward_fill`` has two plans:

* ``bucket=None``: one window per group.  Right when a group is bounded by nature (one
  game's play-by-play is a few hundred rows).
* ``bucket=<Column>``: a prefix scan for unbounded groups, over rows in the order of (key, bucket,
  order).  No group has to fit into a task, and rows of one key and one timestamp are split too:

  1. rows are dealt by range of (key, bucket, order), one scan and one exchange, and sorted;
  2. each partition is filled on its own (Arrow batches, one carried value per column);
  3. a partition's summary is its first key, its last key and the last value known there; a later
     partition that begins with that key starts from the latest such value.  There is one summary
     row for each partition, whatever the rows, and these rows are broadcast.

  The summaries read the same exchange, so the input is planned once and nothing is joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _same_as_before(col):
    """For each row of an Arrow column but the first: whether it equals the row before (nulls are equal,
    and so are NaNs)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    a, b = col.slice(0, len(col) - 1), col.slice(1)
    same = pc.fill_null(pc.equal(a, b), False)
    same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(col.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same.to_numpy(zero_copy_only=False)


def _fill_batches(batches, keys: list[int], values: list[int]):
    """Sorted batches to (batch, filled columns, first: rows of the partition's first group).  What
    follows from one batch to the next is one row."""
    import numpy as np
    import pyarrow as pa

    before, filled_before, all_first = None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.num_rows
        if before is None:
            own, start = batch, 0
        else:           # the last row so far leads the batch, with what was known there
            joined = [pa.concat_arrays([before.column(i), batch.column(i)]) for i in range(batch.num_columns)]
            own, start = pa.RecordBatch.from_arrays(joined, names=batch.schema.names), 1
        change = np.zeros(n + start, bool)
        change[0] = True
        for k in keys:
            change[1:] |= ~_same_as_before(own.column(k))
        at = np.arange(n + start)
        group = np.maximum.accumulate(np.where(change, at, 0))
        filled = []
        for j, v in enumerate(values):
            col = own.column(v) if before is None else pa.concat_arrays([filled_before[j], batch.column(v)])
            known = np.maximum.accumulate(np.where(col.is_valid().to_numpy(zero_copy_only=False), at, -1))
            filled.append(col.take(pa.array(known, mask=known < group)))
        all_first = all_first & (np.cumsum(change) == 1)
        yield batch, [c.slice(start) for c in filled], all_first[start:]
        before, filled_before, all_first = batch.slice(n - 1), [c.slice(len(c) - 1) for c in filled], all_first[-1]


def _prefix_scan(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[str | Column],
                 value_cols: Sequence[str], bucket: Column, out: dict[str, str]) -> DataFrame:
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_ff_key{i}" for i in range(len(partition_by))]
    keyed = df.withColumns({**{n: F.col(k) if isinstance(k, str) else k for n, k in zip(names, partition_by)}, "_ff_bucket": bucket})
    order = [*names, "_ff_bucket", *order_by]
    rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = rows.schema
    keys, values = [schema.names.index(n) for n in names], [schema.names.index(c) for c in value_cols]
    local = [f"_ff_local{j}" for j in range(len(values))]

    def fill(batches):
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        for batch, filled, first in _fill_batches(batches, keys, values):
            yield pa.RecordBatch.from_arrays([*batch.columns, *filled, pa.array(first), pa.repeat(pa.scalar(part, pa.int32()), batch.num_rows)],
                                             names=[*batch.schema.names, *local, "_ff_first", "_ff_part"])

    def summary(batches):
        import pyarrow as pa

        part, head, tail = TaskContext.get().partitionId(), None, None
        for batch, filled, _ in _fill_batches(batches, keys, values):
            head = head or [batch.column(k).slice(0, 1) for k in keys]
            tail = [batch.column(k).slice(batch.num_rows - 1) for k in keys], [c.slice(len(c) - 1) for c in filled]
        if head:        # what begins here asks for a value, what ends here has one
            none = [pa.nulls(1, c.type) for c in tail[1]]
            for ends, cols in ((False, [*head, *none]), (True, [*tail[0], *tail[1]])):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ends]), *cols], names=["_ff_at", "_ff_ends", *names, *local])

    fields = [T.StructField(n, schema[c].dataType) for n, c in zip(local, value_cols)]
    done = rows.mapInArrow(fill, T.StructType([*schema.fields, *fields, T.StructField("_ff_first", T.BooleanType()), T.StructField("_ff_part", T.IntegerType())]))
    sums = rows.mapInArrow(summary, T.StructType([T.StructField("_ff_at", T.IntegerType()), T.StructField("_ff_ends", T.BooleanType()),
                                                  *(T.StructField(n, schema[n].dataType) for n in names), *fields]))
    # keys are in order, so the partitions that end with a key lie together before the one that goes on with it
    w = Window.partitionBy(*names).orderBy("_ff_at", "_ff_ends").rowsBetween(Window.unboundedPreceding, -1)
    known = [F.last(F.col(n), ignorenulls=True).over(w).alias(f"_ff_carry{j}") for j, n in enumerate(local)]
    carry = sums.select("_ff_at", "_ff_ends", *known).where(~F.col("_ff_ends")).drop("_ff_ends")
    filled = done.join(F.broadcast(carry), F.col("_ff_part") == F.col("_ff_at"), "left")
    cols = {out[c]: F.coalesce(F.col(local[j]), F.when(F.col("_ff_first"), F.col(f"_ff_carry{j}"))) for j, c in enumerate(value_cols)}
    return filled.withColumns(cols).select(*df.columns, *[c for c in out.values() if c not in df.columns])


def forward_fill(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[str | Column],
                 value_cols: Sequence[str], bucket: Column | None = None,
                 suffix: str = "") -> DataFrame:
    """Replace nulls in ``value_cols`` with the last earlier non-null value of the group.

    ``order_by`` must be a total order within a group (end it with a unique id).  With
    ``suffix`` the filled values go to new columns ``<c><suffix>``.  Null keys form a group and
    null buckets come first, with either plan; a bucket of any sortable type orders its rows as
    it sorts itself."""
    out = {c: f"{c}{suffix}" for c in value_cols}
    if bucket is not None:
        return _prefix_scan(df, partition_by, order_by, value_cols, bucket, out)
    w = (Window.partitionBy(*partition_by).orderBy(*order_by)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({out[c]: F.last(F.col(c), ignorenulls=True).over(w) for c in value_cols})


def minute_bucket(ts: str | Column) -> Column:
    """Order-preserving bucket for ``forward_fill`` over a timestamp ordering."""
    return F.date_trunc("minute", F.col(ts) if isinstance(ts, str) else ts)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remaining nulls (before the first known value) become 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols})


def label_markers(conditions: Sequence[tuple[Column, str]]) -> Column:
    """Multi-branch select: the label of the first true condition, else null."""
    expr = None
    for cond, label in conditions:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def period_from_markers(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                        conditions: Sequence[tuple[Column, str]], out_col: str,
                        bucket: Column | None = None) -> DataFrame:
    """Label marker rows and carry the label forward to the following rows of the group.

    Must run before marker/header rows are filtered out, since they carry the labels."""
    df = df.withColumn(out_col, label_markers(conditions))
    return forward_fill(df, partition_by, order_by, [out_col], bucket=bucket)
