"""Side output: rows that cannot load are kept beside those that do, with a reason, in one pass.

A marked frame holds both kinds of row.  ``aside_reason`` is null on a row that loads; on a row set
aside it says why, and ``row`` holds what was read as JSON.  :func:`stage_aside` writes such a frame
once, into two partitions of one staging table, and counts both during that write.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "aside_reason"
ROW = "row"


def set_aside(df: DataFrame, ok: Column, reason: str, row: Sequence[str]) -> DataFrame:
    """Mark rows on which ``ok`` is false or null, unless they are marked already; ``row`` names the
    columns that tell what was read."""
    bad = ~F.coalesce(ok, F.lit(False))
    seen = REASON in df.columns
    old = F.col(REASON) if seen else F.lit(None).cast("string")
    old_row = F.col(ROW) if seen else F.lit(None).cast("string")
    new = old.isNull() & bad
    return df.withColumns({
        ROW: F.when(new, F.to_json(F.struct(*row), {"ignoreNullFields": "false"})).otherwise(old_row),
        REASON: F.when(new, F.lit(reason)).otherwise(old)})


def lockstep_marked(df: DataFrame, cols: Sequence[str], reason: str = "lists differ in length") -> DataFrame:
    """Explode list columns together, element i with element i, as a marked frame: a row whose lists
    differ in length is one row with null elements, set aside.  A row whose lists are all empty or
    null stays, with null elements."""
    sizes = [F.coalesce(F.size(c), F.lit(-1)) for c in cols]
    same = reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes[1:]], F.lit(True))
    others = [c for c in df.columns if c not in cols]
    z = F.arrays_zip(*[F.col(c) for c in cols])
    none = F.array(F.get(z, F.lit(-1)))         # one null element
    marked = set_aside(df, same, reason, df.columns)
    z = F.explode(F.when(same & (sizes[0] > 0), z).otherwise(none)).alias("_z")
    return (marked.select(*others, REASON, ROW, z)
            .select(*others, *[F.col(f"_z.{c}").alias(c) for c in cols], REASON, ROW))


def loading(marked: DataFrame) -> DataFrame:
    """The rows that load, without the marks."""
    return marked.where(F.col(REASON).isNull()).drop(REASON, ROW)


def kept_aside(marked: DataFrame) -> DataFrame:
    """(aside_reason, row) of the rows set aside."""
    return marked.where(F.col(REASON).isNotNull()).select(REASON, ROW)


def stage_aside(marked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Write a marked frame once to ``path`` and read it back: (rows that load, all columns of the rows
    set aside, count of each).  The counts are observed by the write; an empty frame gives two empty ones."""
    seen = Observation(f"aside_{uuid.uuid4().hex[:8]}")
    part = marked.withColumn("_aside", F.col(REASON).isNotNull())
    (part.observe(seen, F.count_if(~F.col("_aside")).alias("load"), F.count_if("_aside").alias("aside"))
     .write.mode("overwrite").partitionBy("_aside").parquet(path))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in part.schema])
    back = marked.sparkSession.read.schema(schema).parquet(path)
    good = back.where(~F.col("_aside")).drop("_aside", REASON, ROW)
    return good, back.where("_aside").drop("_aside"), int(seen.get.get("load", 0)), int(seen.get.get("aside", 0))
