"""Helpers shared by the operators: input tables, written intermediates, ordered blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.session import scratch_path, ship_package

MIN_LONG = -(2**63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def order_key(col: str) -> Column:
    """An integer id as a sort key that is never null: null ids come first."""
    return F.coalesce(F.col(col).cast("long"), F.lit(MIN_LONG))


def block_starts(df: DataFrame, key: Column, per_partition: int = 4) -> list[int]:
    """First keys of about equally filled, ordered blocks of ``key``.

    A few blocks per shuffle partition, so what reaches the driver is as long as the
    cluster is wide and does not follow the rows.  Every start is a key that occurs."""
    n = max(1, per_partition * shuffle_partitions(df.sparkSession))
    low, cuts = df.agg(
        F.min(key), F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 20 * n)).first()
    return sorted({low, *(cuts or [])}) if low is not None else [MIN_LONG]
