"""File and table scans: text logs, CSV/JSON with declared schemas, warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_log_lines(spark: SparkSession, path: str | Sequence[str],
                   with_source: bool = False) -> DataFrame:
    """One row per physical line, column ``errors`` (a continuation line of a multi-line
    message is its own row).  ``with_source`` adds the file each line came from."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.text(paths).withColumnRenamed("value", "errors")
    if with_source:
        df = df.withColumn("source_file", F.input_file_name())
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, date_format: str | None = None) -> DataFrame:
    """CSV with a declared schema (no inference pass over the data)."""
    r = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str,
              multiline: bool = False) -> DataFrame:
    """JSON lines (or one JSON document/array per file with ``multiline``), declared schema."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Full or projected table scan; with ``columns`` only those reach the scan
    (``ReadSchema`` shows the pruning)."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df
