"""courtline: a Spark-native ingestion and analytics engine for daily sports-data ELT.

Landed web pages, forum dumps and reference tables are turned into typed datasets with
DataFrame/SQL operators and published through keyed upserts, snapshot appends and
date-partitioned parquet. Every function takes and returns lazy DataFrames; the core work
runs on executors.
"""

__version__ = "0.1.0"
