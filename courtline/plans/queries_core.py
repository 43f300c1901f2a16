"""Registered queries over the semantic core: keep-best-per-key, forward fill, period labels,
change detection and keyed upsert.  Each has its SQL twin in ``ORACLE``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.operators import (
    changed_rows,
    dedup_batch,
    fill_zero,
    first_nonnull_per_group,
    forward_fill,
    keep_last_per_key,
    label_markers,
    merge_keyed,
    minute_bucket,
    not_equal_keep_null,
)
from courtline.functions.dates import ts_ntz_lit
from courtline.plans.catalog import CUTOFF_TS, RUN_TS, table

# Fixed run parameters of the order-history queries.
ORDERS_CUTOFF = dt.datetime(2001, 1, 1)
CUSTOMER_CREATED = dt.datetime(2024, 1, 1)


def ts_lit(v: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (wall clock, no zone)."""
    return ts_ntz_lit(v)


def _time_bucket(ts: str) -> Column:
    # order-preserving bucket for the skew-proof forward fill
    return minute_bucket(ts)


# ---------------------------------------------------------------- A2 keep last per key
def keep_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return keep_last_per_key(ev, ["user_id"], ["ts", "event_id"])


# ---------------------------------------------------------------- A1 first non-null per column
def first_nonnull_per_group_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    et = F.col("event_type")
    d = ev.select(
        "user_id", "event_id",
        F.when(et != "signup", F.col("value")).alias("mp"),
        F.when(et == "purchase", F.col("value")).alias("purchase_value"),
        F.when(et != "error", F.col("props")).alias("props"),
        F.when(et.isin("click", "view"), et).alias("engagement"),
        F.col("event_id").alias("top_event_id"))
    # rank: mp descending with nulls last, then page order (event_id) ascending
    rank = F.struct(F.col("mp").isNotNull(), F.coalesce(F.col("mp"), F.lit(0.0)),
                    -F.col("event_id"))
    return first_nonnull_per_group(d, ["user_id"], rank,
                                   ["purchase_value", "props", "engagement", "top_event_id"])


# ---------------------------------------------------------------- W1 W2 S22 forward fill
def _filled_purchases(ev: DataFrame) -> DataFrame:
    d = ev.select("event_id", "user_id", "ts", "event_type", "value",
                  F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    d = forward_fill(d, ["user_id"], ["ts", "event_id"], ["last_purchase"],
                     bucket=_time_bucket("ts"))
    return fill_zero(d, ["last_purchase"])


def forward_fill_q(spark: SparkSession, sf: str) -> DataFrame:
    d = _filled_purchases(table(spark, sf, "events"))
    return d.withColumn("margin", F.col("value") - F.col("last_purchase"))


# ---------------------------------------------------------------- W3 C1 F2 period markers
PERIOD_RULES = [  # (day-of-month upper bound, label) for marker rows
    (10, "1st Period"), (20, "2nd Period"), (31, "3rd Period")]


def period_markers(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    is_marker = F.col("event_type") == "signup"
    conds = [(is_marker & (F.dayofmonth("ts") <= ub), label) for ub, label in PERIOD_RULES]
    d = ev.withColumn("period", label_markers(conds))
    d = forward_fill(d, ["user_id"], ["ts", "event_id"], ["period"], bucket=_time_bucket("ts"))
    # marker rows go only after they have labelled the rows that follow them
    return d.where(not_equal_keep_null("event_type", "signup"))


# ---------------------------------------------------------------- SK4 J2 changed rows
def _customer_state(orders: DataFrame) -> DataFrame:
    last = F.struct(F.col("o_orderdate"), F.col("o_orderkey"))
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_orderdate").alias("last_orderdate"),
        F.max_by("o_orderstatus", last).alias("last_status"))


def changed_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    existing = _customer_state(orders.where(F.col("o_orderdate") < ts_lit(ORDERS_CUTOFF)))
    incoming = _customer_state(orders)
    return changed_rows(incoming, existing, ["o_custkey"],
                        ["n_orders", "last_orderdate", "last_status"])


# ---------------------------------------------------------------- SK2 keyed upsert result
def upsert_result(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    target = (cust.where(F.col("c_mktsegment") != "BUILDING").select(*cols)
              .withColumn("created_at", ts_lit(CUSTOMER_CREATED))
              .withColumn("modified_at", ts_lit(CUSTOMER_CREATED)))
    batch = (cust.where((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "BUILDING"))
             .withColumn("c_acctbal", F.greatest(F.col("c_acctbal"), F.lit(0.0)))
             .select(*cols))
    batch = dedup_batch(batch, ["c_custkey"], "c_custkey")
    return merge_keyed(target, batch, ["c_custkey"], ts_lit(RUN_TS))


# ---------------------------------------------------------------- flagship: user state upsert
def _user_state(ev: DataFrame) -> DataFrame:
    filled = _filled_purchases(ev)
    latest = keep_last_per_key(filled, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "ts", "event_type", "last_purchase")


def user_state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Forward fill -> keep latest per user -> change detection against an earlier cut-off
    -> keyed upsert of the changes into that earlier state."""
    ev = table(spark, sf, "events")
    existing = _user_state(ev.where(F.col("ts") < ts_lit(CUTOFF_TS)))
    incoming = _user_state(ev)
    changes = changed_rows(incoming, existing, ["user_id"], ["event_id", "last_purchase"])
    target = (existing.withColumn("created_at", ts_lit(CUTOFF_TS))
              .withColumn("modified_at", ts_lit(CUTOFF_TS)))
    return merge_keyed(target, changes, ["user_id"], ts_lit(RUN_TS))


QUERIES = {
    "keep_latest_per_key": keep_latest_per_key,
    "first_nonnull_per_group": first_nonnull_per_group_q,
    "forward_fill": forward_fill_q,
    "period_markers": period_markers,
    "changed_rows": changed_rows_q,
    "upsert_result": upsert_result,
    "user_state_upsert": user_state_upsert,
}

_FILL_PURCHASES_SQL = """
  fp AS (
    SELECT event_id, user_id, ts, event_type, value,
           coalesce(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
                    OVER (PARTITION BY user_id ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS last_purchase
    FROM {src})"""

ORACLE = {
    "keep_latest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props
FROM events WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
    "first_nonnull_per_group": """
WITH d AS (
  SELECT user_id, event_id,
         CASE WHEN event_type <> 'signup' THEN value END AS mp,
         CASE WHEN event_type = 'purchase' THEN value END AS purchase_value,
         CASE WHEN event_type <> 'error' THEN props END AS props,
         CASE WHEN event_type IN ('click', 'view') THEN event_type END AS engagement
  FROM events WHERE user_id IS NOT NULL)
SELECT user_id,
  first(purchase_value ORDER BY mp DESC NULLS LAST, event_id)
    FILTER (WHERE purchase_value IS NOT NULL) AS purchase_value,
  first(props ORDER BY mp DESC NULLS LAST, event_id) FILTER (WHERE props IS NOT NULL) AS props,
  first(engagement ORDER BY mp DESC NULLS LAST, event_id)
    FILTER (WHERE engagement IS NOT NULL) AS engagement,
  first(event_id ORDER BY mp DESC NULLS LAST, event_id) AS top_event_id
FROM d GROUP BY user_id
""",
    "forward_fill": "WITH" + _FILL_PURCHASES_SQL.format(src="events") + """
SELECT event_id, user_id, ts, event_type, value, last_purchase, value - last_purchase AS margin
FROM fp
""",
    "period_markers": """
WITH d AS (
  SELECT event_id, user_id, ts, event_type,
         CASE WHEN event_type = 'signup' AND day(ts) <= 10 THEN '1st Period'
              WHEN event_type = 'signup' AND day(ts) <= 20 THEN '2nd Period'
              WHEN event_type = 'signup' AND day(ts) <= 31 THEN '3rd Period' END AS marker
  FROM events)
SELECT event_id, user_id, ts, event_type,
       last_value(marker IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period
FROM d
QUALIFY event_type IS DISTINCT FROM 'signup'
""",
    "changed_rows": """
WITH inc AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_orderdate,
         arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status
  FROM orders GROUP BY o_custkey),
ex AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_orderdate,
         arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00' GROUP BY o_custkey)
SELECT i.o_custkey, i.n_orders, i.last_orderdate, i.last_status
FROM inc i LEFT JOIN ex e ON i.o_custkey IS NOT DISTINCT FROM e.o_custkey
WHERE e.n_orders IS NULL
   OR coalesce(i.n_orders <> e.n_orders, true)
   OR coalesce(i.last_orderdate <> e.last_orderdate, true)
   OR coalesce(i.last_status <> e.last_status, true)
""",
    "upsert_result": """
WITH tgt AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' AS modified_at
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
b AS (
  SELECT c_custkey, c_name, c_nationkey, greatest(c_acctbal, 0.0) AS c_acctbal, c_mktsegment,
         true AS present
  FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING')
SELECT CASE WHEN b.present THEN b.c_custkey ELSE t.c_custkey END AS c_custkey,
       CASE WHEN b.present THEN b.c_name ELSE t.c_name END AS c_name,
       CASE WHEN b.present THEN b.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN b.present THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN b.present THEN b.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       coalesce(t.created_at, TIMESTAMP '2024-01-31 06:00:00') AS created_at,
       CASE WHEN b.present THEN TIMESTAMP '2024-01-31 06:00:00' ELSE t.modified_at END AS modified_at
FROM tgt t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey
""",
    "user_state_upsert": """
WITH""" + _FILL_PURCHASES_SQL.format(src="events") + """,
""" + _FILL_PURCHASES_SQL.format(src="events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'")
    .replace("fp AS", "fp_old AS", 1) + """,
inc AS (SELECT user_id, event_id, ts, event_type, last_purchase FROM fp
        WHERE user_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ex AS (SELECT user_id, event_id, ts, event_type, last_purchase FROM fp_old
       WHERE user_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ch AS (SELECT i.*, true AS present FROM inc i LEFT JOIN ex e
         ON i.user_id IS NOT DISTINCT FROM e.user_id
       WHERE e.event_id IS NULL
          OR coalesce(i.event_id <> e.event_id, true)
          OR coalesce(i.last_purchase <> e.last_purchase, true))
SELECT CASE WHEN c.present THEN c.user_id ELSE x.user_id END AS user_id,
       CASE WHEN c.present THEN c.event_id ELSE x.event_id END AS event_id,
       CASE WHEN c.present THEN c.ts ELSE x.ts END AS ts,
       CASE WHEN c.present THEN c.event_type ELSE x.event_type END AS event_type,
       CASE WHEN c.present THEN c.last_purchase ELSE x.last_purchase END AS last_purchase,
       coalesce(CASE WHEN x.user_id IS NOT NULL THEN TIMESTAMP '2024-01-20 00:00:00' END,
                TIMESTAMP '2024-01-31 06:00:00') AS created_at,
       CASE WHEN c.present THEN TIMESTAMP '2024-01-31 06:00:00'
            ELSE TIMESTAMP '2024-01-20 00:00:00' END AS modified_at
FROM ex x FULL OUTER JOIN ch c ON x.user_id = c.user_id
""",
}
