"""Operators on skewed data (one key holds a third of all rows) against a pandas brute force
on the same fixture."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from courtline.operators import (
    changed_rows,
    exists_on,
    first_nonnull_per_group,
    forward_fill,
    keep_first_per_key,
    keep_last_per_key,
    minute_bucket,
)

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(N):
        user = 0 if i % 3 == 0 else rnd.randint(1, 200)          # user 0: a third of rows
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        v = round(rnd.random() * 100, 2) if rnd.random() < 0.2 else None
        tag = rnd.choice(["a", "b", None])
        rows.append((i, user, ts, v, tag))
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "v", "tag"])
    sdf = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, "
                                      "v double, tag string").repartition(8)
    return sdf, pdf


def test_keep_last_first_under_skew(skewed):
    sdf, pdf = skewed
    got = {r.user_id: r.event_id for r in
           keep_last_per_key(sdf, ["user_id"], ["ts", "event_id"]).collect()}
    exp = pdf.sort_values(["ts", "event_id"]).groupby("user_id").tail(1)
    assert got == dict(zip(exp.user_id, exp.event_id))
    got = {r.user_id: r.event_id for r in
           keep_first_per_key(sdf, ["user_id"], ["ts", "event_id"]).collect()}
    exp = pdf.sort_values(["ts", "event_id"]).drop_duplicates("user_id")
    assert got == dict(zip(exp.user_id, exp.event_id))


def test_first_nonnull_under_skew(skewed):
    sdf, pdf = skewed
    rank = F.struct(F.col("v").isNotNull(), F.coalesce("v", F.lit(0.0)), -F.col("event_id"))
    got = {r.user_id: r.tag for r in
           first_nonnull_per_group(sdf, ["user_id"], rank, ["tag"]).collect()}
    exp = (pdf.sort_values(["v", "event_id"], ascending=[False, True], na_position="last")
           .groupby("user_id")["tag"].first())
    assert got == {k: (None if pd.isna(v) else v) for k, v in exp.items()}


@pytest.mark.parametrize("bucket", ["day", "minute"])
def test_bucketed_forward_fill_under_skew(skewed, bucket):
    sdf, pdf = skewed
    b = F.to_date("ts") if bucket == "day" else minute_bucket("ts")
    out = forward_fill(sdf, ["user_id"], ["ts", "event_id"], ["v"], bucket=b, suffix="_f")
    got = {r.event_id: r.v_f for r in out.collect()}
    p = pdf.sort_values(["user_id", "ts", "event_id"])
    p["v_f"] = p.groupby("user_id")["v"].ffill()
    exp = {e: (None if pd.isna(v) else v) for e, v in zip(p.event_id, p.v_f)}
    assert got == exp


def test_changed_rows_and_semi_join_under_skew(spark, skewed):
    sdf, pdf = skewed
    latest = keep_last_per_key(sdf, ["user_id"], ["ts", "event_id"]).select("user_id", "tag")
    older = keep_last_per_key(sdf.where(F.col("event_id") < N // 2), ["user_id"],
                              ["ts", "event_id"]).select("user_id", "tag")
    got = {r.user_id for r in changed_rows(latest, older, ["user_id"], ["tag"]).collect()}
    p_new = pdf.sort_values(["ts", "event_id"]).groupby("user_id").tail(1).set_index("user_id")
    p_old = (pdf[pdf.event_id < N // 2].sort_values(["ts", "event_id"]).groupby("user_id")
             .tail(1).set_index("user_id"))
    exp = set()
    for u, r in p_new.iterrows():
        if u not in p_old.index:
            exp.add(u)
        else:
            a, b = r.tag, p_old.loc[u, "tag"]
            if a is None or b is None or pd.isna(a) or pd.isna(b) or a != b:
                exp.add(u)
    assert got == exp
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 31)], "d date")
    hit = {r.d for r in exists_on(days, sdf.select(F.to_date("ts").alias("d")), ["d"]).collect()}
    assert hit == set(pdf.ts.dt.date.unique())
