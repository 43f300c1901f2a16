"""Registered queries for scans, sinks, joins, sentiment and run orchestration.

Queries that exercise a sink write to a fresh directory under the session's shared
checkpoint root and read the result back, so the check sees what a reader would see.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions import html_cell_text
from courtline.operators import exists_on, lookup_by_key, natural_join, page_key
from courtline.operators.sentiment import (
    BOOST,
    BOOSTERS_DOWN,
    BOOSTERS_UP,
    CAPITALS,
    CONTRAST,
    DAMPING,
    EXCLAMATION,
    NEGATION,
    NEGATORS,
    NORM_ALPHA,
    POINT,
    QUESTION,
    QUESTIONS,
    SEED_LEXICON,
    WHOLE,
    _PUNCT,
    score_sentiment,
    seed_lexicon,
)
from courtline.plans.catalog import RUN_DATE, RUN_TS, table
from courtline.plans.queries_core import ts_lit
from courtline.plans.queries_text import _CODES_SQL, _code
from courtline.plans.run import (
    DatasetSpec,
    FeatureFlags,
    backfill_dates,
    flags_table,
    gate_relational,
    run_datasets,
)
from courtline.session import scratch_path
from courtline.sinks import TableStore, read_archive, write_archive, write_mode
from courtline.sources import list_items, read_log_lines, table_rows
from courtline.sources.forum import (
    POST_URL_PREFIX,
    comments_of_posts,
    flatten_trees,
    read_comment_trees,
    read_comments,
    read_posts,
)


# ---------------------------------------------------------------- SC1 SC2 SC4 SC5 P3 P6 F2
_PAGE_HEAD = (
    "<html><head><script>var s=\"</td><td>\";</script></head><body>"
    "<table><tr><th>id</th></tr><tr><td>{first}</td></tr></table>"
    "<table id=\"stats\"><thead>"
    "<tr><th colspan=\"3\">Order</th><th colspan=\"3\">Line</th></tr>"
    "<tr><th>Rk</th><th>Order</th><th>Line</th><th>Qty</th>"
    "<th><img alt=\"DraftKings\" src=\"dk.png\">Price</th><th>Flag</th></tr></thead><tbody>")
_REPEAT = ("<tr class=\"thead\"><th>Rk</th><td>Order</td><td>Line</td><td>Qty</td>"
           "<td>Price</td><td>Flag</td></tr>")
_PAGE_TAIL = "</tbody></table></body></html>"


def _render_pages(li: DataFrame) -> DataFrame:
    """Stats-table pages rendered from lineitem rows: 16 order numbers a page, a decoy table
    first, a two-level header with a sportsbook logo in one cell, a row-number ``<th>`` per
    body row, the order's number in one cell that spans its lines, cell text with stray
    whitespace and entities, an unclosed ``<td>``, and the header row repeated before every
    fourth order."""
    cents = F.floor(F.col("l_extendedprice") * 100)
    price = F.concat((cents / 100).cast("long").cast("string"), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    cells = F.concat(
        F.lit("<td>"), F.col("l_linenumber").cast("string"),
        F.lit("</td><td>\n   "), F.col("l_quantity").cast("long").cast("string"),
        F.lit("  </td><td>"), price,
        F.lit("<td>"), F.col("l_returnflag"), F.lit(" &amp; "), F.col("l_linestatus"),
        F.lit("</td></tr>"))
    # an order's page holds all its lines: dealt by page once, both groupings find their rows together
    rows = li.select(F.floor(F.col("l_orderkey") / 16).alias("page_id"), "l_orderkey", "l_linenumber", cells.alias("html")).repartition("page_id")
    lines = rows.groupBy("page_id", "l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "html"))).alias("lines"))
    spanning = F.concat(F.lit("<td rowspan=\""), F.size("lines").cast("string"), F.lit("\">"),
                        F.col("l_orderkey").cast("string"), F.lit("</td>"))
    order = F.array_join(F.transform("lines", lambda r, i: F.concat(
        F.lit("<tr><th>"), (i + 1).cast("string"), F.lit("</th>"),
        F.when(i == 0, spanning).otherwise(F.lit("")), r["html"])), "")
    orders = lines.select("page_id", "l_orderkey", order.alias("html"))
    pages = orders.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("l_orderkey", "html"))).alias("orders"))
    body = F.array_join(F.transform("orders", lambda o, i: F.concat(
        F.when((i > 0) & (i % 4 == 0), F.lit(_REPEAT)).otherwise(F.lit("")), o["html"])), "")
    head, tail = _PAGE_HEAD.split("{first}")
    return pages.select("page_id", F.concat(F.lit(head), F.col("page_id").cast("string"), F.lit(tail), body, F.lit(_PAGE_TAIL)).alias("html"))


def html_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    pages = _render_pages(table(spark, sf, "lineitem", spread=True))
    rows = table_rows(pages, tables=[1], locate_alt=("DraftKings", 1), spread=False)
    body = rows.where((F.col("section") == "tbody")
                      & ~F.coalesce(F.get("cells", 0) == "Rk", F.lit(False)))
    return body.select(
        F.get("cells", 1).cast("long").alias("l_orderkey"),
        F.get("cells", 2).cast("int").alias("l_linenumber"),
        html_cell_text(F.get("cells", 3)).alias("quantity"),
        F.get("cells", F.col("alt_col")).alias("price"),
        F.get("cells", 5).alias("flag"),
        F.array_join(F.get("header", F.col("alt_col")), "").alias("price_header"),
        F.get(F.get("header", 1), 1).alias("last_level"),
        F.size("td_cells").alias("n_td"))


# ---------------------------------------------------------------- SC3 nested list scan
def html_list_scan(spark: SparkSession, sf: str) -> DataFrame:
    items = list_items(table(spark, sf, "pages"))
    return items.select("page_id", "ul_idx", "li_idx", "date", F.size("items").alias("n_items"),
                        "text", "href")


# ---------------------------------------------------------------- SK1 mode writes
def snapshot_append(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice", "o_orderdate")
    path = scratch_path(spark, "snapshot")
    write_mode(o.where(F.col("o_orderstatus") == "F"), path, "fail")
    write_mode(o.where(F.col("o_orderstatus") != "F"), path, "append")
    write_mode(o.where(F.col("o_orderstatus").isNull()), path, "append")   # empty: no-op
    failed = write_mode(o, path, "fail")       # existing target: reported, not raised
    assert failed.status == "failed"
    return spark.read.parquet(path)


# ---------------------------------------------------------------- SK3 archive round trip
def archive_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    root = scratch_path(spark, "archive")
    write_archive(o, root, "orders", RUN_DATE)
    write_archive(o.where(F.col("o_totalprice") < 0), root, "orders", RUN_DATE)  # empty: no-op
    write_archive(o, root, "orders", RUN_DATE)          # same-day rerun replaces the day
    return read_archive(spark, root, "orders")


# ---------------------------------------------------------------- SK2 SK4 SK6 keyed store
def store_upsert(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    store = TableStore(spark, scratch_path(spark, "store"), buckets=16)
    first = cust.where(F.col("c_mktsegment") != "BUILDING").select(*cols)
    store.stage_upsert("customers", first, ["c_custkey"], ts_lit(dt.datetime(2024, 1, 1)),
                       order_col="c_custkey")
    store.commit("run-1")
    batch = (cust.where((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "BUILDING"))
             .withColumn("c_acctbal", F.greatest(F.col("c_acctbal"), F.lit(0.0)))
             .select(*cols))
    store.stage_upsert("customers", batch, ["c_custkey"], ts_lit(RUN_TS), order_col="c_custkey",
                       compare_cols=["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    store.commit("run-2")
    return store.read("customers")


# ---------------------------------------------------------------- J1 natural join
def _plays_and_away(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    plays = li.select(F.col("l_orderkey").alias("game_id"), "l_linenumber",
                      _code((F.col("l_orderkey") % 30).cast("int")).alias("HomeTeam"))
    away = (o.where(F.col("o_orderstatus") != "P")
            .select(F.col("o_orderkey").alias("game_id"),
                    _code((F.col("o_orderkey") % 30).cast("int")).alias("HomeTeam"),
                    _code(((F.col("o_custkey") + 7) % 30).cast("int")).alias("AwayTeam"))
            .dropDuplicates())
    return plays, away


def away_join(spark: SparkSession, sf: str) -> DataFrame:
    plays, away = _plays_and_away(spark, sf)
    return natural_join(plays, away)


# ---------------------------------------------------------------- J3 existence on date
def exists_on_date(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    sched = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    played = exists_on(days, sched, ["day"]).withColumn("has_games", F.lit(True))
    none = exists_on(days, sched, ["day"], negate=True).withColumn("has_games", F.lit(False))
    return played.unionByName(none)


# ---------------------------------------------------------------- J4 dependent key lookup
def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    requests = o.select(F.to_date("o_orderdate").alias("game_date"),
                        _code((F.col("o_custkey") % 30).cast("int")).alias("home_team")).distinct()
    pages = li.select(page_key(F.col("l_shipdate"), _code((F.col("l_suppkey") % 30).cast("int")))
                      .alias("page_key"), "l_orderkey", "l_linenumber")
    return lookup_by_key(requests, pages, page_key("game_date", "home_team"), "page_key")


# ---------------------------------------------------------------- SC6 SC7 J5 forum landing
def _land_forum(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Render conversations as forum dumps (turn 0 = post, later turns = comments whose
    parent is the previous turn) and land them as JSON lines."""
    conv = table(spark, sf, "conversations")
    root = scratch_path(spark, "forum")
    permalink = F.concat(F.lit("/r/nba/comments/"), F.col("conv_id").cast("string"))
    (conv.where(F.col("turn") == 0)
     .select(F.col("conv_id").alias("feed_rank"), F.col("text").alias("title"),
             F.length("text").cast("long").alias("score"),
             F.col("conv_id").cast("string").alias("id"),
             F.concat(F.lit("https://example.com/"), F.col("conv_id").cast("string")).alias("url"),
             permalink.alias("permalink"), F.lit(0).cast("long").alias("num_comments"),
             F.col("text").alias("selftext"))
     .write.json(f"{root}/posts"))
    cid = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))  # noqa
    (conv.where(F.col("turn") >= 1)
     .select(F.concat(F.lit("https://www.reddit.com"), permalink).alias("post_url"),
             cid(F.col("turn")).alias("comment_id"), cid(F.col("turn") - 1).alias("parent_id"),
             F.col("turn").alias("row_idx"), F.col("role").alias("author"),
             F.col("text").alias("body"), (F.length("text") % 17).cast("long").alias("score"),
             F.lit(None).cast("string").alias("author_flair_css_class"),
             F.col("role").alias("author_flair_text"),
             F.when(F.col("turn") % 2 == 0, F.lit("false")).otherwise(F.lit("1700000000"))
             .alias("edited"),
             (F.col("role") == "system").alias("is_stub"))
     .write.json(f"{root}/comments"))
    return f"{root}/posts", f"{root}/comments"


def comment_flatten(spark: SparkSession, sf: str) -> DataFrame:
    posts_path, comments_path = _land_forum(spark, sf)
    landed = read_posts(spark, posts_path)      # comments of every post; the top-27 pick is ``top_posts``' own
    every = landed.select(F.concat(F.lit(POST_URL_PREFIX), F.col("permalink")).alias("reddit_url"))
    c = comments_of_posts(read_comments(spark, comments_path), every)
    return c.select("url", "comment_id", "parent_id", "author", F.col("body").alias("comment"),
                    "score")


def _land_trees(spark: SparkSession, sf: str) -> str:
    """Render conversations as nested dumps: a turn answers the latest odd turn before it (the post,
    if there is none), so odd turns nest and even turns are their leaves; a stub ends each listing."""
    conv = table(spark, sf, "conversations").where(F.col("turn") >= 1)
    listing = '{"kind":"Listing","data":{"children":['
    stub = '{"kind":"more","data":{"count":2,"id":"_"}}]}}'
    data = F.to_json(F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
        F.col("role").alias("author"), F.col("text").alias("body"), (F.length("text") % 17).cast("long").alias("score")))
    opened = F.concat(F.lit('{"kind":"t1","data":'), F.substr(data, F.lit(1), F.length(data) - 1), F.lit(',"replies":'))
    odd = F.col("turn") % 2 == 1
    piece = F.concat(opened, F.when(odd, F.lit(listing)).otherwise(F.lit('""}},')))
    whole = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", piece.alias("piece")))).alias("pieces"),
                                        F.count_if(odd).cast("int").alias("odd"))
    tree = F.concat(F.lit(listing), F.array_join(F.col("pieces.piece"), ""), F.repeat(F.lit(stub + "}},"), F.col("odd")), F.lit(stub))
    path = scratch_path(spark, "forum-trees")
    (whole.select(F.concat(F.lit(POST_URL_PREFIX + "/r/nba/comments/"), F.col("conv_id").cast("string")).alias("post_url"), tree.alias("comments"))
     .write.json(path))
    return path


def comment_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Nested replies to any depth, flattened level by level, "load more" stubs dropped."""
    c = flatten_trees(read_comment_trees(spark, _land_trees(spark, sf)))
    return c.select(F.col("post_url").alias("url"), "comment_id", "parent_id", "author", F.col("body").alias("comment"), "score",
                    "depth", F.array_join(F.transform("path", lambda p: p.cast("string")), ".").alias("place"))


# ---------------------------------------------------------------- S23 sentiment
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations", spread=True).select("conv_id", "turn", "text")
    return score_sentiment(conv, ["conv_id", "turn"], "text", seed_lexicon(spark))


# ---------------------------------------------------------------- D-comm composition
def comment_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Comments of the top posts: deleted authors dropped, the highest-scored copy of each
    (author, comment, url) kept, scored for sentiment, edited flag, md5 key."""
    from courtline.functions import md5_key
    from courtline.operators import keep_last_per_key, not_equal_keep_null

    posts_path, comments_path = _land_forum(spark, sf)
    landed = read_posts(spark, posts_path)      # comments of every post; the top-27 pick is ``top_posts``' own
    every = landed.select(F.concat(F.lit(POST_URL_PREFIX), F.col("permalink")).alias("reddit_url"))
    c = comments_of_posts(read_comments(spark, comments_path), every)
    c = c.select("author", F.col("body").alias("comment"), "score", "url",
                 F.col("author_flair_css_class").alias("flair1"),
                 F.col("author_flair_text").alias("flair2"), "edited", "row_idx")
    c = c.where(not_equal_keep_null("author", "None") & F.col("author").isNotNull())
    c = keep_last_per_key(c, ["author", "comment", "url"], ["score", "row_idx"])
    scored = score_sentiment(c, ["author", "comment", "url"], "comment", seed_lexicon(spark))
    out = c.join(scored, ["author", "comment", "url"], "inner")
    return out.select(
        "author", "comment", "score", "url", "flair1", "flair2",
        F.when(F.coalesce(F.col("edited"), F.lit("false")) == "false", 0).otherwise(1)
        .alias("edited"),
        "compound", "neg", "neu", "pos", "sentiment",
        md5_key("author", "comment", "url").alias("md5_pk"))


# ---------------------------------------------------------------- SC10 F12 log scan
def _land_log(spark: SparkSession, sf: str) -> str:
    ev = table(spark, sf, "events")
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    msg = F.when(F.col("event_type") == "error", F.concat(
        F.lit("Failed to process event "), F.col("event_id").cast("string"), F.lit(" for user "),
        F.col("user_id").cast("string"))).otherwise(F.concat(
            F.lit("Processed "), F.col("event_type"), F.lit(" event "),
            F.col("event_id").cast("string")))
    line = F.concat(F.lit("["), level, F.lit("] "),
                    F.date_format("ts", "yyyy-MM-dd hh:mm:ss a"), F.lit(" "), msg)
    path = scratch_path(spark, "logs")
    ev.select(line.alias("value")).write.text(path)
    return path


def log_failures(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_log_lines(spark, _land_log(spark, sf))
    return lines.where(F.col("errors").contains("Failed"))


def error_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Failure lines with the failure count of their day (the digest's header figure).  The
    day count is a partial aggregate joined back on the day, not a global window."""
    failed = log_failures(spark, sf).withColumn("digest_date", F.substring("errors", 9, 10))
    counts = failed.groupBy("digest_date").agg(F.count(F.lit(1)).alias("n_errors"))
    return failed.join(counts, "digest_date").select("digest_date", "n_errors", "errors")


# ---------------------------------------------------------------- R1 R3 A5 flags and metrics
_DATASET_TABLES = [  # (dataset, flag, input table)
    ("player_boxscores", "boxscores", "lineitem"), ("game_odds", "odds", "orders"),
    ("player_pbp", "pbp", "events"), ("reddit_comments", "reddit_comments", "conversations"),
    ("reddit_posts", "reddit_posts", "documents"), ("injuries", "injuries", "customer"),
    ("transactions", "transactions", "part"), ("player_stats", "stats", "supplier"),
    ("fake_feed", "fake", "nation")]


def flag_gate(spark: SparkSession, sf: str) -> DataFrame:
    counts = None
    for name, flag, tbl in _DATASET_TABLES:
        c = table(spark, sf, tbl).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("dataset"), F.lit(flag).alias("flag"), "n")
        counts = c if counts is None else counts.unionByName(c)
    g = gate_relational(counts, F.broadcast(flags_table(spark)))
    return g.select("dataset", "flag", "gate",
                    F.when(F.col("gate") == "enabled", F.col("n")).otherwise(F.lit(0))
                    .cast("long").alias("rows"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from courtline.operators import require_columns
    from courtline.plans.queries_core import keep_latest_per_key
    from courtline.plans.queries_text import md5_key_q, top_posts

    specs = [
        DatasetSpec("latest_events", "pbp", lambda: keep_latest_per_key(spark, sf)),
        DatasetSpec("comment_keys", "reddit_comments", lambda: md5_key_q(spark, sf)),
        DatasetSpec("top_posts", "reddit_posts", lambda: top_posts(spark, sf)),
        DatasetSpec("bad_schema", "stats",
                    lambda: require_columns(table(spark, sf, "supplier"), ["pts"])),
        DatasetSpec("fake_feed", "fake", lambda: table(spark, sf, "nation")),
    ]
    m = run_datasets(spark, specs, FeatureFlags.load(flags_table(spark)), RUN_DATE)
    return m.select("dataset", "flag", "status", "rows")


# ---------------------------------------------------------------- R4 backfill over many dates
BACKFILL_DATES = [f"2024-01-{d:02d}" for d in range(1, 32)]


def batch_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Per-day re-computation for a list of run dates in one job: each day's purchases are
    forward-filled within (user, day), as a per-date rerun would."""
    from courtline.operators import fill_zero, forward_fill, minute_bucket

    dates = backfill_dates(BACKFILL_DATES)
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    ev = ev.where(F.col("day").isin(dates))
    d = ev.select("day", "event_id", "user_id", "ts",
                  F.when(F.col("event_type") == "purchase", F.col("value")).alias("day_purchase"))
    d = forward_fill(d, ["user_id", "day"], ["ts", "event_id"], ["day_purchase"],
                     bucket=minute_bucket("ts"))
    return fill_zero(d, ["day_purchase"])


# ---------------------------------------------------------------- U4 P9 W1 W2 S22 scores
def pbp_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Play-by-play score handling on event rows: a score cell ``away-home`` is split once,
    coerced (junk such as a jump-ball text becomes null), carried forward within the game
    (a user's events, skew-proof by minute buckets), zero before the first score, margin home-away."""
    from courtline.operators import fill_zero, forward_fill, minute_bucket, split_fixed

    ev = table(spark, sf, "events")
    score = (F.when(F.col("event_type") == "purchase",
                    F.concat(F.floor("value").cast("string"), F.lit("-"),
                             F.floor(F.col("value") * 1.5).cast("string")))
             .when(F.col("event_type") == "signup", F.lit("Jump ball: A vs. B")))
    d = ev.select("event_id", "user_id", "ts", score.alias("score"))
    d = d.select("*", *split_fixed("score", "-", ["scoreaway", "scorehome"]))
    d = d.withColumns({c: F.col(c).try_cast("double") for c in ("scoreaway", "scorehome")})
    d = forward_fill(d, ["user_id"], ["ts", "event_id"], ["scoreaway", "scorehome"],
                     bucket=minute_bucket("ts"))
    d = fill_zero(d, ["scoreaway", "scorehome"])
    return d.withColumn("marginscore", F.col("scorehome") - F.col("scoreaway"))


# ---------------------------------------------------------------- SK7 A11 uniqueness check
def duplicate_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that occur more than once (the check run before publishing a keyed table)."""
    from courtline.operators import duplicate_keys

    docs = table(spark, sf, "documents").select(F.md5("text").alias("text_md5"))
    return duplicate_keys(docs, ["text_md5"]).withColumnRenamed("count", "n")


# ---------------------------------------------------------------- SC12 CSV / JSON scans
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    from courtline.sources import read_csv

    cust = table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    cust.write.option("header", True).csv(path)
    return read_csv(spark, path, cust.schema)


def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-line texts with quotes survive a JSON-lines landing and a declared-schema read."""
    from courtline.sources import read_json

    conv = table(spark, sf, "conversations")
    path = scratch_path(spark, "json")
    conv.write.json(path)
    return read_json(spark, path, conv.schema)


QUERIES = {
    "pbp_scores": pbp_scores,
    "duplicate_keys": duplicate_keys_q,
    "csv_scan": csv_scan,
    "json_scan": json_scan,
    "html_table_scan": html_table_scan,
    "html_list_scan": html_list_scan,
    "snapshot_append": snapshot_append,
    "archive_roundtrip": archive_roundtrip,
    "store_upsert": store_upsert,
    "away_join": away_join,
    "exists_on_date": exists_on_date,
    "key_lookup": key_lookup,
    "comment_flatten": comment_flatten,
    "comment_tree": comment_tree,
    "sentiment": sentiment,
    "comment_pipeline": comment_pipeline,
    "log_failures": log_failures,
    "error_digest": error_digest,
    "flag_gate": flag_gate,
    "run_metrics": run_metrics,
    "batch_backfill": batch_backfill,
}


# ---------------------------------------------------------------- SQL twins
def _sql_list(xs) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


_LEX_SQL = ", ".join(f"('{k}', CAST({round(v * POINT)} AS BIGINT))" for k, v in SEED_LEXICON.items())
_PUNCT_SQL = _PUNCT.replace("'", "''")


def sentiment_sql(src: str, ids: list[str], text: str) -> str:
    """CTE chain scoring ``src`` (a relation with ``ids`` and ``text``); ends in ``scored``."""
    idl = ", ".join(ids)

    def before(d: int, c: str) -> str:
        return f"CASE WHEN i > {d} THEN {c}[i - {d}] END"

    def boosted(d: int, w: int) -> str:
        loud = f"CASE WHEN differs AND coalesce({before(d, 'loud')}, false) THEN {CAPITALS} ELSE 0 END"
        return (f"{w} * CASE WHEN {before(d, 'low')} IN {_sql_list(BOOSTERS_UP)} THEN {BOOST} + {loud} "
                f"WHEN {before(d, 'low')} IN {_sql_list(BOOSTERS_DOWN)} THEN {-BOOST} + {loud} ELSE 0 END")

    negated = " OR ".join(f"coalesce({before(d, 'low')} IN {_sql_list(NEGATORS)}, false)" for d in (1, 2, 3))
    boost = " + ".join(boosted(d, w) for d, w in zip((1, 2, 3), DAMPING))
    asks = f"(length({text}) - length(replace({text}, '?', '')))"
    return f"""
lex(token, valence) AS (VALUES {_LEX_SQL}),
sr AS (
  SELECT {idl}, list_filter(list_transform(string_split_regex({text}, '[ \\t\\n\\r\\f\\v]+'),
           lambda t: regexp_replace(t, '{_PUNCT_SQL}', '', 'g')), lambda t: t <> '') AS toks,
    least(length({text}) - length(replace({text}, '!', '')), 4) * {EXCLAMATION}
      + CASE WHEN {asks} > 3 THEN {QUESTIONS} WHEN {asks} > 1 THEN {asks} * {QUESTION} ELSE 0 END AS marks
  FROM {src}),
sl AS (
  SELECT *, list_transform(toks, lambda t: lower(t)) AS low,
    list_transform(toks, lambda t: t = upper(t) AND t <> lower(t)) AS loud FROM sr),
sd AS (
  SELECT *, coalesce(list_position(low, 'but'), 0) AS but, list_contains(loud, false) AS differs FROM sl),
st AS (
  SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM sd),
sc AS (
  SELECT {idl}, marks, low[i] AS token, CASE WHEN {negated} THEN {NEGATION} ELSE 100 END AS negation,
    CASE WHEN but = 0 OR i = but THEN 2 WHEN i < but THEN {CONTRAST[0]} ELSE {CONTRAST[1]} END AS contrast,
    CAST({boost} + CASE WHEN differs AND loud[i] THEN {CAPITALS * DAMPING[0]} ELSE 0 END AS BIGINT) AS boost FROM st),
sv AS (
  SELECT sc.*, CASE WHEN coalesce(lex.valence, 0) = 0 THEN 0
    ELSE (lex.valence + CASE WHEN lex.valence > 0 THEN boost ELSE -boost END) * negation * contrast END AS s
  FROM sc LEFT JOIN lex ON sc.token = lex.token),
su AS (
  SELECT {idl}, max(marks) AS marks, sum(s) AS s, coalesce(sum(s + {WHOLE}) FILTER (WHERE s > 0), 0) AS p,
    coalesce(sum({WHOLE} - s) FILTER (WHERE s < 0), 0) AS n, count(*) FILTER (WHERE s = 0) AS z
  FROM sv GROUP BY {idl}),
sa AS (
  SELECT {idl}, CAST(s + CASE WHEN s > 0 THEN marks WHEN s < 0 THEN -marks ELSE 0 END AS DOUBLE) / {WHOLE} AS sum_s,
    CAST(p + CASE WHEN p > n THEN marks ELSE 0 END AS DOUBLE) / {WHOLE} AS pos_sum,
    CAST(n + CASE WHEN p < n THEN marks ELSE 0 END AS DOUBLE) / {WHOLE} AS neg_sum,
    CAST(z AS DOUBLE) AS neu_n FROM su),
sb AS (
  SELECT {", ".join("sd." + i for i in ids)}, sa.sum_s, coalesce(sa.pos_sum, 0.0) AS pos_sum,
    coalesce(sa.neg_sum, 0.0) AS neg_sum, coalesce(sa.neu_n, 0.0) AS neu_n,
    sa.sum_s IS NULL AS no_tokens
  FROM sd LEFT JOIN sa ON {" AND ".join(f"sd.{i} IS NOT DISTINCT FROM sa.{i}" for i in ids)}),
scored AS (
  SELECT {idl},
    CASE WHEN no_tokens THEN 0.0
         ELSE least(1.0, greatest(-1.0, sum_s / sqrt(sum_s * sum_s + {NORM_ALPHA}))) END
      AS compound,
    CASE WHEN pos_sum + neg_sum + neu_n > 0 THEN neg_sum / (pos_sum + neg_sum + neu_n)
         ELSE 0.0 END AS neg,
    CASE WHEN pos_sum + neg_sum + neu_n > 0 THEN neu_n / (pos_sum + neg_sum + neu_n)
         ELSE 0.0 END AS neu,
    CASE WHEN pos_sum + neg_sum + neu_n > 0 THEN pos_sum / (pos_sum + neg_sum + neu_n)
         ELSE 0.0 END AS pos
  FROM sb)"""


_FORUM_SQL = """
  top_conv AS (SELECT conv_id FROM conversations WHERE turn = 0 ),
  com AS (
    SELECT 'https://www.reddit.com/r/nba/comments/' || CAST(c.conv_id AS VARCHAR) AS url,
      CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn AS VARCHAR) AS comment_id,
      CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn - 1 AS VARCHAR) AS parent_id,
      c.turn AS row_idx, c.role AS author, c.text AS comment,
      CAST(length(c.text) % 17 AS BIGINT) AS score, c.role AS flair2,
      CASE WHEN c.turn % 2 = 0 THEN 0 ELSE 1 END AS edited
    FROM conversations c JOIN top_conv t ON c.conv_id = t.conv_id
    WHERE c.turn >= 1 AND NOT coalesce(c.role = 'system', false))"""

ORACLE = {
    "pbp_scores": """
WITH d AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_type = 'purchase'
           THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '-'
                || CAST(CAST(floor(value * 1.5) AS BIGINT) AS VARCHAR)
         WHEN event_type = 'signup' THEN 'Jump ball: A vs. B' END AS score
  FROM events),
s AS (
  SELECT *,
    TRY_CAST(CASE WHEN strpos(score, '-') > 0 THEN substr(score, 1, strpos(score, '-') - 1)
                  ELSE score END AS DOUBLE) AS a,
    TRY_CAST(CASE WHEN strpos(score, '-') > 0 THEN substr(score, strpos(score, '-') + 1) END
             AS DOUBLE) AS h
  FROM d),
f AS (
  SELECT event_id, user_id, ts, score,
    coalesce(last_value(a IGNORE NULLS) OVER w, 0) AS scoreaway,
    coalesce(last_value(h IGNORE NULLS) OVER w, 0) AS scorehome
  FROM s
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT *, scorehome - scoreaway AS marginscore FROM f
""",
    "duplicate_keys": """
SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1
""",
    "csv_scan": "SELECT * FROM customer",
    "json_scan": "SELECT * FROM conversations",
    "html_table_scan": """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
  CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
    || lpad(CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS price,
  l_returnflag || ' & ' || l_linestatus AS flag,
  'LinePrice' AS price_header, 'Order' AS last_level, 5 AS n_td
FROM lineitem
""",
    "html_list_scan": """
WITH s AS (
  SELECT page_id,
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS t,
    regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS h
  FROM pages)
SELECT page_id, 0 AS ul_idx, CAST(unnest(range(0, len(t))) AS INTEGER) AS li_idx,
  CAST(NULL AS VARCHAR) AS date, 0 AS n_items, unnest(t) AS text, unnest(h) AS href
FROM s
""",
    "snapshot_append": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
""",
    "archive_roundtrip": """
SELECT o_orderkey, o_totalprice, '2024' AS year, '01' AS month, '2024-01-31' AS run_date
FROM orders
""",
    "store_upsert": """
WITH tgt AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
  WHERE c_mktsegment <> 'BUILDING'),
b AS (
  SELECT c_custkey, c_name, c_nationkey, greatest(c_acctbal, 0.0) AS c_acctbal, c_mktsegment
  FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'),
ch AS (
  SELECT b.*, true AS present FROM b LEFT JOIN tgt t ON b.c_custkey = t.c_custkey
  WHERE t.c_name IS NULL
     OR coalesce(b.c_name <> t.c_name, true) OR coalesce(b.c_nationkey <> t.c_nationkey, true)
     OR coalesce(b.c_acctbal <> t.c_acctbal, true)
     OR coalesce(b.c_mktsegment <> t.c_mktsegment, true))
SELECT CASE WHEN c.present THEN c.c_custkey ELSE t.c_custkey END AS c_custkey,
  CASE WHEN c.present THEN c.c_name ELSE t.c_name END AS c_name,
  CASE WHEN c.present THEN c.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
  CASE WHEN c.present THEN c.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN c.present THEN c.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
  CASE WHEN t.c_custkey IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00'
       ELSE TIMESTAMP '2024-01-31 06:00:00' END AS created_at,
  CASE WHEN c.present THEN TIMESTAMP '2024-01-31 06:00:00'
       ELSE TIMESTAMP '2024-01-01 00:00:00' END AS modified_at
FROM tgt t FULL OUTER JOIN ch c ON t.c_custkey = c.c_custkey
""",
    "away_join": f"""
WITH plays AS (
  SELECT l_orderkey AS game_id, l_linenumber, {_CODES_SQL}[(l_orderkey % 30) + 1] AS HomeTeam
  FROM lineitem),
away AS (
  SELECT DISTINCT o_orderkey AS game_id, {_CODES_SQL}[(o_orderkey % 30) + 1] AS HomeTeam,
    {_CODES_SQL}[((o_custkey + 7) % 30) + 1] AS AwayTeam
  FROM orders WHERE o_orderstatus <> 'P')
SELECT p.game_id, p.HomeTeam, p.l_linenumber, a.AwayTeam
FROM plays p JOIN away a ON p.game_id = a.game_id AND p.HomeTeam = a.HomeTeam
""",
    "exists_on_date": """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT day, EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = days.day)
  AS has_games
FROM days
""",
    "key_lookup": f"""
WITH req AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS game_date,
    {_CODES_SQL}[(o_custkey % 30) + 1] AS home_team FROM orders),
pg AS (
  SELECT strftime(l_shipdate, '%Y%m%d') || '0' || {_CODES_SQL}[(l_suppkey % 30) + 1] AS page_key,
    l_orderkey, l_linenumber FROM lineitem)
SELECT r.game_date, r.home_team, pg.page_key, pg.l_orderkey, pg.l_linenumber
FROM req r JOIN pg ON strftime(r.game_date, '%Y%m%d') || '0' || r.home_team = pg.page_key
""",
    "comment_flatten": "WITH" + _FORUM_SQL + """
SELECT url, comment_id, parent_id, author, comment, score FROM com
""",
    "comment_tree": """
WITH RECURSIVE c AS (
  SELECT *, max(CASE WHEN turn % 2 = 1 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent
  FROM conversations WHERE turn >= 1),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, parent ORDER BY turn) - 1 AS pos FROM c),
t AS (
  SELECT conv_id, turn, parent, role, text, 1 AS depth, CAST(pos AS VARCHAR) AS place FROM p WHERE parent IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, p.parent, p.role, p.text, t.depth + 1, t.place || '.' || CAST(p.pos AS VARCHAR)
  FROM t JOIN p ON p.conv_id = t.conv_id AND p.parent = t.turn)
SELECT 'https://www.reddit.com/r/nba/comments/' || CAST(conv_id AS VARCHAR) AS url,
  CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS comment_id,
  CAST(conv_id AS VARCHAR) || '_' || CAST(parent AS VARCHAR) AS parent_id,
  role AS author, text AS comment, CAST(length(text) % 17 AS BIGINT) AS score, depth, place
FROM t
""",
    "sentiment": "WITH" + sentiment_sql("conversations", ["conv_id", "turn"], "text") + """
SELECT conv_id, turn, compound, neg, neu, pos,
  CASE WHEN compound > 0 THEN 1 ELSE 0 END AS sentiment
FROM scored
""",
    "comment_pipeline": "WITH" + _FORUM_SQL + """,
  kept AS (
    SELECT * FROM com WHERE author IS DISTINCT FROM 'None' AND author IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY author, comment, url
                               ORDER BY score DESC, row_idx DESC) = 1),""" + sentiment_sql(
        "kept", ["author", "comment", "url"], "comment") + """
SELECT k.author, k.comment, k.score, k.url, CAST(NULL AS VARCHAR) AS flair1, k.flair2, k.edited,
  s.compound, s.neg, s.neu, s.pos, CASE WHEN s.compound > 0 THEN 1 ELSE 0 END AS sentiment,
  md5(coalesce(k.author, 'None') || coalesce(k.comment, 'None') || coalesce(k.url, 'None'))
    AS md5_pk
FROM kept k JOIN scored s ON k.author = s.author AND k.comment = s.comment AND k.url = s.url
""",
    "log_failures": """
SELECT '[ERROR] ' || strftime(ts, '%Y-%m-%d %I:%M:%S %p') || ' Failed to process event '
  || CAST(event_id AS VARCHAR) || ' for user ' || CAST(user_id AS VARCHAR) AS errors
FROM events WHERE event_type = 'error'
""",
    "error_digest": """
WITH f AS (
  SELECT '[ERROR] ' || strftime(ts, '%Y-%m-%d %I:%M:%S %p') || ' Failed to process event '
    || CAST(event_id AS VARCHAR) || ' for user ' || CAST(user_id AS VARCHAR) AS errors,
    strftime(ts, '%Y-%m-%d') AS digest_date
  FROM events WHERE event_type = 'error')
SELECT digest_date, count(*) OVER (PARTITION BY digest_date) AS n_errors, errors FROM f
""",
    "flag_gate": """
SELECT * FROM (VALUES
  ('player_boxscores', 'boxscores', 'enabled', (SELECT count(*) FROM lineitem)),
  ('game_odds', 'odds', 'enabled', (SELECT count(*) FROM orders)),
  ('player_pbp', 'pbp', 'enabled', (SELECT count(*) FROM events)),
  ('reddit_comments', 'reddit_comments', 'enabled', (SELECT count(*) FROM conversations)),
  ('reddit_posts', 'reddit_posts', 'enabled', (SELECT count(*) FROM documents)),
  ('injuries', 'injuries', 'enabled', (SELECT count(*) FROM customer)),
  ('transactions', 'transactions', 'enabled', (SELECT count(*) FROM part)),
  ('player_stats', 'stats', 'enabled', (SELECT count(*) FROM supplier)),
  ('fake_feed', 'fake', 'disabled', 0)) AS t(dataset, flag, gate, rows)
""",
    "run_metrics": """
SELECT * FROM (VALUES
  ('latest_events', 'pbp', 'written',
     (SELECT count(DISTINCT user_id) FROM events WHERE user_id IS NOT NULL)),
  ('comment_keys', 'reddit_comments', 'written', (SELECT count(*) FROM conversations)),
  ('top_posts', 'reddit_posts', 'written', (SELECT least(count(*), 27) FROM documents)),
  ('bad_schema', 'stats', 'failed', 0),
  ('fake_feed', 'fake', 'disabled', 0)) AS t(dataset, flag, status, rows)
""",
    "batch_backfill": """
SELECT CAST(ts AS DATE) AS day, event_id, user_id, ts,
  coalesce(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS day_purchase
FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
""",
}

