"""Forum landing data: posts and flattened comment trees, read from JSON lines.

The forum client is not part of this engine; its dumps land as JSON.  Posts carry their
feed rank.  Comments land in either of two shapes:

* flat, one row per comment with the url of their post and the id of their parent (a tree
  flattened by the dump): ``read_comments``;
* nested, one line per post with its listing of comments, each of which may hold a listing
  of replies, to any depth: ``read_comment_trees`` and ``flatten_trees``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.dates import ts_ntz_lit
from courtline.session import scratch_path

# Fixed value: prefix turning a permalink into a post url.
POST_URL_PREFIX = "https://www.reddit.com"
# Fixed value: posts kept per run (the "hot" feed depth).
TOP_POSTS = 27

POST_SCHEMA = T.StructType([
    T.StructField("feed_rank", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("selftext", T.StringType()),
])

COMMENT_SCHEMA = T.StructType([
    T.StructField("post_url", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("author_flair_css_class", T.StringType()),
    T.StructField("author_flair_text", T.StringType()),
    T.StructField("edited", T.StringType()),       # false, or the edit epoch as text
    T.StructField("is_stub", T.BooleanType()),     # "load more comments" placeholder
])

TREE_SCHEMA = T.StructType([
    T.StructField("post_url", T.StringType()),
    T.StructField("comments", T.StringType()),      # the listing, as JSON text
])

# Kinds of a listing's children, a comment and a "load more comments" stub.
COMMENT_KIND, STUB_KIND = "t1", "more"

#: One level of a listing; the replies stay text until the next level reads them.
LISTING_SCHEMA = T.StructType([T.StructField("data", T.StructType([T.StructField("children", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("author_flair_css_class", T.StringType()),
        T.StructField("author_flair_text", T.StringType()),
        T.StructField("edited", T.StringType()),
        T.StructField("replies", T.StringType()),   # a listing, or an empty text
    ])),
])))]))])


def posts(raw: DataFrame, run_date: dt.date, run_ts: dt.datetime,
          limit: int = TOP_POSTS) -> DataFrame:
    """Top ``limit`` posts by feed rank, projected to the post dataset columns."""
    top = raw.orderBy(F.col("feed_rank"), F.col("id")).limit(limit)
    return top.select(
        "title", "score", "id", "url",
        F.concat(F.lit(POST_URL_PREFIX), F.col("permalink")).alias("reddit_url"),
        "num_comments", F.col("selftext").alias("body"),
        F.lit(run_date).alias("scrape_date"),
        ts_ntz_lit(run_ts).alias("scrape_time"))


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POST_SCHEMA).json(path)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMENT_SCHEMA).json(path)


def read_comment_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).json(path)


def flatten_trees(trees: DataFrame) -> DataFrame:
    """Every comment of the trees: the columns of COMMENT_SCHEMA, ``depth`` (1: a comment on the
    post) and ``path`` (places among the siblings from the top, stubs not counted).

    One level a round: the frontier's listings are unfolded in place (no shuffle), the comments are
    written with the replies as text, and those that have replies are the next frontier.  A round
    reads only what is left below its level, and the rounds end with the deepest reply, so a hot
    post is dealt over as many rows as it has comments.  Stubs are dropped.  ``row_idx`` is null:
    the order "level by level, siblings as they stand" is that of (depth, path).  A null, empty or
    unreadable listing holds no comments; a child without data is none; repeated posts are read
    as often as they land."""
    spark = trees.sparkSession
    root = scratch_path(spark, "comment-levels")
    frontier = trees.select("post_url", F.lit(None).cast("string").alias("parent_id"),
                            F.array().cast("array<bigint>").alias("path"), F.col("comments").alias("listing"))
    depth = 0
    while True:
        depth += 1
        children = F.filter(F.from_json("listing", LISTING_SCHEMA)["data"]["children"],
                            lambda c: (c["kind"] == COMMENT_KIND) & c["data"].isNotNull())
        level = frontier.select("post_url", "parent_id", "path", F.posexplode(children).alias("place", "child"))
        c = F.col("child.data")
        level = level.select(
            "post_url", c["id"].alias("comment_id"), "parent_id", F.lit(None).cast("bigint").alias("row_idx"),
            *[c[n].alias(n) for n in ("author", "body", "score", "author_flair_css_class", "author_flair_text", "edited")],
            F.lit(False).alias("is_stub"), F.lit(depth).alias("depth"),
            F.concat("path", F.array(F.col("place").cast("bigint"))).alias("path"),
            F.when(F.ltrim(c["replies"]).startswith("{"), c["replies"]).alias("replies"))
        at = f"{root}/level-{depth:05d}"
        level.write.parquet(at)
        frontier = (spark.read.schema(level.schema).parquet(at).where(F.col("replies").isNotNull())
                    .select("post_url", F.col("comment_id").alias("parent_id"), "path", F.col("replies").alias("listing")))
        if frontier.isEmpty():
            break
    return spark.read.schema(level.schema).parquet(f"{root}/level-*").drop("replies")


def reading_order(comments: DataFrame) -> Column:
    """Place of a comment among those of its post: its row for flat comments, level by level for trees."""
    flat = F.col("row_idx")
    if "path" not in comments.columns:
        return F.struct(F.lit(0).alias("depth"), F.array(flat).alias("path"))
    return F.struct(F.col("depth"), F.col("path"))


def comments_of_posts(comments: DataFrame, post_df: DataFrame) -> DataFrame:
    """Comments of the selected posts only ("load more" stubs dropped), with the post url
    carried as ``url``: one semi-join on the url instead of a loop over posts."""
    c = comments.where(~F.coalesce(F.col("is_stub"), F.lit(False)))
    keep = post_df.select(F.col("reddit_url").alias("post_url"))
    return c.join(keep, "post_url", "left_semi").withColumnRenamed("post_url", "url")
