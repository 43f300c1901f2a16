"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

A source's target is its share of the mix: ``share`` times all words, dealt by weight, at most
``cap`` times the source's own words; what a full source leaves goes to the others by weight.
A target of more than the source's words takes every document once (or twice), and the rest
of the target from the documents with the smallest hashes.  The threshold on the hash is
found without sorting: words are summed by source and the hash's top bits, the bucket in which
the running sum passes the budget is found, and only that bucket is summed again by its next
bits; within the last bucket the running sum goes hash by hash.  Thresholds are nested: a
larger budget takes a superset.

Sizes are words (runs of characters other than ASCII blanks).  Null text: size 0.  Null
source: a source of its own, last.  A document is hashed by its id (null: the empty text), its
text and, in ``mix``, its number among the rows equal in both, so rows that share an id are taken
or left one by one; ``mixed`` takes rows equal in id and text together.  Empty table: no rows; a
mix without words takes none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import written

WORDS = r"[^\x20\x09-\x0D]+"
BITS, LEVEL_BITS = 60, 12           # bits of the hash; bits of one histogram level
BROADCAST_SOURCES = 10_000          # rows of a per-source table that may be broadcast
SALTS = 64                          # copies of it beyond that
CHUNK = 10_000                      # equal rows numbered in one go
WEIGHTS = (5, 2, 1)


def hash60(col: Column) -> Column:
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def content(id_col: str, text_col: str) -> Column:
    """Digest of a document's id and text."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary"))


def hash_of(key: Column, number: Column) -> Column:
    """Hash of one of the rows with this digest."""
    return hash60(F.concat(key, F.lit("|"), number.cast("string")))


def targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """Per source (source, source_size): weight and target.  With the sources in the order in
    which they fill up, the level that fits the unfilled ones is the largest of the levels
    'what is left / the weights left' along that order."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    w = w.withColumn("most", F.col("source_size") * cap).withColumn("fills", F.col("most") / F.col("weight"))
    order = Window.orderBy("fills", F.col("source").isNull(), "source")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    w = w.withColumn("level", left / F.sum("weight").over(later))
    return w.select("source", "source_size", "weight", F.least("most", F.col("weight") * F.max("level").over(everything)).alias("target"))


def _by_source(rows: DataFrame, small: DataFrame, few: bool, how: str, *also: str) -> DataFrame:
    """Join the rows with a table of one row per source without gathering a source's rows:
    broadcast when it is known to be short, else salted."""
    right = small.withColumnRenamed("source", "r_source")
    for c in also:
        right = right.withColumnRenamed(c, f"r_{c}")
    on = F.col("source").eqNullSafe(F.col("r_source"))
    for c in also:
        on = on & (F.col(c) == F.col(f"r_{c}"))
    if few:
        right = F.broadcast(right)
    else:
        rows = rows.withColumn("salt", F.col("h") % SALTS)
        right = right.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = on & (F.col("salt") == F.col("r_salt"))
    return rows.join(right, on, how).drop("r_source", "r_salt", "salt", *(f"r_{c}" for c in also))


def thresholds(rows: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """Per source the largest hash taken, from rows (source, h, size) and (source, budget):
    the taken sizes come as near to the budget as whole hashes allow."""
    below = budgets.select("source", "budget", F.lit(0).cast("long").alias("under"))
    inside, shift = rows, BITS
    while shift > LEVEL_BITS * 3:
        shift -= LEVEL_BITS
        bucket = F.shiftright("h", shift)
        run = Window.partitionBy("source").orderBy("bucket")
        hist = (inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))   # at most 2^LEVEL_BITS a source
                .withColumn("upto", F.sum("n").over(run)))
        edge = (_by_source(hist.withColumn("h", F.col("bucket")), below, few, "inner").where(F.col("under") + F.col("upto") > F.col("budget"))
                .groupBy("source", "budget", "under").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("e")))
        below = written(edge.select("source", "budget", (F.col("under") + F.col("e.before")).alias("under"), F.col("e.bucket").alias("bucket")), "mix-edge")
        inside = _by_source(inside.withColumn("bucket", bucket), below.select("source", "bucket"), few, "inner", "bucket").drop("bucket")
        below = below.withColumn("first", F.shiftleft("bucket", shift)).drop("bucket")
    run = Window.partitionBy("source").orderBy("h")
    exact = _by_source(inside.groupBy("source", "h").agg(F.sum("size").alias("n")), below, few, "inner")
    exact = exact.withColumn("upto", F.col("under") + F.sum("n").over(run))
    near = F.col("budget") - (F.col("upto") - F.col("n")) > F.col("upto") - F.col("budget")
    return exact.groupBy("source", "first").agg(F.max(F.when((F.col("upto") <= F.col("budget")) | near, F.col("h"))).alias("h")) \
        .select("source", F.coalesce("h", F.col("first") - 1).alias("threshold"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), content(id_col, text_col).alias("key"),
                       F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long").alias("size"))


def numbered(rows: DataFrame, *cols: str) -> DataFrame:
    """The same rows with their ``number`` among equal ones: they are counted (combined before the
    shuffle) and unfolded in chunks that are dealt anew, so a hot row's copies do not meet in one task."""
    same = rows.groupBy(*cols).agg(F.count("*").alias("rows"))
    chunk = same.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / CHUNK))).alias("chunk"))
    number = F.sequence(F.col("chunk") * CHUNK + 1, F.least("rows", (F.col("chunk") + 1) * CHUNK))
    return chunk.repartition("key", "chunk").select(*cols, F.explode(number).alias("number"))


def plan(rows: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> tuple[DataFrame, bool]:
    """Per source: source_size, target, whole (times that every document is taken), threshold
    (hashes up to it once more); and whether the table is known to be short."""
    goal = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, cap, weights), "mix-targets")
    few = goal.count() <= BROADCAST_SOURCES
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    limit = thresholds(rows, goal.select("source", "budget").where("budget > 0"), few).withColumnRenamed("source", "l_source")
    goal = goal.join(limit, F.col("source").eqNullSafe(F.col("l_source")), "left")
    return goal.select("source", "source_size", "target", "whole", "threshold"), few


def _copies() -> Column:
    return (F.col("whole") + F.when(F.col("h") <= F.col("threshold"), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        *, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies`` (how often the mix takes it)."""
    rows = numbered(_sized(docs, id_col, text_col, source_col), "doc_id", "source", "key", "size")
    rows = written(rows.select("doc_id", "source", hash_of(F.col("key"), F.col("number")).alias("h"), "size"), "mix-sizes")
    rows = _by_source(rows, *plan(rows, share, cap, weights), "inner")
    return rows.select("doc_id", "source", "size", "source_size", "target", _copies().alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          *, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, each as often as it is taken; the texts are not shuffled."""
    sized = _sized(docs, id_col, text_col, source_col)
    table, few = plan(written(sized.select("source", hash_of(F.col("key"), F.lit(1)).alias("h"), "size"), "mix-sizes"), share, cap, weights)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(source_col).alias("source"), hash_of(content(id_col, text_col), F.lit(1)).alias("h"))
    rows = _by_source(rows, table.select("source", "whole", "threshold"), few, "inner").select("row", _copies().alias("copies"))
    return rows.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def oracle_sql() -> str:
    """The whole query as DuckDB SQL (sorts every source; the operator does not)."""
    return r"""
WITH n AS (
  SELECT doc_id, source, CAST('0x' || substr(md5(key || '|' || CAST(row_number() OVER (PARTITION BY doc_id, source, key) AS VARCHAR)), 1, 15) AS BIGINT) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key FROM documents)),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM n GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
f AS (SELECT *, 2.0 * source_size AS most, 2.0 * source_size / weight AS fills FROM w),
v AS (SELECT *, (sum(source_size) OVER () * 1.5
         - coalesce(sum(most) OVER (ORDER BY fills, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY fills, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM v),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
b AS (SELECT n.doc_id, n.size, n.h, g.*, target - whole * source_size AS budget FROM n JOIN g ON n.source IS NOT DISTINCT FROM g.source),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY source, h) AS same FROM b)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN upto <= budget OR budget - (upto - same) > upto - budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
