"""Exact top-k search with vector-approximation files.

Equal vectors become one entry with its ``k + 1`` smallest ids: no query can need more of them.
Entries lie in blocks; a block's approximation file holds one byte a component, the cell between
the least and the greatest value of its dimension in the block, and no exact vector.

1. Scan: files and blocks of queries are dealt over tiles, a group of files with a part of the
   queries, so that every query meets every file of its length in one tile.  The cells bound each
   score from below and above; an entry stays if its upper bound reaches the ``k + 1``-th greatest
   lower bound, of its tile first and then of all tiles.
2. Read: only the entries that stay fetch their exact vectors, and the best k are ranked by exact
   integer scores.

So the result is exact whatever the cells lose.  The scan is queries x entries, in tasks that hold a
bounded group of files; what is sent grows with the square root of tasks, files and queries, not with
files times queries.  No vector is broadcast: sizes that Spark estimates after a step in Python or
an explode leave out what these add, and its estimate of a stored vector is a fixed one.

A vector that is null, or holds a null or non-finite component, takes no part, nor does a null id.
Only vectors of equal length are compared.  Ties go to the smaller id.  Rows of equal id are
candidates and queries of their own: a query skips its own row alone, and a repeated query has its
ranks once for each row.  Components are integers after ``floor(scale * x)``, of any size; a score
outside a long is ranked exactly and shown as the nearest long.  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import shuffle_partitions, written
from courtline.llm.jaccard_join import _maybe_wanted

CELLS = 256                 # one byte a component
ENTRIES = 2048              # entries of a block
QUERIES = 256
BLOCK_BYTES = 1 << 18       # long vectors make smaller blocks
TILE_BYTES = 1 << 25        # of the files that a task holds at once
FOUND = 1 << 20             # entries that a task holds for a block of queries
SCALE = 256
LONG = 2 ** 63 - 1
KEY_BYTES = 272             # two components below 2^1032 each, 2^31 of them


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles; infinite where that is beyond a double."""
    with np.errstate(over="ignore"):
        return np.floor(np.asarray(x, float) * scale)


def exact(x: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) as integers of any size; a double of 2^53 or more is an integer itself."""
    return [int(c) * scale if abs(c) >= 2.0 ** 53 else math.floor(c * scale) for c in x.tolist()]


def score(q: np.ndarray, x: np.ndarray, scale: int = SCALE) -> int:
    """The inner product of the integer components."""
    a, b = whole(q, scale), whole(x, scale)
    if np.abs(a).max(initial=0) * max(1, len(a)) < 2.0 ** 31 and np.abs(b).max(initial=0) < 2.0 ** 31:
        return int(a.astype(np.int64) @ b.astype(np.int64))
    return sum(m * n for m, n in zip(exact(q, scale), exact(x, scale), strict=True))


def scores(q: np.ndarray, x: np.ndarray, ends: np.ndarray, scale: int = SCALE) -> list[int]:
    """The scores of many pairs of vectors that lie one after another."""
    a, b = whole(q, scale), whole(x, scale)
    if np.abs(a).max(initial=0) * max(1, np.diff(ends).max(initial=0)) < 2.0 ** 31 and np.abs(b).max(initial=0) < 2.0 ** 31:
        sums = np.concatenate([[0], np.cumsum(a.astype(np.int64) * b.astype(np.int64))])    # differences hold beyond an overflow
        return (sums[ends[1:]] - sums[ends[:-1]]).tolist()
    return [score(q[i:j], x[i:j], scale) for i, j in zip(ends[:-1], ends[1:], strict=True)]


def approximated(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, and each dimension's first edge and cell width."""
    with np.errstate(all="ignore"):
        low = x.min(0)
        width = np.maximum((x.max(0) - low) / CELLS, 1e-300)
        return np.clip(np.nan_to_num((x - low) / width), 0, CELLS - 1).astype(np.uint8), low, width


def margins(q: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half of what lies between a query's bounds, and its score of the cells 0."""
    size = np.abs(q)
    most = np.abs(low) + (CELLS + 1) * width
    half = size @ (width * (0.5 + 1e-9) + most * 1e-14)
    half += (size @ most) * (q.shape[1] + 8) * 1e-15 + 1e-300           # rounding of the sums
    return half, q @ (low + width / 2)


def bounds(q: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores [query, entry]."""
    with np.errstate(all="ignore"):
        half, start = margins(q, low, width)
        middle = (q * width) @ cells.T.astype(float) + start[:, None]
        lower, upper = middle - half[:, None], middle + half[:, None]
    unsure = ~(np.isfinite(lower) & np.isfinite(upper))
    lower[unsure], upper[unsure] = -np.inf, np.inf
    return lower, upper


def scan_block(q: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(query, entry, lower, upper) of the entries that may be among a query's best k + 1 of the block,
    and whose upper bound reaches ``least``, a bound of each query."""
    least = np.full(len(q), -np.inf) if least is None else least
    with np.errstate(all="ignore"):
        size = np.abs(q)
        reach = size @ (width * CELLS)
        half, start = margins(q, low, width)
        half += reach * (q.shape[1] + 8) * 1.2e-7                       # rounding of single precision
        plain = (reach < 1e37) & np.isfinite(half) & np.isfinite(start)
    if not plain.all():
        lower, upper = bounds(q, cells, low, width)
        if lower.shape[1] > k:
            least = np.maximum(least, np.partition(lower, -(k + 1), axis=1)[:, -(k + 1)])
        at = np.nonzero(upper >= least[:, None])
        return *at, lower[at], upper[at]
    middle = (q * width).astype(np.float32) @ cells.T.astype(np.float32)
    if middle.shape[1] > k and not np.isfinite(least).all():
        least = np.maximum(least, np.partition(middle, -(k + 1), axis=1)[:, -(k + 1)] + start - half)
    with np.errstate(over="ignore"):
        need = np.nextafter((least - half - start).astype(np.float32), np.float32(-np.inf))
    own, other = np.divmod(np.flatnonzero(middle >= need[:, None]), middle.shape[1])
    near_to = middle[own, other] + start[own]
    lower, upper = near_to - half[own], near_to + half[own]
    stay = upper >= least[own]
    return own[stay], other[stay], lower[stay], upper[stay]


def greatest(top: np.ndarray, own: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The greatest values of each row of ``top``, after ``lower`` came to the rows ``own``."""
    order = np.lexsort((-lower, own))
    row = own[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    few = place < top.shape[1]
    more = np.full(top.shape, -np.inf)
    more[row[few], place[few]] = lower[order][few]
    return np.sort(np.concatenate([top, more], axis=1), axis=1)[:, -top.shape[1]:]


def scan_tile(q: np.ndarray, files: list[tuple[np.ndarray, ...]], k: int):
    """Lists (query, a, b, lower, upper) of the entries (a, b) of ``files`` that may be among a query's best k + 1."""
    top, found, count = np.full((len(q), k + 1), -np.inf), [], 0

    def out():
        own, a, b, lower, upper = map(np.concatenate, zip(*found, strict=True))
        stay = np.argsort(own, kind="stable")       # equal neighbours take little room in the shuffle
        stay = stay[upper[stay] >= top[own[stay], 0]]
        return own[stay], a[stay], b[stay], lower[stay], upper[stay]

    for a, b, low, width, cells in files:
        own, other, lower, upper = scan_block(q, cells, low, width, k, top[:, 0])
        top = greatest(top, own, lower)
        found.append((own, a[other], b[other], lower, upper))
        count += len(own)
        if count > FOUND:
            yield out()
            found, count = [], 0
    if found:
        yield out()


def entries(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (tag, dim, members, v, asked) with the k + 1 smallest (id, copies), and the queries
    (tag, id, copies).  A tag is 128 bits of a vector's content; it is asked if it is a query's."""
    x = F.col(vec_col)
    fine = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda c: F.coalesce(c.cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
    kind = "float" if vectors.select(x).dtypes[0][1] == "array<float>" else "double"
    rows = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: c.cast(kind) + F.lit(0.0).cast(kind)).alias("v"),
                                      F.coalesce(is_query, F.lit(False)).cast("long").alias("asked"))
    # of the type that is read again, else the join would cast and shuffle once more
    rows = rows.withColumn("tag", F.struct(F.xxhash64(F.size("v"), "v").alias("a"), F.xxhash64(F.lit("other"), "v", F.size("v")).alias("b")).cast("struct<a:bigint,b:bigint>"))
    ids = written(rows.groupBy("tag", "id").agg(F.count("*").alias("copies"), F.sum("asked").alias("asked")), "vector-ids")
    first = F.row_number().over(Window.partitionBy("tag").orderBy("id"))
    members = (ids.select("tag", "id", "copies", first.alias("place")).where(F.col("place") <= k + 1)
               .groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("id", F.least("copies", F.lit(k + 1)).alias("copies")))).alias("members")))
    queries = ids.where("asked > 0").select("tag", "id", F.col("asked").alias("copies"))
    whose = queries.select("tag").distinct().withColumn("asked", F.lit(True)).hint("shuffle_hash")
    # the vectors themselves are shuffled once and written once
    table = rows.groupBy("tag").agg(F.any_value("v").alias("v")).join(members.join(whose, "tag", "left").hint("merge"), "tag")
    return written(table.select("tag", "members", "v", F.size("v").alias("dim"), F.col("asked").isNotNull().alias("asked")), "vector-entries"), queries


def _blocks(rows: DataFrame, size: int, scale: int, approximate: bool) -> DataFrame:
    """Entries (tag, dim, v) in blocks of up to ``size`` of one length, as they lie: approximation files, or whole
    vectors.  Blocks of a task have consecutive numbers ``at``."""

    def pack(batches):
        at, held = int(TaskContext.get().partitionId() * 0.6180339887498949 % 1 * 2 ** 30), {}

        def most(dim):
            return max(1, min(size, BLOCK_BYTES // max(1, dim * (1 if approximate else 8))))

        def out(dim):
            nonlocal at
            a, b, vecs = map(np.concatenate, zip(*held.pop(dim), strict=True))
            for i in range(0, len(a), n := most(dim)):
                x = whole(vecs[i:i + n], scale)
                if approximate:
                    cells, low, width = approximated(x)
                else:
                    far = np.abs(x).max(initial=0)
                    cells, low, width = x.astype(np.int16 if far < 2 ** 15 else np.int32 if far < 2 ** 31 else float), np.zeros(0), np.zeros(0)
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "dim": pa.array([dim], pa.int32()), "a": pa.array([a[i:i + n]]), "b": pa.array([b[i:i + n]]),
                                                  "low": [low.tobytes()], "width": [width.tobytes()], "cells": [cells.tobytes()]})
                at += 1

        for batch in batches:
            a, b, sizes, flat = (c.to_numpy(zero_copy_only=False) for c in (batch[0], batch[1], batch[2].value_lengths(), batch[2].flatten()))
            for dim in np.unique(sizes).tolist():
                mine = sizes == dim
                held.setdefault(dim, []).append((a[mine], b[mine], flat[np.repeat(mine, sizes)].reshape(mine.sum(), dim)))
                if sum(len(h[0]) for h in held[dim]) >= most(dim):
                    yield from out(dim)
            if sum(len(h[0]) for x in held.values() for h in x) >= 4 * size:    # of many lengths
                for dim in [*held]:
                    yield from out(dim)
        for dim in [*held]:
            yield from out(dim)

    return rows.select("tag.a", "tag.b", "v").mapInArrow(pack, "at int, dim int, a array<long>, b array<long>, low binary, width binary, cells binary")


def dealt(entry_bytes: int, query_bytes: int, tasks: int) -> tuple[int, int]:
    """Groups of files and parts of the queries: at least ``tasks`` tiles, so that the least is sent, and no
    group larger than a task holds.  Files go to each part, queries to each group."""
    even = round(math.sqrt(tasks * entry_bytes / max(1, query_bytes)))
    groups = max(1, min(tasks, even), -(-entry_bytes // TILE_BYTES))
    return groups, max(1, -(-tasks // groups))


def tiles(table: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """Approximation files (kind 0) and blocks of queries (kind 1) by tile; in a tile each length's files come first."""
    n, dims, m, asked_dims = table.agg(F.count("*"), F.sum("dim"), F.count_if("asked"), F.sum(F.when(F.col("asked"), F.col("dim")))).first()
    # of a query a group gets its vector, and sends about two times k + 1 entries
    groups, parts = dealt((dims or 0) + 16 * n, 2 * (asked_dims or 0) + 16 * m + 64 * (k + 1) * m, shuffle_partitions(table.sparkSession))

    def tile(blocks, kind, group, part):
        return blocks.select(group.alias("group"), part.alias("part"), F.lit(kind).alias("kind"), *blocks.columns)

    def each(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    both = (tile(_blocks(table, ENTRIES, scale, True), 0, F.pmod("at", F.lit(groups)), each(parts))
            .unionByName(tile(_blocks(asked, QUERIES, scale, False), 1, each(groups), F.pmod("at", F.lit(parts)))))
    return (both.withColumn("tile", F.col("group").cast("long") * parts + F.col("part")).select("tile", "dim", "kind", "a", "b", "low", "width", "cells")
            .repartition(2 * groups * parts, "tile").sortWithinPartitions("tile", "dim", "kind"))


def near(table: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """The scan: (q, tag) of the entries whose upper bound reaches the (k + 1)th greatest lower bound."""

    def run(batches):
        held, files = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                tile, dim, kind, a, b, low, width, cells = (c[i] for c in batch.columns)
                at, a, b, cells = (tile.as_py(), dim.as_py()), a.values.to_numpy(), b.values.to_numpy(), cells.as_py()
                if at != held:
                    held, files = at, []
                if kind.as_py() == 0:
                    files.append((a.copy(), b.copy(), np.frombuffer(low.as_py()), np.frombuffer(width.as_py()), np.frombuffer(cells, np.uint8).reshape(len(a), at[1])))
                    continue
                kinds = {2: np.int16, 4: np.int32, 8: float}
                q = np.frombuffer(cells, kinds[len(cells) // len(a) // at[1]] if at[1] else float).reshape(len(a), at[1]).astype(float)
                for own, xa, xb, lower, upper in scan_tile(q, files, k):
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (a[own], b[own], xa, xb, lower, upper))], names=["qa", "qb", "a", "b", "lower", "upper"])

    found = tiles(table, asked, k, scale).mapInArrow(run, "qa long, qb long, a long, b long, lower double, upper double")
    every = Window.partitionBy("qa", "qb").orderBy(F.desc("lower")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (found.withColumn("least", F.nth_value("lower", k + 1).over(every)).where("least IS NULL OR upper >= least")
            .select(F.struct(F.col("qa").alias("a"), F.col("qb").alias("b")).alias("q"), F.struct("a", "b").alias("tag")))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score."""
    table, queries = entries(vectors, is_query, id_col, vec_col, k)
    asked = table.where("asked")
    pairs = written(near(table, asked, k, scale), "vector-pairs")
    stay = _maybe_wanted(table.select("tag", "v", "members"), pairs, "tag").hint("merge")
    pairs = pairs.join(asked.select(F.col("tag").alias("q"), F.col("v").alias("qv")).hint("merge"), "q")
    pairs = pairs.join(stay, "tag").select("q", "tag", "members", "qv", "v")

    def run(batches):
        for b in batches:
            qv, xv = (c.flatten().to_numpy() for c in b.columns[3:])
            exactly = scores(qv, xv, np.concatenate([[0], np.cumsum(b.column(3).value_lengths().to_numpy(), dtype=np.int64)]), scale)
            shown = [max(-LONG - 1, min(LONG, s)) for s in exactly]
            key = [None if -LONG - 1 < s < LONG else (s + (1 << 8 * KEY_BYTES - 1)).to_bytes(KEY_BYTES, "big") for s in exactly]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(shown, pa.int64()), pa.array(key, pa.binary())], names=["q", "tag", "members", "score", "beyond"])

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    scored = pairs.mapInArrow(run, f"q {kinds['q']}, tag {kinds['tag']}, members {kinds['members']}, score long, beyond binary")
    mine = queries.select(F.col("tag").alias("q"), F.col("id").alias("query_id"), F.col("copies").alias("asked"))
    rows = scored.join(mine, "q").select("q", "query_id", "asked", "tag", "score", "beyond", F.inline("members"))
    own = (F.col("tag") == F.col("q")) & (F.col("id") == F.col("query_id"))
    rows = rows.withColumn("copies", F.col("copies") - own.cast("long")).where("copies > 0")
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "id")
    rows = rows.select("q", "query_id", "asked", "id", "score", "beyond", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # a repeated query has its ranks once for each of its rows
    return rows.select("query_id", "rank", F.col("id").alias("vec_id"), "score", F.explode(F.sequence(F.lit(1).cast("long"), "asked")).alias("row")).drop("row")


ORACLE = """
WITH x AS (SELECT vec_id, unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL),
ok AS (SELECT vec_id FROM x GROUP BY vec_id HAVING bool_and(c IS NOT NULL AND isfinite(c))),
v AS (SELECT vec_id, i, floor(CAST(c AS DOUBLE) * 256) AS c FROM x WHERE vec_id IN (SELECT vec_id FROM ok)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.c * c.c) AS BIGINT) AS score
      FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
