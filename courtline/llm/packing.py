"""Mixture-controlled packing: deficit round-robin over source queues.

Every window of ``WINDOW`` ids is filled with each queue's share of all ids.  Per window a
queue is owed ``WINDOW * share`` ids; the fraction it could not get is its deficit and is
carried into the next window.  Written as cumulative counts this is exact integer arithmetic:
with A_j the ids of the first j queues and T all ids, the first w windows hold
``floor(w * WINDOW * A_j / T)`` ids of the first j queues.  So what any queue has delivered
before any window is known without replaying earlier windows: tasks start anywhere, and
deficits carry over partitions.  All queues end together, so every window but the last is
full; the last is cut into sequences whose lengths are powers of two (no padding).

A source is a queue.  Sources owed less than one id a window share one queue (so at most
``WINDOW`` queues reach the driver).  Within a queue documents come by ascending id.

Null text: empty (the end id alone).  Null source: a source of its own, last.  Null id: first,
returned as null.  Equal ids: ordered by text ids.  Empty table: no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import MIN_LONG, block_starts, order_key, shuffle_partitions, written
from courtline.llm.tokens import encoder, spans

WINDOW = 4096
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "queue int")


class Schedule:
    """What each queue has delivered before each window, in closed form."""

    def __init__(self, totals: list[int], window: int = WINDOW):
        self.window, self.sizes = window, totals
        self.ends = [0]
        for t in totals:
            self.ends.append(self.ends[-1] + t)
        self.total = self.ends[-1]
        self.full = self.total // window
        self.tail = [1 << b for b in range(window.bit_length(), -1, -1) if (self.total - self.full * window) >> b & 1]

    def before(self, j: int, w: int) -> int:
        """Ids of the first j queues in the first w windows."""
        return self.ends[j] if w > self.full else w * self.window * self.ends[j] // self.total

    def delivered(self, q: int, w: int) -> int:
        return self.before(q + 1, w) - self.before(q, w)

    def cut(self, q: int, start: int, n: int):
        """Pieces (from, length, sequence, offset) of ids start..start+n of queue q."""
        w = start * self.total // (self.window * self.sizes[q])
        while w > 0 and self.delivered(q, w) > start:
            w -= 1
        at, end = start, start + n
        while at < end:
            while (until := self.delivered(q, w + 1)) <= at:
                w += 1
            place = self.before(q, w + 1) - self.before(q, w) + at - self.delivered(q, w)
            k = min(end, until) - at
            if w < self.full:
                yield at - start, k, w, place
            else:
                yield from self._last(at - start, k, place)
            at += k

    def _last(self, at: int, k: int, place: int):
        low = 0
        for i, size in enumerate(self.tail):
            a, z = max(place, low), min(place + k, low + size)
            if a < z:
                yield at + a - place, z - a, self.full + i, a - low
            low += size


def queues(sizes: dict, total: int) -> tuple[list, list[int], int]:
    """Sources with a queue of their own (by code point, null last), the ids of each queue,
    and the queue of all other sources: one more, or the last if that would be too small."""
    own = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    counts = [sizes[s] for s in own]
    rest = total - sum(counts)
    if own and 0 < rest * WINDOW < total:
        counts[-1] += rest
        return own, counts, len(own) - 1
    return own, counts + [rest] * (rest > 0), len(own)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         *, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """One row per piece; each id of each document lies in exactly one piece."""
    spark = docs.sparkSession
    key = order_key(id_col)
    starts = block_starts(docs, key)

    def encode(batches):
        enc, edges = encoder(tokenizer), np.array(starts, np.int64)
        tail = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            keys = b.column(0).to_numpy()
            blk = (np.searchsorted(edges, keys, "right") - 1).astype(np.int32)
            for at, texts in spans(b.column(2)):
                ids = [x + tail for x in enc.encode(texts)]
                k = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blk[at:at + k]), pa.array(keys[at:at + k]), b.column(1).slice(at, k),
                     pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["blk", "key", "source", "n", "ids"])

    ids = written(docs.select(key.alias("key"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
                  .mapInArrow(encode, "blk int, key long, source string, n long, ids binary"), "packing-ids", compression="zstd")

    total = ids.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], SCHEMA)
    # at most WINDOW sources are owed an id a window
    own, counts, shared = queues(dict(ids.groupBy("source").agg(F.sum("n").alias("n")).where(F.col("n") * WINDOW >= total).collect()), total)
    plan = Schedule(counts)

    names = spark.createDataFrame([(s, i) for i, s in enumerate(own)], "name string, own int")
    queued = (ids.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")), "left")
              .select(F.coalesce("own", F.lit(shared)).alias("queue"), "blk", "key", "n", "ids"))
    per_block = queued.groupBy("queue", "blk").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    # a first row for each (queue, block): the queue's ids in earlier blocks
    heads = per_block.select("queue", "blk", F.lit(MIN_LONG).alias("key"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
                             F.lit(None).cast("binary").alias("ids"), F.lit(0).alias("role"))

    def pieces(batches):
        item, at, out = encoder(tokenizer).dtype, 0, []
        for b in batches:
            for q, k, n, x in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if x is None:
                    at = n
                    continue
                wide = np.frombuffer(x, item).astype("<u4")
                d = None if k == MIN_LONG else k
                out += [(d, a, m, zlib.crc32(wide[a:a + m]), n, w, o, q) for a, m, w, o in plan.cut(q, at, n)]
                at += n
                if len(out) >= 8192:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    def batch(rows):
        types = [*[pa.int64()] * 7, pa.int32()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return (queued.withColumn("role", F.lit(1)).unionByName(heads).repartition(shuffle_partitions(spark), "queue", "blk")
            .sortWithinPartitions("queue", "blk", "role", "key", "ids").mapInArrow(pieces, SCHEMA))
