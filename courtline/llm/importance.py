"""Quality classifier by importance resampling.

Two generative models of hashed n-grams (words and pairs of neighbouring words in ``BUCKETS``
buckets): one of the target text (documents labelled good), one of all raw text.  A document's
log-weight is the sum of the log-ratios of its n-grams.  Gumbel top-k: with independent Gumbel noise from a
hash of the document, the ``fraction`` of documents with the largest log-weight plus noise is a sample
without replacement in proportion to the weights.  The kth largest key is found by histograms of
the keys, refined in the one slice that holds it; nothing is sorted.

The raw model counts all documents (per task one row for each bucket that occurs); the target
model a bounded sample, the ``TARGET_DOCS`` labelled documents with the smallest hash of their id.

Null or empty text: no n-grams, log-weight 0.  Without target rows all log-weights are 0.  The
noise is a hash of the id (null: the empty text), the text and the row's number among the rows equal
in both, so every row has noise of its own and repeated rows do not tie.  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textnum
from courtline.llm.common import written
from courtline.llm.mixing import BITS, content, hash_of, numbered

BUCKETS = 1 << 15
FRACTION = 0.8
TARGET_DOCS = 8192
SLICES = 1024


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of the texts, and the text of each."""
    flat, starts = textnum.joined(texts)
    words, first = textnum.word_hashes(textnum.LOWER[flat], starts, textnum.NOT_WORD)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    inside = doc[:-1] == doc[1:]
    with np.errstate(over="ignore"):
        pairs = textnum.mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[inside]
    return (np.concatenate([words, pairs]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([doc, doc[:-1][inside]])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """n-grams of a one-column table of texts by bucket."""
    def count(batches):
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, run in textnum.slices(b.column(0)):
                n += np.bincount(grams(run)[0], minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for at, n in texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[at] = n
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log-ratio of target to raw by bucket."""
    good = (labels.groupBy(F.col("doc_id").cast("long").alias("target_id")).agg(F.max("quality").alias("quality")).where("quality = 1 and target_id is not null")
            .select("target_id").orderBy(F.xxhash64("target_id"), "target_id").limit(TARGET_DOCS))
    target = bucket_counts(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                           .join(F.broadcast(good), F.col("id") == F.col("target_id"), "left_semi").select("text"))
    raw = bucket_counts(docs.select(text_col))
    if not target.sum():
        return np.zeros(BUCKETS)
    share = raw + 1.0
    share /= share.sum()
    smoothed = target + 0.02 * max(1, target.sum()) * share       # the target leans on the raw model where it has seen little
    return np.log(smoothed / smoothed.sum()) - np.log(share)


def weighted(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (digest of id and text), n_grams, log_weight."""
    def run(batches):
        for b in batches:
            for at, texts in textnum.slices(b.column(2)):
                bucket, doc = grams(texts)
                n = np.bincount(doc, minlength=len(texts))
                total = np.bincount(doc, ratio[bucket], minlength=len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), b.column(1).slice(at, len(texts)), pa.array(n.astype(np.int64)), pa.array(total)],
                                                 names=["doc_id", "key", "n_grams", "log_weight"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), content(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, key string, n_grams long, log_weight double"))


def gumbel(h: Column) -> Column:
    return -F.log(-F.log((h + F.lit(0.5)) / float(1 << BITS)))


def kth_largest(rows: DataFrame, col: str, k: int) -> float | None:
    """The kth largest value (the least if there are fewer); SLICES counts a pass reach the driver."""
    low, high = rows.agg(F.min(col), F.max(col)).first()
    if low is None or k < 1:
        return None if low is None else math.inf
    inside = rows.where(F.col(col).between(low, high))
    while low < high:
        place = F.least(F.floor((F.col(col) - low) / (high - low) * SLICES), F.lit(SLICES - 1)).cast("int")
        found = inside.groupBy(place.alias("s")).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(found, key=lambda r: -r.s):
            if r.n >= k or r.s == min(f.s for f in found):
                low, high = r.lo, r.hi
                break
            k -= r.n
        inside = rows.where(F.col(col).between(low, high))
    return low


def resample(docs: DataFrame, labels: DataFrame, *, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_grams, log_weight, sample_key, kept."""
    rows = numbered(weighted(docs, fit(docs, labels)), "doc_id", "key", "n_grams", "log_weight")
    rows = written(rows.withColumn("sample_key", F.col("log_weight") + gumbel(hash_of(F.col("key"), F.col("number")))).drop("key", "number"), "importance")
    cut = kth_largest(rows, "sample_key", math.ceil(rows.count() * fraction))
    return rows.withColumn("kept", F.col("sample_key") >= F.lit(cut if cut is not None else math.inf))
