"""Toxicity: a factorization machine over hashed terms.

A text's terms are its lower-cased words (letters and digits) and the stems of longer words
(their first ``STEMS`` bytes, since insults are inflected), hashed to 64 bits, each counted once.  The score is the logistic function of ``w0 + sum w_i + sum over pairs <v_i, v_j>``, so a
pair of terms (an insult and whom it is aimed at) can weigh more or less than its two terms.

Training takes a bounded sample: the ``PER_LABEL`` labelled rows of each class with the smallest
hash of their id.  Terms enter the model if their presence differs between the classes beyond
chance (log-likelihood ratio of at least ``LEAST_G2``), at most ``MAX_TERMS``.  Rare words that
say nothing are thereby no noise in long texts.  The intercept is set to the classes' share
among all labelled training rows.

Null or empty text: no terms, the score of the intercept.  A label other than 0 or 1, or null,
takes no part; of several labels of an id the largest holds.  Without labelled rows of both
classes every score is the share of toxic rows (0 if there are none).  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textnum
from courtline.llm.common import written

PER_LABEL = 4000
LEAST_G2 = 20.0
MAX_TERMS = 1024
RANK = 8
STEPS, RATE, DECAY = 250, 0.1, 1e-5
STEMS = (5, 7)              # bytes of a longer word's stem, a term of its own
THRESHOLD = 0.7


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    flat, starts = textnum.joined([(t or "").lower().encode() for t in texts])
    return textnum.word_hashes(flat, starts, textnum.NOT_WORD, STEMS)


def _runs(column, rows: int = 512, chars: int = 1 << 20):
    out, first, size = [], 0, 0
    for i, t in enumerate(column):
        out.append(t.as_py())
        size += len(out[-1] or "")
        if len(out) >= rows or size >= chars:
            yield first, out
            out, first, size = [], i + 1, 0
    if out:
        yield first, out


def telling_terms(sampled: DataFrame) -> np.ndarray:
    """The at most ``MAX_TERMS`` terms whose presence tells the classes of (y, terms) apart."""
    n1, n0 = sampled.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    if not n1 or not n0:
        return np.zeros(0, np.uint64)

    def count(batches):
        for b in batches:
            if b.num_rows:
                sets = [np.frombuffer(x, np.uint64) for x in b.column(1).to_pylist()]
                found, which = np.unique(np.concatenate(sets), return_inverse=True)
                y = np.repeat(b.column(0).to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.bincount(which, y, len(found)).astype(np.int64)),
                                                  pa.array(np.bincount(which, minlength=len(found)).astype(np.int64))], names=["term", "a", "n"])

    def part(x, n, p):
        return x * F.log(F.greatest(x, F.lit(1e-12)) / n / p) + (n - x) * F.log(F.greatest(n - x, F.lit(1e-12)) / n / (1 - p))

    a, b = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double")
    p = F.least(F.greatest((a + b) / (n1 + n0), F.lit(1e-9)), F.lit(1 - 1e-9))
    rated = (sampled.mapInArrow(count, "term long, a long, n long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
             .select("term", (2 * (part(a, n1, p) + part(b, n0, p))).alias("g2")).where(F.col("g2") > LEAST_G2 - 1e-6))
    # ties as in train: by the term as an unsigned integer
    best = rated.orderBy(F.desc("g2"), F.col("term").bitwiseXOR(F.lit(-(2**63)))).limit(MAX_TERMS).collect()
    return np.sort(np.array([r.term for r in best], np.int64).view(np.uint64))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[list, float]:
    """(label, distinct telling terms) of the training sample, and the share of label 1.  Terms are
    counted and rated on executors; the driver gets the telling ones alone."""
    rows = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("y")).where("y in (0, 1) and id is not null")
    rows = rows.withColumn("h", F.xxhash64("id"))
    share = rows.agg(F.avg("y")).first()[0]
    # at most 2 * PER_LABEL ids
    chosen = [r for y in (0, 1) for r in rows.where(F.col("y") == y).orderBy("h", "id").limit(PER_LABEL).select("id", "y").collect()]
    if share is None:
        return [], 0.0
    chosen = docs.sparkSession.createDataFrame(chosen, "id long, y int")

    def terms(batches):
        for b in batches:
            for at, texts in _runs(b.column(1)):
                words, first = _words(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)),
                     pa.array([np.unique(words[a:z]).tobytes() for a, z in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["y", "terms"])

    sampled = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
                      .select("y", "text").mapInArrow(terms, "y int, terms binary"), "toxicity-sample")
    known = telling_terms(sampled)

    def telling(batches):
        for b in batches:
            sets = [np.frombuffer(x, np.uint64) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s[np.isin(s, known)].tobytes() for s in sets], pa.binary())], names=["y", "terms"])

    got = sampled.mapInArrow(telling, "y int, terms binary").collect()
    return sorted((r.y, bytes(r.terms)) for r in got), float(share)


class Model:
    def __init__(self, terms: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.w0, self.w, self.v = terms, w0, w, v

    def scores(self, texts: list[str | None]) -> np.ndarray:
        words, first = _words(texts)
        z = np.full(len(texts), self.w0)
        if len(self.terms) and len(words):
            i = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
            hit = np.flatnonzero(self.terms[i] == words)
            doc = np.searchsorted(first, hit, "right") - 1
            pair = np.unique(doc * len(self.terms) + i[hit])
            doc, term = np.divmod(pair, len(self.terms))
            sums = np.zeros((len(texts), RANK))
            np.add.at(sums, doc, self.v[term])
            own = self.w[term] - 0.5 * (self.v[term] ** 2).sum(1)
            z += np.bincount(doc, own, len(texts)) + 0.5 * (sums ** 2).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _g2(a, b, n1, n0):
    """Log-likelihood ratio of presence in a of n1 and b of n0."""
    def part(x, n, p):
        return x * np.log(np.maximum(x, 1e-12) / n / p) + (n - x) * np.log(np.maximum(n - x, 1e-12) / n / (1 - p))
    p = np.clip((a + b) / (n1 + n0), 1e-9, 1 - 1e-9)
    return 2 * (part(a, n1, p) + part(b, n0, p))


def train(rows: list, share: float) -> Model:
    """Fit on (label, terms) rows by full-batch Adam."""
    y = np.array([r[0] for r in rows], float)
    n1, n0 = y.sum(), (1 - y).sum()
    prior = math.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), prior, np.zeros(0), np.zeros((0, RANK)))
    sets = [np.frombuffer(r[1], np.uint64) for r in rows]
    flat, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    terms, which = np.unique(flat, return_inverse=True)
    with_1 = np.bincount(which, y[doc], len(terms))
    g2 = _g2(with_1, np.bincount(which, minlength=len(terms)) - with_1, n1, n0)
    best = np.argsort(-g2, kind="stable")[:MAX_TERMS]
    best = np.sort(best[g2[best] >= LEAST_G2])
    x = np.zeros((len(rows), len(best)), np.float32)
    place = np.full(len(terms), -1)
    place[best] = np.arange(len(best))
    keep = place[which] >= 0
    x[doc[keep], place[which[keep]]] = 1
    rng = np.random.default_rng(7)
    bias = math.log(n1 / n0)
    w, v, w0 = np.zeros(len(best), np.float32), rng.normal(0, 0.05, (len(best), RANK)).astype(np.float32), np.float32(bias)
    params = [np.array([w0]), w, v]
    m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, STEPS + 1):
        w0, w, v = params
        xv = x @ v
        z = w0[0] + x @ w + 0.5 * ((xv ** 2).sum(1) - x @ (v ** 2).sum(1))
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y).astype(np.float32) / len(y)
        xd = x.T @ d
        grads = [np.array([d.sum()]), xd + DECAY * w, x.T @ (d[:, None] * xv) - v * xd[:, None] + DECAY * v]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.99 * s[i] + 0.01 * g * g
            params[i] = params[i] - RATE * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(s[i] / (1 - 0.99 ** t)) + 1e-8)
    return Model(terms[best], float(params[0][0]) - bias + prior, params[1].astype(float), params[2].astype(float))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labelled rows outside the held-out fold."""
    return train(*sample(docs, labels.where(~held_out("doc_id")), id_col, text_col))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score."""
    def run(batches):
        for b in batches:
            for at, texts in _runs(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(model.scores(texts))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for i, texts in _runs(b.column(at)):
                yield b.slice(i, len(texts)).filter(pa.array(model.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    s = scored(docs, model)
    return s.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
