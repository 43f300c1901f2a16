"""Periodic runs of words: Re-Pair grammars, runs across each rule's boundary, maximal intervals.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
at least ``max(least, power * q)`` words that no neighbouring word extends keeping period q.

1. Word ids, then Re-Pair in rounds: a pair of neighbouring symbols that occurs twice or more in a
   document becomes a rule wherever it is more frequent than the pairs that overlap it.  A pair that
   occurs once stays single for ever, so what lies between such pairs leaves the next rounds.
   Many documents go through a round together, each with a grammar of its own.
2. What no rule shortens is the start rule; it is split into halves of halves.
3. Every rule X = YZ has its runs across the boundary of Y and Z computed once, on one occurrence:
   ``power >= 4`` leaves two whole periods on one side of the boundary, so the periods worth a look
   are those at which words beside the boundary recur.
4. These runs are copied to all places where X is derived.  Pieces of equal period that overlap by
   a period are one run; the rule that holds the whole run in both halves has it whole.

Word identity is exact; equal stretches are found by two 31-bit rolling hashes and confirmed word
by word.  Null, empty or blank text: no words, no runs, empty collapsed text.  Null id: returned as
null.  Rows of equal id or text are documents of their own.  Empty table: no rows.  Extra columns
do not matter.  A document is one task's work, its memory follows its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textnum

#: candidate periods looked at in one go
CHUNK = 1 << 20
_PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
_BASES = (1_103_515_245, 1_664_525_013)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and value of first[i], first[i]+1, ... (count[i] values each)."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]


def repair(sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of each document's symbols ``sym[starts[d]:starts[d + 1]]``; symbols of different
    documents must differ.

    Returns the rules (one row (first word, boundary, end) of an occurrence each), all occurrences
    (rule, first word) and a mask of the words at which a symbol of the start rules begins."""
    n = len(sym)
    top = np.ones(n, bool)
    if n < 2:
        return np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64), top
    rules, occurrences, known = [], [], 0
    # active symbols: value, first word, end; joined[i]: symbol i + 1 follows in the same segment
    s, a, z = sym.astype(np.int64), np.arange(n), np.arange(1, n + 1)
    joined = np.ones(n, bool)
    joined[starts[1:][starts[1:] > 0] - 1] = False
    fresh = int(sym.max()) + 1
    while True:
        at = np.flatnonzero(joined[:-1])
        if not len(at):
            break
        left, right = s[at], s[at + 1]
        order = np.lexsort((right, left))
        l, r = left[order], right[order]
        new = np.r_[True, (l[1:] != l[:-1]) | (r[1:] != r[:-1])]
        pair = np.empty(len(at), np.int64)
        pair[order] = np.cumsum(new) - 1
        count = np.bincount(pair)
        # a pair that occurs once never occurs twice again
        often = count[pair] > 1
        joined[at[~often]] = False
        at, pair = at[often], pair[often]
        if not len(at):
            break
        # a place wins against the places that overlap it by (frequency, pair); in a stretch of one
        # pair (a a a a) every other place wins
        rank = np.zeros(len(s) + 2, np.int64)
        weight = np.empty(len(count), np.int64)
        weight[np.lexsort((textnum.mixed(np.arange(len(count)).astype(np.uint64)), count))] = np.arange(1, len(count) + 1)
        rank[at + 1] = weight[pair]
        here, before, after = rank[at + 1], rank[at], rank[at + 2]
        same = np.r_[False, (at[1:] == at[:-1] + 1) & (here[1:] == here[:-1])]
        place = np.arange(len(at))
        odd = (place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 1
        # the whole stretch gives way if a better pair overlaps its first place; then the other parity wins
        lost = before > here
        shifted = lost[np.maximum.accumulate(np.where(same, 0, place))]
        win = np.where(shifted, odd, ~odd) & ~(before > here) & ~(after > here)
        win_at = at[win]
        if not len(win_at):
            break
        names, first, rule = np.unique(pair[win], return_index=True, return_inverse=True)
        rules.append(np.stack([a[win_at], a[win_at + 1], z[win_at + 1]], 1)[first])
        occurrences.append(np.stack([known + rule, a[win_at]], 1))
        top[a[win_at + 1]] = False
        s[win_at], z[win_at] = fresh + rule, z[win_at + 1]
        joined[win_at] = joined[win_at + 1]
        keep = np.ones(len(s), bool)
        keep[win_at + 1] = False
        known, fresh = known + len(names), fresh + len(names)
        s, a, z, joined = s[keep], a[keep], z[keep], joined[keep]
        keep = joined | np.r_[False, joined[:-1]]     # symbols joined to none are done
        s, a, z, joined = s[keep], a[keep], z[keep], joined[keep]
    if not rules:
        return np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64), top
    return np.concatenate(rules), np.concatenate(occurrences), top


def halves(top: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(first word, boundary, end) for every boundary inside a document's start rule, halved and halved again."""
    begin = np.flatnonzero(top)
    first = np.searchsorted(begin, starts)
    doc, r = _ranges(np.ones(len(starts) - 1, np.int64), np.maximum(np.diff(first) - 1, 0))
    if not len(r):
        return np.zeros((0, 3), np.int64)
    span = r & -r
    edge = np.append(begin, starts[-1])
    lo, end = first[doc] + r - span, np.minimum(r + span, np.diff(first)[doc]) + first[doc]
    return np.stack([begin[lo], begin[first[doc] + r], np.where(end == first[doc + 1], starts[doc + 1], edge[end])], 1)


class _Equal:
    """How far T[i:] and T[i + q:] agree, to the right and to the left."""

    def __init__(self, t: np.ndarray):
        self.sums = []
        x = textnum.mixed(t.astype(np.uint64))
        for k, p in enumerate(_PRIMES):
            if len(_POWERS[k]) <= len(t):
                w, b = np.ones(1, np.uint64), _BASES[k]
                while len(w) <= len(t):
                    w = np.concatenate([w, w * np.uint64(pow(b, len(w), int(p))) % p])
                _POWERS[k] = w
            # cumulative sums stay under 2^64 for 2^33 words
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum((x >> np.uint64(8 * k)) % p * _POWERS[k][: len(t)] % p)]))

    def same(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        ok = np.ones(len(i), bool)
        for k, p in enumerate(_PRIMES):
            c = self.sums[k]
            ok &= (c[i + n] - c[i]) % p * _POWERS[k][q] % p == (c[i + q + n] - c[i + q]) % p
        return ok

    def extent(self, at, q, lo, hi):
        """The stretch [s, e) around words at and at + q in which words q apart are identical, inside [lo, hi)."""
        right, most = np.zeros(len(at), np.int64), hi - q - at
        left, least = np.zeros(len(at), np.int64), at - lo
        top = int(max(most.max(initial=0), least.max(initial=0)))
        step = 1 << max(top.bit_length() - 1, 0)
        while step:
            n = right + step
            ok = n <= most
            ok[ok] = self.same(at[ok], q[ok], n[ok])
            right = np.where(ok, n, right)
            n = left + step
            ok = n <= least
            ok[ok] = self.same(at[ok] - n[ok], q[ok], n[ok])
            left = np.where(ok, n, left)
            step >>= 1
        return at - left, at + right + q


def _crossing(t: np.ndarray, nodes: np.ndarray, least: int, power: int, equal: _Equal) -> np.ndarray:
    """Rows (node, start, end, period): runs across the boundary of each node, within it."""
    found = []
    for right in (True, False):
        most = np.minimum((nodes[:, 2] - nodes[:, 1] if right else nodes[:, 1] - nodes[:, 0]) // 2, (nodes[:, 2] - nodes[:, 0]) // power)
        some = np.flatnonzero(most > 0)
        ends = np.cumsum(most[some])
        done = 0
        while done < len(some):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + CHUNK)))
            ids = some[done:stop]
            done = stop
            owner, q = _ranges(np.ones(len(ids), np.int64), most[ids])
            node = ids[owner]
            b = nodes[node, 1]
            ok = t[b] == (t[b + q] if right else t[b - q])
            node, q, b = node[ok], q[ok], b[ok]
            if right:       # words b - 1 to b + q - 1 recur q later
                ok = (t[b - 1] == t[b - 1 + q]) & (t[b + q - 1] == t[b + 2 * q - 1])
            else:           # words b - 2q to b - q recur q later
                ok = (t[b - 1] == t[b - 1 - q]) & (t[b - q] == t[b - 2 * q])
            node, q, b = node[ok], q[ok], b[ok]
            if len(node):
                s, e = equal.extent(b if right else b - q, q, nodes[node, 0], nodes[node, 2])
                ok = (e - s >= np.maximum(least, power * q)) & (s < b) & (e > b)
                found.append(np.stack([node, s, e, q], 1)[ok])
    if not found:
        return np.zeros((0, 4), np.int64)
    x = np.concatenate(found)
    x = x[np.lexsort((x[:, 3], x[:, 2], x[:, 1], x[:, 0]))]
    # of one stretch's periods the smallest; the others are its multiples
    x = x[np.r_[True, (x[1:, :3] != x[:-1, :3]).any(1)]] if len(x) else x
    # confirm word by word; where the hashes were wrong the node is looked at plainly
    owner, i = _ranges(x[:, 1], x[:, 2] - x[:, 1] - x[:, 3])
    wrong = np.unique(x[owner[t[i] != t[i + x[owner, 3]]], 0])
    if len(wrong):
        x = np.concatenate([x[~np.isin(x[:, 0], wrong)], *(_plain(t, k, nodes[k], least, power) for k in wrong)])
    return x


def _plain(t: np.ndarray, k: int, node: np.ndarray, least: int, power: int) -> np.ndarray:
    """As ``_crossing`` for one node, comparing words only."""
    lo, b, hi = map(int, node)
    seen: dict[tuple[int, int], int] = {}
    for q in range(1, (hi - lo) // power + 1):
        edge = np.flatnonzero(np.diff((t[lo:hi - q] == t[lo + q:hi]).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        for s, e in zip(edge[0::2] + lo, edge[1::2] + lo + q, strict=True):
            if e - s >= max(least, power * q) and s < b < e:
                seen.setdefault((int(s), int(e)), q)
    return np.array([(k, s, e, q) for (s, e), q in seen.items()], np.int64).reshape(-1, 4)


def runs_of(t: np.ndarray, starts: np.ndarray, least: int = 6, power: int = 4) -> np.ndarray:
    """Rows (start, end, period), by start and period, of word ids ``t`` in documents
    ``t[starts[d]:starts[d + 1]]``."""
    if power < 4:
        raise ValueError("runs of fewer than four periods are not looked for")
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    _, sym = np.unique(doc * (int(t.max(initial=0)) + 1) + t, return_inverse=True)
    rules, occurrences, top = repair(sym, starts)
    nodes = np.concatenate([rules, halves(top, starts)])
    x = _crossing(t, nodes, least, power, _Equal(t)) if len(nodes) else np.zeros((0, 4), np.int64)
    own = x[:, 0] < len(rules)
    places = occurrences[np.argsort(occurrences[:, 0], kind="stable")]
    first = np.searchsorted(places[:, 0], x[own, 0])
    owner, i = _ranges(first, np.searchsorted(places[:, 0], x[own, 0], side="right") - first)
    y = x[own][owner]
    shift = places[i, 1] - rules[y[:, 0], 0]
    pieces = np.concatenate([np.stack([y[:, 1] + shift, y[:, 2] + shift, y[:, 3]], 1), x[~own, 1:]])
    if not len(pieces):
        return pieces
    # pieces of equal period that overlap by a period are one run
    pieces = pieces[np.lexsort((pieces[:, 1], pieces[:, 0], pieces[:, 2]))]
    s, e, q = pieces.T
    period = np.cumsum(np.r_[False, q[1:] != q[:-1]])
    far = np.maximum.accumulate(e + period * (len(t) + 1)) - period * (len(t) + 1)
    new = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (s[1:] + q[1:] > far[:-1])])
    out = np.stack([s[new], np.maximum.reduceat(e, new), q[new]], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _batch(texts: list[bytes], least: int, power: int):
    """Runs (document's first word taken off) and collapsed text of each text."""
    words = [t.split() for t in texts]          # splits at [\x20\x09-\x0D]+
    ids: dict[bytes, int] = {}
    t = np.array([ids.setdefault(w, len(ids)) for ws in words for w in ws], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    x = runs_of(t, starts, least, power)
    step = np.zeros(len(t) + 1, np.int64)
    np.add.at(step, x[:, 0] + x[:, 2], 1)
    np.add.at(step, x[:, 1], -1)
    kept = np.cumsum(step[:-1]) == 0
    first = np.searchsorted(x[:, 0], starts)
    for d, ws in enumerate(words):
        a, z = first[d], first[d + 1]
        own = x[a:z]
        yield (own[:, 0] - starts[d], own[:, 1] - own[:, 0], own[:, 2],
               b" ".join(ws) if a == z else b" ".join([w for w, k in zip(ws, kept[starts[d]:starts[d + 1]].tolist(), strict=True) if k]))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 6, power: int = 4) -> DataFrame:
    """doc_id, runs (array of start, length, period; by start, then period) and collapsed (the words
    outside every run's repetitions, joined by one space) of each row."""
    def run(batches):
        for b in batches:
            for at, texts in textnum.slices(b.column(1)):
                rows = list(_batch(texts, least, power))
                ends = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
                flat = [pa.array(np.concatenate([r[k] for r in rows])) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, fields=list(_RUN))),
                     pa.array([r[3] for r in rows], pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"))


def with_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: every tenth document (crc32 of its decimal id) repeats a period from a word on;
    its words are joined by one space then.  A null id, or a text without words, stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", h)
    out = out.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("a", F.when(n > 0, g % n))
    out = out.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    return out.select("doc_id", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row of numbers and hashes for each row of ``find_runs``."""
    def line(r: Column) -> Column:
        return F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))

    # greatest length, then smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = found.withColumn("b", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
        F.expr("1000 * b.length div -b.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return digest(find_runs(with_tails(docs, id_col, text_col)))
