"""Source divergence: how far the word rates of a language's sources lie apart, exactly.

Terms are maximal runs of letters and characters beyond ASCII, A-Z lower-cased.  A language keeps
the V terms found in at least ``least_docs`` of its documents.  Each (lang, source) group and each
language gives a kept term, with ``count`` occurrences there, the rate

    p = 1 + floor(1000000000 * (count + 2) / (N + 2 * V)),   N: all its kept occurrences,

and two rates p, q differ by f = floor((p - q)^2 / (p + q)).

* ``pair``: f of two sources' rates, summed over all kept terms of their language.
* ``term``: the terms that a source uses more than its language does, by f, the first ``top``.

Pairs are priced from joint tables.  A group's counts take few levels, and a price depends only on
(level in a, level in b).  A block of terms has one indicator column for each (group, level > 0);
the matrix times its transpose counts, for every two columns, the terms that have both levels:
the joint tables of all pairs of groups, as exact integers.  Level 0 follows by subtraction from
the columns' sums, and the terms that neither group has by subtraction from V.  Terms are dealt
into blocks of about ``BLOCK`` and groups into blocks of about ``GROUPS``, so a task holds a
bounded matrix; blocks' prices are whole numbers and add up in any order.

Words are counted by Arrow batches (bounded dictionaries), combined before the shuffle; the term
list is cut to ``top`` in each task before the ranks are made.

Null text, lang or source: ''.  Groups without terms occur, with value 0 where V = 0.  Equal values
are ranked by the item's bytes.  Repeated rows count each time.  Empty table: no rows.  Extra
columns do not matter.  No id is used.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from courtline.llm.common import written

SCALE = 1_000_000_000
BLOCK = 128                 # terms of a block, about
GROUPS = 32                 # groups of a block, about
HELD = 200_000              # counters kept in a task before they are handed on
WIDTH = 2048                # columns of a matrix multiplied at once

#: bytes that are no part of a term become blanks, A-Z become a-z
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, count (occurrences), docs (documents that hold it); one row with a null
    term for each group, its docs being the group's documents."""
    def run(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter, list]] = {}

        def out():
            for (lang, source), (count, docs_, rows) in found.items():
                terms = list(count)
                n = len(terms) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, n), pa.repeat(source, n), pa.array([*terms, None], pa.binary()).cast(pa.string()),
                     pa.array([*count.values(), 0], pa.int64()), pa.array([*(docs_[t] for t in terms), rows[0]], pa.int64())],
                    names=["lang", "source", "term", "count", "docs"])
            found.clear()

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                count, docs_, rows = found.setdefault((lang, source), (Counter(), Counter(), [0]))
                words = (text.as_py() or "").encode().translate(_TERMS).split()
                count.update(words)
                docs_.update(set(words))
                rows[0] += 1
            if sum(len(c) for c, *_ in found.values()) > HELD:
                yield from out()
        yield from out()

    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    parts = docs.select(*blank).mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def rate(count: Column | str, total: Column | str) -> Column:
    """p of a count, where total is N + 2 * V."""
    count, total = (F.col(c) if isinstance(c, str) else c for c in (count, total))
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("long") * (count + 2), total)


def gap(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def price(source: np.ndarray, term: np.ndarray, count: np.ndarray, totals: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every two groups a in ``first`` and b in ``second``: the prices of the terms that either has,
    summed, and how many these are.  Entries (source, term, count > 0) are numbered from 0; totals
    holds N + 2 * V of each group."""
    rates = lambda c, g: 1 + SCALE * (c + 2) // totals[g]
    # one column for each (group, level), groups together
    level, column = np.unique(np.stack([source, count], 1), axis=0, return_inverse=True)
    column = column.ravel()
    of, p = level[:, 0], rates(level[:, 1], level[:, 0])
    n_terms, size = int(term.max(initial=-1)) + 1, np.bincount(column, minlength=len(level)).astype(np.int64)
    zero = rates(0, np.arange(len(totals)))
    place = np.full(len(totals), -1)
    place[first] = np.arange(len(first))
    other = np.full(len(totals), -1)
    other[second] = np.arange(len(second))
    value, both = (np.zeros((len(first), len(second)), np.int64) for _ in range(2))
    mine, theirs = np.flatnonzero(place[of] >= 0), np.flatnonzero(other[of] >= 0)

    def indicator(columns):
        at = np.full(len(level), -1)
        at[columns] = np.arange(len(columns))
        hit = at[column] >= 0
        m = np.zeros((n_terms, len(columns)), np.float32)
        m[term[hit], at[column[hit]]] = 1
        return m

    for i in range(0, len(mine), WIDTH):
        left = mine[i:i + WIDTH]
        a = indicator(left).T
        for j in range(0, len(theirs), WIDTH):
            right = theirs[j:j + WIDTH]
            joint = a @ indicator(right)        # whole numbers up to the block's terms: exact
            r, c = np.nonzero(joint)
            n = joint[r, c].astype(np.int64)
            r, c = left[r], right[c]
            # terms of both groups leave the columns at which one of them has level 0
            ga, gb = of[r], of[c]
            at = place[ga] * len(second) + other[gb]
            worth = n * (_gap(p[r], p[c]) - _gap(p[r], zero[gb]) - _gap(zero[ga], p[c]))
            order = np.argsort(at, kind="stable")
            cells, begin = np.unique(at[order], return_index=True)
            if len(cells):
                value.ravel()[cells] += np.add.reduceat(worth[order], begin)
                both.ravel()[cells] += np.add.reduceat(n[order], begin)
    # every term of a against level 0 of b, and the other way round
    for k, g in enumerate(first):
        own = np.flatnonzero(of == g)
        value[k] += (size[own, None] * _gap(p[own, None], zero[second][None])).sum(0)
    for k, g in enumerate(second):
        own = np.flatnonzero(of == g)
        value[:, k] += (size[own, None] * _gap(p[own, None], zero[first][None])).sum(0)
    terms = np.bincount(of, size, len(totals)).astype(np.int64)
    return value, terms[first][:, None] + terms[second][None] - both


def _cells(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of terms, two blocks of groups: lang, a, b, value, either; a < b."""
    names, source = np.unique(rows["source"].to_numpy(object), return_inverse=True)
    totals, block = np.ones(len(names), np.int64), np.zeros(len(names), np.int64)
    totals[source], block[source] = rows["total"].to_numpy(), rows["block"].to_numpy()
    held = rows["term"].notna().to_numpy()
    _, term = np.unique(rows["term"].to_numpy(object)[held], return_inverse=True)
    p, q = int(rows["p"].iat[0]), int(rows["q"].iat[0])
    first, second = np.flatnonzero(block == p), np.flatnonzero(block == q)
    # where V is 0 no rate is needed
    value, either = price(source[held], term, rows["count"].to_numpy()[held], np.maximum(totals, 1), first, second)
    a, b = np.meshgrid(first, second, indexing="ij")
    # names are in order; blocks are not, so the pair may come as (larger, smaller)
    use = (a < b) if p == q else np.ones(a.shape, bool)
    a, b, value, either = a[use], b[use], value[use], either[use]
    return pd.DataFrame({"lang": rows["lang"].iat[0], "a": names[a], "total_a": totals[a], "b": names[b], "total_b": totals[b], "value": value, "either": either})


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", *, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = written(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least_docs).select("lang", "term", "lang_count"))
    kept = written(kept, "divergence-kept")
    entries = counts.where("term IS NOT NULL").select("lang", "source", "term", "count").join(kept, ["lang", "term"])
    entries = written(entries, "divergence-entries")
    # sizes: of languages and of groups, those without kept terms too
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("n"))
    groups = (counts.where("term IS NULL").select("lang", "source").join(entries.groupBy("lang", "source").agg(F.sum("count").alias("own")), ["lang", "source"], "left")
              .join(langs, "lang", "left").select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("own", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"),
                                                  (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total")))
    groups = written(groups, "divergence-groups")
    wide = groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUPS).cast("int").alias("wide"))
    groups = groups.join(wide, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "wide").cast("int")).withColumn(
        "deep", F.greatest(F.ceil(F.col("v") / BLOCK), F.lit(1)).cast("int"))
    with_group = entries.join(groups, ["lang", "source"])

    # pairs: each entry goes to the blocks of its term, each group to all blocks of terms
    of_terms = with_group.select("lang", "source", "block", "wide", "total", "term", "count", F.pmod(F.xxhash64("term"), "deep").cast("int").alias("part"))
    of_groups = groups.select("lang", "source", "block", "wide", "total", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("count"),
                              F.explode(F.sequence(F.lit(0), F.col("deep") - 1)).alias("part"))
    cells = (of_terms.unionByName(of_groups).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)))
             .select("lang", "part", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "source", "block", "total", "term", "count"))
    priced = cells.groupBy("lang", "part", "p", "q").applyInPandas(_cells, "lang string, a string, total_a long, b string, total_b long, value long, either long")
    pairs = (priced.groupBy("lang", "a", "total_a", "b", "total_b").agg(F.sum("value").alias("value"), F.sum("either").alias("either"))
             .join(langs.select("lang", "v"), "lang", "left"))
    none = lambda c: rate(F.lit(0), F.greatest(F.col(c), F.lit(1)))
    pairs = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, F.col("value") + (F.col("v") - F.col("either")) * gap(none("total_a"), none("total_b")))
                         .otherwise(F.lit(0)).cast("long").alias("value"))
    pairs = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "value")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", F.row_number().over(order))

    p, q = rate("count", "total"), rate("lang_count", "lang_total")
    terms = (with_group.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(p, q).alias("value"), (p > q).alias("more"))
             .where("more").drop("more").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return pairs.unionByName(terms)


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (SELECT row_id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
langs AS (SELECT lang, count(*)::BIGINT AS v, sum(c)::BIGINT AS n FROM kept GROUP BY lang),
entries AS (SELECT w.lang, w.source, w.term, count(*)::BIGINT AS c FROM words w JOIN kept k USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(c)::BIGINT AS n FROM entries GROUP BY ALL),
groups AS (SELECT DISTINCT d.lang, d.source, coalesce(s.n, 0)::BIGINT AS n, coalesce(l.v, 0)::BIGINT AS v FROM docs d LEFT JOIN sizes s USING (lang, source) LEFT JOIN langs l USING (lang)),
rates AS (SELECT g.lang, g.source, k.term, coalesce(e.c, 0)::BIGINT AS c, 1 + (1000000000 * (coalesce(e.c, 0)::BIGINT + 2)) // (g.n + 2 * g.v) AS p,
                 1 + (1000000000 * (k.c + 2)) // (l.n + 2 * l.v) AS q
          FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN entries e ON e.lang = g.lang AND e.source = g.source AND e.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM rates WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
