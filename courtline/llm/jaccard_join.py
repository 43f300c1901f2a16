"""N-gram Jaccard self-join by vertical partitioning, down to its connected components.

A document's set is its distinct ``k``-word shingles; two documents link when 100 * intersection
>= percent * union.  Documents of equal sets are one class.

Global order.  Shingle hashes are counted in ``2 ** CELL_BITS`` cells over all documents, and the
cells ranked by their counts; a shingle's token is its hash with the cell replaced by the cell's
rank.  Tokens in numeric order are then roughly the rare shingles first, whatever the corpus, and
the table that orders them has a fixed size.  ``FRAGMENTS`` cuts of equal weight divide the order.

Vertical partition.  A set's tokens between two cuts are its segment in that fragment.  A pair's
overlap is counted fragment by fragment, each in a task of its own that sees segments only, and
summed per pair: first the fragments of rare tokens, which leave most unlike pairs with too
many differences, then the others for the pairs that are left.

Candidates.  Linked sets share a token among the first ``n - ceil(percent * n / 100) + 1`` of each
(prefix filter); pairs whose sizes, segment lengths or token positions already rule out the
threshold are left.  Sets meet at keys, a token together with one of two neighbouring classes of
set sizes, so sets of unlike size do not meet.  A key of up to ``FEW`` sets has its possible pairs
looked at once.  For the others only what connects matters, so their pairs are not listed:

1. Hub turns.  The documents that share a token meet one hub, the one that shares the most; links
   join components; the hub has met all of them and leaves the token, and tokens whose documents
   are one component are done.
2. Rest.  Documents of different components that still share a key are all compared, in blocks of
   bounded size, at the first key they share.  No pair is left out: the result is that of all pairs.

Before its fragments are counted a pair meets by parity sketch: a row of bits, at least as many as
the set has tokens, each the parity of the tokens that fall on it.  Bits in which two sketches
differ are at most the tokens that one set alone has, so no link is left out.

Shingles are known by 64-bit hashes, sets by 128 bits of sums of them (class numbers are salted anew
if two classes ever share one).  Links are counted on whole sets.

Null or empty text, or only blanks: no shingle, linked with nothing.  Fewer than ``k`` words: one
shingle of all.  Null id: sorted before all ids, returned as null.  Rows of equal id are documents of
their own.  Empty table: no rows.  Extra columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import textnum
from courtline.llm.common import MIN_LONG, order_key, shuffle_partitions, written
from courtline.llm.components import connected_components
from courtline.llm.minhash import shingle_sets

CELL_BITS = 20              # cells of the order table: 4 bytes each on every executor
CHUNK = 1024                # cells summed by one task at a time
FRAGMENTS = 16              # vertical partitions; their lengths are kept in a byte each
FEW = 32                    # sets of a key whose possible pairs are all listed
FIRST = 32                  # a set's first keys, kept with it to name a pair once in the rest
EARLY = 4                   # fragments that are counted before the others
HUB_TURNS = 3
SKETCH = -1                 # stands for a fragment where parity sketches are compared
LEAST_BITS = 256            # of a parity sketch
FILTER_BITS = 23            # the bitmap of wanted texts has 2 ** 23 bits: 131,072 words of 8 bytes
BLOCK = 512                 # documents of a token compared with each other in one go
SHARE = 256                 # pairs of a hub in one group

_SHIFT = np.uint64(64 - CELL_BITS)
_LOW = (np.uint64(1) << _SHIFT) - np.uint64(1)
_LENGTHS = ["low", "high"]
SET = ["node", "n", "place", *_LENGTHS]


def _names(sets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (1, 0x5851F42D4C957F2D):
            total = np.zeros(len(sets) + 1, np.uint64)
            np.cumsum(textnum.mixed(sets + np.uint64(salt)), out=total[1:])
            out.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return out[0], out[1]


def _node(one: Column, two: Column, n: Column, salt: int) -> Column:
    return F.xxhash64(one, two, n, F.lit(salt))


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """key, text_hash, n (set size), one, two (the set's sums), bits (its parity sketch) of each row; and, with a chunk number
    in place of these, each task's counts of the order table's cells."""
    def run(batches):
        count = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            for at, texts in textnum.slices(b.column(2)):
                sets, ends = shingle_sets(texts, k)
                count += np.bincount((sets >> _SHIFT).astype(np.int64), minlength=len(count))
                one, two = _names(sets, ends)
                blank = pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())
                bits = pa.array([p.tobytes() for p in parities(sets, ends)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, len(texts)) for i in (0, 1)), pa.array(np.diff(ends)), pa.array(one), pa.array(two), *blank, bits], names=names)
        chunks = [c.astype(np.uint32).tobytes() for c in count.reshape(-1, CHUNK)]
        empty = [pa.nulls(len(chunks), pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([*empty, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary()), pa.nulls(len(chunks), pa.binary())], names=names)

    names = ["key", "text_hash", "n", "one", "two", "chunk", "cells", "bits"]
    return (docs.select(order_key(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "key long, text_hash long, n long, one long, two long, chunk int, cells binary, bits binary"))


def global_order(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each cell, and the tokens at which fragments begin, from (chunk, cells).  Chunks are
    summed in tasks as they stream by; the driver gets the table alone."""
    def run(batches):
        at, total = None, None
        for b in batches:
            for chunk, cells in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if chunk != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "cells"])
                    at, total = chunk, np.zeros(CHUNK, np.int64)
                total += np.frombuffer(cells.as_buffer(), np.uint32)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "cells"])

    rows = counts.repartition(shuffle_partitions(counts.sparkSession), "chunk").sortWithinPartitions("chunk").mapInArrow(run, "chunk int, cells binary").collect()
    count = np.zeros(1 << CELL_BITS, np.int64)
    for r in rows:
        count[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.cells, np.int64)
    order = np.argsort(count, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    weight = np.cumsum(count[order])
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, FRAGMENTS) // FRAGMENTS, side="right")
    return rank, cuts.astype(np.uint64) << _SHIFT


def tokens(sets: np.ndarray, ends: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Each set's tokens in the global order."""
    out = (rank[(sets >> _SHIFT).astype(np.int64)].astype(np.uint64) << _SHIFT) | (sets & _LOW)
    for a, z in zip(ends[:-1], ends[1:], strict=True):
        out[a:z].sort()
    return out


def _lengths(toks: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Tokens of each set in each fragment."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    return np.bincount(owner * FRAGMENTS + np.searchsorted(cuts, toks, side="right"), minlength=(len(ends) - 1) * FRAGMENTS).reshape(-1, FRAGMENTS)


def _prefixes(docs: DataFrame, text_col: str, k: int, percent: int, order) -> DataFrame:
    """token, one, two, n, place (of the token in the set's order), low, high (segment lengths, a byte
    each, 255 for more): the prefix of each set, once for a set in a batch."""
    def run(batches):
        rank, cuts = order.value
        for b in batches:
            for _, texts in textnum.slices(b.column(0)):
                sets, ends = shingle_sets(texts, k)
                toks, n = tokens(sets, ends, rank), np.diff(ends)
                one, two = _names(sets, ends)
                _, first = np.unique(np.stack([one, two, n], 1), axis=0, return_index=True)
                first = np.sort(first[n[first] > 0])
                count = n[first] - -(-percent * n[first] // 100) + 1
                owner = np.repeat(first, count)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                lengths = np.minimum(_lengths(toks, ends, cuts), 255).astype(np.uint8).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toks[ends[owner] + place].view(np.int64)), pa.array(one[owner]), pa.array(two[owner]), pa.array(n[owner]), pa.array(place.astype(np.int32)),
                     pa.array(lengths[owner, 0]), pa.array(lengths[owner, 1])], names=["token", "one", "two", "n", "place", *_LENGTHS])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "token long, one long, two long, n long, place int, low long, high long")


def parities(toks: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Each set's parity sketch: a power of two of bits, LEAST_BITS and the set's size at least.  Hashes and
    tokens of a set give the same one: only bits below the cell count."""
    n = np.maximum(np.diff(ends), LEAST_BITS)
    words = (1 << np.ceil(np.log2(n)).astype(np.int64)) // 64
    edge = np.concatenate([[0], np.cumsum(words)])
    owner = np.repeat(np.arange(len(n)), np.diff(ends))
    bits = np.zeros(edge[-1], np.uint64)
    word = ((toks & _LOW) >> np.uint64(6)).astype(np.int64) % words[owner]
    np.bitwise_xor.at(bits, edge[owner] + word, np.uint64(1) << (toks & np.uint64(63)))
    return [bits[a:z] for a, z in zip(edge[:-1], edge[1:], strict=True)]


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch that the same set has with fewer words."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def segments(texts: DataFrame, k: int, order) -> DataFrame:
    """node, fragment, tokens (sorted, 8 bytes each) of (node, text); empty segments have no row."""
    def run(batches):
        rank, cuts = order.value
        for b in batches:
            for at, some in textnum.slices(b.column(1)):
                sets, ends = shingle_sets(some, k)
                toks = tokens(sets, ends, rank)
                size = _lengths(toks, ends, cuts).ravel()
                full = np.flatnonzero(size)
                edge = np.concatenate([[0], np.cumsum(size)])
                node = b.column(0).slice(at, len(some)).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[full // FRAGMENTS]), pa.array((full % FRAGMENTS).astype(np.int32)),
                     pa.array([toks[edge[f]:edge[f + 1]].tobytes() for f in full], pa.binary())], names=["node", "fragment", "tokens"])

    return texts.select("node", "text").mapInArrow(run, "node long, fragment int, tokens binary")


def least_overlap(percent: int, both: Column) -> Column:
    """Least intersection of linked sets whose sizes add up to ``both``."""
    return F.ceil(percent * both / F.lit(100 + percent))


def _possible(percent: int, a: str, b: str) -> Column:
    """Whether sizes, segment lengths and the places of a shared token leave a link possible."""
    x, y = (lambda c, p=p: F.col(f"{p}.{c}" if p else c) for p in (a, b))
    both = x("n") + y("n")
    need = least_overlap(percent, both)
    byte = lambda c, i: F.shiftrightunsigned(c, 8 * i).bitwiseAND(F.lit(255))
    apart = sum((F.abs(byte(x(c), i) - byte(y(c), i)) for c in _LENGTHS for i in range(8)), F.lit(0))
    return ((100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n"))) & (apart <= both - 2 * need)
            & (F.least(x("place"), y("place")) + 1 + F.least(x("n") - x("place"), y("n") - y("place")) - 1 >= need))


def partial_overlaps(pairs: DataFrame, segs: DataFrame) -> DataFrame:
    """For each pair (a, b) the tokens shared in the fragments of ``segs`` and those that only one has
    there (of sketches: the bits that differ): a, b, shared, apart.  One fragment of a hub a and of up to SHARE or so partners meet in a task."""
    share = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).alias("groups"))
    salted = pairs.select("a", "b").join(share, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("salt"))
    wanted = (salted.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role"))
              .unionByName(salted.select(F.col("a").alias("node"), "a", "salt", F.lit(0).alias("role")).distinct()))
    rows = segs.join(wanted, "node").select("a", "salt", "fragment", "role", "node", "tokens")

    def run(batches):
        at = mine = None
        for b in batches:
            a, salt, fragment, role, node = (b.column(i).to_pylist() for i in range(5))
            toks = b.column(5)
            out = []
            for i in range(len(a)):
                own = np.frombuffer(toks[i].as_buffer(), np.uint64)
                if role[i] == 0:
                    at, mine = (a[i], salt[i], fragment[i]), own
                elif fragment[i] == SKETCH:
                    words = min(len(mine), len(own))
                    out.append((a[i], node[i], 0, int(np.bitwise_count(folded(mine, words) ^ folded(own, words)).sum())))
                elif at == (a[i], salt[i], fragment[i]):
                    place = np.minimum(np.searchsorted(mine, own), len(mine) - 1)
                    both = int((mine[place] == own).sum())
                    out.append((a[i], node[i], both, len(mine) + len(own) - 2 * both))
                else:       # the hub has no token in this fragment
                    out.append((a[i], node[i], 0, len(own)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "shared", "apart"])

    counted = (rows.repartition(shuffle_partitions(pairs.sparkSession), "a", "salt", "fragment").sortWithinPartitions("a", "salt", "fragment", "role")
               .mapInArrow(run, "a long, b long, shared long, apart long"))
    return counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.sum("apart").alias("apart"))


def alike(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, both: sizes added up) whose parity sketches (node, bits) leave a link possible."""
    bits = partial_overlaps(pairs, marks.select("node", F.lit(SKETCH).alias("fragment"), F.col("bits").alias("tokens")))
    return (pairs.join(bits, ["a", "b"]).where(F.col("apart") <= F.col("both") - 2 * least_overlap(percent, F.col("both")))
            .select("a", "b", "both"))


def linked(pairs: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, both: sizes added up) that link, as (u, v)."""
    early = pairs.join(partial_overlaps(pairs, segs.where(F.col("fragment") < EARLY)), ["a", "b"], "left").fillna(0, ["shared", "apart"])
    left = written(early.where(F.col("apart") <= F.col("both") - 2 * least_overlap(percent, F.col("both"))).select("a", "b", "both", F.col("shared").alias("early")), "jaccard-early")
    rest = partial_overlaps(left, segs.where(F.col("fragment") >= EARLY))
    shared = F.col("early") + F.coalesce("shared", F.lit(0))
    return (left.join(rest, ["a", "b"], "left").where(100 * shared >= percent * (F.col("both") - shared))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _hubs(open_: DataFrame) -> DataFrame:
    """token, hub (the row of the document that shares the most)."""
    size = open_.groupBy("token").agg(F.count("*").alias("m"))
    filled = open_.join(size, "token").groupBy("node").agg(F.sum("m").alias("filled"))
    hub = F.max(F.struct("filled", "node", "n", "place", "label", *_LENGTHS)).alias("hub")
    return open_.join(filled, "node").groupBy("token").agg(hub)


def _rest(open_: DataFrame, keys: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a key and may link, by parity sketches too, compared in
    blocks; a pair that shares an earlier one of both sets' first keys (node, keys) was or is compared there."""
    about = keys.join(marks, "node")
    size = open_.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = (open_.join(size, "token").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    rows = own.join(about, "node").select("token", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                                         (F.col("own") > F.col("other")).cast("long").alias("side"), "node", "label", "n", "place", *_LENGTHS, "keys", "bits")

    def pairs(at, group):
        if len(group) < 2:
            return
        same_block = at[1] == at[2]
        earlier = [{k for k in r[7] if k < at[0]} for r in group]
        side, node, label, n, place = (np.array([r[i] for r in group], np.int64) for i in range(5))
        lengths = np.array([r[5:7] for r in group], np.int64).view(np.uint8).astype(np.int16)
        words = min(len(r[8]) for r in group) // 8
        bits = np.stack([folded(np.frombuffer(r[8], np.uint64), words) for r in group])
        for i in range(len(group)):
            them = np.flatnonzero((label != label[i]) & ((np.arange(len(group)) > i) if same_block else (side > side[i])))
            both = n[them] + n[i]
            need = -(-percent * both // (100 + percent))
            ok = 100 * np.minimum(n[them], n[i]) >= percent * np.maximum(n[them], n[i])
            ok &= np.minimum(place[them], place[i]) + np.minimum(n[them] - place[them], n[i] - place[i]) >= need
            ok &= np.abs(lengths[them] - lengths[i]).sum(1) <= both - 2 * need
            them, both, need = them[ok], both[ok], need[ok]
            ok = np.bitwise_count(bits[them] ^ bits[i]).sum(1, dtype=np.int64) <= both - 2 * need
            for j, size in zip(them[ok], both[ok], strict=True):
                if earlier[i].isdisjoint(earlier[j]):
                    yield min(node[i], node[j]), max(node[i], node[j]), size

    def run(batches):
        at, group = None, []
        for b in batches:
            out = set()
            for token, p, q, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (token, p, q) != at:
                    out.update(pairs(at, group))
                    at, group = (token, p, q), []
                group.append(rest)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "both"])
        if out := set(pairs(at, group)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "both"])

    return (rows.repartition(shuffle_partitions(open_.sparkSession), "token", "p", "q").sortWithinPartitions("token", "p", "q")
            .mapInArrow(run, "a long, b long, both long").distinct())


def _keys(prefixes: DataFrame, percent: int) -> DataFrame:
    """Prefix rows by key, the token and the set's class of sizes, or the next class: token (the key's hash), m (sets of the
    key), sets (node, n, place, low, high of each; keys of more than FEW sets have several rows).  Sizes within the
    threshold are in the same class or in neighbouring ones; keys of one set are left out.  The rows are dealt out by
    their tokens once, and all is done there."""
    width = 1.0001 * max(math.log(100 / percent), 1e-6)
    size = F.floor(F.log(F.col("n")) / width)
    of_token, of_key = Window.partitionBy("token"), Window.partitionBy("token", "size")
    several = (prefixes.select("token", *SET, F.min("node").over(of_token).alias("least"), F.max("node").over(of_token).alias("most"))
               .where("least != most").select("token", *SET).distinct())
    keyed = (several.withColumn("size", F.explode(F.array(size, size + 1))).withColumn("m", F.count("*").over(of_key)).where("m > 1")
             .withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / FEW))))
    return (keyed.groupBy("token", "size", "m", "part").agg(F.collect_list(F.struct(*SET)).alias("sets"))
            .select(F.xxhash64("token", "size").alias("token"), "m", "sets"))


def _few(few: DataFrame, percent: int) -> DataFrame:
    """All pairs of keys with few sets, each key a row, that may link."""
    pair = (few.select("sets", F.posexplode("sets").alias("at", "x"))
            .select("x", F.explode(F.slice("sets", F.col("at") + 2, F.size("sets"))).alias("y")).where(_possible(percent, "x", "y")))
    return pair.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), (F.col("x.n") + F.col("y.n")).alias("both")).distinct()


def components(first: DataFrame, open_: DataFrame, keys: DataFrame, segs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Components (node, label) of links that connect what the threshold connects, from pairs (a, b, both) to look at, prefix
    rows (token, node, n, place, low, high) of keys that many sets share, and the sets' first keys, segments and
    parity sketches."""
    labels, open_ = None, open_.withColumn("label", F.col("node"))
    for turn in range(HUB_TURNS + 1):
        if turn < HUB_TURNS:
            hubs = written(_hubs(open_), "jaccard-hubs")
            met = open_.join(hubs, "token").where(F.col("node") != F.col("hub.node"))
            pairs = (met.where((F.col("label") != F.col("hub.label")) & _possible(percent, "", "hub"))
                     .select(F.col("hub.node").alias("a"), F.col("node").alias("b"), (F.col("hub.n") + F.col("n")).alias("both")).distinct())
        else:
            met, pairs = None, _rest(open_, keys, marks, percent)
        if met is not None:
            pairs = alike(written(pairs, "jaccard-hub-pairs"), marks, percent)
        pairs = written(pairs if turn else pairs.unionByName(first).distinct(), "jaccard-pairs")
        new = written(linked(pairs, segs, percent), "jaccard-links")
        # each node and its label are all that is left of former links
        labels = connected_components(new if labels is None else new.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
        if met is None:
            break
        named = (met.drop("hub", "label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
        named = written(named, "jaccard-named")
        several = named.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least != most").select("token")
        open_ = written(named.join(several, "token").select("token", "node", "n", "place", *_LENGTHS, "label"), "jaccard-open")
        if open_.isEmpty():
            break
    return labels


def _maybe_wanted(rows: DataFrame, wanted: DataFrame, *by: str) -> DataFrame:
    """Rows whose columns ``by`` may be among ``wanted``, before they are shuffled: a bitmap of
    2 ** FILTER_BITS hashes, as words that are broadcast, leaves out most others and none of these.  Its size is
    fixed; where it fills up, more rows pass to the join that decides."""
    place = lambda: F.pmod(F.xxhash64(*by), F.lit(1 << FILTER_BITS))
    words = (wanted.select(place().alias("place"))
             .groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("hits")))
    return (rows.withColumn("place", place()).withColumn("word", F.expr("place div 64"))
            .join(F.broadcast(words), "word").where(F.getbit("hits", (F.col("place") % 64).cast("int")) == 1).select(*rows.columns))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links)."""
    spark = docs.sparkSession
    both = written(sketches(docs, id_col, text_col, k), "jaccard-sketches")
    order = spark.sparkContext.broadcast(global_order(both.where("chunk IS NOT NULL").select("chunk", "cells")))
    sketch = both.where("chunk IS NULL").select("key", "text_hash", "n", "one", "two")
    # one row for a class of equal sets, its least key first
    classes = written(both.where("n > 0").groupBy("one", "two", "n").agg(F.min(F.struct("key", "text_hash", "bits")).alias("first")), "jaccard-classes")
    salt = 0
    while not classes.groupBy(_node(F.col("one"), F.col("two"), F.col("n"), salt).alias("node")).count().where("count > 1").isEmpty():
        salt += 1
    name = _node(F.col("one"), F.col("two"), F.col("n"), salt).alias("node")
    classes = classes.select(name, F.col("first.key").alias("key"), F.col("first.text_hash").alias("text_hash"), F.col("first.bits").alias("bits"))

    shared = written(_keys(_prefixes(docs, text_col, k, percent, order).select("token", name, "n", "place", *_LENGTHS), percent), "jaccard-shared")
    open_ = written(shared.where(F.col("m") > FEW).select("token", F.inline("sets")), "jaccard-open")
    first = written(_few(shared.where(F.col("m") <= FEW), percent), "jaccard-few")

    def nodes(pairs: DataFrame) -> DataFrame:
        return open_.select("node").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node"))).distinct()

    # a set's first keys, for those that share a key with many
    keys = (_maybe_wanted(shared.select("token", F.explode("sets.node").alias("node")), open_, "node")
            .groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRST).alias("keys")))
    some = written(_maybe_wanted(classes, nodes(first), "node").join(nodes(first), "node", "left_semi"), "jaccard-candidates")
    marks = some.select("node", "bits")
    first = written(alike(first, marks, percent), "jaccard-few-alike")
    # texts of candidates that parity sketches leave, one for a class
    some = written(some.select("node", "key", "text_hash").join(nodes(first), "node", "left_semi"), "jaccard-wanted")
    every = docs.select(order_key(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    texts = (_maybe_wanted(every, some, "key", "text_hash")
             .join(some.hint("shuffle_hash"), ["key", "text_hash"]).dropDuplicates(["key", "text_hash", "node"]))
    segs = written(segments(texts, k, order), "jaccard-segments")
    labels = components(first, open_, keys, segs, marks, percent)

    low = labels.join(classes, "node").groupBy("label").agg(F.min("key").alias("whole"))
    whole = labels.join(low, "label").select("node", "whole")
    out = (sketch.select("key", "n", name).join(classes.select("node", F.col("key").alias("low")), "node", "left").join(whole, "node", "left"))
    own = F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("whole", "low"))
    null = lambda c: F.when(c != MIN_LONG, c)
    return out.select(null(F.col("key")).alias("doc_id"), F.col("n").alias("n_shingles"), null(own).alias("component_id"))
