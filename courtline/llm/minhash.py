"""MinHash near-dedup: universal hash minima, banding, signature verification, exact
confirmation, connected components.

A document's set is its distinct ``k``-word shingles.  Documents of equal sets are one class.
Each class has ``BANDS * ROWS`` minima; classes that agree in a whole band are candidates.  A
pair at the threshold of 0.85 shares none of 32 bands of 4 with a chance of 6e-11.

Only what connects matters, so a bucket's pairs are not listed:

1. Star round.  Each bucket's candidates are paired with one hub, the member whose buckets
   are the most filled (the text the others were copied from).  Pairs whose signatures agree
   are confirmed on their full sets; components are formed; buckets that now lie in one
   component are done.
2. Neighbour rounds.  In the buckets left, every member is paired with the member of another
   component whose signature is nearest.
3. Rest.  All members of different components that still share a bucket are compared by
   signature, in blocks of bounded size, each pair in the first band it shares, and those that
   agree confirmed.  No pair is left out, so the result is that of all pairs.

The signature for verification is one permutation's: the least shingle hash in each of ``BINS``
ranges, eight bits of it.  It estimates the similarity of small sets almost exactly; pairs more than
``DEVIATIONS`` standard deviations under the threshold are left.  Classes are known by a 64-bit hash
of the set.

Null or empty text, or only blanks: no shingle, linked with nothing.  Fewer than ``k`` words:
one shingle of all.  Null id: sorted before all ids; returned as null.  Rows of equal id are
documents of their own.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import textnum
from courtline.llm.common import MIN_LONG, order_key, shuffle_partitions, written
from courtline.llm.components import connected_components

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
BINS, DEVIATIONS = 1024, 4.5
NEIGHBOURS = 2              # neighbour rounds before the rest is compared
BLOCK = 512                 # members of a bucket compared with each other in one go
SALTS = 1024                # tasks that a hub's pairs may go to

_rng = np.random.default_rng(20240131)
_A = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined; first of each text, and the end."""
    flat, starts = textnum.joined(texts)
    words, first = textnum.word_hashes(textnum.LOWER[flat], starts, textnum.BLANKS)
    out, at = [], [0]
    mult = [np.uint64(pow(0xD6E8FEB86659FD93, k - 1 - i, 1 << 64)) for i in range(k)]
    with np.errstate(over="ignore"):
        n = len(words) - k + 1
        runs = sum((words[i:n + i] * mult[i] for i in range(k)), np.zeros(n, np.uint64)) if n > 0 else None
        for a, z in zip(first[:-1], first[1:], strict=True):
            if z - a >= k:
                s = np.unique(textnum.mixed(runs[a:z - k + 1]))
            elif z > a:     # shorter sequences, kept apart by their length
                s = textnum.mixed(np.array([sum((w * m for w, m in zip(words[a:z], mult[k - (z - a):], strict=True)), np.uint64(z - a))], np.uint64))
            else:
                s = np.zeros(0, np.uint64)
            out.append(s)
            at.append(at[-1] + len(s))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.array(at)


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MINIMA 32-bit minima of each non-empty set."""
    full = np.flatnonzero(np.diff(at))
    sig = np.zeros((len(at) - 1, MINIMA), np.uint32)
    if not len(full):
        return sig
    begins, step, run = at[full], 1 << 16, 32
    with np.errstate(over="ignore"):
        for lo in range(0, len(full), run):      # a run of sets that stays in the processor's cache
            b = begins[lo:lo + run]
            end = at[full[min(lo + run, len(full)) - 1] + 1]
            x = sets[b[0]:end]
            if len(x) <= step:
                for i in range(MINIMA):
                    sig[full[lo:lo + run], i] = np.minimum.reduceat((x * _A[i] + _B[i]) >> np.uint64(32), b - b[0])
            else:
                for j, a in enumerate(b):
                    z = at[full[lo + j] + 1]
                    for i in range(MINIMA):
                        sig[full[lo + j], i] = min(int(((sets[p:min(p + step, z)] * _A[i] + _B[i]) >> np.uint64(32)).min()) for p in range(a, z, step))
    return sig


def bin_minima(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set and range of hashes eight bits of the least hash there (0: none)."""
    out = np.zeros((len(at) - 1, BINS), np.uint8)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = owner * BINS + (sets >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))      # sets are sorted
    out.ravel()[place[first]] = 1 + (sets[first] % np.uint64(255)).astype(np.uint8)
    return out


def alike(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Estimated similarity of one signature to others; -1 where it cannot reach the threshold."""
    has, goal = others > 0, percent / 100
    either = np.maximum((has | (one > 0)).sum(1), 1)
    share = ((others == one) & has).sum(1) / either
    # the bins sample ``either`` of the union's members, of which there are at most so many at the threshold
    rest = np.maximum(0.0, 1 - either * (1 + goal) / np.maximum(sizes + size, 1))
    return np.where(share >= goal - 0.01 - DEVIATIONS * np.sqrt(goal * (1 - goal) / either * rest), share, -1.0)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for r in range(ROWS):
            key = textnum.mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    return key.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """key, text_hash, n (set size), node (class), sig (size and bin minima), bands (keys)."""
    def run(batches):
        for b in batches:
            for at, texts in textnum.slices(b.column(2)):
                sets, ends = shingle_sets(texts, k)
                n = np.diff(ends)
                sig, keys = bin_minima(sets, ends), band_keys(signatures(sets, ends))
                with np.errstate(over="ignore"):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textnum.mixed(sets + np.uint64(1)), dtype=np.uint64)])
                    node = textnum.mixed((total[ends[1:]] - total[ends[:-1]]) ^ n.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(at, len(texts)) for i in (0, 1)), pa.array(n), pa.array(node),
                     pa.array([int(m).to_bytes(8, "little") + s.tobytes() for m, s in zip(n, sig, strict=True)], pa.binary()),
                     pa.array([k.tobytes() for k in keys], pa.binary())], names=["key", "text_hash", "n", "node", "sig", "bands"])

    return (docs.select(order_key(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
            .mapInArrow(run, "key long, text_hash long, n long, node long, sig binary, bands binary"))


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], names=["band", "node"])

    return classes.select("node", "bands").mapInArrow(run, "band long, node long")


def _unpacked(sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and bin minima."""
    both = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), 8 + BINS)
    return np.ascontiguousarray(both[:, :8]).view("<i8").ravel(), both[:, 8:]


def _against_hub(pairs: DataFrame, table: DataFrame, value: str, keep) -> DataFrame:
    """Pairs (a, b) for which ``keep(value of a, [values of b])`` holds, from table (node, value).
    Both values are fetched by one join; a hub's pairs go to up to SALTS tasks."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    wanted = (salted.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role"))
              .unionByName(salted.select(F.col("a").alias("node"), "a", "salt", F.lit(0).alias("role")).distinct()))
    rows = table.select("node", value).join(wanted.hint("shuffle_hash"), "node").select("a", "salt", "role", "node", value)

    def run(batches):
        hub = mine = None
        for b in (whole.slice(lo, 512) for whole in batches for lo in range(0, whole.num_rows, 512)):
            a, salt, role, node, val = (b.column(i).to_pylist() for i in range(5))
            i, out = 0, []
            while i < len(a):
                if role[i] == 0:
                    hub, mine = (a[i], salt[i]), val[i]
                    i += 1
                    continue
                j = i
                while j < len(a) and role[j] == 1 and (a[j], salt[j]) == hub and j - i < 256:
                    j += 1
                if j == i:
                    raise ValueError(f"class {a[i]} has no value")
                out += [(a[i], node[i + x]) for x in np.flatnonzero(keep(mine, val[i:j]))]
                i = j
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return (rows.repartition(shuffle_partitions(pairs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "role")
            .mapInArrow(run, "a long, b long"))


def _similar(percent: int):
    def keep(one: bytes, others: list[bytes]) -> np.ndarray:
        sizes, sigs = _unpacked([one, *others])
        return alike(sigs[0], sizes[0], sigs[1:], sizes[1:], percent) >= 0
    return keep


def _linked(k: int, percent: int):
    def keep(one: str, others: list[str]) -> np.ndarray:
        sets, at = shingle_sets([(t or "").encode() for t in [one, *others]], k)
        mine, out = sets[:at[1]], []
        for a, z in zip(at[1:-1], at[2:], strict=True):
            both = len(np.intersect1d(mine, sets[a:z], assume_unique=True))
            out.append(100 * both >= percent * (len(mine) + z - a - both))
        return np.array(out, bool)
    return keep


def _crossing(members: DataFrame, classes: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of different components in a bucket whose signatures agree, in the first band that they
    share; with ``nearest`` only each member's best in its block.  Members are (band, node, label,
    m: members of the bucket), compared in blocks."""
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = own.select("node", "band", "label", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                      (F.col("own") > F.col("other")).cast("int").alias("side"))
    rows = classes.select("node", "sig", "bands").join(rows.hint("shuffle_hash"), "node").select("band", "p", "q", "side", "node", "label", "sig", "bands")

    def pairs(at, group):
        if len(group) < 2:
            return
        band, p, q = at
        side, node, label = (np.array([r[i] for r in group]) for i in (0, 1, 2))
        sizes, sigs = _unpacked([r[3] for r in group])
        keys = np.frombuffer(b"".join(r[4] for r in group), np.int64).reshape(len(group), BANDS)
        for i in range(len(group)):
            apart = label != label[i]
            apart &= (np.arange(len(group)) > i) if p == q and not nearest else (side != side[i] if nearest and p != q else side > side[i]) if p != q else True
            there = np.flatnonzero(apart)
            if not len(there):
                continue
            like = alike(sigs[i], sizes[i], sigs[there], sizes[there], percent)
            if nearest:
                there = there[[like.argmax()]] if like.max() >= 0 else there[:0]
            else:
                there = there[like >= 0]
                same = keys[there] == keys[i]
                there = there[keys[i][same.argmax(1)] == band]
            for j in there:
                yield min(node[i], node[j]), max(node[i], node[j])

    def run(batches):
        at, group, out = None, [], []
        for b in batches:
            for band, p, q, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (band, p, q) != at:
                    out += pairs(at, group)
                    at, group = (band, p, q), []
                group.append(rest)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
                out = []
        if out := [*out, *pairs(at, group)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return (rows.repartition(shuffle_partitions(members.sparkSession), "band", "p", "q").sortWithinPartitions("band", "p", "q", "node")
            .mapInArrow(run, "a long, b long").distinct())


def _stars(members: DataFrame) -> DataFrame:
    """Each bucket's members with its hub."""
    rated = members.join(members.groupBy("node").agg(F.sum("m").alias("filled")), "node")
    hubs = (rated.groupBy("band").agg(F.max("filled").alias("filled")).join(rated, ["band", "filled"])
            .groupBy("band").agg(F.min("node").alias("a")))
    return members.join(hubs, "band").where("node != a").select("a", F.col("node").alias("b")).distinct()


def components(classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Components (node, label) of confirmed links that connect what the threshold connects, from classes (node, sig, bands)
    and texts (node, text)."""
    bands = written(_bands(classes), "minhash-bands")
    shared = bands.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    open_ = written(bands.join(shared, "band"), "minhash-open")
    # only classes that share a bucket are looked at from here on
    some = open_.select("node").distinct().hint("shuffle_hash")
    classes = written(classes.join(some, "node", "left_semi"), "minhash-candidates")
    texts = written(texts.join(some, "node", "left_semi"), "minhash-texts", compression="zstd")
    labels, confirm = None, _linked(k, percent)
    for turn in range(NEIGHBOURS + 2):
        if turn == 0:
            pairs = _against_hub(written(_stars(open_), "minhash-pairs"), classes, "sig", _similar(percent))
        else:
            pairs = _crossing(open_, classes, percent, nearest=turn <= NEIGHBOURS)
        pairs = written(pairs, "minhash-pairs")     # each side of the pairs is looked up: compute them once
        new = written(_against_hub(pairs, texts, "text", confirm).select(F.col("a").alias("u"), F.col("b").alias("v")), "minhash-links")
        # each node and its label are all that is left of former links
        labels = connected_components(new if labels is None else new.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
        if turn > NEIGHBOURS:
            break
        # buckets that still hold several components
        named = (open_.select("band", "node").join(labels, "node", "left")
                 .select("band", "node", F.coalesce("label", "node").alias("label")))
        mixed = named.groupBy("band").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("band", "m")
        open_ = written(named.join(mixed, "band"), "minhash-open")
        if open_.isEmpty():
            break
    return labels


def _members(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """key, n, own (least key of the component), text_hash, part (the component's node; null without shingles)."""
    sketch = written(sketches(docs, id_col, text_col, k), "minhash-sketches")
    classes = sketch.where("n > 0").groupBy("node").agg(F.min("key").alias("low"))
    # one row of a class carries its signature and its text
    first = sketch.where("n > 0").join(classes.hint("shuffle_hash"), "node").where("key = low").select("node", "key", "text_hash", "sig", "bands").dropDuplicates(["node"])
    first = written(first, "minhash-classes")
    texts = (docs.select(order_key(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
             .join(first.select("key", "text_hash", "node").hint("shuffle_hash"), ["key", "text_hash"]).select("node", "text").dropDuplicates(["node"]))
    labels = components(first.select("node", "sig", "bands"), texts, k, percent)
    low = labels.join(classes, "node").groupBy("label").agg(F.min("low").alias("whole"))
    linked = labels.join(low, "label").select("node", "label", "whole")
    out = sketch.select("key", "text_hash", "n", "node").join(classes, "node", "left").join(linked, "node", "left")
    own = F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("whole", "low"))
    return out.select("key", "n", own.alias("own"), "text_hash", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("part"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (least id of the component), kept; and text_hash."""
    null = lambda c: F.when(F.col(c) != MIN_LONG, F.col(c))
    return _members(docs, id_col, text_col, k, percent).select(
        null("key").alias("doc_id"), F.col("n").alias("n_shingles"), null("own").alias("component_id"), (F.col("key") == F.col("own")).alias("kept"), "text_hash")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = 5, percent: int = 85) -> DataFrame:
    """The rows of one document of each component, all columns as they are.  Of rows of equal id
    in one component the one with the least text hash stays, and of rows of equal id and text the least
    by all its columns."""
    found = _members(docs, id_col, text_col, k, percent).where("key = own")
    # by the component's node: components of different texts can have the same least id
    chosen = (found.where("n > 0").groupBy("part", "key").agg(F.min("text_hash").alias("r_hash")).select(F.col("key").alias("r_key"), "r_hash")
              .unionByName(found.where("n = 0").select(F.col("key").alias("r_key"), F.col("text_hash").alias("r_hash")).distinct()))
    rows = docs.select(F.struct(*docs.columns).alias("row"), order_key(id_col).alias("key"), F.xxhash64(text_col).alias("hash"))
    rows = rows.join(chosen.hint("shuffle_hash"), (F.col("key") == F.col("r_key")) & (F.col("hash") == F.col("r_hash")))
    # of rows of equal id and text the least, so that a rerun keeps the same one
    return rows.groupBy("key", "hash").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
