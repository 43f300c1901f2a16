"""Document fingerprints by randomised edit embedding.

A walk reads a text one character at a time.  At step j it emits the character it stands on,
and moves on if a shared random bit of (j, character) is set.  Two texts a few edits apart soon
walk in step again, so their emitted strings differ in few places: edit distance becomes
Hamming distance.  The random bits repeat after ``PERIOD`` steps and characters are hashed to 256
classes, so the time a walk stays on a character is one lookup, and many texts walk at once.

The fingerprint has ``BITS`` bits.  Bit k is a random bit of the character emitted at position
p_k, the position below the emitted length with the least value of a shared random priority.
Positions are therefore spread over the whole text and agree between texts of nearly equal
length.  The priorities' running minima are drawn directly: after a minimum at place m the next
one lies at floor((m + 1) / u), u uniform.

Likeness is ``2 * (share of equal bits) - 1``, at least 0: 1 for equal texts, about 0 for unrelated.

Null text: empty; an empty text emits one mark of its own.  Null id: before all ids; returned as
null.  Equal ids: ordered by their text.  The next document of the last is the first; of a single
document it is itself.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import MIN_LONG, block_starts, order_key, shuffle_partitions
from courtline.llm.components import connected_components

BITS, PERIOD = 512, 1024
BANDS, BAND_BITS = 24, 20
FEW = 10                    # so few walks go on one by one
BATCH_CHARS = 4 << 20

_rng = np.random.default_rng(1789)
_STEP = _rng.integers(0, 2, (PERIOD, 256), dtype=np.uint8)


def _stays() -> np.ndarray:
    """Steps a walk that comes to class c at step j (mod PERIOD) needs to leave it."""
    _STEP[PERIOD - 1] = 1       # no walk stays for ever
    out = np.zeros((PERIOD, 256), np.int64)
    nxt = np.zeros(256, np.int64)
    for j in [*range(PERIOD - 1, -1, -1)] * 2:
        nxt = np.where(_STEP[j], 1, nxt + 1)
        out[j] = nxt
    return out


def _places() -> np.ndarray:
    """For each bit the places of its running minima, ascending, filled up with 2^62."""
    rows = []
    for u in _rng.random((BITS, 96)):
        place, row = 0, [0]
        for x in u:
            place = int((place + 1) / max(x, 1e-12))
            if place >= 1 << 40:
                break
            row.append(place)
        rows.append(row)
    out = np.full((BITS, max(map(len, rows))), 1 << 62, np.int64)
    for k, row in enumerate(rows):
        out[k, :len(row)] = row
    return out


_STAY = np.ascontiguousarray(_stays().T.astype(np.int32)).ravel()      # by class, then step
_STAY_LIST = _STAY.tolist()
_PLACES = _places()
_ROW = np.arange(BITS)
_MULT = _rng.integers(0, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_AT = np.array([np.sort(_rng.choice(BITS, BAND_BITS, replace=False)) for _ in range(BANDS)])


def walks(classes: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step at which each character is reached (texts joined), and the steps of each text."""
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    order = np.argsort(-lens, kind="stable")
    at, size, step = starts[order], lens[order], np.zeros(len(lens), np.int32)
    reached = np.empty(len(classes), np.int32)
    # all walks together while many are left: characters laid out by place, then text
    wide = int(size[FEW]) if len(size) > FEW else 0
    if wide:
        together = np.searchsorted(-size, -np.arange(wide), "left")     # texts longer than each place
        first = np.concatenate([[0], np.cumsum(together)])
        place = np.repeat(np.arange(wide), together)
        where = at[np.arange(first[-1]) - np.repeat(first[:-1], together)] + place
        cls = classes[where].astype(np.int32)
        cls <<= PERIOD.bit_length() - 1
        seen = np.empty(first[-1], np.int32)
        i, d = np.empty(len(lens), np.int32), np.empty(len(lens), np.int32)
        for k, a in zip(together.tolist(), first.tolist(), strict=False):
            j, ik, dk = step[:k], i[:k], d[:k]
            seen[a:a + k] = j
            np.bitwise_and(j, PERIOD - 1, out=ik)
            ik += cls[a:a + k]
            _STAY.take(ik, out=dk, mode="clip")
            j += dk
        reached[where] = seen
    for r in range(min(FEW, len(lens))):
        j, a, z = int(step[r]), int(at[r]) + min(wide, int(size[r])), int(at[r] + size[r])
        seen = []
        for c in classes[a:z].tolist():
            seen.append(j)
            j += _STAY_LIST[(c << 10) | (j & 1023)]
        reached[a:z] = seen
        step[r] = j
    total = np.zeros(len(lens), np.int64)
    total[order] = step
    return reached, total


def fingerprints(texts: list[str]) -> np.ndarray:
    """BITS bits (as bytes) of each text."""
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.array([len(t) for t in texts])
    with np.errstate(over="ignore"):
        classes = ((cps * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
        reached, total = walks(classes, lens)
        out = np.zeros((len(texts), BITS), np.uint8)
        a = 0
        for i, (n, steps) in enumerate(zip(lens.tolist(), total.tolist(), strict=True)):
            if n:
                place = _PLACES[_ROW, (_PLACES < steps).sum(1) - 1]
                own = cps[a + np.searchsorted(reached[a:a + n], place, "right") - 1].astype(np.uint64)
            else:
                own = np.full(BITS, 1 << 32, np.uint64)
            out[i] = ((own + np.uint64(1)) * _MULT) >> np.uint64(63)
            a += n
    return np.packbits(out, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of fingerprints row by row."""
    return np.maximum(0.0, 1 - 2 * np.unpackbits(a ^ b, axis=1).sum(1) / BITS)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text; one shuffle of the texts into ordered
    blocks.  A block also gets the first document of the next block."""
    spark = docs.sparkSession
    key = order_key(id_col)
    starts = block_starts(docs, key)

    def deal(batches):
        edges = np.array(starts, np.int64)
        for b in batches:
            keys = b.column(0).to_numpy()
            blk = np.searchsorted(edges, keys, "right") - 1
            first = np.flatnonzero(edges[blk] == keys)
            yield pa.RecordBatch.from_arrays([pa.array(blk.astype(np.int32)), pa.array(np.zeros(len(keys), np.int32)), *b.columns],
                                             names=["blk", "role", "key", "text"])
            if len(first):
                yield pa.RecordBatch.from_arrays([pa.array(((blk[first] - 1) % len(edges)).astype(np.int32)), pa.array(np.ones(len(first), np.int32)),
                                                  *(c.take(pa.array(first)) for c in b.columns)], names=["blk", "role", "key", "text"])

    def batch(rows):
        """rows: (key, text, next text)."""
        texts = [r[1] for r in rows]
        new = [edited(t, n) for _, t, n in rows]
        both = fingerprints(texts + new + [rows[-1][2]])
        own, other, nxt = both[:len(rows)], both[len(rows):-1], both[1:len(rows)]
        nxt = np.concatenate([nxt, both[-1:]])
        return pa.RecordBatch.from_arrays(
            [pa.array([None if r[0] == MIN_LONG else r[0] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]),
             pa.array([x.tobytes().hex() for x in own]), pa.array([x.tobytes().hex() for x in other]),
             pa.array(likeness(own, other)), pa.array(likeness(own, nxt))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        blk, held, rows, size, over = None, None, [], 0, False
        for b in batches:
            for g, role, k, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != blk:
                    blk, held, over = g, None, False
                if over:
                    continue            # further rows of the next block's first id
                if held:
                    rows.append((*held, t))
                    size += len(held[1])
                held, over = (k, t), role == 1
                # rows of one batch follow each other: each one's next text is the next row's text
                if rows and (over or size >= BATCH_CHARS or len(rows) >= 4096):
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(key.alias("key"), text.alias("text")).mapInArrow(deal, "blk int, role int, key long, text string")
            .repartition(shuffle_partitions(spark), "blk").sortWithinPartitions("blk", "role", "key", "text").mapInArrow(run, SCHEMA))


def near_pairs(prints: DataFrame, least: float = 0.7) -> DataFrame:
    """Near copies by fingerprint (doc_id, fingerprint): each document's class, the least id it is
    linked with over verified links.  Bands are samples of ``BAND_BITS`` bits; in a band's bucket
    every member is compared with the bucket's least id."""
    def bands(batches):
        weights = 1 << np.arange(BAND_BITS, dtype=np.int64)
        for b in batches:
            bits = np.unpackbits(np.array([np.frombuffer(bytes.fromhex(x), np.uint8) for x in b.column(1).to_pylist()]).reshape(b.num_rows, -1), axis=1)
            keys = bits[:, BAND_AT] @ weights + (np.arange(BANDS, dtype=np.int64) << BAND_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), BANDS)),
                                              b.column(1).take(pa.array(np.repeat(np.arange(b.num_rows), BANDS)))], names=["band", "id", "print"])

    rows = prints.where("doc_id is not null").select("doc_id", "fingerprint").mapInArrow(bands, "band long, id long, print string")
    hubs = rows.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("m")).where("m > 1")
    pairs = rows.join(hubs, "band").where("id != hub").select("hub", "id", "print").distinct()
    hub_prints = prints.select(F.col("doc_id").alias("hub"), F.col("fingerprint").alias("hub_print"))
    halves = [sum((F.bit_count(F.conv(F.substring("print", i, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("hub_print", i, 8), 16, 10).cast("long")))
                   for i in range(1, BITS // 4, 8)), F.lit(0))]
    linked = pairs.join(hub_prints, "hub").withColumn("like", 1 - 2 * halves[0] / BITS).where(F.col("like") >= least)
    labels = connected_components(linked.select(F.col("id").alias("u"), F.col("hub").alias("v")))
    return (prints.select("doc_id").join(labels, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", F.coalesce("label", "doc_id").alias("class_id")))
