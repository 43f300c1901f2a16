"""Exact substring dedup by prefix-free parsing.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier (in a
document of smaller id, or earlier in the same one).

Parse.  Rolling hashes of ``GRAM`` bytes are triggers: the trigger of a string of ``LENGTH`` bytes
is its gram of the least hash (the first of equal ones), so equal strings have equal triggers at
equal places.  Neighbouring strings of one trigger make a phrase: the bytes from the first
string's start to the last one's end.  The dictionary is the set of distinct phrases, known by
(trigger, hash of the phrase); the parse is the list of their occurrences in corpus order.

Order.  Of the order of the corpus' suffixes by ``LENGTH`` bytes only the groups of equal strings,
each in corpus order, are needed; they are found from coarse to fine.  Strings in equal phrases need
no comparison: all occurrences of a phrase but the first are repeats as a whole.  Different phrases
share strings only if they have the same trigger: the first occurrences of such phrases are cut into
pieces of up to ``STEP`` neighbouring strings, pieces that could share a string are brought together by
the bytes common to all of them, and again all but the first of equal pieces are repeats.  What is left
(first occurrences of pieces that differ, at the ends of shared passages) is compared string by string.
A suffix array of dictionary and parse would bring the same groups together, but a passage that a third
of the documents share would lie in one range of it, in one task.

Identity is that of two 64-bit hashes (the trigger's and the phrase's or string's).  Triggers with
many occurrences are found in a sample of documents (at most ten per shuffle partition) and their
occurrences are dealt over ``SALTS`` tasks; that changes the plan, not the result.

Null or empty texts and texts shorter than ``LENGTH`` bytes: nothing removed.  Null id: before all
ids, returned as null.  Rows of equal id and different text are ordered by a hash of the text;
equal rows count once and have equal results.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textnum
from courtline.llm.common import MIN_LONG, order_key, shuffle_partitions, written

LENGTH, GRAM = 100, 32
STEP = 8                    # places of the trigger in the strings of a piece
SALTS = 32
SAMPLE = 64                 # one document of so many is looked through for frequent triggers
SEGMENT = 1 << 22           # starts of strings that are parsed at once (places have 24 bits)
START_BITS, MORE_BITS = 40, 7       # a place: byte offset, further starts
GROUP = 1 << 20             # bytes of spans that are looked at together
SHARED = 1 << 16            # buckets of ids in which some id has several texts


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    m, w = h, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[:len(h) - width + 1], m[width - w:]) if w < width else m


def _sums(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = textnum.powers(len(flat))
    run = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:len(flat)], out=run[1:])
    return run, down


def _triggers(run: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and the place of each string's trigger."""
    gram = _hash(run, down, np.arange(len(run) - GRAM), np.arange(GRAM, len(run)))
    tagged = (gram & ~np.uint64((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64)
    return gram, (_least(tagged, LENGTH - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)


def _hash(run: np.ndarray, down: np.ndarray, a, z) -> np.ndarray:
    """Hashes of the bytes from a to z."""
    with np.errstate(over="ignore"):
        return textnum.mixed((run[z] - run[a]) * down[a])


def parse(flat: np.ndarray, starts: np.ndarray | None = None):
    """Phrases of bytes: trigger's hash, phrase's hash, first and last start of their strings.
    ``starts``: those of the strings that lie in one document, ascending (all, if None)."""
    n = len(flat) - LENGTH + 1
    starts = np.arange(max(n, 0)) if starts is None else starts
    if n <= 0 or not len(starts):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    run, down = _sums(flat)
    gram, at = _triggers(run, down)
    t = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    lo, hi, t = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1], t[new]
    with np.errstate(over="ignore"):
        phrase = textnum.mixed(_hash(run, down, lo, hi + LENGTH) + textnum.mixed(((t - lo) * 1024 + hi - lo).astype(np.uint64)))
    return gram[t], phrase, lo, hi


class Strings:
    """The strings that start in some spans (first, last, number of the text) of texts: where they start
    (number and start in one long, see ``_split``), trigger's hash and place, and hashes of any of their
    bytes.  Only the bytes of spans are looked at, those of many texts at once."""

    def __init__(self, texts: list[bytes], lo: np.ndarray, hi: np.ndarray, doc: np.ndarray):
        n = hi - lo + 1
        ends = np.cumsum(n)
        c = np.repeat((doc << START_BITS) + lo - ends + n, n) + np.arange(ends[-1])
        if (c[1:] <= c[:-1]).any():
            c = np.unique(c)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(c) > LENGTH) + 1, [len(c)]])
        edge = np.concatenate([*(np.arange(a, z, SEGMENT) for a, z in zip(edge[:-1], edge[1:], strict=True)), [len(c)]]) if len(c) > SEGMENT else edge
        first, size = c[edge[:-1]], c[edge[1:] - 1] - c[edge[:-1]] + LENGTH
        part = np.cumsum(size) // SEGMENT
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(size)]])
        self.parts = []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            flat = np.frombuffer(b"".join(texts[d][a:a + m] for d, a, m in zip(*(x.tolist() for x in (*_split(first[i:j]), size[i:j])), strict=True)), np.uint8)
            mine = c[edge[i]:edge[j]]
            o = mine + np.repeat(np.cumsum(size[i:j]) - size[i:j] - first[i:j], np.diff(edge[i:j + 1]))
            run, down = _sums(flat)
            gram, at = _triggers(run, down)
            self.parts.append((mine, o, gram, at[o], run, down))

    def each(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Trigger's hash, string's hash, start."""
        out = [(gram[t], _hash(run, down, o, o + LENGTH), c) for c, o, gram, t, run, down in self.parts]
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def pieces(self) -> tuple[np.ndarray, ...]:
        """Neighbouring strings with the trigger at nearly the same place (``STEP`` places): hash of
        trigger, place and the bytes common to all that could be there; hash of the piece; first and
        last start; the trigger's hash."""
        out = []
        for c, o, gram, t, run, down in self.parts:
            q = (t - o) // STEP
            new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (q[1:] != q[:-1]) | (o[1:] != o[:-1] + 1)]))
            end = np.concatenate([new[1:], [len(o)]]) - 1
            lo, hi, t, q = o[new], o[end], t[new], q[new]
            with np.errstate(over="ignore"):
                core = _hash(run, down, t - q * STEP, t - q * STEP + LENGTH - STEP + 1)
                g = textnum.mixed(core * np.uint64(0x9E3779B97F4A7C15) + gram[t] + q.astype(np.uint64))
                x = textnum.mixed(_hash(run, down, lo, hi + LENGTH) + textnum.mixed(((t - lo) * 1024 + hi - lo).astype(np.uint64)))
            out.append((g, x, c[new], c[end], gram[t]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def shared_ids(docs: DataFrame) -> list[int]:
    """Buckets of the ids that have several texts, of (key, hash)."""
    several = docs.groupBy("key").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi")).where("lo != hi")
    return [r[0] for r in several.select(_bucket("key")).distinct().collect()]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SHARED)).cast("int")


def tied(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, tie, text.  The tie tells texts of one id apart: the text's 64-bit hash, or 0 in buckets of
    ids that have one text each (a column of zeros takes little room)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(order_key(id_col).alias("key"), F.xxhash64(text).alias("hash"), text.alias("text"))
    shared = np.zeros(SHARED, bool)
    shared[shared_ids(rows.select("key", "hash"))] = True
    if not shared.any():
        return rows.select("key", F.lit(0).cast("long").alias("tie"), "text")
    bits = np.packbits(shared).tobytes()

    def run(batches):
        has = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for b in batches:
            ties = np.where(has[b.column(1).to_numpy()], b.column(2).to_numpy(), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ties, pa.int64()), b.column(3)], names=["key", "tie", "text"])

    return rows.select("key", _bucket("key").alias("bucket"), "hash", "text").mapInArrow(run, "key long, tie long, text string")


def _place(lo, more):
    """First start and the number of starts after it in one long that sorts in this order."""
    return (lo << MORE_BITS) + more


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _salts(h: np.ndarray, docs: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """0, or for frequent triggers 1 to SALTS by document."""
    salt = np.zeros(len(h), np.int32)
    if len(frequent):
        hot = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
        salt[hot] = 1 + (textnum.mixed(docs[hot].view(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
    return salt


ROWS = "g long, salt int, x long, key long, tie long, place long"
NAMES = ["g", "salt", "x", "key", "tie", "place"]


def phrases(docs: DataFrame, frequent: np.ndarray | None = None) -> DataFrame:
    """The parse of (key, tie, text): trigger (salted if frequent), phrase, document and place."""
    frequent = np.zeros(0, np.int64) if frequent is None else np.sort(frequent)

    def rows(keys, ties, h, x, lo, hi):
        g = h.view(np.int64)
        return _batch(NAMES, g, _salts(g, keys ^ ties, frequent), x.view(np.int64), keys, ties, _place(lo, hi - lo))

    def run(batches):
        for b in batches:
            all_keys, all_ties = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at, texts in textnum.slices(b.column(2)):
                keys, ties = all_keys[at:at + len(texts)], all_ties[at:at + len(texts)]
                if len(texts) == 1 and len(texts[0]) > SEGMENT:
                    for j in range(0, len(texts[0]) - LENGTH + 1, SEGMENT):
                        h, x, lo, hi = parse(np.frombuffer(texts[0][j:j + SEGMENT + LENGTH - 1], np.uint8))
                        yield rows(np.repeat(keys, len(h)), np.repeat(ties, len(h)), h, x, lo + j, hi + j)
                    continue
                size = np.array([len(t) for t in texts])
                ends = np.cumsum(size)
                begins = ends - size
                flat = np.frombuffer(b"".join(texts), np.uint8)
                full = np.flatnonzero(size >= LENGTH)       # begins of these are distinct
                change = np.zeros(len(flat) + 1, np.int32)
                np.add.at(change, begins[full], 1)
                np.add.at(change, ends[full] - LENGTH + 1, -1)
                h, x, lo, hi = parse(flat, np.flatnonzero(np.cumsum(change[:-1])))
                if len(h):
                    doc = full[np.searchsorted(begins[full], lo, "right") - 1]
                    yield rows(keys[doc], ties[doc], h, x, lo - begins[doc], hi - begins[doc])

    return docs.select("key", "tie", "text").mapInArrow(run, ROWS)


def frequent_triggers(docs: DataFrame) -> np.ndarray:
    """Triggers that would hold a tenth of a task's rows or more, judged by a sample."""
    parts = shuffle_partitions(docs.sparkSession)
    some = docs.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0)
    seen = phrases(some.select("key", F.lit(0).cast("long").alias("tie"), "text")).groupBy("g").agg(F.count("*").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    return np.array([r[0] for r in seen.where(F.col("n") >= max(4, total / (10 * parts))).select("g").collect()], np.int64)


MARKS = "kind int, g long, x long, key long, tie long, place long"
MARK_NAMES = ["kind", "g", "x", "key", "tie", "place"]
REPEAT, FIRST, LEADER = 0, 1, 2


def _firsts(rows: DataFrame, leaders: bool = False) -> DataFrame:
    """From rows (g, salt, x, key, tie, place) in corpus order: REPEAT, any occurrence of (g, x) but the
    first; FIRST, the first of an x whose g has other x too; LEADER, the first of an x in its salt.
    The rows may be such ``leaders``: then every first is a FIRST."""
    def run(batches):
        last = waiting = None
        for b in batches:
            g, salt, x, key, tie, place = (c.to_numpy() for c in b.columns)
            n = len(g)
            if not n:
                continue
            before = [np.concatenate([[v], c[:-1]]) for v, c in zip(last or (0, 0, 0, 0, 0, 0), (g, salt, x, key, tie, place), strict=True)]
            new_group = (g != before[0]) | (salt != before[1])
            if last is None:
                new_group[0] = True
            new_x = new_group | (x != before[2])
            again = ~new_x & (key == before[3]) & (tie == before[4]) & (place == before[5])      # the same row of the table twice
            last = (g[-1], salt[-1], x[-1], key[-1], tie[-1], place[-1])
            kind = np.where(new_x, FIRST, np.where(again, -1, REPEAT))
            held = None
            if not leaders:
                starts = np.flatnonzero(new_group)
                if waiting and new_x[:starts[0] if len(starts) else n].any():
                    held, waiting = waiting, None
                if len(starts):
                    alone = np.add.reduceat(new_x.astype(np.int64), starts) == 1
                    kind[starts[alone]] = -1
                    i = int(starts[-1])
                    waiting = (g[i], x[i], key[i], tie[i], place[i]) if alone[-1] and not salt[i] else None
                kind = np.where(new_x & (salt > 0), LEADER, kind)
            keep = np.flatnonzero(kind >= 0)
            kind = kind[keep].astype(np.int32)
            once = kind == REPEAT       # a repeat's hashes are not needed any more
            yield _batch(MARK_NAMES, kind, np.where(once, 0, g[keep]), np.where(once, 0, x[keep]), key[keep], tie[keep], place[keep])
            if held:
                yield _batch(MARK_NAMES, np.array([FIRST], np.int32), *(np.array([v], np.int64) for v in held))

    by = ["g", "x"] if leaders else ["g", "salt"]
    return (rows.select(*NAMES).repartition(shuffle_partitions(rows.sparkSession), *by)
            .sortWithinPartitions(*by, *(c for c in ("x", "key", "tie", "place") if c not in by)).mapInArrow(run, MARKS))


def _settled(rows: DataFrame, salted: bool, name: str | None = None) -> DataFrame:
    """REPEAT and FIRST of the rows, those of frequent triggers through their leaders."""
    once = _firsts(rows)
    if name:
        once = written(once, name)
    if not salted:
        return once
    lead = once.where(F.col("kind") == LEADER).withColumn("salt", F.lit(0))
    return once.where(F.col("kind") != LEADER).unionByName(_firsts(lead, leaders=True))


def _spans(rows: DataFrame) -> DataFrame:
    """Per document (key, tie) the places of its rows."""
    return rows.groupBy("key", "tie").agg(F.collect_list("place").alias("places"))


def _unpacked(places) -> tuple[np.ndarray, np.ndarray]:
    p = np.asarray(places, np.int64)
    return p >> MORE_BITS, p & ((1 << MORE_BITS) - 1)


def _split(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and start."""
    return at >> START_BITS, at & ((1 << START_BITS) - 1)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists of longs, and where each row's begin (and the end); null is empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _groups(b: pa.RecordBatch):
    """Keys, ties and strings of a few documents each (key, tie, text, places) of a batch; a document is in one group."""
    keys, ties = b.column(0).to_numpy(), b.column(1).to_numpy()
    values, edge = _lists(b.column(3))
    lo, more = _unpacked(values)
    size = np.concatenate([[0], np.cumsum(more + LENGTH)])[edge[1:]]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(size // GROUP)) + 1, [len(keys)]])
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if edge[i] < edge[j]:
            doc = np.repeat(np.arange(j - i), np.diff(edge[i:j + 1]))
            some = slice(edge[i], edge[j])
            order = np.lexsort((lo[some], doc))
            texts = [t.encode() for t in b.column(2).slice(i, j - i).to_pylist()]
            yield keys[i:j], ties[i:j], Strings(texts, lo[some][order], (lo + more)[some][order], doc[order])


def _pieces(texts: DataFrame, firsts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Pieces of first phrases, as rows for ``_firsts``."""
    frequent = np.sort(frequent)

    def run(batches):
        for b in batches:
            for keys, ties, strings in _groups(b):
                g, x, first, last, h = strings.pieces()
                doc, lo = _split(first)
                yield _batch(NAMES, g.view(np.int64), _salts(h.view(np.int64), keys[doc] ^ ties[doc], frequent), x.view(np.int64), keys[doc], ties[doc], _place(lo, last - first))

    return texts.join(_spans(firsts).hint("shuffle_hash"), ["key", "tie"]).select("key", "tie", "text", "places").mapInArrow(run, ROWS)


def _strings(texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """The strings of first pieces: REPEAT if the document has the same string in an earlier one of
    them, else FIRST."""
    def run(batches):
        for b in batches:
            for keys, ties, strings in _groups(b):
                h, x, at = strings.each()
                order = np.lexsort((h, x))      # stable: equal strings of a document are together, the first one first
                h, x = h[order], x[order]
                doc, lo = _split(at[order])
                same = np.concatenate([[False], (h[1:] == h[:-1]) & (x[1:] == x[:-1]) & (doc[1:] == doc[:-1])])
                yield _batch(MARK_NAMES, np.where(same, REPEAT, FIRST).astype(np.int32), h.view(np.int64), x.view(np.int64), keys[doc], ties[doc], _place(lo, 0))

    return texts.join(_spans(firsts).hint("shuffle_hash"), ["key", "tie"]).select("key", "tie", "text", "places").mapInArrow(run, MARKS)


def repeats(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Strings that also start earlier: (key, tie, place), from docs and texts (key, tie, text; dealt by key and tie)."""
    frequent = frequent_triggers(docs)
    kind = lambda rows, k: rows.where(F.col("kind") == k)
    whole = _settled(phrases(docs, frequent), len(frequent) > 0, "repeats-phrases")
    parts = _settled(_pieces(texts, kind(whole, FIRST), frequent), len(frequent) > 0)
    single = _strings(texts, kind(parts, FIRST))
    candidates = kind(single, FIRST).select("g", "x", "key", "tie", "place", F.struct("key", "tie").alias("own"))
    least = candidates.groupBy("g", "x").agg(F.min("own").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = candidates.join(least, ["g", "x"]).where(F.col("own") > F.col("least"))
    out = [kind(r, REPEAT).select("key", "tie", "place") for r in (whole, parts, single)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(later.select("key", "tie", "place"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes left)."""
    plain = tied(docs, id_col, text_col)
    texts = plain.repartition(shuffle_partitions(docs.sparkSession), "key", "tie")

    def run(batches):
        for b in batches:
            out = []
            values, edge = _lists(b.column(2))
            lo, more = _unpacked(values)
            end = lo + more + LENGTH
            for i, (key, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                raw = kept = text.encode()
                spans = removed = 0
                if edge[i] < edge[i + 1]:
                    change = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(change, lo[edge[i]:edge[i + 1]], 1)
                    np.add.at(change, end[edge[i]:edge[i + 1]], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((None if key == MIN_LONG else key, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), *[kept] * keep_text))
            if out:
                types = [*[pa.int64()] * 4, pa.string(), *[pa.binary()] * keep_text]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return (texts.join(_spans(repeats(plain, texts)).hint("shuffle_hash"), ["key", "tie"], "left").select("key", "text", "places").mapInArrow(run, schema))
