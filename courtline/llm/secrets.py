"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary
identifiers compared by log-likelihood ratio.

The patterns mark assignments, access keys and hexadecimal runs.  The models mark further runs
of ``[A-Za-z0-9+/_=-]`` of ``LEAST_RUN`` characters or more that touch no pattern's span: both are
first-order chains over 67 symbols and a start, trained on the labelled runs of all documents.  Runs
that a pattern found are the random class, other runs of ``LEAST_WORD`` characters or more the
ordinary one.  The labelled secrets of a corpus may all be of one alphabet (hexadecimal keys, say), so
the random chain leans half on its letters and half on the uniform distribution.  Secrets that no
pattern marks lie among the ordinary runs, in proportion to the corpus: a second pass takes every run
that the first chains call random out of the ordinary class again, so recall does not fall as the
corpus grows.  A run is a secret if the ratio is at least ``LEAST_RATIO`` in all and ``LEAST_MEAN`` a
character.

Null or empty text: no spans.  Empty table: no rows.  Rows of equal id are rows of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")       # 16 or more: a shorter match ends its run
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
LEAST_RUN, LEAST_WORD = 20, 8
LEAST_RATIO, LEAST_MEAN = 25.0, 0.8
MASK = "[SECRET]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(128, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
START, SYMBOLS = len(ALPHABET), len(ALPHABET) + 1
_CODE[0] = START                                # a zero byte parts the runs


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    for run in RUN.finditer(text):      # the other patterns lie inside such runs
        a, s = run.start(), run[0]
        out += [(a + m.start(), 1, a + m.end()) for m in ACCESS.finditer(s)]
        out += [(a + m.start(), 2, a + m.end()) for m in HEX.finditer(s)]
    return sorted(out)


def _codes(s: str) -> np.ndarray:
    return _CODE[np.frombuffer(s.encode("ascii"), np.uint8)]


def _apart(text: str, pattern: re.Pattern, spans: list) -> list[re.Match]:
    """Matches that touch no span; spans are in order of their starts, both lists are read once."""
    out, at, far = [], 0, -1
    for m in pattern.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            far = max(far, spans[at][2])
            at += 1
        if far <= m.start():
            out.append(m)
    return out


def _pairs(runs: list[str]) -> np.ndarray:
    """Transition counts of the runs, their starts included."""
    c = _codes("".join("\0" + s for s in runs))
    inside = c[1:] != START
    return np.bincount(c[:-1][inside] * SYMBOLS + c[1:][inside], minlength=SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)


def transitions(texts: list[str | None]) -> np.ndarray:
    """Transition counts [random, ordinary] of labelled runs."""
    found = [], []
    for t in texts:
        if not t:
            continue
        spans = base_spans(t)
        found[0].extend(ASSIGN.match(s)[2].replace(".", "") if kind == 0 else s for a, kind, z in spans for s in (t[a:z],))
        found[1].extend(m[0] for m in _apart(t, WORD, spans))
    return np.stack([_pairs(f) for f in found])


def hidden(texts: list[str | None], models: Models) -> np.ndarray:
    """Transition counts of the runs among the ordinary ones that the models call random."""
    found = []
    for t in texts:
        if t and RUN.search(t):
            found += [m[0] for m in _apart(t, RUN, base_spans(t)) if models.score(m[0]) > 0]
    return _pairs(found)


class Models:
    """Log-likelihood ratio of two chains; without samples both are uniform."""

    def __init__(self, counts: np.ndarray):
        letters = [(n.sum(0) + 0.1) / (n.sum() + 0.1 * SYMBOLS) for n in counts]
        random = counts[0] + 500.0 * (letters[0] + 1 / SYMBOLS) / 2
        ordinary = counts[1] + 1000.0 * letters[1]
        if not counts[0].sum() or not counts[1].sum():
            random = ordinary = np.ones((SYMBOLS, SYMBOLS))
        self.ratio = np.log(random / random.sum(1, keepdims=True)) - np.log(ordinary / ordinary.sum(1, keepdims=True))

    def score(self, s: str) -> float:
        c = _codes(s)
        return float(self.ratio[START, c[0]] + self.ratio[c[:-1], c[1:]].sum())


def _summed(docs: DataFrame, text_col: str, counts: Callable[[list], np.ndarray], shape: tuple) -> np.ndarray:
    """``counts`` of all texts, summed; per task one row for each transition that occurs."""
    def count(batches):
        n = np.zeros(shape, np.int64)
        for b in batches:
            n += counts(b.column(0).to_pylist())
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.ravel()[at])], names=["at", "n"])

    out = np.zeros(np.prod(shape), np.int64)
    for at, n in docs.select(text_col).mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out.reshape(shape)


def fit(docs: DataFrame, text_col: str = "text") -> Models:
    """Models from the runs of all documents, in two passes."""
    counts = _summed(docs, text_col, transitions, (2, SYMBOLS, SYMBOLS))
    first = Models(counts)
    if first.ratio.any():
        counts[1] -= _summed(docs, text_col, lambda texts: hidden(texts, first), (SYMBOLS, SYMBOLS))
    return Models(counts)


def find(text: str | None, models: Models) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order."""
    if not text:
        return []
    spans = base_spans(text)
    more = []
    for m in _apart(text, RUN, spans):
        n = len(m[0])
        if n >= LEAST_RUN and (r := models.score(m[0])) >= LEAST_RATIO and r >= LEAST_MEAN * n:
            more.append((m.start(), 3, m.end()))
    return sorted(spans + more)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each maximal run of spans replaced by MASK."""
    out, at = [], 0
    for a, _, z in spans:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, z)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    def run(batches):
        for b in batches:
            rows = [find(t.as_py(), models) for t in b.column(1)]
            base = [[s for s in r if s[1] < 3] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([sum(s[1] == k for s in r) for r in base], pa.int64()) for k in range(3)),
                 pa.array([hashlib.sha256(listed(r).encode()).hexdigest() for r in base]), pa.array([listed(r) for r in rows])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def without_secrets(docs: DataFrame, models: Models, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows with every span masked in the text and, where there is one, the length set anew."""
    at = docs.columns.index(text_col)
    size = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        for b in batches:
            old = b.column(at).to_pylist()
            new = [masked(t, s) if t and (s := find(t, models)) else t for t in old]
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            if size is not None:
                n = [k if a is c else len(c) for a, c, k in zip(old, new, b.column(size).to_pylist(), strict=True)]
                b = b.set_column(size, b.schema.field(size), pa.array(n, b.schema.field(size).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def secrets(docs: DataFrame) -> DataFrame:
    return scan(docs, fit(docs))
