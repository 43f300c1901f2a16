"""Word runs and source divergence against plain recomputation, on driver tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from courtline.llm import common, divergence, runs

SCHEMA = "doc_id long, text string, lang string, source string, runs string, w string, h string, term string, count string, total string"


def odd_rows():
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(4_000))
    texts = [None, "", " \n\t ", "one", "a " * 500, "a b c " * 40 + "end", "x " * 5, "x " * 6, "A a é É ÉA _b-c 9z", long, long, "a b a b a b a b c c c c c c",
             "to be or not to be " * 30, "\x00a\x1fb \x0bc", "a" * 5000, "one", "   x"]
    rows = [(i if i % 5 else None, t, ["en", None, "de"][i % 3], [None, "s", "t", ""][i % 4], *"rwhtcz") for i, t in enumerate(texts)]
    return rows + [(5, "one two", "xx", f"only{i}", *"rwhtcz") for i in range(3)] + rows[5:8] * 6


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


# ------------------------------------------------------------------ runs
def plain_runs(w, least=6, power=4):
    seen = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_are_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 6)):
            w, size, letters = [], rng.choice([0, 1, 5, 7, 20, 60, 200]), rng.choice([1, 2, 3, 6])
            while len(w) < size:
                w += w[-rng.randint(1, 9):] * rng.randint(1, 8) if w and rng.random() < 0.4 else [rng.randrange(letters)]
            docs.append(w)
        starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = runs.runs_of(np.array(sum(docs, []), np.int64), starts)
        want = [(s + int(o), s + n + int(o), q) for o, d in zip(starts, docs, strict=False) for s, n, q in plain_runs(d)]
        assert [tuple(map(int, r)) for r in got] == sorted(want, key=lambda r: (r[0], r[2]))


def test_every_rule_derives_equal_words():
    rng = np.random.default_rng(4)
    t = np.concatenate([np.tile(rng.integers(0, 4, 7), 9), rng.integers(0, 3, 400)])
    rules, places, top = runs.repair(t, np.array([0, len(t)]))
    assert len(rules) and top[0]
    for rule, at in places:
        lo, _, hi = rules[rule]
        assert (t[lo:hi] == t[at:at + hi - lo]).all()
    left = np.flatnonzero(top)
    assert len(left) < len(t) / 2       # the start rule is shorter than the words


def test_wrong_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(runs._Equal, "same", lambda self, i, q, n: np.ones(len(i), bool))
    w = [0, 1, 0, 1, 0, 1, 0, 1, 2, 0, 1, 1, 0, 1, 1, 0, 1, 1, 0, 1, 1, 0, 3, 3, 3, 3, 3, 3, 3, 0]
    got = runs.runs_of(np.array(w), np.array([0, len(w)]))
    assert [(int(s), int(e - s), int(q)) for s, e, q in got] == plain_runs(w)


@pytest.mark.parametrize("which", ["driver", "odd"])
def test_word_runs_rows(spark, sf_dir, odd, which):
    docs = common.documents(spark, sf_dir) if which == "driver" else odd
    key = lambda r: str(r)
    got = sorted((tuple(r) for r in runs.word_runs(docs).collect()), key=key)
    assert got == sorted((plain_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=key)


def test_word_runs_of_nothing(spark):
    assert runs.word_runs(spark.createDataFrame([], SCHEMA)).collect() == []


# ------------------------------------------------------------------ divergence
def plain_divergence(rows, least_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})
        size = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        rate = lambda c, n: 1 + 1_000_000_000 * (c + 2) // (n + 2 * len(kept))  # noqa: B023, E731
        for s in sources:
            pairs = [(sum(gap(rate(counts[lang, s][t], size[s]), rate(counts[lang, o][t], size[o])) for t in kept), o) for o in sources if o != s]
            terms = []
            for t in kept:
                if counts[lang, s][t]:
                    p, q = rate(counts[lang, s][t], size[s]), rate(whole[t], sum(whole.values()))
                    terms += [(gap(p, q), t)] if p > q else []
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("least_docs, block, groups, width", [(10, 128, 32, 2048), (2, 3, 2, 5), (1, 1000, 4, 64)])
def test_divergence_is_that_of_plain_sums(spark, sf_dir, odd, monkeypatch, least_docs, block, groups, width):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "WIDTH", width)
    short = odd.where("coalesce(length(text), 0) < 10000")     # blocks of three terms: thousands for the long texts
    for docs in [odd, common.documents(spark, sf_dir)] if least_docs == 10 else [short]:
        got = divergence.source_divergence(docs, least_docs=least_docs).collect()
        assert sorted(map(tuple, got)) == plain_divergence(docs.select("text", "lang", "source").collect(), least_docs)


def test_joint_prices_in_narrow_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    table = rng.integers(0, 4, (40, 6)) * (rng.random((40, 6)) < 0.6)
    term, source = np.nonzero(table)
    totals = rng.integers(50, 90, 6)
    rates = 1 + 1_000_000_000 * (table + 2) // totals
    for width in (1, 3, 100):
        monkeypatch.setattr(divergence, "WIDTH", width)
        value, either = divergence.price(source, term, table[term, source], totals, np.arange(3), np.arange(2, 6))
        for i, a in enumerate(range(3)):
            for j, b in enumerate(range(2, 6)):
                held = (table[:, a] > 0) | (table[:, b] > 0)
                assert either[i, j] == held.sum()
                p, q = rates[held, a], rates[held, b]
                assert value[i, j] == ((p - q) ** 2 // (p + q)).sum()


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []
