"""Rows that broke an operator once: repeated queries, large values, shared ids, ties, long texts."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtline.llm import importance, jaccard_join, minhash, mixing, repeats, secrets, textnum, vector_search

LETTERS = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))


# ------------------------------------------------------------------ vectors
def brute_top(rows, k=5):
    """All rows (id, vector) against those whose id is divisible by 50, a row skipping only itself."""
    fine = [(i, [math.floor(c) if abs(c) >= 2**53 else math.floor(c * 256) for c in v], [abs(c) >= 2**53 for c in v])
            for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    ints = [(i, [c * 256 if big else c for c, big in zip(v, wide, strict=True)]) for i, v, wide in fine]
    out = []
    for at, (i, q) in enumerate(ints):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for n, (j, v) in enumerate(ints) if n != at and len(v) == len(q))[:k]
            out += [(i, r + 1, j, max(-2**63, min(2**63 - 1, -s))) for r, (s, j) in enumerate(best)]
    return Counter(out)


def top(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return Counter(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 50 == 0).collect())


def test_repeated_queries_and_shared_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [rows[50], rows[50], (50, rows[7][1]), (100, rows[100][1]), (3, rows[50][1]), (None, rows[50][1])]
    rows += [(200 + i, rows[9][1]) for i in range(40)] + [(500, []), (501, []), (550, [])]
    assert top(spark, rows) == brute_top(rows)


def test_large_finite_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 10.0 ** (i % 4)).tolist()) for i in range(110)]
    rows += [(50, [1e20, 1.0, -2.0, 0.5]), (150, [1e308, -1e308, 3.0, 0.0]), (151, [1.7e308, 1.0, 1.0, 1.0]), (152, [2.0**53 + 2, -(2.0**60), 1e9, -0.0])]
    rows += [(200, [1e18, 1e18, 0.0, 0.0]), (201, [1e18, 1e18, 1.0, 0.0]), (202, [float("nan")] * 4), (203, [1.0, None, 1.0, 1.0]), (250, None)]
    assert top(spark, rows) == brute_top(rows)


def test_bounds_hold_every_score(monkeypatch):
    rng = np.random.default_rng(3)
    for scale in (1e-3, 1.0, 1e6):
        x, q = (vector_search.whole(rng.normal(size=(n, 16)) * scale, 256) for n in (500, 20))
        lower, upper = vector_search.bounds(q, *vector_search.approximated(x))
        true = q @ x.T
        assert (lower <= true).all() and (true <= upper).all()
        own, entry, _, _ = vector_search.scan_block(q, *vector_search.approximated(x), 5)
        best = np.argsort(-true, axis=1)[:, :6]
        assert all(set(best[i]) <= set(entry[own == i]) for i in range(20))
        assert len(own) < 20 * 500 / 3 or scale < 1        # most exact vectors are never read


def test_copies_of_queries_are_not_broadcast(spark, monkeypatch):
    """240 queries, for each of 1200 files: 150 MB of copies, which Spark took for the 120 kB that they are made of."""
    rng = np.random.default_rng(4)
    rows = [(i * 10, rng.normal(size=64).tolist()) for i in range(1200)]
    monkeypatch.setattr(vector_search, "ENTRIES", 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    try:
        spark.conf.set("spark.sql.maxBroadcastTableSize", "72m")   # the least page of a small table counts as up to 64 MB
        got = Counter(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 50 == 0).collect())
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert got == brute_top(rows)


@pytest.mark.parametrize("found", [1 << 20, 50])
@pytest.mark.parametrize("scale", [1.0, 1e6, 1e200, 1e301])
def test_a_tile_keeps_the_best_of_its_files(monkeypatch, scale, found):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(vector_search, "FOUND", found)
    x, q = (vector_search.whole(rng.normal(size=(n, 16)), 256) for n in (900, 20))
    x[450:] *= scale
    files = [(np.arange(i, i + 100), np.arange(i, i + 100), low, width, cells)
             for i in range(0, 900, 100) for cells, low, width in [vector_search.approximated(x[i:i + 100])]]
    own, a, b, lower, upper = (np.concatenate(c) for c in zip(*vector_search.scan_tile(q, files, 5), strict=True))
    true = q @ x.T
    assert (a == b).all() and (lower <= true[own, a]).all() and (true[own, a] <= upper).all()
    assert all(set(np.argsort(-true[i])[:6]) <= set(a[own == i]) for i in range(20))


def test_tiles_suffice_and_fit():
    for sent in [(0, 0, 16), (5 * 10**7, 2 * 10**6, 38), (12 * 10**8, 43 * 10**6, 1200), (10**11, 1, 24), (10**6, 10**11, 24)]:
        groups, parts = vector_search.dealt(*sent)
        assert groups * parts >= sent[2] and sent[0] <= groups * vector_search.TILE_BYTES


# ------------------------------------------------------------------ secrets
def test_time_of_a_long_text_follows_its_length():
    def seconds(n):
        text = "".join(f"token = {i:032x} plainwords{i} " for i in range(n))
        start = time.perf_counter()
        assert len(secrets.find(text, secrets.Models(secrets.transitions([text])))) >= n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16_000) < 40 * max(seconds(1_000), 0.01)


def test_spans_that_nest_are_all_avoided():
    text = "password=" + "0af3" * 10 + "x" * 30 + " " + "y" * 30
    spans = secrets.base_spans(text)
    assert [m[0] for m in secrets._apart(text, secrets.WORD, spans)] == ["y" * 30]


@pytest.mark.parametrize("n", [1_500, 6_000])
def test_hidden_secrets_are_found_at_any_size(spark, sf_dir, n):
    """One text in sixteen holds a random string of an alphabet that no labelled secret has; the
    labelled ones are hexadecimal.  Recall stays where the corpus, and what hides in it, is four
    times as large."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(3, 14))) for _ in range(400)]
    alphabets = [LETTERS, np.concatenate([LETTERS[:26], LETTERS[52:]]), LETTERS[26:], np.concatenate([LETTERS, list("+/_-")])]
    rows, planted = [], {}
    for i in range(n):
        text = " ".join(rng.choice(words, 40))
        if i % 30 == 1:
            text += f' token = "{rng.bytes(20).hex()}"'
        if i % 16 == 0:
            planted[i] = "".join(rng.choice(alphabets[i // 16 % 4], rng.choice([24, 32, 40])))
            text += f" key {planted[i]} end"
        rows.append((i, text))
    found, clean = 0, 0
    for r, (_, text) in zip(secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect(), rows, strict=True):
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("markov")]
        if r.doc_id in planted:
            at = text.index(planted[r.doc_id])
            found += ["markov", str(at), str(at + len(planted[r.doc_id]))] in spans
        else:
            clean += len(spans)
    assert found >= 0.9 * len(planted) and clean == 0


# ------------------------------------------------------------------ mixing, importance resampling
def test_rows_of_one_id_are_taken_one_by_one(spark):
    rows = [(None, "a b c d", "x")] * 100 + [(7, f"t{i} b c d", "y") for i in range(100)] + [(i, "a b c d", None) for i in range(100)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    assert len(got) == 300 and all(0 <= r.copies <= 2 for r in got)
    for source in ("x", "y", None):
        mine = [r for r in got if r.source == source]
        assert len(mine) == 100 and abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 4


def test_copies_of_a_row_are_unfolded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    df = spark.createDataFrame([("a",)] * 23 + [("b",)] * 7 + [("c",)], "key string")
    got = Counter(tuple(r) for r in mixing.numbered(df, "key").collect())
    assert got == Counter([("a", i + 1) for i in range(23)] + [("b", i + 1) for i in range(7)] + [("c", 1)])


def test_repeated_rows_do_not_exceed_the_fraction(spark):
    docs = spark.createDataFrame([(None, "same words here")] * 50, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.resample(docs, labels, fraction=0.8).where("kept").count() == 40


def test_weights_are_plain_sums(spark):
    rows = [(i, " ".join(f"w{(i * j) % 11}" for j in range(5 + 40 * (i % 4)))) for i in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")

    def grams(text):
        words = (text or "").split()
        return words + [tuple(p) for p in zip(words, words[1:])]

    def bucket(gram):
        word = lambda w: textnum.word_hashes(textnum.LOWER[np.frombuffer(w.encode(), np.uint8)], np.array([0, len(w)]), textnum.NOT_WORD)[0][0]
        with np.errstate(over="ignore"):
            h = word(gram) if isinstance(gram, str) else textnum.mixed(np.array([word(gram[0]) * np.uint64(0x9E3779B97F4A7C15) + word(gram[1])]))[0]
        return int(h % np.uint64(importance.BUCKETS))

    raw = Counter(bucket(g) for _, t in rows for g in grams(t))
    target = Counter(bucket(g) for i, t in rows[:60] if i % 2 for g in grams(t))
    share = {b: (raw[b] + 1) / (sum(raw.values()) + importance.BUCKETS) for b in raw}
    n = sum(target.values())
    want = {i: sum(math.log((target[b] + 0.02 * n * share[b]) / (n * 1.02)) - math.log(share[b]) for g in grams(t) for b in (bucket(g),)) for i, t in rows}
    got = importance.resample(docs, labels).collect()
    assert {r.doc_id for r in got} == set(want) and all(abs(r.log_weight - want[r.doc_id]) < 1e-6 for r in got)


def test_the_pipeline_joins_pairs_from_four_fifths(spark, sf_dir):
    words = [f"w{i}" for i in range(224)]
    near = words[:-20] + [f"z{i}" for i in range(20)]       # 200 of 240 shingles: 0.83
    far = words[:-30] + [f"y{i}" for i in range(30)]        # 190 of 250: 0.76
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()) == [1, 3]


# ------------------------------------------------------------------ work that was done twice
@pytest.mark.parametrize("module, dedup", [(minhash, minhash.near_duplicates), (jaccard_join, jaccard_join.jaccard_components)])
def test_components_are_formed_once_a_turn(spark, monkeypatch, module, dedup):
    """Near copies that the first turn links: their components are formed there, and not again at the end."""
    calls, formed = [], module.connected_components
    monkeypatch.setattr(module, "connected_components", lambda edges: calls.append(1) or formed(edges))
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([f"x{i}", *words] if i < 6 else [f"{w}-{i}" for w in words])) for i in range(12)]
    got = dict(r[:] for r in dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == {i: 0 if i < 6 else i for i in range(12)}
    assert len(calls) == 1


def test_strings_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (100, 130, 900, 5000, 260)]
    texts.append(texts[2][:400])
    lo, hi, doc = (np.array(c) for c in zip(*((a, a + m, d) for d, t in enumerate(texts) for a, m in ((0, 0), (5, 24), (20, 140), (310, 90), (1000, 700)) if a + m + repeats.LENGTH <= len(t)), strict=True))
    several = repeats.Strings(texts, lo, hi, doc)
    for kind, at in (("each", (2,)), ("pieces", (2, 3))):
        whole = Counter(zip(*(c.tolist() for c in getattr(several, kind)()), strict=True))
        alone = Counter()
        for d, t in enumerate(texts):
            found = getattr(repeats.Strings([t], lo[doc == d], hi[doc == d], np.zeros((doc == d).sum(), np.int64)), kind)()
            alone.update(zip(*((c + (d << repeats.START_BITS) if i in at else c).tolist() for i, c in enumerate(found)), strict=True))
        assert whole == alone
