"""The n-gram Jaccard join against brute force, on driver tables, on families of near copies and on odd rows."""

import random
import re

import numpy as np
import pytest

from courtline.llm import common, jaccard_join

SCHEMA = "doc_id long, text string, n long, node string, token string, label string, one int, key string, place string"


def brute(rows, k=3, percent=90):
    """(doc_id, set size, least id of the component) of (doc_id, text); rows of equal id apart."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    least = [r[0] for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    up[find(i)] = find(j)
    first = {}
    order = lambda d: (d is not None, d)  # noqa: E731  null ids come first
    for i, d in enumerate(least):
        root = find(i)
        first[root] = min(first.get(root, d), d, key=order)
    return sorted(((d, len(s), first[find(i)]) for i, (d, s) in enumerate(zip(least, sets, strict=True))), key=str)


def families(n=160):
    """Texts edited more or less, many of them close to the threshold, with shared passages."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    texts = []
    while len(texts) < n:
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 40, 120]))] + (passage.split() if rng.random() < 0.4 else [])
        for _ in range(rng.choice([1, 2, 8, 20])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    return texts


def odd_rows():
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(20_000))
    texts = [None, "", " \n ", "one", "One", "one two", "ONE two", "one two three", "a a a a a a", "a a a a", long, long + " tail", long, "é É ñ", "é É ñ"]
    # ids: null, repeated with other texts, repeated rows
    return [(i, t, 1, *"abcd"[:3], 1, "k", "p") for i, t in enumerate(families() + texts)] + [
        (None, "null ids are apart from each other here", 1, *"abc", 1, "k", "p"), (None, "unless their texts are alike in all words", 1, *"abc", 1, "k", "p"),
        (7, "one id with another text than before it", 1, *"abc", 1, "k", "p"), (7, "one two three", 1, *"abc", 1, "k", "p")] + [(3, "one two three", 1, *"abc", 1, "k", "p")] * 30


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def test_driver_table(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    assert got(jaccard_join.jaccard_components(docs)) == brute(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("k, percent, turns, block, early, share, few", [(3, 90, 3, 512, 4, 256, 4), (3, 90, 0, 5, 1, 2, 1), (2, 75, 1, 7, 15, 3, 2)])
def test_families_and_odd_rows(odd, monkeypatch, k, percent, turns, block, early, share, few):
    for name, value in (("HUB_TURNS", turns), ("FEW", few), ("BLOCK", block), ("EARLY", early), ("SHARE", share)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert got(jaccard_join.jaccard_components(odd, k=k, percent=percent)) == brute(odd.select("doc_id", "text").collect(), k, percent)


def test_pairs_at_the_threshold(spark):
    """All sizes about 90 of 100: linked at the threshold, apart one shingle under it."""
    rows = []
    for n in range(20, 200, 9):         # sets of n words each, k = 1
        for shared in range(-(-9 * n // 10), n):
            base = [f"s{n}x{shared}x{i}" for i in range(n)]
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[:shared] + [f"t{n}x{shared}x{i}" for i in range(n - shared)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard_join.jaccard_components(docs, k=1)) == brute(rows, 1)


def test_empty_table(spark):
    assert got(jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA))) == []


def test_tokens_keep_shingles_apart_and_fragments_in_order():
    rng = np.random.default_rng(1)
    sets = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    rank = rng.permutation(1 << jaccard_join.CELL_BITS).astype(np.uint32)
    toks = jaccard_join.tokens(sets, np.array([0, len(sets)]), rank)
    assert len(np.unique(toks)) == len(sets) and (np.diff(toks.astype(object)) > 0).all()
    cuts = np.sort(rng.choice(toks, jaccard_join.FRAGMENTS - 1, replace=False))
    lengths = jaccard_join._lengths(toks, np.array([0, len(toks)]), cuts)
    assert lengths.sum() == len(toks) and lengths[0, 0] == (toks < cuts[0]).sum()


def test_prefix_rows_are_dealt_out_once_and_keys_hold_their_sets(spark):
    """One shuffle by token, whatever is done with the rows; pairs of few sets are formed where their key's row is."""
    rng = random.Random(8)
    sets = {node: rng.randrange(20, 400) if node % 3 else rng.randrange(100, 120) for node in range(150)}
    rows = [(rng.randrange(90) if node % 3 else 7, node, n, place, 0, 0) for node, n in sets.items() for place in range(4)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    prefixes = spark.createDataFrame(rows + rows[::2], "token long, node long, n long, place int, low long, high long").repartition(5)
    keys = jaccard_join._keys(prefixes, 90)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(keys).count("Exchange hashpartitioning") == 1
    # sets of a key, by brute force
    width, by = 1.0001 * np.log(100 / 90), {}
    for token, node, n, *_ in rows:
        for size in (int(np.log(n) / width), int(np.log(n) / width) + 1):
            by.setdefault((token, size), set()).add(node)
    want = sorted(sorted(v) for v in by.values() if len(v) > 1)
    found = {}
    for r in keys.collect():
        assert len(r.sets) <= r.m
        found.setdefault((r.token, r.m), []).extend(x.node for x in r.sets)
    assert sorted(sorted(v) for v in found.values()) == want and all(len(v) == m for (_, m), v in found.items())
    assert any(len(v) > jaccard_join.FEW for v in want)
    few = common.written(keys.where(keys.m <= jaccard_join.FEW), "few")
    pairs = jaccard_join._few(few, 90)
    assert plan(pairs).count("Exchange hashpartitioning") == 1      # to make them distinct
    place = {(token, node): at for token, node, _, at, _, _ in rows}

    def possible(token, a, b):
        (n, i), (m, j) = ((sets[x], place[token, x]) for x in (a, b))
        return 100 * min(n, m) >= 90 * max(n, m) and min(i, j) + min(n - i, m - j) >= -(-90 * (n + m) // 190)

    assert {(r.a, r.b, r.both) for r in pairs.collect()} == {
        (a, b, sets[a] + sets[b]) for (token, _), v in by.items() if len(v) <= jaccard_join.FEW for a in v for b in v if a < b and possible(token, a, b)}


def test_a_bitmap_leaves_out_no_wanted_row(spark):
    rows = spark.range(20_000).selectExpr("id AS node", "id * 2 AS x")
    wanted = spark.range(0, 20_000, 7).selectExpr("id AS node")
    left = {r.node for r in jaccard_join._maybe_wanted(rows, wanted, "node").collect()}
    assert left >= set(range(0, 20_000, 7)) and len(left) < 4_000


# ------------------------------------------------------------------ MinHash classes
def test_equal_sets_are_one_class_wherever_they_stand(spark):
    from courtline.llm import minhash

    rng = random.Random(4)
    other = lambda: " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 300)))
    rows = [(i, "the same words in each of these many texts here" if i % 3 == 0 else other()) for i in range(300)]
    sketch = minhash.sketches(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text", 5)
    assert sketch.where("key % 3 = 0").select("node").distinct().count() == 1
    assert sketch.select("node").distinct().count() == 201


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    from courtline.llm import minhash

    rows = [(1, "one text of some words that all these rows have", f"s{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {minhash.representatives(docs.repartition(n, "source")).collect()[0].source for n in (1, 3, 7)} == {"s0"}


def test_parity_sketches_never_exceed_the_difference():
    """Bits that differ are at most the tokens that differ, also after folding, and most of them where sets are small."""
    rng = np.random.default_rng(3)
    for n, apart in ((1, 1), (40, 3), (300, 42), (255, 30), (257, 30), (3000, 400), (9000, 9000)):
        one = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        two = np.unique(np.concatenate([one[apart:], rng.integers(0, 2**63, apart // 2, dtype=np.uint64)]))
        sketch = jaccard_join.parities(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
        words = min(map(len, sketch))
        a, b = (jaccard_join.folded(s, words) for s in sketch)
        bits, real = int(np.bitwise_count(a ^ b).sum()), len(np.setxor1d(one, two))
        assert bits <= real and (bits - real) % 2 == 0
        assert bits > 0.6 * real or real > len(one) // 2
        for small in (4, 2, 1):
            assert int(np.bitwise_count(jaccard_join.folded(a, small) ^ jaccard_join.folded(b, small)).sum()) <= bits
