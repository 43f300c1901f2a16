"""Operators with an exact answer against brute force, on driver tables and on odd rows: nulls,
empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from courtline.llm import common, edit_embedding, minhash, mixing, packing, queries, repeats, secrets, token_files, vector_search

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, g int, h string, size string, score string, band string"
BASE = "the quick brown fox jumps over the lazy dog and then runs far away from all of them again "


def odd_rows():
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    texts = [None, "", "   \n", "one", "one two three", BASE * 3, BASE * 3, BASE * 3 + "end", "é" * 150, "x" * 400, long, long + " tail",
             "token = abcdefgh12345678 AKIA" + "B7" * 8 + " " + "0af3" * 10, "A  b\n\n c's it's", "plain words here only"]
    return [(i * 3 if i else 0, t, "en", [None, "a", "ä", "b"][i % 4], 0, "k", 1, "h", "s", "z", "b") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def both(spark, sf_dir, odd):
    return [common.documents(spark, sf_dir), odd]


def texts_of(df):
    return sorted((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


# ------------------------------------------------------------------ tokens
def reference_ids(name, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.vocabulary(name))
    tok.encode_special_tokens = True
    return [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_join_to_the_ids_of_whole_texts(vocabulary):
    import public_tokenizers
    from tokenizers import Tokenizer

    from courtline.llm.tokens import Encoder

    rng = random.Random(5)
    parts = ["a", "bC", "\u00e9", "e\u0301", "\u0301", " ", "  ", "\n", "\n\n", "\r\n", "\t", ".", ",", "!?", "'s", "'", "\u00a0", "\u2003", "\u3000",
             "\u0085", "7", "42", "<|endoftext|>", "-", "\u201c", "\u042f", "\u03a3", "\u4e2d", "\x1c", "\x00", "\U0001f600", "_", "\u0130", "\u0e33"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + [None, "", "x" * 300_000]
    path = public_tokenizers.path(vocabulary)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    want = [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    enc = Encoder(path)
    for _ in range(2):      # the second time from kept pieces
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == want


@pytest.mark.parametrize("vocabulary, few", [("byte_bpe_50k.json", 5), ("word_bpe_49k.json", 4)])
def test_added_tokens_in_a_text_are_those_of_the_plain_call(spark, vocabulary, few):
    import public_tokenizers
    from tokenizers import Tokenizer

    from courtline.llm import tokens

    path = public_tokenizers.path(vocabulary)
    tok = Tokenizer.from_file(path)
    plain = lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    rng = random.Random(6)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>"]
    parts = [*marks * 3, "a", "bC", "\u00e9", "\u0301", " ", "  ", "\n", "\n\n", "\t", ".", "!?", "'s", "'", "\u00a0", "\u2003", "7", "-", "\u4e2d"]
    texts = ["a b <|endoftext|> c", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 15))) for _ in range(4000))]
    enc, want = tokens.encoder(path), plain(texts)
    assert len(want[0]) == few
    for _ in range(2):
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == want
    docs = spark.createDataFrame([(1, "one <|endoftext|> two", "a"), (2, "three", "a")], "doc_id long, text string, source string")
    ids = [x + [2] for x in plain(["one <|endoftext|> two", "three"])]
    if few == 5:
        got = sorted(map(tuple, token_files.token_files(docs, tokenizer=path).collect()))
        assert got == [(1, 0, len(ids[0]), crc(ids[0])), (2, len(ids[0]), len(ids[1]), crc(ids[1]))]
    else:
        assert {r.doc_id: r.doc_tokens for r in packing.pack(docs, tokenizer=path).collect()} == {1: len(ids[0]), 2: len(ids[1])}


@pytest.mark.parametrize("which", [0, 1])
def test_token_files_round_trip(spark, sf_dir, odd, which):
    docs = both(spark, sf_dir, odd)[which]
    got = sorted(map(tuple, token_files.token_files(docs, tokenizer=queries.vocabulary("byte_bpe_50k.json")).collect()))
    rows, start, want = texts_of(docs), 0, []
    for (d, _), ids in zip(rows, reference_ids("byte_bpe_50k.json", [t for _, t in rows]), strict=True):
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want


def test_token_file_reads_one_document(spark, odd):
    from courtline.session import scratch_path

    path, vocab = scratch_path(spark, "one"), queries.vocabulary("byte_bpe_50k.json")
    token_files.write_files(odd, path, tokenizer=vocab)
    text = dict(texts_of(odd))[15]
    assert token_files.read_document(spark, path, 15) == reference_ids("byte_bpe_50k.json", [text])[0]
    with pytest.raises(KeyError):
        token_files.read_document(spark, path, 1)


@pytest.mark.parametrize("which", [0, 1])
def test_packing_covers_every_id_once(spark, sf_dir, odd, which):
    docs = both(spark, sf_dir, odd)[which]
    out = packing.pack(docs, tokenizer=queries.vocabulary("word_bpe_49k.json")).collect()
    rows = texts_of(docs)
    ids = {d: x for (d, _), x in zip(rows, reference_ids("word_bpe_49k.json", [t for _, t in rows]), strict=True)}
    places, lengths = {}, Counter()
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        assert r.start == places.get(r.doc_id, 0) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length])
        places[r.doc_id] = r.start + r.length
    assert places == {d: len(x) for d, x in ids.items()}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths[r.sequence_id]
        lengths[r.sequence_id] += r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths.values())


def test_every_window_has_the_target_proportions():
    plan = packing.Schedule([70_001, 20_003, 9_997, 30])
    for w in range(plan.full):
        owed = [plan.delivered(q, w + 1) - plan.delivered(q, w) for q in range(4)]
        assert sum(owed) == 4096 and min(owed) >= 0
        assert all(abs(plan.delivered(q, w) - w * 4096 * plan.sizes[q] / plan.total) < 1.001 for q in range(4))


# ------------------------------------------------------------------ fingerprints
@pytest.mark.parametrize("which", [0, 1])
def test_fingerprints_of_documents_and_edits(spark, sf_dir, odd, which):
    docs = both(spark, sf_dir, odd)[which]
    rows = texts_of(docs)
    got = sorted(edit_embedding.fingerprint_documents(docs).collect())
    following = [t for _, t in rows[1:]] + [rows[0][1]]
    prints = edit_embedding.fingerprints([t for _, t in rows])
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    for r, (_, t), n, p in zip(got, rows, following, prints, strict=True):
        e = edit_embedding.edited(t, n)
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), p.tobytes().hex())
        assert 0 <= r.near_next <= 1 and (r.near_edited == 1.0 if e == t else r.near_edited <= 1)
    long = [r for r in got if r.n_chars > 2000]
    assert all(r.near_edited > 0.55 for r in long)


def test_walks_one_by_one_and_together_agree():
    rng = np.random.default_rng(0)
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in [*rng.integers(0, 300, 60), 5000]]
    together = edit_embedding.fingerprints(texts)
    assert (together == np.concatenate([edit_embedding.fingerprints([t]) for t in texts])).all()
    near = edit_embedding.fingerprints([t[:100] + "q" + t[101:] for t in texts])
    assert edit_embedding.likeness(together, near)[-1] > 0.8


def test_fingerprint_classes(spark):
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    prints = edit_embedding.fingerprints([text, text[:1500] + "#" + text[1501:], text[::-1]])
    df = spark.createDataFrame([(i + 1, p.tobytes().hex()) for i, p in enumerate(prints)], "doc_id long, fingerprint string")
    assert {r.doc_id: r.class_id for r in edit_embedding.near_pairs(df).collect()} == {1: 1, 2: 1, 3: 3}


# ------------------------------------------------------------------ vectors
def test_vector_search_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * (i % 7)).tolist()) for i in range(300)]
    rows[3], rows[4], rows[5], rows[6] = (3, None), (4, [None] * 8), (5, [float("nan")] * 8), (6, [float("inf")] * 8)
    rows += [(100, rows[7][1]), (400, [1.0] * 3), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [int(np.floor(c * 256)) for c in v]) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for at, (i, q) in enumerate(ints):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for n, (j, v) in enumerate(ints) if n != at and len(v) == len(q))[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    got = vector_search.top_k(df, df.vec_id % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert vector_search.top_k(df.limit(0), df.vec_id % 50 == 0).count() == 0


def test_large_components_do_not_overflow():
    x = np.array([[2.0**40, 3 / 256], [2.0**40 + 1, -5 / 256]])
    assert vector_search.score(x[0], x[1]) == 2**16 * 2**40 * (2**40 + 1) - 15


# ------------------------------------------------------------------ substrings
def brute_repeats(rows):
    seen, out = set(), []
    for d, t in rows:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            k = raw[s:s + 100]
            if k in seen:
                gone[s:s + 100] = True
            seen.add(k)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((d, len(raw), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", [0, 1])
def test_repeats_match_brute_force(spark, sf_dir, odd, which):
    docs = both(spark, sf_dir, odd)[which]
    assert sorted(map(tuple, repeats.dedup(docs).collect())) == brute_repeats(texts_of(docs))


def test_repeats_of_frequent_passages_and_rows(spark):
    rng = np.random.default_rng(3)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = word(260)
    rows = [(i, word(int(rng.integers(0, 90))) + passage[int(rng.integers(0, 40)):] + word(30)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert len(repeats.frequent_triggers(docs.selectExpr("doc_id AS key", "text"))) > 0
    assert sorted(map(tuple, repeats.dedup(docs).collect())) == brute_repeats(rows)
    twice = repeats.dedup(docs.unionByName(docs.where("doc_id = 0"))).where("doc_id = 0").collect()
    assert len(twice) == 2 and twice[0] == twice[1]


def test_repeats_of_texts_that_share_an_id(spark):
    """Hundreds of null ids and of one id, many with the same low bits of any hash."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = word(150)
    rows = []
    for i in range(900):
        t = word(int(rng.integers(0, 200))) + passage[int(rng.integers(0, 40)):] + word(int(rng.integers(0, 99)))
        rows.append((None if i % 2 else 4, t))
    assert len({zlib.crc32(t.encode()) % (1 << 15) for i, t in rows if i}) < 450
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ordered = [(r.doc_id, r.text) for r in df.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).collect()]
    got = Counter(map(tuple, repeats.dedup(df).collect()))
    assert got == Counter(brute_repeats(ordered))


def test_a_long_text_behind_short_ones(spark):
    import pyarrow as pa

    from courtline.llm import textnum

    size = repeats.SEGMENT
    assert [(at, [len(t) for t in ts]) for at, ts in textnum.slices(pa.array(["ab", "c" * (size + 1), "d"]))] == [(0, [2]), (1, [size + 1]), (2, [1])]
    long = np.random.default_rng(9).bytes(9 << 20).hex()
    rows = [(1, "short " * 10), (2, long + long[1000:1400]), (3, long[-700:-300])]
    got = repeats.dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in got} == {1: (0, 0), 2: (400, 1), 3: (400, 1)}


# ------------------------------------------------------------------ near copies
def brute_components(rows, k=5, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [(d, len(s), rows[root(i)][0], root(i) == i) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def near(docs):
    return sorted(map(tuple, minhash.near_duplicates(docs).drop("text_hash").collect()))


@pytest.mark.parametrize("which", [0, 1])
def test_near_duplicates_match_brute_force(spark, sf_dir, odd, which):
    docs = both(spark, sf_dir, odd)[which]
    assert near(docs) == brute_components(texts_of(docs))


def test_large_family_of_near_copies_is_complete(spark):
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(250):
        w = list(base)
        for j in rng.integers(0, 150, int(rng.integers(0, 8))):
            w[j] = f"e{i}x{j}"
        rows.append((i, " ".join(w)))
    assert near(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute_components(rows)


@pytest.mark.parametrize("both, one, other", [(102, 9, 9), (125, 11, 11), (85, 7, 8), (51, 4, 5), (340, 30, 30), (1700, 150, 150)])
def test_signatures_keep_pairs_at_the_threshold(both, one, other):
    rng = np.random.default_rng(both)
    for _ in range(1500):
        x = rng.integers(0, 1 << 64, both + one + other, dtype=np.uint64)
        a, b = np.sort(x[:both + one]), np.sort(np.concatenate([x[:both], x[both + one:]]))
        sig = minhash.bin_minima(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert minhash.alike(sig[0], len(a), sig[1:], np.array([len(b)]), 85)[0] >= 0


def test_representatives_keep_one_row_of_each_group(spark, odd):
    docs = odd.unionByName(odd)
    kept = minhash.representatives(docs)
    assert kept.columns == docs.columns
    want = sorted(d for d, _, _, keep in brute_components(texts_of(odd)) if keep)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_representatives_of_null_and_shared_ids(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " end"), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[5]),
            (6, texts[5]), (7, texts[6]), (9, texts[6]), (None, None), (None, "")]
    kept = minhash.representatives(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = Counter((r.doc_id, None if r.text is None else r.text.removesuffix(" end")) for r in kept)
    assert got == Counter([(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[5]), (7, texts[6]), (None, None), (None, "")])


# ------------------------------------------------------------------ secrets
def test_base_spans_are_the_patterns(spark, sf_dir, odd):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for docs in both(spark, sf_dir, odd):
        got = {r.doc_id: r for r in secrets.secrets(docs).collect()}
        for d, t in texts_of(docs):
            spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
            spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
            spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
            assert [got[d].n_assign, got[d].n_access, got[d].n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
            assert got[d].base_sha256 == hashlib.sha256(secrets.listed(sorted(spans)).encode()).hexdigest()


def test_a_failing_match_uses_up_its_text():
    assert secrets.base_spans("password: token: abcdefgh12") == []


# ------------------------------------------------------------------ mixing
def test_mix_of_odd_rows(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.copies <= 2
    assert abs(sum(rs[0].target for rs in by.values()) - 1.5 * total) < 1e-6 * total
    for rs in by.values():
        taken, largest = sum(r.size * r.copies for r in rs), max(r.size for r in rs)
        assert rs[0].target <= 2 * rs[0].source_size and abs(taken - rs[0].target) <= largest
    mixed = Counter(r.doc_id for r in mixing.mixed(odd).collect())
    assert mixed == {r.doc_id: r.copies for r in rows if r.copies}


def test_a_larger_budget_takes_a_superset(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    less, more = ({r.doc_id for r in mixing.mix(docs, share=s, cap=1.0).collect() if r.copies} for s in (0.2, 0.5))
    assert less and less < more


# ------------------------------------------------------------------ empty tables
def test_empty_tables(spark, none):
    vocab = queries.vocabulary("word_bpe_49k.json")
    for out in (token_files.token_files(none, tokenizer=vocab), packing.pack(none, tokenizer=vocab), mixing.mix(none), repeats.dedup(none),
                minhash.near_duplicates(none), minhash.representatives(none), secrets.secrets(none), edit_embedding.fingerprint_documents(none)):
        assert out.count() == 0
