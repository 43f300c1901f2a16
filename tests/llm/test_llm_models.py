"""Learned operators: held-out accuracy, defined results on odd rows, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtline.llm import common, importance, queries, secrets, toxicity

WORDS = [f"{a}{b}" for a in "ba ce di fo gu ha je ki lo mu".split() for b in "na re si to vu xi".split()]


def labelled(spark, n=900, seed=1):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        w = list(rng.choice(WORDS, int(rng.integers(20, 60))))
        toxic = int(i % 3 == 0)
        if toxic:
            w[int(rng.integers(0, len(w)))] = str(rng.choice(["scumbag", "scumbags", "loserish"]))
        docs.append((i, " ".join(w), "x"))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97


def test_pairwise_terms_are_learned():
    """Either term alone is harmless; together they are not."""
    import itertools

    a, b, c = np.uint64([5]), np.uint64([9]), np.uint64([2])
    rows = []
    for i, (x, y) in itertools.product(range(100), itertools.product((0, 1), repeat=2)):
        terms = np.sort(np.concatenate([c, *[a] * x, *[b] * y]))
        rows.append((x & y, terms.tobytes()))
    m = toxicity.train(rows, 0.25)
    at = {int(t): i for i, t in enumerate(m.terms)}
    assert m.v[at[5]] @ m.v[at[9]] > 0.5


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark, 60)
    odd = spark.createDataFrame([(1001, None, ""), (1002, "", ""), (None, "abc", "")], docs.schema)
    rows = toxicity.toxicity(docs.unionByName(odd), labels).collect()
    assert len(rows) == 63 and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    assert score[1001] == score[1002]
    one = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r.predicted for r in one} == {0}
    assert toxicity.toxicity(docs, labels.limit(0)).where("score > 0.001").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_markov_models_tell_random_from_words(spark):
    rng = np.random.default_rng(2)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    random = lambda n: "".join(rng.choice(letters, n))
    docs = [(i, f"note {rng.choice(WORDS)}{rng.choice(WORDS)}{rng.choice(WORDS)}{rng.choice(WORDS)}{rng.choice(WORDS)}x password={random(24)} end") for i in range(400)]
    hidden = random(40)
    docs += [(900, f"see {hidden} there"), (901, None), (902, "")]
    got = {r.doc_id: r.spans for r in secrets.secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[900] == "markov:4:44" and got[901] == got[902] == ""
    assert all(s.count("assign") == 1 and "markov" not in s for d, s in got.items() if d < 400)


def test_markov_models_learn_from_all_documents(spark):
    """More documents than any sample held; the few with secrets are those of the largest id hashes."""
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    random = lambda n: "".join(rng.choice(letters, n))
    ids = [r.id for r in spark.range(9000).orderBy(F.xxhash64("id")).collect()]
    docs = [(i, f"note {''.join(rng.choice(WORDS, 5))}x end") for i in ids[:8600]]
    docs += [(i, f"note {''.join(rng.choice(WORDS, 5))}x password={random(24)} end") for i in ids[8600:]]
    hidden = random(40)
    docs += [(ids[0] + 100_000, f"see {hidden} there")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    texts = [t for _, t in docs]
    counts = secrets.transitions(texts)
    counts[1] -= secrets.hidden(texts, secrets.Models(counts))
    want = secrets.Models(counts)
    assert np.array_equal(secrets.fit(df).ratio, want.ratio)
    assert [r.spans for r in secrets.secrets(df).where("doc_id >= 100000").collect()] == ["markov:4:44"]


def test_importance_resampling(spark):
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(WORDS[:30] if i % 2 else WORDS[30:], 40)), "k") for i in range(400)]
    docs += [(1000, None, "k"), (1001, "", "k"), (None, "bana", "k")]
    df = spark.createDataFrame(docs, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 400, 3)], "doc_id long, quality int, toxic int")
    rows = importance.resample(df, labels, fraction=0.5).collect()
    kept = [r for r in rows if r.kept]
    assert len(rows) == 403 and len(kept) == 202
    best = sorted((r.sample_key for r in rows), reverse=True)[:202]
    assert sorted((r.sample_key for r in kept), reverse=True) == best
    assert sum(r.doc_id is not None and r.doc_id < 400 and r.doc_id % 2 == 1 for r in kept) >= 190
    assert importance.resample(df.limit(0), labels).count() == 0
    assert {r.log_weight for r in importance.resample(df, labels.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("k", [1, 3, 7, 10, 50])
def test_kth_largest_with_ties(spark, k):
    values = [1.0, 2.0, 2.0, 2.0, 5.0, -1.0, 7.5, 7.5, 0.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert importance.kth_largest(df, "v", k) == sorted(values, reverse=True)[min(k, 10) - 1]


def test_pipeline_stages(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.schema == before.schema
        ids, earlier = ({r.doc_id for r in d.select("doc_id").collect()} for d in (docs, before))
        assert ids <= earlier
        if name == "secret_scan":
            assert ids == earlier and not any(secrets.base_spans(r.text or "") for r in docs.collect())
        if name == "near_dedup":
            assert docs.count() == len(ids) < n
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = common.documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_sql_twins(spark, sf_dir):
    from oracle_check import compare, duck

    con = duck(sf_dir)
    for name, sql in queries.ORACLE.items():
        r = compare(spark, name, queries.QUERIES[name], sql, sf_dir, con)
        assert r["status"] == "MATCH", r
