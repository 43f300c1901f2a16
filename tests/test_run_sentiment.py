"""Orchestration (flags, isolation, metrics) and sentiment scoring."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from courtline.operators.sentiment import score_sentiment, seed_lexicon
from courtline.plans.run import (
    DatasetSpec,
    alert_text,
    FeatureFlags,
    failure_digest,
    flags_table,
    gate,
    run_datasets,
)


def test_flag_gate(spark):
    flags = FeatureFlags.load(flags_table(spark))
    df = spark.range(5)
    assert gate(df, flags, "boxscores").count() == 5
    assert gate(df, flags, "fake").count() == 0
    with pytest.raises(ValueError):
        gate(df, flags, "not_a_flag")


def test_run_isolates_failures(spark):
    flags = FeatureFlags({"a": 1, "b": 1, "off": 0})

    def boom():
        raise RuntimeError("page layout changed")

    specs = [DatasetSpec("good", "a", lambda: spark.range(3)),
             DatasetSpec("bad", "b", boom),
             DatasetSpec("lazy_bad", "a",
                         lambda: spark.range(2).select(F.assert_true(F.lit(False)))),
             DatasetSpec("skipped", "off", lambda: spark.range(9)),
             DatasetSpec("unknown_flag", "zzz", lambda: spark.range(1))]
    m = run_datasets(spark, specs, flags, dt.date(2024, 1, 31))
    got = {r["dataset"]: (r["status"], r["rows"]) for r in m.collect()}
    assert got == {"good": ("written", 3), "bad": ("failed", 0), "lazy_bad": ("failed", 0),
                   "skipped": ("disabled", 0), "unknown_flag": ("failed", 0)}
    d = failure_digest(m).first()
    assert d["n_errors"] == 3 and d["digest"].count("\n") == 2
    msg = alert_text(m, dt.date(2024, 1, 31))
    assert msg.startswith("3 errors during ingestion on 2024-01-31:")
    assert "bad: RuntimeError: page layout changed" in msg
    ok = m.where(F.col("status") != "failed")
    assert alert_text(ok, dt.date(2024, 1, 31)) is None


def score(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = score_sentiment(df, "id", "text", seed_lexicon(spark))
    return {r["id"]: r for r in out.collect()}


def test_sentiment_rules(spark):
    s = score(spark, ["the game was on", "a great game", "not a great game",
                      "a very great game", "", "bad bad bad"])
    no_hit = s[0]
    assert (no_hit.compound, no_hit.neg, no_hit.neu, no_hit.pos, no_hit.sentiment) == \
        (0.0, 0.0, 1.0, 0.0, 0)
    assert s[1].compound > 0 and s[1].sentiment == 1
    assert s[2].compound < 0 and s[2].sentiment == 0          # negation flips
    assert s[3].compound > s[1].compound                      # booster raises
    assert (s[4].compound, s[4].neu) == (0.0, 0.0)            # no tokens
    assert -1.0 <= s[5].compound < 0 and s[5].neg > 0.5
    assert abs(s[1].pos + s[1].neu + s[1].neg - 1.0) < 1e-9


def plain_score(text, lexicon):
    """The rules word by word, in floating point."""
    from courtline.operators import sentiment as S

    words = [w for w in (re.sub(S._PUNCT, "", t) for t in re.split(r"[ \t\n\r\f\x0B]+", text)) if w]
    loud = [w == w.upper() and w != w.lower() for w in words]
    loud = [c and not all(loud) for c in loud]
    low = [w.lower() for w in words]
    but = low.index("but") if "but" in low else None
    found = []
    for i, w in enumerate(low):
        v = lexicon.get(w, 0.0)
        if v:
            sign = 1 if v > 0 else -1
            v += sign * 0.733 * loud[i]
            for d, damp in ((1, 1), (2, 0.95), (3, 0.9)):
                if i >= d and low[i - d] in S.BOOSTERS_UP + S.BOOSTERS_DOWN:
                    v += sign * damp * ((0.293 if low[i - d] in S.BOOSTERS_UP else -0.293) + 0.733 * loud[i - d])
            if any(x in S.NEGATORS for x in low[max(0, i - 3):i]):
                v *= -0.74
            if but is not None and i != but:
                v *= 0.5 if i < but else 1.5
        found.append(v)
    asks = text.count("?")
    marks = 0.292 * min(4, text.count("!")) + (0.96 if asks > 3 else 0.18 * asks if asks > 1 else 0)
    total, pos, neg = sum(found), sum(v + 1 for v in found if v > 0), sum(1 - v for v in found if v < 0)
    total += marks if total > 1e-9 else -marks if total < -1e-9 else 0
    pos, neg = pos + marks * (pos > neg + 1e-9), neg + marks * (neg > pos + 1e-9)
    mass = pos + neg + sum(v == 0 for v in found)
    return (total / (total * total + 15) ** 0.5, *((x / mass if mass else 0.0) for x in (neg, mass - pos - neg, pos)))


LEXICON = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "great": 3.1, "bad": -2.5, "sux": -1.5, "uncompelling": -0.9}


def test_sentiment_published_examples(spark):
    """Compound scores that the method's authors publish for these sentences."""
    published = [
        ("VADER is smart, handsome, and funny.", 0.8316), ("VADER is smart, handsome, and funny!", 0.8439),
        ("VADER is very smart, handsome, and funny.", 0.8545), ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
        ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342), ("VADER is not smart, handsome, nor funny.", -0.7424),
        ("Today SUX!", -0.5461),
        ("The plot was good, but the characters are uncompelling and the dialog is not great.", -0.7042),
    ]
    lex = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(published)], "id long, text string")
    got = {r.id: r.compound for r in score_sentiment(df, "id", "text", lex).collect()}
    assert [round(got[i], 4) for i in range(len(published))] == [c for _, c in published]


def test_sentiment_against_plain_rules(spark):
    rng = random.Random(5)
    words = [*LEXICON, "but", "not", "very", "slightly", "the", "game", "BUT", "Very", "I", "\u00c9T\u00c9", "123"]
    texts = ["", "!!!", "???? !", "GREAT", "GREAT BAD", "good bad ??", "but good", "good but", "but but bad"]
    for _ in range(400):
        picked = [rng.choice(words) for _ in range(rng.randrange(1, 12))]
        picked = [w.upper() if rng.random() < 0.25 else w for w in picked]
        texts.append(" ".join(picked) + rng.choice(["", "", "!", "!!!!!!", "?", "??", "?????", "!?!?"]))
    lex = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: (r.compound, r.neg, r.neu, r.pos) for r in score_sentiment(df, "id", "text", lex).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(t, LEXICON), abs=1e-9), t


def test_sentiment_requires_strings(spark):
    df = spark.createDataFrame([(1, 5)], "id long, text long")
    with pytest.raises(TypeError):
        score_sentiment(df, "id", "text", seed_lexicon(spark))
