"""Lexicon sentiment scoring as a Spark job.

The scoring rules follow the published VADER method (Hutto & Gilbert, 2014):

* a token has its lexicon valence, raised by 0.733 (away from 0) if it is in capitals and the text
  is not all in capitals;
* booster words among the three preceding tokens raise or lower it, damped by distance (a booster
  in capitals counts 0.733 more); a negator among these three flips and shrinks it;
* tokens before the first "but" count half, those after it one and a half times;
* exclamation marks (up to four, 0.292 each) and question marks (from two on, 0.18 each, 0.96 for
  more than three) push the sum away from 0, and the larger of positive and negative mass with it;
* the sum ``s`` is normalised to ``compound = s / sqrt(s^2 + 15)``; ``pos``/``neg``/``neu`` are the
  shares of positive mass (each positive valence +1), negative mass (each negative valence -1) and
  neutral tokens.

Plan: what a text says as a whole (its marks, whether capitals stand out, the place of "but") and
the flags of its tokens are computed inside its row; the look-back to the three previous tokens is
done by zipping the token array with copies of the flag arrays shifted by 1-3 places - no window, no
self-join, no per-element lookups.  Tokens are then exploded in the task that holds the row and meet
the lexicon, and the per-document sums are a hash aggregate that combines map-side, so one huge
document does not land whole in one task.  All valences are whole numbers of a fixed small unit, so
sums are exact and independent of aggregation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (our own seed lexicon, valence on the -4..+4 scale): production runs pass a
# full lexicon table with the same (token, valence) shape.
SEED_LEXICON = {
    "good": 1.9, "great": 3.1, "best": 3.2, "better": 1.9, "excellent": 3.2, "amazing": 2.8,
    "awesome": 3.1, "love": 3.2, "like": 1.5, "nice": 1.8, "happy": 2.7, "win": 2.8,
    "wins": 2.7, "winning": 2.4, "clutch": 1.6, "fun": 2.3, "glad": 2.0, "strong": 2.3,
    "perfect": 2.7, "beautiful": 2.9, "brilliant": 2.8, "legend": 2.0, "thanks": 1.9,
    "bad": -2.5, "worst": -3.1, "worse": -2.1, "terrible": -2.9, "awful": -2.9, "hate": -2.7,
    "sad": -2.1, "lose": -1.7, "loss": -1.3, "losing": -1.6, "lost": -1.3, "weak": -1.9,
    "trash": -2.4, "boring": -1.3, "angry": -2.3, "injury": -1.6, "injured": -1.7,
    "poor": -2.1, "ugly": -2.3, "fail": -2.5, "failed": -2.3, "wrong": -2.1, "robbed": -2.6,
    "choke": -1.9, "overrated": -1.5,
}
# Tokens that negate the sentiment of the next three tokens.
NEGATORS = ["not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere",
            "without", "cannot", "can't", "don't", "doesn't", "didn't", "isn't", "wasn't",
            "aren't", "won't", "wouldn't", "shouldn't", "couldn't", "nicht", "kein", "pas",
            "jamais", "nunca"]
# Booster words and the direction they push a following sentiment word.
BOOSTERS_UP = ["very", "really", "extremely", "so", "too", "absolutely", "incredibly",
               "totally", "completely", "super", "hugely", "most"]
BOOSTERS_DOWN = ["slightly", "barely", "somewhat", "hardly", "kinda", "marginally", "less"]
# Fixed values of the method, in the whole units of a step: valences in POINTs of 1/2,000,000,
# after the factors of negation (hundredths) and "but" (halves) in WHOLEs of 1/400,000,000.
POINT = 2_000_000
WHOLE = POINT * 100 * 2
BOOST = 29_300             # booster increment 0.293, times a weight by distance
CAPITALS = 73_300          # capitals 0.733, times a weight
DAMPING = [20, 19, 18]     # weight of a booster at distance 1, 2, 3: 1, 0.95, 0.9
NEGATION = -74             # negation scalar -0.74
CONTRAST = [1, 3]          # before and after "but": 0.5, 1.5
EXCLAMATION = 116_800_000  # 0.292 for each of up to four marks
QUESTION = 72_000_000      # 0.18 for each of two or three marks
QUESTIONS = 384_000_000    # 0.96 for more
NORM_ALPHA = 15            # compound normalisation constant

SCORE_COLS = ["compound", "neg", "neu", "pos", "sentiment"]
_DEC = T.DecimalType(12, 4)
_PUNCT = r"""^[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+|[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+$"""


def seed_lexicon(spark: SparkSession) -> DataFrame:
    rows = [(k, float(v)) for k, v in SEED_LEXICON.items()]
    return spark.createDataFrame(rows, "token string, valence double")


def tokens(text: Column) -> Column:
    """Tokens split on ASCII whitespace, outer punctuation stripped, empty ones dropped."""
    raw = F.split(text, r"[ \t\n\r\f\x0B]+")
    stripped = F.transform(raw, lambda t: F.regexp_replace(t, _PUNCT, ""))
    return F.filter(stripped, lambda t: t != "")


def marks(text: Column) -> Column:
    """What a text's exclamation and question marks add to its sum, in WHOLEs."""
    count = lambda m: F.length(text) - F.length(F.replace(text, F.lit(m)))
    asks = count("?")
    return (F.least(count("!"), F.lit(4)) * F.lit(EXCLAMATION).cast("long")
            + F.when(asks > 3, F.lit(QUESTIONS)).when(asks > 1, asks * QUESTION).otherwise(F.lit(0))).cast("long")


def _flags(low: Column, loud: Column) -> tuple[Column, Column]:
    """Per token: is it a negator, and its booster increment for each weight (0 when not a booster)."""
    neg, up, down = (F.array(*[F.lit(x) for x in words]) for words in (NEGATORS, BOOSTERS_UP, BOOSTERS_DOWN))
    is_neg = F.transform(low, lambda t: F.array_contains(neg, t))
    boost = F.transform(F.arrays_zip(low.alias("low"), loud.alias("loud")), lambda t: F.when(
        F.array_contains(up, t["low"]), F.lit(BOOST) + F.when(t["loud"], F.lit(CAPITALS)).otherwise(F.lit(0))).when(
        F.array_contains(down, t["low"]), F.lit(-BOOST) + F.when(t["loud"], F.lit(CAPITALS)).otherwise(F.lit(0)))
        .otherwise(F.lit(0)).cast("long"))
    return is_neg, boost


def _shift(arr: Column, d: int, fill: Column) -> Column:
    """``arr`` moved right by ``d`` places, ``fill`` in front: element i is arr[i - d]."""
    n = F.size(arr)
    return F.concat(F.array_repeat(fill, F.least(F.lit(d), n)),
                    F.slice(arr, 1, F.greatest(n - d, F.lit(0))))


def score_sentiment(df: DataFrame, id_cols: str | list[str], text_col: str,
                    lexicon: DataFrame) -> DataFrame:
    """``(*ids, compound, neg, neu, pos, sentiment)`` per row of ``df`` (``id_cols`` must be
    unique per row); ``sentiment`` is 1 iff ``compound > 0``.  A text without any lexicon word scores (0, 0, 1, 0, 0); an empty
    text (no tokens) scores all zeros.  ``text_col`` must be a string column.

    ``lexicon(token, valence)``: tokens that differ only in case are one entry with their mean
    valence.  How it is joined is left to the planner (a small one is broadcast)."""
    if df.schema[text_col].dataType != T.StringType():
        raise TypeError(f"{text_col} must be a string column")
    lex = lexicon.groupBy(F.lower("token").alias("token")).agg(F.avg(F.col("valence").cast(_DEC)).cast(_DEC).alias("valence"))
    lex = lex.select("token", (F.col("valence") * POINT).cast("long").alias("valence"))

    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    text = F.col(text_col)
    docs = df.select(F.struct(*ids).alias("_id"), tokens(text).alias("_toks"), marks(text).alias("_marks"))
    docs = docs.select("_id", "_marks", F.transform("_toks", F.lower).alias("_low"),
                       F.transform("_toks", lambda t: (t == F.upper(t)) & (t != F.lower(t))).alias("_loud"))
    # capitals say something only where some tokens are not in capitals
    stands_out = F.exists("_loud", lambda c: ~c)
    docs = docs.select("_id", "_marks", "_low", F.array_position("_low", "but").alias("_but"),
                       F.transform("_loud", lambda c: c & stands_out).alias("_loud"))
    neg, bst = _flags(F.col("_low"), F.col("_loud"))
    docs = docs.select("_id", "_marks", "_low", "_but", "_loud", neg.alias("_neg"), bst.alias("_bst"))
    # the look-back is positional alignment (linear, no per-element lookups)
    zero = F.lit(0).cast("long")
    docs = docs.select("_id", "_marks", "_low", "_but", "_loud", *[
        _shift(F.col("_neg"), d, F.lit(False)).alias(f"_n{d}") for d in (1, 2, 3)], *[
        _shift(F.col("_bst"), d, zero).alias(f"_b{d}") for d in (1, 2, 3)])
    # documents with no token still need a row: keep them with a null token
    z = F.arrays_zip("_low", "_loud", "_n1", "_n2", "_n3", "_b1", "_b2", "_b3")
    side = F.col("pos") + 1 - F.col("_but")
    toks = docs.select("_id", "_marks", "_but", F.posexplode_outer(z).alias("pos", "t")).select(
        "_id", "_marks", F.col("t._low").alias("token"),
        F.when(F.col("t._n1") | F.col("t._n2") | F.col("t._n3"), F.lit(NEGATION)).otherwise(F.lit(100)).alias("negation"),
        F.when((F.col("_but") == 0) | (side == 0), F.lit(2)).when(side < 0, F.lit(CONTRAST[0])).otherwise(F.lit(CONTRAST[1])).alias("contrast"),
        (sum((F.col(f"t._b{d}") * w for d, w in zip((1, 2, 3), DAMPING)), zero)
         + F.when(F.col("t._loud"), F.lit(CAPITALS * DAMPING[0])).otherwise(F.lit(0))).alias("boost"))
    j = toks.join(lex, "token", "left")
    v = F.col("valence")
    adj = F.when(v.isNull() | (v == 0), zero).otherwise(
        (v + F.when(v > 0, F.col("boost")).otherwise(-F.col("boost"))) * F.col("negation") * F.col("contrast"))
    s = j.select("_id", "_marks", "token", adj.alias("s"))
    agg = s.groupBy("_id").agg(
        F.sum("s").alias("sum_s"), F.max("_marks").alias("marks"),
        F.coalesce(F.sum(F.when(F.col("s") > 0, F.col("s") + WHOLE)), zero).alias("pos_sum"),
        F.coalesce(F.sum(F.when(F.col("s") < 0, WHOLE - F.col("s"))), zero).alias("neg_sum"),
        F.count(F.when((F.col("s") == 0) & F.col("token").isNotNull(), 1)).alias("neu_n"),
        F.count(F.col("token")).alias("n_tok"))
    points = lambda c: c.cast("double") / F.lit(float(WHOLE))
    marked = lambda sign: F.when(sign, F.col("marks")).otherwise(zero)
    ahead = F.col("pos_sum") - F.col("neg_sum")
    sd = points(F.col("sum_s") + marked(F.col("sum_s") > 0) - marked(F.col("sum_s") < 0))
    pos_sum = points(F.col("pos_sum") + marked(ahead > 0))
    neg_sum = points(F.col("neg_sum") + marked(ahead < 0))
    neu = F.col("neu_n").cast("double")
    total = pos_sum + neg_sum + neu
    compound = F.when(F.col("n_tok") == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(-1.0), sd / F.sqrt(sd * sd + F.lit(NORM_ALPHA)))))
    share = lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0))
    return agg.select(
        *[F.col(f"_id.{c}").alias(c) for c in ids], compound.alias("compound"),
        share(neg_sum).alias("neg"),
        share(neu).alias("neu"), share(pos_sum).alias("pos"),
        F.when(compound > 0, 1).otherwise(0).alias("sentiment"))
