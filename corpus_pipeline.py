"""From documents to packed training sequences, five stages.

1. toxicity: documents that the factorization machine scores at the threshold or above go; it is
   fitted on the labelled rows outside the held-out fold;
2. near-dedup: one document of each MinHash component stays, the one of least id; texts whose
   five-word shingles are at least 0.8 alike are linked;
3. secret scan: every found span is masked in the text, ``n_chars`` follows; no document goes;
4. mixing: sources are brought to their target weights, documents taken up to twice;
5. packing: the mix is packed into sequences, one row per piece.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``docs`` (the last one the pieces).  Between stages documents are written to the shared
checkpoint folder.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import common, minhash, mixing, packing, secrets, toxicity
from courtline.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs, common.read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.representatives(docs, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs, secrets.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer=vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("secret_scan", mask_secrets),
          ("mixing", mix_sources), ("packing", pack)]

#: models and components are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
