"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import (common, divergence, edit_embedding, importance, jaccard_join, minhash, mixing, packing, repeats, runs, secrets,
                           token_files, toxicity, vector_search)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.fingerprint_documents(common.documents(spark, sf_dir))


def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(common.documents(spark, sf_dir), tokenizer=vocabulary("byte_bpe_50k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir), tokenizer=vocabulary("word_bpe_49k.json"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(common.documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(common.documents(spark, sf_dir))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(common.documents(spark, sf_dir), common.read(spark, sf_dir, "labels"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(common.documents(spark, sf_dir))


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(common.documents(spark, sf_dir), common.read(spark, sf_dir, "labels"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(common.documents(spark, sf_dir))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(common.documents(spark, sf_dir))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.word_runs(common.documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_edit_embedding, op2_vector_search, op3_token_files, op4_packing, op5_repeats, op6_mixing,
                                   op7_toxicity, op8_minhash, op9_secrets, op10_importance,
                                   op11_jaccard_join, op12_divergence, op13_word_runs)}
ORACLE = {"op2_vector_search": vector_search.ORACLE, "op6_mixing": mixing.oracle_sql(), "op12_divergence": divergence.ORACLE}
