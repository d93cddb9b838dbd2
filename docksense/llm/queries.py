"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docksense.llm import (
    alignment,
    ann,
    conversations,
    decontaminate,
    embedding_dedup,
    html_extract,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    substring_dedup,
    toxicity,
)
from docksense.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), words=3, radius=3)


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), cut=0.7)


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), cut=0.5)


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents"))


ORACLE["op1_mixing"] = mixing.ORACLE_SQL


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeats(read(spark, sf_dir, "documents"), words=13)


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query
def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


ORACLE["op11_decontaminate"] = decontaminate.ORACLE_SQL


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(read(spark, sf_dir, "conversations"))


@query
def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
