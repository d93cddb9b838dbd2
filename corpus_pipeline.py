"""A corpus from raw documents: good ones, without near copies and secrets, mixed by source, packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docksense.llm import mixing, packing, quality, secrets, simhash
from docksense.llm.common import read
from docksense.llm.queries import tokenizer_path
from docksense.session import cut_lineage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more)."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"), cut=0.5)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits): the one with the smallest doc_id."""
    return simhash.drop_near_copies(docs, words=3, radius=3)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(docs, tokenizer_path(), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("simhash", without_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained trees, hashes and a tokenizer are beyond SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return cut_lineage(STAGES[-1][1](spark, docs, sf_dir))
