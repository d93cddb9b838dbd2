"""What the operators share: test tables, byte text, scratch tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docksense.session import cut_lineage

#: A word: a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
#: ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """The text as bytes; a null text is empty."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit("")).cast("binary")


def usable(vector: str) -> Column:
    """True for vectors that are not null, not all zero and hold only finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star contraction.

    ``edges`` has long columns ``a`` and ``b``; the result has a row (``node``, ``root``) for each node of an edge
    between two different nodes, ``root`` being the smallest node of its component. Every step is a partially
    aggregated minimum and an equi-join, so a hub with very many edges is split by adaptive execution. Rounds are cut
    by written tables and end when the edge set no longer changes.
    """
    pair = [F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")]
    edges = cut_lineage(edges.filter("a <> b").select(*pair).distinct())
    seen = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if state == seen or state[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select("lo", "lo")).distinct()
        seen = state
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = cut_lineage(large)
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = cut_lineage(small.union(low.select("hi", F.col("m").alias("lo"))).distinct())
