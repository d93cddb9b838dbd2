"""Row placement for work that is heavy per row rather than per byte."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows by key over the full number of shuffle partitions.

    Adaptive execution would merge the partitions of a small table into one task; this keeps them apart for
    steps that make many rows, or do much work, out of each. Later grouping by the keys finds its partitioning
    in place.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
