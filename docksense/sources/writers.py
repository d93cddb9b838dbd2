"""Sinks: day partitions, exports, documents, keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.sources.versions import read_table, replace_table


def write_days(df: DataFrame, root: str, date_col: str) -> None:
    """One partition per day; only the days in ``df`` are replaced. Rows without a date are left out.

    Rows are rebalanced by day: adaptive execution merges small days and splits a busy one over several tasks.
    """
    out = df.filter(F.col(date_col).isNotNull()).withColumns(
        {"year": F.year(date_col), "month": F.month(date_col), "date": F.col(date_col).cast("date")}
    )
    out = out.hint("rebalance", F.col("date"))
    (
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "date").parquet(root)
    )


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Header CSV. ``single`` brings the rows into one file, for small reports; the work before stays parallel."""
    (df.repartition(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, target: str, mode: str = "append", fmt: str = "parquet", **options) -> None:
    """Nested documents; any other connector goes through ``fmt`` and ``options``."""
    df.write.format(fmt).options(**options).mode(mode).save(target)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace those of the same key, new keys are added."""
    cols = target.columns
    rest = [c for c in cols if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = updates.select(*keys, F.struct(*rest).alias("_new"))
    row = F.coalesce("_new", "_old")
    return old.join(new, keys, "full_outer").select(*keys, *[row[c].alias(c) for c in rest]).select(*cols)


def upsert_table(updates: DataFrame, target: str, keys: list[str]) -> int:
    """``upsert`` into the versioned table at ``target``; the result is its next version, whose number is returned."""
    return replace_table(upsert(read_table(updates.sparkSession, target), updates, keys), target)


def merge_datasets(a: DataFrame, b: DataFrame, by_name: bool = False) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True) if by_name else a.union(b)


def repair_boundary(df: DataFrame, folder_year, folder_month, date_col: str, out: str = "partition_date") -> DataFrame:
    """Partition day of rows that reached the neighbour month's folder.

    In the folder of month M, the last day of M-1 goes to day 1 of M and day 1 of M+1 to the last day of M.
    """
    first = F.make_date(_c(folder_year), _c(folder_month), F.lit(1))
    last = F.last_day(first)
    day = F.col(date_col)
    fixed = F.when(day == F.date_sub(first, 1), first).when(day == F.date_add(last, 1), last).otherwise(day)
    return df.withColumn(out, fixed)


def to_messages(df: DataFrame, key: str, value_cols: list) -> DataFrame:
    """Key / JSON value pairs for a message sink."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*value_cols), {"ignoreNullFields": "false"}).alias("value"),
    )


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))
