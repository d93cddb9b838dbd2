"""Scans of landed files and zone trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docksense.functions.calendar import from_epoch_millis


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV. Give a schema at scale: inference reads the data a second time."""
    reader = spark.read.option("header", True).option("sep", ",")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_tree(spark: SparkSession, root: str, partitioned: bool = True) -> DataFrame:
    """A whole zone as one table; foreign trees without ``key=value`` folders need ``partitioned=False``."""
    if partitioned:
        return spark.read.option("basePath", root).parquet(root)
    return spark.read.option("recursiveFileLookup", "true").parquet(root)


def unit_name(folder: bool = False) -> Column:
    """Name of the file a row came from, or of the folder that holds it (without a ``key=`` prefix)."""
    if folder:
        return F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]+$", 1)
    return F.col("_metadata.file_name")


def filter_by_file_name(df: DataFrame, keywords: list[str], after_year: int, folder: bool = False) -> DataFrame:
    """Rows of files named ``yyyy?mm...`` that hold a keyword and whose year is later than ``after_year``.

    The condition uses file metadata only, so files that fail it are never opened.
    """
    name = unit_name(folder)
    has_word = F.lit(False)
    for word in keywords:
        has_word = has_word | name.contains(word)
    return df.filter(has_word & (F.substring(name, 1, 4).try_cast("int") > after_year))


def only_new(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose unit is not in the target yet."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")


def time_partition_cols(df: DataFrame, ms_col: str) -> DataFrame:
    """``year``, ``month``, ``day``, ``hour`` of epoch milliseconds (UTC)."""
    ts = from_epoch_millis(ms_col)
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}
    )


def project(df: DataFrame, fields: list[str], limit: int | None = None,
            order: list[str] | None = None) -> DataFrame:
    """Only the listed (possibly nested) fields, so the scan reads nothing else; optional ordered row cap."""
    if limit is not None:
        df = df.orderBy(*(order or fields)).limit(limit)
    return df.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields])
