"""Registry of the queries over the test tables and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docksense.session import new_path
from docksense.tables import table, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


@dataclass
class Data:
    """Tables and scratch paths of one run."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def path(self, label: str) -> str:
        return new_path(self.spark, label)


def printable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, so that both engines show them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(key: str, sql: str | None = None):
    """Register ``fn(data) -> DataFrame`` and its SQL twin."""

    def add(fn: Callable[[Data], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: printable(fn(Data(spark, sf_dir)))
        if sql:
            ORACLE[key] = with_views(sql)
        return fn

    return add


# SQL fragments shared by several twins
def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def day(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"
