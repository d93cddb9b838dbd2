"""Tables in versions: each is written beside the others, then a small entry makes it the current one.

Layout below a table's root: ``data/<label>-<id>`` holds rows, ``log/<number>`` one line of JSON that names what the version
consists of. An entry is written elsewhere and renamed into place, so a reader sees all of it or none; a job that fails
before that leaves the old version as it was. One job writes a table at a time.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DATA, LOG, TEMPORARY = "data", "log", "tmp"
#: Versions whose rows stay for readers that began before the last change.
KEEP = 2


class Versions:
    """The versions of the table at ``root``, a path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []

    def _delete(self, path: str) -> None:
        self._files.delete(self._path(f"{self.root}/{path}"), True)

    def numbers(self) -> list[int]:
        """Versions in order."""
        return sorted(int(n) for n in self._names(LOG) if n.isdigit())

    def entry(self, number: int) -> dict[str, Any]:
        file = self._files.open(self._path(f"{self.root}/{LOG}/{number:020d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def latest(self) -> tuple[int, dict[str, Any]] | None:
        """Number and entry of the current version."""
        numbers = self.numbers()
        return (numbers[-1], self.entry(numbers[-1])) if numbers else None

    def place(self, label: str) -> str:
        """A fresh path below the root for rows of a version that is being written."""
        return f"{DATA}/{label}-{uuid.uuid4().hex[:12]}"

    def full(self, path: str) -> str:
        return f"{self.root}/{path}"

    def commit(self, entry: dict[str, Any]) -> int:
        """Make ``entry`` the current version. Its ``paths`` are the ``data`` folders that it needs."""
        numbers = self.numbers()
        number = numbers[-1] + 1 if numbers else 0
        there, temporary = f"{LOG}/{number:020d}", f"{TEMPORARY}/{uuid.uuid4().hex[:12]}"
        file = self._files.create(self._path(self.full(temporary)))
        file.write(json.dumps(entry).encode())
        file.close()
        self._files.mkdirs(self._path(self.full(LOG)))
        if not self._files.rename(self._path(self.full(temporary)), self._path(self.full(there))):
            raise RuntimeError(f"version {number} of {self.root} was written by another job")
        return number

    def clean(self, keep: int = KEEP) -> None:
        """Delete the entries before the last ``keep`` and all rows that none of these needs, left-overs of failed jobs too."""
        numbers = self.numbers()
        needed = {p.split("/")[1] for n in numbers[-keep:] for p in self.entry(n)["paths"]}
        self._delete(TEMPORARY)
        for name in self._names(DATA):
            if name not in needed:
                self._delete(f"{DATA}/{name}")
        for n in numbers[:-keep]:
            self._delete(f"{LOG}/{n:020d}")


def replace_table(df: DataFrame, target: str, keep: int = KEEP) -> int:
    """Make the rows of ``df`` the table at ``target`` and return the version's number.

    ``df`` may read the table itself. Readers see the old rows until all new ones are there; the rows of the last
    ``keep`` versions stay, so a reader that has begun may end.
    """
    versions = Versions(df.sparkSession, target)
    path = versions.place("table")
    df.write.parquet(versions.full(path))
    number = versions.commit({"paths": [path], "schema": df.schema.json()})
    versions.clean(keep)
    return number


def read_table(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The current version of a table, or one of those kept."""
    versions = Versions(spark, target)
    if version is None:
        found = versions.latest()
        if found is None:
            raise FileNotFoundError(f"no table at {target}")
        entry = found[1]
    else:
        entry = versions.entry(version)
    schema = StructType.fromJson(json.loads(entry["schema"]))
    return spark.read.schema(schema).parquet(*[versions.full(p) for p in entry["paths"]])
