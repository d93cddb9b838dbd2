"""Keyed state of a stream: buckets of newest rows, changes on top, and an entry that says which files count."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docksense.operators.windows import latest_info
from docksense.sources.versions import Versions

#: Buckets of the state, and changes on top of them before they are merged. A bucket is written by one task.
BUCKETS, CHANGES = 16, 8
_BATCH, _BUCKET = "_batch", "_bucket"


class KeyedState:
    """The newest row per key.

    A micro-batch adds one table of changes and then an entry that counts it; if the job ends between the two, the state is as
    before and the batch comes again. An entry remembers the last batch of each checkpoint, so one that comes again changes
    nothing. After ``changes`` tables they are merged into the buckets that they touch, other buckets keep their files. A
    reader thus opens at most a file per bucket and ``changes`` tables, however long the stream has run.
    """

    def __init__(self, spark: SparkSession, target: str, key: str = "station_id", order: tuple[str, ...] = ("last_reported",),
                 buckets: int = BUCKETS, changes: int = CHANGES) -> None:
        self.spark, self.key, self.order = spark, key, order
        self.buckets, self.changes = buckets, changes
        self.versions = Versions(spark, target)

    def _entry(self) -> dict[str, Any]:
        found = self.versions.latest()
        return found[1] if found else {"base": {}, "changes": [], "batches": {}, "buckets": self.buckets, "schema": None}

    def _commit(self, entry: dict[str, Any]) -> None:
        paths = [*entry["changes"], *{p for p in entry["base"].values()}]
        self.versions.commit(entry | {"paths": paths})

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_info(rows, self.key, [*self.order, _BATCH])

    def _read(self, entry: dict[str, Any], changes: list[str], buckets: list[str]) -> DataFrame:
        """Rows of some tables of changes and of some buckets."""
        folders = [f"{self.versions.full(entry['base'][b])}/{_BUCKET}={b}" for b in buckets]
        schema = StructType.fromJson(json.loads(entry["schema"]))
        paths = [*map(self.versions.full, changes), *folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def apply(self, batch: DataFrame, batch_id: int, source: str) -> None:
        """Take a micro-batch of the stream whose checkpoint is ``source``."""
        entry = self._entry()
        if entry["batches"].get(source, -1) >= batch_id:
            return
        path = self.versions.place("changes")
        # later batches count for more on ties, whatever stream they come from
        number = sum(entry["batches"].values()) + len(entry["batches"]) + 1
        rows = self._newest(batch.withColumn(_BATCH, F.lit(number).cast("long")))
        rows.write.parquet(self.versions.full(path))
        entry["schema"] = entry["schema"] or rows.schema.json()
        if not self.spark.read.schema(rows.schema).parquet(self.versions.full(path)).isEmpty():
            entry["changes"] = [*entry["changes"], path]
        entry["batches"] = entry["batches"] | {source: batch_id}
        self._commit(self._merged(entry) if len(entry["changes"]) >= self.changes else entry)
        self.versions.clean()

    def _merged(self, entry: dict[str, Any]) -> dict[str, Any]:
        """The entry with all changes merged into new files of the buckets that they touch."""
        if not entry["changes"]:
            return entry
        bucket = F.pmod(F.xxhash64(self.key), F.lit(entry["buckets"]))
        changed = self._read(entry, entry["changes"], [])
        touched = sorted(str(r[0]) for r in changed.select(bucket).distinct().collect())  # at most one row per bucket
        old = [b for b in touched if b in entry["base"]]
        rows = self._newest(self._read(entry, entry["changes"], old)).withColumn(_BUCKET, bucket)
        path = self.versions.place("base")
        rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(self.versions.full(path))
        return entry | {"base": entry["base"] | dict.fromkeys(touched, path), "changes": []}

    def merge(self) -> None:
        """Merge the changes now."""
        entry = self._entry()
        if entry["changes"]:
            self._commit(self._merged(entry))
            self.versions.clean()

    def current(self) -> DataFrame:
        """The newest row per key."""
        entry = self._entry()
        if entry["schema"] is None:
            raise FileNotFoundError(f"no state at {self.versions.root}")
        return self._newest(self._read(entry, entry["changes"], sorted(entry["base"]))).drop(_BATCH)
