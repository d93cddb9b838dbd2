"""What streaming queries did, trigger by trigger, in a table that outlives them."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, run string, batch_id long, at timestamp, rows long, duration_ms long, observed string"
#: Triggers whose rows are held before they are appended.
HELD = 50


class TriggerLog(StreamingQueryListener):
    """Appends a row per trigger to a parquet table: all queries of the session while it is registered.

    ``recentProgress`` forgets triggers beyond the last hundred; the log does not. Rows are appended ``held`` at a time and
    when a query ends. ``observed`` is JSON of what the plan observes (``DataFrame.observe``).
    """

    def __init__(self, spark: SparkSession, path: str, held: int = HELD) -> None:
        self.spark, self.path, self.held = spark, path, held
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Lock(), threading.Condition()
        self.over: set[str] = set()

    def __enter__(self) -> TriggerLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        from datetime import datetime

        p = event.progress
        observed = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        at = datetime.fromisoformat(p.timestamp)
        with self.lock:
            self.rows.append((str(p.id), str(p.runId), p.batchId, at, p.numInputRows,
                              p.durationMs.get("triggerExecution", 0), json.dumps(observed, default=str)))
            full = len(self.rows) >= self.held
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self.ended:
            self.over.add(str(event.runId))
            self.ended.notify_all()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, run: str, seconds: float = 60) -> None:
        """Until all triggers of an ended query are in the table."""
        with self.ended:
            if not self.ended.wait_for(lambda: run in self.over, seconds):
                raise TimeoutError(f"the end of run {run} was not reported")

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
