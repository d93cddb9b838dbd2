"""Live status: unbounded JSON source, enrichment, keyed state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docksense.functions.status import classify
from docksense.operators.windows import latest_info
from docksense.schemas import LIVE_STATUS
from docksense.session import new_path
from docksense.streaming.state import KeyedState


def start_mark(spark: SparkSession, checkpoint: str | None) -> Column:
    """The time at which a stream that starts at ``latest`` was started first.

    It is the modification time of a small file beside the checkpoint, so the file system's clock tells it, and a stream that
    is started again reads it instead of a later one. Without a checkpoint it is the present time.
    """
    mark = f"{checkpoint.rstrip('/')}-start" if checkpoint else new_path(spark, "start")
    spark.createDataFrame([("latest",)], "value string").coalesce(1).write.mode("ignore").text(mark)
    return F.lit(spark.read.text(mark).agg(F.min("_metadata.file_modification_time")).first()[0])


def read_status_stream(spark: SparkSession, source: str | dict, start: str | datetime = "earliest",
                       files_per_trigger: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """One text column ``value`` per message: files of a folder, or a broker given by its options.

    ``start`` is ``earliest``, ``latest`` (messages from the first start on), or for files a time: those written at it or
    before are skipped by their modification time, without being read. With ``latest`` pass the ``checkpoint`` that the query
    will use: files that arrive while it is stopped are then read when it is started again.
    """
    if isinstance(source, dict):
        raw = spark.readStream.format("kafka").option("startingOffsets", start).options(**source).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.load(source)
    written = F.col("_metadata.file_modification_time")
    if start == "latest":
        return rows.filter(written >= start_mark(spark, checkpoint))
    return rows if start == "earliest" else rows.filter(written > F.lit(start))


def decode_status(messages: DataFrame, schema: T.StructType = LIVE_STATUS) -> DataFrame:
    """Typed status columns; ``last_reported`` seconds become ``last_reported_ts``."""
    rows = messages.select(F.from_json("value", schema).alias("j")).select("j.*").filter(F.col("station_id").isNotNull())
    return rows.withColumn("last_reported_ts", F.timestamp_seconds("last_reported"))


def enrich_stream(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of the static attributes."""
    return status.join(stations, "station_id", "left")


def stamp(df: DataFrame) -> DataFrame:
    """Processing time as ``lastUpdate``."""
    return df.withColumn("lastUpdate", F.current_timestamp())


def status_stream(messages: DataFrame, stations: DataFrame) -> DataFrame:
    """Decoded, enriched, classified and stamped status; no state, so it works on batch and stream alike."""
    return stamp(classify(enrich_stream(decode_status(messages), stations)))


def distinct_polls(status: DataFrame, expiry: str = "1 hour", key: tuple[str, ...] = ("station_id", "last_reported")) -> DataFrame:
    """One row of those that say the same: a station that has not reported anew since it was polled last.

    On a stream the keys seen are state that expires by the time of arrival, not of the report, so a station that has been
    silent for long is never taken for a late one.
    """
    if not status.isStreaming:
        return status.dropDuplicates(list(key))
    arrived = status.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", expiry)
    return arrived.dropDuplicatesWithinWatermark(list(key)).drop("_arrival")


def latest_state(df: DataFrame, key: str = "station_id", order: tuple = ("last_reported",)) -> DataFrame:
    """Newest row per key; on a stream use output mode ``update``."""
    return latest_info(df, key, list(order))


def start_upsert(stream: DataFrame, target: str, checkpoint: str, key: str = "station_id",
                 order: tuple = ("last_reported",), trigger: dict | None = None) -> StreamingQuery:
    """Keyed overwrite: each micro-batch is taken into the ``KeyedState`` at ``target`` once, however often it comes."""
    state = KeyedState(stream.sparkSession, target, key, order)
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: state.apply(batch, batch_id, checkpoint))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def current_state(spark: SparkSession, target: str, key: str = "station_id", order: tuple = ("last_reported",)) -> DataFrame:
    """What the keyed sink holds: the newest row per key over all batches, later batches first on ties."""
    return KeyedState(spark, target, key, order).current()


def compact_state(spark: SparkSession, target: str, key: str = "station_id", order: tuple = ("last_reported",)) -> str:
    """Merge the changes of the last batches now, which the stream does from time to time; returns the target."""
    KeyedState(spark, target, key, order).merge()
    return target


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append all that is available to a parquet table and return it."""
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def with_metrics(df: DataFrame, name: str, error: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows (and rows where ``error`` holds) while the job runs."""
    seen = Observation(name)
    bad = F.sum(F.expr(error).cast("bigint")) if error else F.lit(0).cast("bigint")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(bad, F.lit(0)).alias("errors")), seen


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Rows and duration of the last finished triggers; ``metrics.TriggerLog`` keeps all."""
    return [
        {"batch_id": p["batchId"], "rows": p["numInputRows"], "duration_ms": p["durationMs"].get("triggerExecution", 0)}
        for p in query.recentProgress
    ]
