"""Scans, sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docksense.catalog.base import day, query, ts
from docksense.functions import calendar as cal
from docksense.schemas import STATION_FEED
from docksense.sources import landing, readers, versions, writers
from docksense.streaming import status as live

STATION_DDL = "station_id INT, name STRING, capacity INT, lon DOUBLE, lat DOUBLE, truck INT"
STATION_SQL = "SELECT station_id, name, capacity, lon, lat, truck FROM v_station"


@query("a01_csv_scan", STATION_SQL)
def _(d):
    path = d.path("csv")
    writers.export_csv(d("v_station"), path)
    return readers.read_csv(d.spark, path, STATION_DDL)


@query("a02_json_scan", STATION_SQL)
def _(d):
    path = d.path("json")
    d("v_station").write.json(path)
    return readers.read_json(d.spark, path, STATION_DDL)


@query("a03_json_string_ingest", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def _(d):
    path = d.path("ingest")
    rows = landing.ingest_json_strings(d("events").select("event_id", "props"), "props", "k INT")
    rows.write.parquet(path)
    return readers.read_parquet(d.spark, path)


@query("a04_parquet_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(d):
    return readers.read_parquet(d.spark, f"{d.sf_dir}/customer.parquet")


@query("a05_recursive_scan", """
SELECT station_id, hora_dia, total_bikes_taken, total_bikes_returned,
  CAST(EXTRACT(YEAR FROM date_reported) AS INT) AS year, CAST(EXTRACT(MONTH FROM date_reported) AS INT) AS month,
  strftime(date_reported, '%Y-%m-%d') AS date
FROM v_hourly""")
def _(d):
    root = d.path("tree")
    writers.write_days(d("v_hourly"), root, "date_reported")
    return readers.read_tree(d.spark, root).select(
        "station_id", "hora_dia", "total_bikes_taken", "total_bikes_returned", "year", "month", "date")


@query("a06_file_name_filter", """
SELECT CAST(EXTRACT(YEAR FROM snap_date) AS INT) AS y, COUNT(*) AS n FROM v_snapshot
WHERE EXTRACT(YEAR FROM snap_date) > 1995 GROUP BY 1""")
def _(d):
    root = d.path("named")
    name = F.date_format("snap_date", "yyyy_MM'_ESTACIONS'")
    d("v_snapshot").withColumn("unit", name).write.partitionBy("unit").parquet(root)
    kept = readers.filter_by_file_name(readers.read_parquet(d.spark, root), ["ESTACIONS"], 1995, folder=True)
    return kept.groupBy(F.year("snap_date").alias("y")).agg(F.count("*").alias("n"))


@query("a07_incremental_load", f"""
SELECT event_id, station_id, {day('date_reported')} AS date_reported FROM v_status
WHERE date_reported NOT IN (SELECT data FROM v_holiday)""")
def _(d):
    done = d("v_holiday").withColumnRenamed("data", "date_reported")
    return readers.only_new(d("v_status"), done, ["date_reported"]).select("event_id", "station_id", "date_reported")


@query("a08_day_partition_write", f"SELECT {day('date_reported')} AS date, COUNT(*) AS n FROM v_status GROUP BY 1")
def _(d):
    root = d.path("days")
    writers.write_days(d("v_status"), root, "date_reported")
    return readers.read_tree(d.spark, root).groupBy("date").agg(F.count("*").alias("n"))


@query("a09_time_partition_cols", """
SELECT event_id, CAST(EXTRACT(YEAR FROM ts) AS INT) AS year, CAST(EXTRACT(MONTH FROM ts) AS INT) AS month,
  CAST(EXTRACT(DAY FROM ts) AS INT) AS day, CAST(EXTRACT(HOUR FROM ts) AS INT) AS hour FROM events""")
def _(d):
    df = d("events").select("event_id", cal.to_epoch("ts", "MILLISECOND").alias("ms"))
    return readers.time_partition_cols(df, "ms").drop("ms")


@query("a10_single_file_export", "SELECT truck, COUNT(*) AS n FROM v_station GROUP BY truck")
def _(d):
    path = d.path("export")
    small = d("v_station").groupBy("truck").agg(F.count("*").alias("n"))
    writers.export_csv(small, path, single=True)
    return readers.read_csv(d.spark, path, "truck INT, n BIGINT")


@query("a11_document_sink", f"""
SELECT station_id, {day('date_reported')} AS date_reported, COUNT(*) AS hours,
  CAST(SUM(total_bikes_taken) AS BIGINT) AS taken FROM v_hourly GROUP BY 1, 2""")
def _(d):
    from docksense.operators.aggs import nest_hours

    path = d.path("documents")
    docs = nest_hours(d("v_hourly"), ["station_id", "date_reported"], ["hora_dia", "total_bikes_taken"])
    writers.write_documents(docs, path, "overwrite")
    back = readers.read_parquet(d.spark, path)
    taken = F.aggregate("status", F.lit(0).cast("bigint"), lambda a, s: a + s.total_bikes_taken)
    return back.select("station_id", "date_reported", F.size("status").cast("bigint").alias("hours"), taken.alias("taken"))


@query("a12_keyed_upsert", """
WITH old AS (SELECT station_id, CAST(SUM(total_bikes_taken) AS BIGINT) AS amount, MAX(hora_dia) AS mark
  FROM v_hourly GROUP BY 1),
new AS (SELECT station_id, CAST(MAX(snap_id) AS BIGINT) AS amount, CAST(MAX(capacity) AS INT) AS mark FROM v_snapshot GROUP BY 1)
SELECT COALESCE(n.station_id, o.station_id) AS station_id,
  CASE WHEN n.station_id IS NOT NULL THEN n.amount ELSE o.amount END AS amount,
  CASE WHEN n.station_id IS NOT NULL THEN n.mark ELSE o.mark END AS mark
FROM old o FULL OUTER JOIN new n ON o.station_id = n.station_id""")
def _(d):
    old = d("v_hourly").groupBy("station_id").agg(F.sum("total_bikes_taken").alias("amount"), F.max("hora_dia").alias("mark"))
    new = d("v_snapshot").groupBy("station_id").agg(F.max("snap_id").alias("amount"), F.max("capacity").alias("mark"))
    path = d.path("amounts")
    versions.replace_table(old, path)
    writers.upsert_table(new, path, ["station_id"])
    return versions.read_table(d.spark, path)


def _messages(d):
    broken = F.expr("substring(props, 1, length(props) - 1)")
    return d("events").select(
        "event_id", F.when(F.col("event_type") == "error", broken).otherwise(F.col("props")).alias("value"))


@query("a13_corrupt_split", """
SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS part, COUNT(*) AS n,
  CAST(SUM(CASE WHEN event_type = 'error' THEN 0 ELSE CAST(json_extract(props, '$.k') AS INT) END) AS BIGINT) AS k
FROM events GROUP BY 1""")
def _(d):
    path = d.path("lines")
    _messages(d).select("value").write.text(path)
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    good, bad = landing.decode(d.spark.read.text(path), "value", schema, on_error="split")
    return good.agg(F.lit("good").alias("part"), F.count("*").alias("n"), F.sum("k").alias("k")).union(
        bad.agg(F.lit("bad"), F.count("*"), F.lit(0).cast("bigint")))


@query("a14_union_rewrite", """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""")
def _(d):
    a = d("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = d("customer").select("c_custkey", "c_name", "c_acctbal")
    path = d.path("merged")
    versions.replace_table(a, path)
    versions.replace_table(writers.merge_datasets(versions.read_table(d.spark, path), b), path)  # over the path it reads
    return versions.read_table(d.spark, path)


@query("a15_partition_repair", f"""
WITH f AS (SELECT *, CAST(date_trunc('month', snap_date + CAST(snap_id % 3 - 1 AS INT)) AS DATE) AS folder FROM v_snapshot)
SELECT snap_id, {day('snap_date')} AS snap_date, strftime(
  CASE WHEN snap_date = folder - 1 THEN folder
       WHEN snap_date = CAST(folder + INTERVAL 1 MONTH AS DATE) THEN CAST(folder + INTERVAL 1 MONTH AS DATE) - 1
       ELSE snap_date END, '%Y-%m-%d') AS partition_date
FROM f""")
def _(d):
    df = d("v_snapshot").withColumn("folder", F.date_add("snap_date", (F.col("snap_id") % 3 - 1).cast("int")))
    fixed = writers.repair_boundary(df, F.year("folder"), F.month("folder"), "snap_date")
    return fixed.select("snap_id", "snap_date", "partition_date")


@query("a16_nested_column_prune", "SELECT station_id, name AS info_name, lon AS info_place_lon FROM v_station")
def _(d):
    path = d.path("nested")
    place = F.struct("lon", "lat").alias("place")
    d("v_station").select("station_id", F.struct("name", "capacity", place).alias("info")).write.parquet(path)
    return readers.project(readers.read_parquet(d.spark, path), ["station_id", "info.name", "info.place.lon"])


def status_messages(d):
    """Live status messages made of the status view."""
    types = F.struct(F.col("num_bikes_available").alias("mechanical"), F.lit(0).alias("ebike")).alias("num_bikes_available_types")
    fields = ["station_id", "num_bikes_available", types, "num_docks_available",
              cal.to_epoch("last_reported_local").alias("last_reported"), "status"]
    return writers.to_messages(d("v_status"), "station_id", fields)


@query("a17_stream_source", """
SELECT station_id, num_bikes_available, num_docks_available, status,
  CAST(floor(epoch(last_reported_local)) AS BIGINT) AS last_reported FROM v_status""")
def _(d):
    folder = d.path("feed")
    status_messages(d).select("value").write.text(folder)
    stream = live.decode_status(live.read_status_stream(d.spark, folder))
    rows = live.run_to_table(
        stream.select("station_id", "num_bikes_available", "num_docks_available", "status", "last_reported"),
        d.path("stream"), d.path("progress"))
    return rows


@query("a18_stream_publish", """
SELECT CAST(station_id AS VARCHAR) AS key,
  '{"station_id":' || station_id || ',"name":"' || name || '","capacity":' || capacity || ',"zone":{"truck":' || truck || '}}' AS value
FROM v_station""")
def _(d):
    zone = F.struct("truck").alias("zone")
    return writers.to_messages(d("v_station"), "station_id", ["station_id", "name", "capacity", zone])


@query("a19_drop_and_replace", "SELECT station_id, capacity FROM v_station")
def _(d):
    path = d.path("replace")
    versions.replace_table(d("v_station").select("station_id", "truck"), path)
    versions.replace_table(d("v_station").select("station_id", "capacity"), path)
    return versions.read_table(d.spark, path)


@query("a20_nested_feed", "SELECT station_id, name, lat, lon, capacity FROM v_station")
def _(d):
    path = d.path("documents")
    item = F.struct("station_id", "name", "lat", "lon", "capacity")
    docs = d("v_station").select(F.to_json(F.struct(F.struct(F.array(item).alias("stations")).alias("data"))).alias("value"))
    docs.write.text(path)
    return landing.feed_rows(d.spark.read.text(path), STATION_FEED).select("station_id", "name", "lat", "lon", "capacity")
