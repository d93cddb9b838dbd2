"""Ordered per-station work."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query, ts
from docksense.catalog.c_joins import MODE_SQL, modes
from docksense.catalog.d_aggregates import LAG_SQL, RETURNED, TAKEN, with_demand
from docksense.operators import windows


@query("e01_lag_demand", f"SELECT event_id, station_id, diff AS diferencia_bicis, {TAKEN} AS bikes_taken, {RETURNED} AS bikes_returned FROM ({LAG_SQL})")
def _(d):
    return with_demand(d).select("event_id", "station_id", "diferencia_bicis", "bikes_taken", "bikes_returned")


@query("e02_latest_record", f"""
SELECT station_id, {day('snap_date')} AS snap_date, snap_id, address, capacity FROM v_snapshot
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY snap_date DESC, snap_id DESC) = 1""")
def _(d):
    return windows.latest_info(d("v_snapshot"), "station_id", ["snap_date", "snap_id"])


@query("e03_rank_mode", f"""
SELECT num_bikes_available, num_docks_available, COUNT(*) AS hours FROM ({MODE_SQL}) GROUP BY 1, 2""")
def _(d):
    return modes(d).groupBy("num_bikes_available", "num_docks_available").agg(F.count("*").alias("hours"))


FULL = "PARTITION BY station_id ORDER BY snap_date, snap_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


@query("e04_last_known_fill", f"""
SELECT snap_id, LAST_VALUE(address IGNORE NULLS) OVER ({FULL}) AS address, LAST_VALUE(capacity IGNORE NULLS) OVER ({FULL}) AS capacity FROM v_snapshot""")
def _(d):
    out = windows.fill_last_known(d("v_snapshot"), "station_id", ["snap_date", "snap_id"], ["address", "capacity"])
    return out.select("snap_id", "address", "capacity")


@query("e05_partition_mean_fill", """
SELECT snap_id, COALESCE(capacity, CAST(round(CAST(SUM(capacity) OVER (PARTITION BY station_id) AS DOUBLE)
  / COUNT(capacity) OVER (PARTITION BY station_id)) AS INT)) AS capacity,
  round(COALESCE(capacity / 2e0, CAST(SUM(capacity) OVER (PARTITION BY station_id) AS DOUBLE) / COUNT(capacity) OVER (PARTITION BY station_id) / 2e0), 6) AS half
FROM v_snapshot""")
def _(d):
    df = d("v_snapshot").withColumn("half", F.col("capacity") / 2.0)
    out = windows.fill_partition_mean(df, "station_id", ["capacity"], ["half"])
    return out.select("snap_id", "capacity", F.round("half", 6).alias("half"))


@query("e06_forward_fill", """
WITH z AS (SELECT event_id, station_id, last_reported_local, CASE WHEN num_bikes_available % 4 = 0 AND num_docks_available % 2 = 0 THEN 0 ELSE num_bikes_available END AS b,
  CASE WHEN num_bikes_available % 4 = 0 AND num_docks_available % 2 = 0 THEN 0 ELSE num_docks_available END AS d FROM v_status),
n AS (SELECT *, CASE WHEN b = 0 AND d = 0 THEN NULL ELSE b END AS nb, CASE WHEN b = 0 AND d = 0 THEN NULL ELSE d END AS nd FROM z)
SELECT event_id, LAST_VALUE(nb IGNORE NULLS) OVER w AS num_bikes_available, LAST_VALUE(nd IGNORE NULLS) OVER w AS num_docks_available FROM n
WINDOW w AS (PARTITION BY station_id ORDER BY last_reported_local, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(d):
    gone = (F.col("num_bikes_available") % 4 == 0) & (F.col("num_docks_available") % 2 == 0)
    df = d("v_status").withColumn("gone", gone)
    df = df.withColumns({c: F.when(F.col("gone"), 0).otherwise(F.col(c)) for c in ("num_bikes_available", "num_docks_available")})
    return windows.forward_fill_zero(df).select("event_id", "num_bikes_available", "num_docks_available")


@query("e07_last_n_per_key", f"""
SELECT station_id, {ts('last_reported_local')} AS last_reported_local, event_id FROM v_status
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY last_reported_local DESC, event_id DESC) <= 24""")
def _(d):
    out = windows.tail_per_key(d("v_status"), ["station_id"], ["last_reported_local", "event_id"])
    return out.select("station_id", "last_reported_local", "event_id")


@query("e08_first_per_bucket", f"""
SELECT station_id, {ts('time_bucket(INTERVAL 30 MINUTE, last_reported_local)')} AS bucket, event_id FROM v_status
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id, time_bucket(INTERVAL 30 MINUTE, last_reported_local) ORDER BY last_reported_local, event_id) = 1""")
def _(d):
    out = windows.first_per_bucket(d("v_status"), ["station_id"], "last_reported_local", "event_id")
    return out.select("station_id", "bucket", "event_id")
