"""Mobility views over the star-schema test tables.

The same view text feeds Spark (over parquet) and the SQL oracle (as ``WITH`` clauses);
``{src}`` stands for the base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[str, str]] = {
    # station attributes; truck = zone id; capacity 0 every 17th station
    "v_station": ("customer", """
SELECT CAST(c_custkey AS INT) AS station_id, c_name AS name,
  CAST(CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE 20 + c_custkey % 11 END AS INT) AS capacity,
  2.05e0 + CAST((c_custkey * 37) % 1000 AS DOUBLE) / 1e3 * 0.18e0 AS lon,
  41.32e0 + CAST((c_custkey * 91) % 1000 AS DOUBLE) / 1e3 * 0.15e0 AS lat,
  CAST(c_nationkey AS INT) AS truck
FROM {src}"""),
    # readings
    "v_status": ("events", """
SELECT event_id, CAST(user_id AS INT) AS station_id, ts AS last_reported_local,
  CAST(ts AS DATE) AS date_reported, CAST(EXTRACT(HOUR FROM ts) AS INT) AS hora_dia,
  CAST(FLOOR(value) AS INT) % 31 AS num_bikes_available,
  CAST(FLOOR(value * 7) AS INT) % 9 AS num_docks_available, event_type AS status
FROM {src}"""),
    # one reading per half-hour slot and day, with gaps
    "v_weather": ("events", """
SELECT event_id % 48 AS slot, CAST(ts AS DATE) AS fecha, MAX(value) AS valor
FROM {src} WHERE event_type = 'view' GROUP BY 1, 2"""),
    "v_holiday": ("events", """
SELECT DISTINCT CAST(ts AS DATE) AS data FROM {src} WHERE EXTRACT(DAY FROM ts) % 7 = 0"""),
    # 5 x 5 rectangles
    "v_area": ("nation", """
SELECT CAST(n_nationkey AS INT) AS area_id, n_name AS name,
  2.05e0 + CAST(n_nationkey % 5 AS DOUBLE) * 0.036e0 AS xmin,
  41.32e0 + CAST(FLOOR(n_nationkey / 5) AS DOUBLE) * 0.03e0 AS ymin,
  2.05e0 + CAST(n_nationkey % 5 AS DOUBLE) * 0.036e0 + 0.036e0 AS xmax,
  41.32e0 + CAST(FLOOR(n_nationkey / 5) AS DOUBLE) * 0.03e0 + 0.03e0 AS ymax
FROM {src}"""),
    # integer-unit polygons as text
    "v_area_wkt": ("nation", """
SELECT CAST(n_nationkey AS INT) AS area_id, CONCAT('POLYGON ((', CAST(n_nationkey AS STRING), ' 0, ',
  CAST(n_nationkey + 1 AS STRING), ' 0, ', CAST(n_nationkey + 1 AS STRING), ' 1, ',
  CAST(n_nationkey AS STRING), ' 1, ', CAST(n_nationkey AS STRING), ' 0))') AS geometry
FROM {src}"""),
    # shops, schools, stops; category = brand
    "v_poi": ("part", """
SELECT CAST(p_partkey AS INT) AS poi_id, p_name AS name, p_brand AS category,
  2.05e0 + CAST((p_partkey * 53) % 997 AS DOUBLE) / 997e0 * 0.18e0 AS lon,
  41.32e0 + CAST((p_partkey * 71) % 991 AS DOUBLE) / 991e0 * 0.15e0 AS lat
FROM {src}"""),
    # one straight segment per area
    "v_lane": ("nation", """
SELECT CAST(n_nationkey AS INT) AS lane_id,
  2.05e0 + CAST(n_nationkey % 5 AS DOUBLE) * 0.036e0 AS x1,
  41.32e0 + CAST(FLOOR(n_nationkey / 5) AS DOUBLE) * 0.03e0 AS y1,
  2.05e0 + CAST(n_nationkey % 5 + 1 AS DOUBLE) * 0.036e0 AS x2,
  41.32e0 + CAST(FLOOR(n_nationkey / 5) + 1 AS DOUBLE) * 0.03e0 AS y2
FROM {src}"""),
    # dated attribute snapshots with nulls
    "v_snapshot": ("orders", """
SELECT CAST(o_custkey AS INT) AS station_id, CAST(o_orderdate AS DATE) AS snap_date, o_orderkey AS snap_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS address,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS INT) END AS capacity
FROM {src}"""),
    # demand grain, taken / returned stand-ins
    "v_hourly": ("events", """
SELECT CAST(user_id AS INT) AS station_id, CAST(ts AS DATE) AS date_reported,
  CAST(EXTRACT(HOUR FROM ts) AS INT) AS hora_dia,
  CAST(SUM(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END) AS INT) AS total_bikes_taken,
  CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS total_bikes_returned,
  MAX(ts) AS last_reported_local
FROM {src} GROUP BY 1, 2, 3"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or one of the mobility views over it."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base, sql = VIEWS[name]
    return spark.sql(sql, src=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def with_views(sql: str) -> str:
    """Prefix a SQL text with the ``WITH`` clauses of the views it names."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    clauses = ",\n".join(f"{v} AS ({VIEWS[v][1].strip().format(src=VIEWS[v][0])})" for v in used)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {clauses},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {clauses},\n{body[5:]}"
    return f"WITH {clauses}\n{body}"
