"""Grouped summaries, rankings and profiles."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query, ts
from docksense.catalog.c_joins import COUNT_SQL, FLAGGED, MODE_SQL, areas, modes, state
from docksense.catalog.h_scalars import EFF_SQL
from docksense.operators import aggs, routes, spatial, windows


@query("d01_first_max", f"""
SELECT station_id, {day('snap_date')} AS snap_date, MAX(CASE WHEN rn = 1 THEN address END) AS address, MAX(capacity) AS max_capacity
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id, snap_date ORDER BY snap_id) AS rn FROM v_snapshot) GROUP BY station_id, snap_date""")
def _(d):
    return aggs.daily_info(d("v_snapshot"), ["station_id", "snap_date"], ["address"], ["snap_id"], "capacity")


LAG_SQL = """SELECT *, num_bikes_available - LAG(num_bikes_available) OVER (PARTITION BY station_id, date_reported
  ORDER BY last_reported_local, event_id) AS diff FROM v_status"""
TAKEN = "CASE WHEN diff < 0 THEN -diff ELSE 0 END"
RETURNED = "CASE WHEN diff > 0 THEN diff ELSE 0 END"


def with_demand(d):
    return windows.demand_from_lag(d("v_status").withColumn("file_date", F.col("date_reported")))


@query("d02_sum_max", f"""
SELECT station_id, {day('date_reported')} AS date_reported, hora_dia, CAST(SUM({TAKEN}) AS INT) AS total_bikes_taken,
  CAST(SUM({RETURNED}) AS INT) AS total_bikes_returned, {ts('MAX(last_reported_local)')} AS last_reported_local
FROM ({LAG_SQL}) GROUP BY station_id, date_reported, hora_dia""")
def _(d):
    return aggs.hourly_demand(with_demand(d))


@query("d03_nest_sorted", f"""
SELECT station_id, {day('date_reported')} AS date_reported, string_agg(hora_dia || ':' || total_bikes_taken, ',' ORDER BY hora_dia) AS hours
FROM v_hourly GROUP BY 1, 2""")
def _(d):
    docs = aggs.nest_hours(d("v_hourly"), ["station_id", "date_reported"], ["hora_dia", "total_bikes_taken"])
    text = F.transform("status", lambda s: F.concat(s.hora_dia.cast("string"), F.lit(":"), s.total_bikes_taken.cast("string")))
    return docs.select("station_id", "date_reported", F.array_join(text, ",").alias("hours"))


def documents(d):
    """Station-day documents of the status view."""
    info = d("v_station").select("station_id", "name", "lon", "lat", "capacity")
    return aggs.station_documents(modes(d).withColumnRenamed("date_reported", "date"), info)


@query("d04_nest_documents", f"""
SELECT m.station_id, {day('date_reported')} AS date, s.name,
  string_agg(hora_dia || ':' || num_bikes_available || ':' || num_docks_available, ',' ORDER BY hora_dia) AS hours
FROM ({MODE_SQL}) m LEFT JOIN v_station s ON m.station_id = s.station_id GROUP BY 1, 2, 3""")
def _(d):
    def part(s):
        return F.concat_ws(":", s["hour"], s.num_bikes_available, s.num_docks_available)

    return documents(d).select("station_id", "date", "name", F.array_join(F.transform("status", part), ",").alias("hours"))


@query("d05_mode_per_group", f"SELECT station_id, {day('date_reported')} AS date_reported, hora_dia, num_bikes_available, num_docks_available FROM ({MODE_SQL})")
def _(d):
    return modes(d)


def shortage_sql(col: str) -> str:
    return f"""SELECT station_id, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS avg_monthly_count, COUNT(*) AS months_count FROM (
  SELECT station_id, EXTRACT(YEAR FROM date_reported) AS y, EXTRACT(MONTH FROM date_reported) AS m, COUNT(*) AS n
  FROM ({MODE_SQL}) WHERE {col} = 0 GROUP BY 1, 2, 3) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query("d06_empty_hours", shortage_sql("num_bikes_available"))
def _(d):
    return aggs.shortage_stations(documents(d), "num_bikes_available")


@query("d07_full_hours", shortage_sql("num_docks_available"))
def _(d):
    return aggs.shortage_stations(documents(d), "num_docks_available")




# every hour of each station's days: the last mode before it, or the day's first
FULL_SQL = f"""SELECT g.station_id, g.date_reported, g.hora_dia,
  COALESCE(LAST_VALUE(num_bikes_available IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING),
    FIRST_VALUE(num_bikes_available IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS num_bikes_available
FROM (SELECT DISTINCT station_id, date_reported, CAST(h AS INT) AS hora_dia FROM ({MODE_SQL}), range(24) r(h)) g
LEFT JOIN ({MODE_SQL}) m ON m.station_id = g.station_id AND m.date_reported = g.date_reported AND m.hora_dia = g.hora_dia
WINDOW w AS (PARTITION BY g.station_id, g.date_reported ORDER BY g.hora_dia)"""


def rotation_sql(positions: int) -> str:
    return f"""SELECT station_id, SUM(CASE WHEN n >= {positions} THEN moved ELSE 0 END) / COUNT(*) AS avg_daily_rotation, COUNT(*) AS "count" FROM (
  SELECT station_id, date_reported, COUNT(*) AS n, CAST(SUM(CASE WHEN pos <= {positions} THEN abs(num_bikes_available - prev) ELSE 0 END) AS DOUBLE) AS moved
  FROM (SELECT *, LAG(num_bikes_available) OVER w AS prev, ROW_NUMBER() OVER w AS pos FROM ({FULL_SQL})
    WINDOW w AS (PARTITION BY station_id, date_reported ORDER BY hora_dia)) GROUP BY 1, 2) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query("d08_daily_rotation", rotation_sql(24))
def _(d):
    return aggs.rotation_stations(aggs.complete_days(documents(d)))


@query("d09_reasons", f"""
SELECT station_id, string_agg(reason, ',' ORDER BY i) AS reasons FROM (
  SELECT station_id, 'No Bikes' AS reason, 0 AS i FROM ({shortage_sql('num_bikes_available')})
  UNION ALL SELECT station_id, 'No Docks', 1 FROM ({shortage_sql('num_docks_available')})
  UNION ALL SELECT station_id, 'High Rotation', 2 FROM ({rotation_sql(24)})) GROUP BY 1""")
def _(d):
    docs = documents(d)
    out = aggs.popular_stations(aggs.shortage_stations(docs, "num_bikes_available"), aggs.shortage_stations(docs, "num_docks_available"),
                                aggs.rotation_stations(aggs.complete_days(docs)))
    return out.select("station_id", F.array_join("reason", ",").alias("reasons"))


@query("d10_null_profile", """
SELECT 'address' AS column_name, round(100e0 * SUM(CASE WHEN address IS NULL THEN 1 ELSE 0 END) / COUNT(*), 6) AS null_pct FROM v_snapshot
UNION ALL SELECT 'capacity', round(100e0 * SUM(CASE WHEN capacity IS NULL THEN 1 ELSE 0 END) / COUNT(*), 6) FROM v_snapshot
UNION ALL SELECT 'station_id', 0e0 UNION ALL SELECT 'snap_date', 0e0 UNION ALL SELECT 'snap_id', 0e0""")
def _(d):
    return aggs.null_percentages(d("v_snapshot")).withColumn("null_pct", F.round("null_pct", 6))


@query("d11_null_report", """
SELECT station_id, CAST(EXTRACT(YEAR FROM snap_date) AS INT) AS year, CAST(EXTRACT(MONTH FROM snap_date) AS INT) AS month, COUNT(*) AS "count"
FROM v_snapshot WHERE address IS NULL OR address = '' OR capacity IS NULL GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
def _(d):
    return aggs.null_report(d("v_snapshot"), "snap_date", ["address", "capacity"])


@query("d12_lifespan", f"SELECT station_id, {day('MIN(snap_date)')} AS creation_date, {day('MAX(snap_date)')} AS end_date FROM v_snapshot GROUP BY 1")
def _(d):
    parts = d("v_snapshot").select("station_id", F.year("snap_date").alias("y"), F.month("snap_date").alias("m"), F.dayofmonth("snap_date").alias("dd"))
    return aggs.lifespan(parts, F.make_date("y", "m", "dd"))


def density_sql(counts: str) -> str:
    return f"""SELECT area_id, "count", CASE WHEN "count" <= t1 THEN 'low' WHEN "count" <= t2 THEN 'medium' WHEN "count" <= t3 THEN 'high' ELSE 'very_high' END AS classification
FROM ({counts}), (SELECT MAX(CASE WHEN rn = floor(n * 0.25e0) + 1 THEN "count" END) AS t1, MAX(CASE WHEN rn = floor(n * 0.60e0) + 1 THEN "count" END) AS t2,
  MAX(CASE WHEN rn = floor(n * 0.75e0) + 1 THEN "count" END) AS t3 FROM (SELECT "count", ROW_NUMBER() OVER (ORDER BY "count") AS rn, COUNT(*) OVER () AS n FROM ({counts})))"""


@query("d13_rank_thresholds", density_sql(COUNT_SQL.format(where="")))
def _(d):
    counted = spatial.count_points(areas(d), d("v_poi"), "area_id", x="lon", y="lat")
    return aggs.density_class(counted).select("area_id", "count", "classification")


LAYER_WHERE = {"shops": " WHERE category < 'Brand#3'", "schools": " WHERE category >= 'Brand#3'", "poi": ""}


@query("d14_density_layers", "SELECT s.area_id, " + ", ".join(
    f'{k}."count" AS {k}_count, {k}.classification AS {k}_class' for k in ("shops", "schools", "poi"))
    + " FROM v_area s " + " ".join(f"JOIN ({density_sql(COUNT_SQL.format(where=w))}) {k} ON {k}.area_id = s.area_id" for k, w in LAYER_WHERE.items()))
def _(d):
    from docksense.operators.clean import flatten_class

    poi = d("v_poi").select(F.col("lon").alias("x"), F.col("lat").alias("y"), "category")
    layers = {"shops": poi.filter(F.col("category") < "Brand#3"), "schools": poi.filter(F.col("category") >= "Brand#3"), "poi": poi}
    out = spatial.density_layers(areas(d), layers, "area_id")
    return flatten_class(out.drop("name", "geometry"), list(layers))


@query("d15_mean_by_station", f"""
SELECT station_id, round(avg(t + r), 6) AS rotacion, round(avg({EFF_SQL}), 6) AS tasa_eficiencia_ajustada FROM
  (SELECT station_id, num_bikes_available AS b, num_docks_available AS d, hora_dia AS t, CAST(event_id % 7 AS INT) AS r FROM v_status) GROUP BY 1""")
def _(d):
    df = d("v_status").withColumns({"total_bikes_taken": F.col("hora_dia"), "total_bikes_returned": (F.col("event_id") % 7).cast("int")})
    out = aggs.station_means(df)
    return out.select("station_id", F.round("rotacion", 6).alias("rotacion"), F.round("tasa_eficiencia_ajustada", 6).alias("tasa_eficiencia_ajustada"))


_METRIC_SQL = " UNION ALL ".join(
    f"SELECT grp, '{c}' AS metric, round(avg(m{i}), 2) AS mean FROM g GROUP BY 1" for i, c in enumerate(aggs.DISTANCES))


@query("d16_group_summary", f"""
WITH b AS (SELECT event_id, status, {', '.join(f'CAST((event_id * {i + 3}) % 400 AS DOUBLE) AS m{i}' for i in range(7))},
  num_bikes_available AS nb, num_docks_available AS nd FROM v_status),
g AS (SELECT 'Proposed' AS grp, * FROM b WHERE status <> 'error' UNION ALL SELECT 'Top Stations', * FROM b WHERE status = 'error'
  UNION ALL SELECT 'No Bikes', * FROM b WHERE status = 'error' AND nb = 0 UNION ALL SELECT 'No Docks', * FROM b WHERE status = 'error' AND nd = 0)
{_METRIC_SQL}""")
def _(d):
    dist = {c: ((F.col("event_id") * (i + 3)) % 400).cast("double") for i, c in enumerate(aggs.DISTANCES)}
    df = d("v_status").withColumns(dist)
    proposed = df.withColumn("cluster", F.when(F.col("status") == "error", -1).otherwise(1))
    why = F.array_compact(F.array(F.when(F.col("num_bikes_available") == 0, "No Bikes"), F.when(F.col("num_docks_available") == 0, "No Docks")))
    top = df.filter(F.col("status") == "error").withColumn("reason", why)
    return aggs.distance_summary(proposed, top)


@query("d17_bounds", "SELECT MIN(xmin) AS xmin, MIN(ymin) AS ymin, MAX(xmax) AS xmax, MAX(ymax) AS ymax FROM v_area")
def _(d):
    return aggs.total_bounds(areas(d))


@query("d18_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, MIN({c}) AS min,
  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, MAX({c}) AS max FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity")))
def _(d):
    out = spatial.describe(d("lineitem"), ["l_extendedprice", "l_quantity"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@query("d19_best_per_cluster", """
SELECT truck AS cluster, poi AS point_id, score AS similarity_score FROM (
  SELECT p_size AS truck, p_partkey AS poi, floor(p_retailprice) AS score, ROW_NUMBER() OVER (PARTITION BY p_size ORDER BY floor(p_retailprice) DESC, p_partkey) AS rn FROM part)
WHERE rn = 1""")
def _(d):
    df = d("part").select(F.col("p_size").alias("cluster"), F.col("p_partkey").alias("point_id"),
                          F.floor("p_retailprice").cast("double").alias("similarity_score"))
    return aggs.best_per_cluster(df)


@query("d20_truck_balance", f"""
SELECT truck, CAST(SUM(CASE WHEN check_status = 'low' THEN trunc(0.75e0 * capacity - num_bikes_available) ELSE -trunc(0.25e0 * capacity) END) AS BIGINT) AS balance_bicicletas
FROM ({FLAGGED}) GROUP BY 1""")
def _(d):
    return aggs.truck_balance(routes.flagged(state(d)))


@query("d21_row_counts", """
SELECT 'status' AS part, COUNT(*) AS rows FROM v_status UNION ALL SELECT 'stations', COUNT(*) FROM v_station
UNION ALL SELECT 'snapshots', COUNT(*) FROM v_snapshot""")
def _(d):
    return aggs.audit_counts(status=d("v_status"), stations=d("v_station"), snapshots=d("v_snapshot"))


@query("d22_distinct_days", f"SELECT DISTINCT {day('snap_date')} AS day FROM v_snapshot")
def _(d):
    return aggs.distinct_days(d("v_snapshot"), "snap_date")


@query("d23_first_doc_fill", """
WITH f AS (SELECT station_id, address AS fa, capacity AS fc FROM v_snapshot QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY snap_date, snap_id) = 1)
SELECT snap_id, s.station_id, COALESCE(fa, address) AS address, COALESCE(fc, capacity) AS capacity FROM v_snapshot s JOIN f ON f.station_id = s.station_id
WHERE fa IS NOT NULL OR fc IS NOT NULL""")
def _(d):
    out = aggs.backfill_info(d("v_snapshot"), "station_id", ["snap_date", "snap_id"], ["address", "capacity"])
    return out.select("snap_id", "station_id", "address", "capacity")


@query("d24_time_bounds", f"SELECT {ts('MIN(ts)')} AS first_ts, {ts('MAX(ts)')} AS last_ts FROM events")
def _(d):
    return aggs.time_bounds(d("events"), "ts")


@query("d25_sorted_names", "SELECT DISTINCT category FROM v_poi ORDER BY 1")
def _(d):
    return aggs.names(d("v_poi"), "category")


@query("d26_centroid", "SELECT round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM v_poi")
def _(d):
    out = aggs.centroid(d("v_poi"))
    return out.select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("d27_is_empty", """
SELECT 'status' AS part, COUNT(*) = 0 AS empty FROM v_status UNION ALL SELECT 'holidays', COUNT(*) = 0 FROM v_holiday
UNION ALL SELECT 'none', COUNT(*) = 0 FROM v_status WHERE station_id < 0""")
def _(d):
    parts = {"status": d("v_status"), "holidays": d("v_holiday"), "none": d("v_status").filter("station_id < 0")}
    return d.spark.createDataFrame([(name, aggs.is_empty(df)) for name, df in parts.items()], "part string, empty boolean")
