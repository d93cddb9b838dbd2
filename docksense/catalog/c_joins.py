"""Joins, spatial joins and nearest-object joins."""

from pyspark.sql import functions as F

from docksense.catalog.a_sources import status_messages
from docksense.catalog.base import day, query, ts
from docksense.catalog.h_scalars import CLASS_SQL, HAV_SQL, JOINED
from docksense.functions import calendar as cal
from docksense.functions import geometry as geom
from docksense.operators import aggs, joins, nearest, routes, spatial, windows
from docksense.plans import live
from docksense.streaming import status as stream


@query("c01_left_join_dim", f"SELECT event_id, station_id, capacity FROM {JOINED}")
def _(d):
    return joins.join_capacity(d("v_status"), d("v_station")).select("event_id", "station_id", "capacity")


CALENDAR_SQL = """SELECT s.*, CASE WHEN h.data IS NULL THEN 0 ELSE 1 END AS festivo, CAST(isodow(date_reported) AS INT) AS weekday,
  CASE WHEN h.data IS NULL AND isodow(date_reported) <= 5 THEN 1 ELSE 0 END AS laborable
  FROM v_status s LEFT JOIN v_holiday h ON s.date_reported = h.data"""


@query("c02_broadcast_calendar", f"SELECT event_id, hora_dia, festivo, weekday, laborable FROM ({CALENDAR_SQL})")
def _(d):
    return joins.join_calendar(d("v_status"), d("v_holiday")).select("event_id", "hora_dia", "festivo", "weekday", "laborable")


@query("c03_stream_static_left", f"""
SELECT station_id, capacity, COUNT(*) AS n FROM {JOINED} GROUP BY 1, 2""")
def _(d):
    folder = d.path("feed")
    status_messages(d).select("value").write.text(folder)
    messages = stream.read_status_stream(d.spark, folder)
    enriched = stream.enrich_stream(stream.decode_status(messages), d("v_station")).select("station_id", "capacity", "last_reported")
    rows = stream.run_to_table(enriched, d.path("stream"), d.path("progress"))
    return rows.groupBy("station_id", "capacity").agg(F.count("*").alias("n"))


def weather_series(d):
    """Long series (variable, ts, valor) with no wind readings."""
    ev = d("events")
    variable = F.when(F.col("event_type") == "view", "temperatura").when(F.col("event_type") == "click", "precipitacion").when(
        F.col("event_type") == "signup", "humedad")
    return ev.select(variable.alias("variable"), cal.floor_time("ts", 1800).alias("ts"), F.floor("value").cast("double").alias("valor")).filter(
        F.col("variable").isNotNull())


WIDE_SQL = """SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bucket,
  MAX(CASE WHEN event_type = 'view' THEN floor(value) END) AS temperatura,
  MAX(CASE WHEN event_type = 'click' THEN floor(value) END) AS precipitacion,
  MAX(CASE WHEN event_type = 'signup' THEN floor(value) END) AS humedad, CAST(NULL AS DOUBLE) AS viento FROM events GROUP BY 1"""


def last_sunday(ts_col: str, month: int) -> str:
    end = f"make_date(CAST(EXTRACT(YEAR FROM {ts_col}) AS INT), {month}, 31)"
    return f"({end} - CAST(isodow({end}) % 7 AS INT))"


#: UTC half-hour of a local reading: summer time from the last Sunday of March to that of October.
UTC_BUCKET = f"""time_bucket(INTERVAL 30 MINUTE, last_reported_local - CASE WHEN last_reported_local >= {last_sunday('last_reported_local', 3)} + INTERVAL 2 HOUR
  AND last_reported_local < {last_sunday('last_reported_local', 10)} + INTERVAL 3 HOUR THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END)"""


@query("c04_time_bucket_join", f"""
SELECT event_id, {ts(UTC_BUCKET)} AS last_reported_rounded, temperatura, precipitacion,
  humedad, viento FROM v_status LEFT JOIN ({WIDE_SQL}) ON bucket = {UTC_BUCKET}""")
def _(d):
    out = joins.join_bucketed(d("v_status"), weather_series(d))
    return out.select("event_id", "last_reported_rounded", *joins.WEATHER)


@query("c05_argmax_self_join", f"""
WITH g AS (SELECT station_id, date_reported, hora_dia, SUM(num_bikes_available) AS a, SUM(num_docks_available) AS b,
  MAX(last_reported_local) AS t FROM v_status GROUP BY 1, 2, 3)
SELECT s.event_id, s.station_id, {day('s.date_reported')} AS date_reported, s.hora_dia,
  CAST(g.a AS INT) AS sum_bikes, CAST(g.b AS INT) AS sum_docks FROM v_status s JOIN g ON s.station_id = g.station_id
  AND s.date_reported = g.date_reported AND s.hora_dia = g.hora_dia AND s.last_reported_local = g.t""")
def _(d):
    out = windows.last_in_group(d("v_status"), ["station_id", "date_reported", "hora_dia"], "last_reported_local",
                                {"sum_bikes": "num_bikes_available", "sum_docks": "num_docks_available"})
    return out.select("event_id", "station_id", "date_reported", "hora_dia", "sum_bikes", "sum_docks")


@query("c06_full_outer_coalesce", """
SELECT station_id, MAX(CASE WHEN ra = 1 THEN length(address) END) AS address_length,
  MAX(CASE WHEN ra = 1 THEN address END) AS address, MAX(CASE WHEN rc = 1 THEN capacity END) AS capacity
FROM (SELECT *, CASE WHEN address IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY station_id, address IS NULL ORDER BY snap_date DESC, snap_id DESC) END AS ra,
  CASE WHEN capacity IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY station_id, capacity IS NULL ORDER BY snap_date DESC, snap_id DESC) END AS rc
  FROM v_snapshot) GROUP BY 1""")
def _(d):
    out = joins.consolidate_snapshots(d("v_snapshot"), "station_id", ["snap_date", "snap_id"])
    return out.withColumn("address_length", F.length("address").cast("bigint"))


GRID_SQL = """SELECT station_id, CAST(unnest(generate_series(c, e, INTERVAL 1 DAY)) AS DATE) AS date_reported FROM
  (SELECT station_id, MIN(date_reported) AS c, MAX(date_reported) AS e FROM v_hourly GROUP BY 1)"""


@query("c07_cross_join_grid", f"""
SELECT station_id, {day('date_reported')} AS date_reported, CAST(h AS INT) AS hora_dia FROM ({GRID_SQL}), range(24) r(h)""")
def _(d):
    return joins.calendar_grid(aggs.lifespan(d("v_hourly"))).select("station_id", "date_reported", "hora_dia")


@query("c08_theta_range_filter", f"""
SELECT station_id, COUNT(*) * 24 AS cells, {day('MIN(date_reported)')} AS first_day, {day('MAX(date_reported)')} AS last_day
FROM ({GRID_SQL}) WHERE date_reported BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1""")
def _(d):
    grid = joins.calendar_grid(aggs.lifespan(d("v_hourly")), "2024-01-10", "2024-01-20")
    return grid.groupBy("station_id").agg(F.count("*").alias("cells"), F.min("date_reported").alias("first_day"),
                                          F.max("date_reported").alias("last_day"))


@query("c09_left_join_grid", f"""
SELECT g.station_id, {day('g.date_reported')} AS date_reported, CAST(h AS INT) AS hora_dia, total_bikes_taken, total_bikes_returned
FROM ({GRID_SQL}) g CROSS JOIN range(24) r(h) LEFT JOIN v_hourly v
  ON v.station_id = g.station_id AND v.date_reported = g.date_reported AND v.hora_dia = h""")
def _(d):
    keys = ["station_id", "date_reported", "hora_dia"]
    grid = joins.calendar_grid(aggs.lifespan(d("v_hourly"))).select(*keys)
    return joins.densify(d("v_hourly"), grid, keys).select(*keys, "total_bikes_taken", "total_bikes_returned")


MODE_SQL = """SELECT station_id, date_reported, hora_dia, num_bikes_available, num_docks_available FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id, date_reported, hora_dia ORDER BY n DESC, num_bikes_available, num_docks_available) AS rn
  FROM (SELECT station_id, date_reported, hora_dia, num_bikes_available, num_docks_available, COUNT(*) AS n FROM v_status
    GROUP BY 1, 2, 3, 4, 5)) WHERE rn = 1"""


def modes(d):
    return aggs.mode_rows(d("v_status"), ["station_id", "date_reported", "hora_dia"], ["num_bikes_available", "num_docks_available"])


@query("c10_left_join_renamed_key", f"""
SELECT m.station_id, {day('date_reported')} AS date_reported, hora_dia, num_bikes_available, name, truck
FROM ({MODE_SQL}) m LEFT JOIN v_station s ON m.station_id = s.station_id""")
def _(d):
    info = d("v_station").select(F.col("station_id").alias("id"), "name", "truck")
    out = joins.join_dim(modes(d), info, "station_id", "id")
    return out.select("station_id", "date_reported", "hora_dia", "num_bikes_available", "name", "truck")


TOP_SQL = "SELECT station_id FROM v_status GROUP BY 1 ORDER BY COUNT(*) DESC, station_id LIMIT 10"


@query("c11_anti_join_first", f"""
SELECT station_id, event_id, status FROM v_status WHERE station_id NOT IN ({TOP_SQL})
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY last_reported_local, event_id) = 1""")
def _(d):
    top = aggs.top_k(d("v_status").groupBy("station_id").agg(F.count("*").alias("n")), "n", 10, "station_id")
    out = joins.others(d("v_status"), top, "station_id", ["last_reported_local", "event_id"])
    return out.select("station_id", "event_id", "status")


@query("c12_semi_exists", f"SELECT DISTINCT {day('date_reported')} AS data FROM v_status WHERE date_reported IN (SELECT data FROM v_holiday)")
def _(d):
    return joins.existing_dates(d("v_status").withColumnRenamed("date_reported", "data"), d("v_holiday"), "data")


def areas(d):
    return d("v_area").select("area_id", "name", geom.rectangle("xmin", "ymin", "xmax", "ymax").alias("geometry"))


@query("c13_point_in_polygon", """
SELECT poi_id, area_id FROM v_poi JOIN v_area ON lon > xmin AND lon < xmax AND lat > ymin AND lat < ymax""")
def _(d):
    return spatial.spatial_join_within(d("v_poi").select("poi_id", "lon", "lat"), areas(d), x="lon", y="lat").select("poi_id", "area_id")


COUNT_SQL = """SELECT area_id, a.name, COUNT(p.poi_id) AS "count" FROM v_area a LEFT JOIN (SELECT * FROM v_poi{where}) p
  ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax GROUP BY 1, 2"""


@query("c14_points_per_area", COUNT_SQL.format(where=""))
def _(d):
    return spatial.count_points(areas(d), d("v_poi"), "area_id", x="lon", y="lat").select("area_id", "name", "count")


def plane(df):
    return df.withColumns({"x": F.col("lon") * 83000, "y": F.col("lat") * 111000})


PLANE = "(SELECT *, lon * 83000 AS x, lat * 111000 AS y FROM {v})"


@query("c15_nearest_join", f"""
SELECT s.station_id, round(MIN(sqrt(pow(s.x - p.x, 2) + pow(s.y - p.y, 2))), 4) AS dist_shopping,
  round(MIN(o.dist), 4) AS dist_station
FROM {PLANE.format(v='v_station')} s CROSS JOIN {PLANE.format(v='v_poi')} p
JOIN (SELECT a.station_id, MIN(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS dist FROM {PLANE.format(v='v_station')} a
  JOIN {PLANE.format(v='v_station')} b ON a.station_id <> b.station_id GROUP BY 1) o ON o.station_id = s.station_id
GROUP BY 1""")
def _(d):
    s = plane(d("v_station"))
    out = nearest.nearest_distance(s, plane(d("v_poi")), "dist_shopping", "station_id")
    out = nearest.nearest_distance(out, s, "dist_station", "station_id", exclude_self=True)
    return out.select("station_id", F.round("dist_shopping", 4).alias("dist_shopping"), F.round("dist_station", 4).alias("dist_station"))


def lanes(d):
    def at(i):
        return F.struct((F.col(f"x{i}") * 83000).alias("x"), (F.col(f"y{i}") * 111000).alias("y"))

    return d("v_lane").select("lane_id", F.array(at(1), at(2)).alias("path"))


@query("c16_distance_to_lines", f"""
WITH l AS (SELECT x1 * 83000 AS x1, y1 * 111000 AS y1, x2 * 83000 AS x2, y2 * 111000 AS y2 FROM v_lane),
t AS (SELECT station_id, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy FROM {PLANE.format(v='v_station')}, l),
c AS (SELECT *, greatest(0e0, least(1e0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) AS f FROM t)
SELECT station_id, round(MIN(sqrt(pow(x - x1 - f * dx, 2) + pow(y - y1 - f * dy, 2))), 4) AS dist_bike_lanes FROM c GROUP BY 1""")
def _(d):
    out = nearest.line_distance(plane(d("v_station")), lanes(d), "dist_bike_lanes", "station_id")
    return out.select("station_id", F.round("dist_bike_lanes", 4).alias("dist_bike_lanes"))


KNN = [f"f{i}" for i in range(7)]


def features(d):
    return d("embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f) for i, f in enumerate(KNN)])


_DIST = " + ".join(f"pow(a.{f} - b.{f}, 2)" for f in KNN)


@query("c17_knn_join", f"""
WITH e AS (SELECT vec_id, label, {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS {f}' for i, f in enumerate(KNN))} FROM embeddings),
r AS (SELECT a.vec_id, sqrt({_DIST}) AS dist, ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}) AS rn
  FROM e a, e b WHERE b.label = 3)
SELECT vec_id, round(avg(dist), 6) AS mean_distance FROM r WHERE rn <= 5 GROUP BY 1""")
def _(d):
    f = features(d)
    out = nearest.knn_mean(f, f.filter(F.col("label") == 3), "vec_id", KNN, 5)
    return out.select("vec_id", F.round("mean_distance", 6).alias("mean_distance"))


@query("c18_edge_join", "SELECT CAST(n_nationkey AS INT) AS src, station_id AS dst FROM nation JOIN v_station ON truck = n_nationkey")
def _(d):
    trucks = d("nation").select(F.col("n_nationkey").cast("int").alias("truck_id"))
    return joins.serves_edges(trucks, d("v_station"))


def state(d):
    return live.station_state(d("v_status"), d("v_station")).select(*routes.STOP_FIELDS)


FLAGGED = f"""SELECT * FROM (SELECT s.station_id, s.num_bikes_available, i.capacity, i.lon, i.lat, i.truck, {CLASS_SQL.replace('capacity', 'i.capacity')} AS check_status
  FROM (SELECT * FROM v_status QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY last_reported_local DESC, event_id DESC) = 1) s
  JOIN v_station i ON s.station_id = i.station_id) WHERE check_status IN ('low', 'full')"""
HAV_AB = HAV_SQL.format(a="a.lat", b="b.lat", p="a.lon", q="b.lon")


@query("c19_pair_self_join", f"""
WITH f AS ({FLAGGED}),
p AS (SELECT a.truck, a.station_id, b.station_id AS other, {HAV_AB} AS metres, round({HAV_AB}, 6) AS dist FROM f a JOIN f b ON a.truck = b.truck AND a.station_id <> b.station_id),
e AS (SELECT truck, station_id, COUNT(*) AS degree, arg_min(other, dist) AS closest_id, round(MIN(dist), 4) AS distance FROM p GROUP BY 1, 2)
SELECT p.truck, p.station_id, p.other AS other_id, round(p.metres, 4) AS pair_distance, a.degree, a.closest_id, a.distance,
  b.closest_id AS other_closest_id, b.distance AS other_distance
FROM p JOIN e a ON a.truck = p.truck AND a.station_id = p.station_id JOIN e b ON b.truck = p.truck AND b.station_id = p.other
WHERE p.station_id < p.other""")
def _(d):
    out = routes.intervention_edges(state(d))
    return out.withColumns({c: F.round(c, 4) for c in ("pair_distance", "distance", "other_distance")})


@query("c20_neighbour_stations", f"""
WITH f AS ({FLAGGED}) SELECT truck, station_id, check_status FROM f a
WHERE EXISTS (SELECT 1 FROM f b WHERE a.truck = b.truck AND a.station_id <> b.station_id)""")
def _(d):
    return routes.route_stations(state(d)).select("truck", "station_id", "check_status")


@query("c21_forecast_vs_actual", f"""
WITH a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY rn DESC) AS pos FROM
  (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY last_reported_local DESC) AS rn FROM v_hourly) WHERE rn <= 24),
p AS (SELECT station_id, hora_dia + 1 AS pos, MAX(total_bikes_taken) AS predicted FROM v_hourly GROUP BY 1, 2)
SELECT a.station_id, CAST(a.pos AS INT) AS pos, {ts('a.last_reported_local')} AS last_reported_local, total_bikes_taken, predicted,
  predicted + 2 AS upper_interval, predicted - 2 AS lower_interval FROM a LEFT JOIN p ON a.station_id = p.station_id AND a.pos = p.pos""")
def _(d):
    pred = d("v_hourly").groupBy("station_id", (F.col("hora_dia") + 1).alias("pos")).agg(F.max("total_bikes_taken").alias("predicted"))
    pred = pred.withColumns({"upper_interval": F.col("predicted") + 2, "lower_interval": F.col("predicted") - 2})
    out = joins.compare_forecast(d("v_hourly"), pred)
    return out.select("station_id", "pos", "last_reported_local", "total_bikes_taken", "predicted", "upper_interval", "lower_interval")


@query("c22_metric_to_dim", """
SELECT m.station_id, m.moved, s.name, s.capacity FROM (SELECT station_id, CAST(SUM(total_bikes_taken + total_bikes_returned) AS BIGINT) AS moved
  FROM v_hourly GROUP BY 1) m LEFT JOIN v_station s ON m.station_id = s.station_id""")
def _(d):
    moved = d("v_hourly").groupBy("station_id").agg(F.sum(F.col("total_bikes_taken") + F.col("total_bikes_returned")).alias("moved"))
    return joins.attach_info(moved, d("v_station")).select("station_id", "moved", "name", "capacity")
