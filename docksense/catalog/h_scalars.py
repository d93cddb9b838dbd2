"""Scalar expressions over the status, hourly and attribute views."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query, ts
from docksense.functions import calendar as cal
from docksense.functions import geo, status, text
from docksense.functions import geometry as geom
from docksense.operators import clean, joins
from docksense.operators.nearest import similarity
from docksense.plans import live

CLASS_SQL = """CASE WHEN num_bikes_available IS NULL OR capacity IS NULL OR capacity = 0 THEN 'undefined'
  WHEN num_bikes_available <= 0.4e0 * (capacity - 0.25e0 * capacity) THEN 'low'
  WHEN num_bikes_available = capacity THEN 'full' ELSE 'sufficient' END"""
JOINED = "v_status s LEFT JOIN (SELECT station_id AS sid, capacity FROM v_station) i ON s.station_id = i.sid"


@query("h01_status_class", f"SELECT event_id, {CLASS_SQL} AS check_status FROM {JOINED}")
def _(d):
    return live.classified_status(d("v_status"), d("v_station")).select("event_id", "check_status")


@query("h02_refill_remove", f"""
SELECT event_id, CASE WHEN c = 'low' THEN CAST(trunc(0.75e0 * capacity - num_bikes_available) AS INT) END AS bikes_to_refill,
  CASE WHEN c = 'full' THEN CAST(trunc(0.25e0 * capacity) AS INT) END AS bikes_to_remove
FROM (SELECT *, {CLASS_SQL} AS c FROM {JOINED})""")
def _(d):
    return live.classified_status(d("v_status"), d("v_station")).select("event_id", "bikes_to_refill", "bikes_to_remove")


@query("h03_bikes_error", f"""
SELECT event_id, CASE WHEN capacity > 0 THEN capacity - (num_bikes_available + num_docks_available) ELSE 0 END AS num_bikes_error
FROM {JOINED}""")
def _(d):
    df = joins.join_capacity(d("v_status"), d("v_station"))
    return df.select("event_id", status.bikes_error().alias("num_bikes_error"))


@query("h04_hour_band", """
SELECT event_id, CASE WHEN hora_dia <= 5 THEN 'night' WHEN hora_dia <= 9 THEN 'early_morning' WHEN hora_dia <= 14 THEN 'morning'
  WHEN hora_dia <= 19 THEN 'afternoon' ELSE 'evening' END AS hora_info FROM v_status""")
def _(d):
    status.register_sql_functions(d.spark)
    return d("v_status").selectExpr("event_id", "hour_band(hora_dia) AS hora_info")


@query("h05_season", f"""
SELECT snap_id, CASE WHEN md BETWEEN '03-21' AND '06-20' THEN 'Primavera' WHEN md BETWEEN '06-21' AND '09-22' THEN 'Verano'
  WHEN md BETWEEN '09-23' AND '12-20' THEN 'Otoño' ELSE 'Invierno' END AS season
FROM (SELECT snap_id, strftime(snap_date, '%m-%d') AS md FROM v_snapshot)""")
def _(d):
    return d("v_snapshot").select("snap_id", cal.season("snap_date").alias("season"))


@query("h06_weekday_workday", """
SELECT snap_id, CAST(isodow(snap_date) AS INT) AS weekday,
  CASE WHEN EXTRACT(DAY FROM snap_date) <> 1 AND isodow(snap_date) <= 5 THEN 1 ELSE 0 END AS laborable FROM v_snapshot""")
def _(d):
    df = d("v_snapshot").withColumn("festivo", (F.dayofmonth("snap_date") == 1).cast("int")).withColumn("weekday", cal.weekday("snap_date"))
    return df.select("snap_id", "weekday", cal.workday("festivo", "weekday").alias("laborable"))


@query("h07_time_parts", """
SELECT event_id, CAST(EXTRACT(YEAR FROM ts) AS INT) AS year, CAST(EXTRACT(MONTH FROM ts) AS INT) AS month,
  CAST(EXTRACT(DAY FROM ts) AS INT) AS day, CAST(substr(strftime(ts, '%H:%M:%S'), 1, 2) AS INT) AS hour FROM events""")
def _(d):
    hour = F.substring(F.date_format("ts", "HH:mm:ss"), 1, 2).cast("int")
    return d("events").select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
                              F.dayofmonth("ts").alias("day"), hour.alias("hour"))


@query("h08_build_ts", f"""
SELECT station_id, hora_dia, {ts('date_reported + hora_dia * INTERVAL 1 HOUR')} AS last_reported_local, {day('date_reported')} AS d FROM v_hourly""")
def _(d):
    y, m, dd = F.year("date_reported"), F.month("date_reported"), F.dayofmonth("date_reported")
    return d("v_hourly").select("station_id", "hora_dia", cal.ts_from_parts(y, m, dd, "hora_dia").alias("last_reported_local"),
                                cal.date_from_parts(y, m, dd).alias("d"))


@query("h09_floor_time", f"SELECT event_id, {ts('time_bucket(INTERVAL 30 MINUTE, ts)')} AS bucket FROM events")
def _(d):
    return d("events").select("event_id", cal.floor_time("ts", 1800).alias("bucket"))


@query("h10_iso_parse", f"SELECT event_id, {ts('date_trunc(' + chr(39) + 'minute' + chr(39) + ', ts)')} AS t, {day('ts')} AS fecha FROM events")
def _(d):
    df = d("events").select("event_id", cal.parse_iso(F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'")).alias("t"))
    return df.withColumn("fecha", F.to_date("t"))


@query("h11_round", "SELECT l_orderkey, l_linenumber, round(l_quantity * 1.25e0, 1) AS valor FROM lineitem")
def _(d):
    return d("lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") * 1.25, 1).alias("valor"))


@query("h12_weather_struct", """
SELECT event_id, value AS temperatura, CAST(NULL AS DOUBLE) AS precipitacion, CAST(floor(value) AS BIGINT) AS humedad, value / 2 AS viento FROM events""")
def _(d):
    df = d("events").select("event_id", F.col("value").alias("temperatura"), F.lit(None).alias("precipitacion"),
                            F.floor("value").cast("double").alias("humedad"), (F.col("value") / 2).alias("viento"))
    return joins.weather_struct(df).select("event_id", "weather.*")


EFF_SQL = """(0.5e0 + 0.5e0 * CASE WHEN b + d = 0 THEN NULL ELSE CAST(b AS DOUBLE) / (b + d) END)
  * (1 - CAST(abs(t - r) AS DOUBLE) / (t + r + 1)) * CASE WHEN b = 0 THEN 0.1e0 ELSE 1e0 END * CASE WHEN d = 0 THEN 0.1e0 ELSE 1e0 END"""
EFF_FROM = """(SELECT event_id, num_bikes_available AS b, num_docks_available AS d, hora_dia AS t,
  CAST(event_id % 7 AS INT) AS r FROM v_status)"""


def _flows(d):
    return d("v_status").select("event_id", F.col("num_bikes_available").alias("b"), F.col("num_docks_available").alias("d"),
                                F.col("hora_dia").alias("t"), (F.col("event_id") % 7).cast("int").alias("r"))


@query("h13_efficiency", f"SELECT event_id, round({EFF_SQL}, 9) AS rate FROM {EFF_FROM}")
def _(d):
    return _flows(d).select("event_id", F.round(status.efficiency("b", "d", "t", "r"), 9).alias("rate"))


@query("h14_rate_colour", f"""
SELECT event_id, CASE WHEN rate < 0.4e0 THEN 'red' WHEN rate < 0.5e0 THEN 'orange' WHEN rate < 0.6e0 THEN 'blue'
  WHEN rate IS NOT NULL THEN 'green' END AS band FROM (SELECT event_id, {EFF_SQL} AS rate FROM {EFF_FROM})""")
def _(d):
    return _flows(d).select("event_id", status.rate_band(status.efficiency("b", "d", "t", "r")).alias("band"))


@query("h15_title_case", r"""
WITH n AS (SELECT p_partkey, 'CARRER DE LA ' || p_type || ' i els ' || p_name AS s FROM part),
t AS (SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(s), '([\p{L}]+|[^\p{L}]+)', 1),
  lambda x: upper(x[1]) || x[2:]), '') AS s FROM n),
w AS (SELECT p_partkey, list_filter(regexp_split_to_array(s, '\s+'), lambda x: x <> '') AS ws FROM t)
SELECT p_partkey, array_to_string(list_transform(ws, lambda x:
  CASE WHEN lower(x) IN ('de', 'del', 'la', 'las', 'el', 'los', 'en', 'y', 'o') THEN lower(x) ELSE x END), ' ') AS title FROM w""")
def _(d):
    name = F.concat(F.lit("CARRER DE LA "), "p_type", F.lit(" i els "), "p_name")
    return d("part").select("p_partkey", text.title_es(name).alias("title"))


@query("h16_level_colour", """
SELECT event_id, CASE shops WHEN 'very_high' THEN '#6a51a3' WHEN 'high' THEN '#9e9ac8' WHEN 'medium' THEN '#cbc9e2'
  WHEN 'low' THEN '#f2f0f7' ELSE '#808080' END AS fill,
  CASE WHEN station_id = 0 THEN '255,0,0' WHEN station_id = 24 THEN '34,139,34' WHEN station_id > 24 THEN '255,255,255' ELSE 'other' END AS rgb
FROM (SELECT event_id, station_id, CASE WHEN num_docks_available < 3 THEN 'low' WHEN num_docks_available < 5 THEN 'medium'
  WHEN num_docks_available < 7 THEN 'high' WHEN num_docks_available < 8 THEN 'very_high' END AS shops FROM v_status)""")
def _(d):
    n = F.col("num_docks_available")
    level = F.when(n < 3, "low").when(n < 5, "medium").when(n < 7, "high").when(n < 8, "very_high")
    rgb = F.array_join(text.truck_colour("station_id").cast("array<string>"), ",")
    known = (F.col("station_id") == 0) | (F.col("station_id") >= 24)
    return d("v_status").select("event_id", text.level_colour(level).alias("fill"), F.when(known, rgb).otherwise("other").alias("rgb"))


@query("h17_format_number", """
SELECT o_orderkey, CASE WHEN cents >= 100000000 THEN (cents // 100000000) || '.' || lpad(CAST((cents // 100000) % 1000 AS VARCHAR), 3, '0')
    WHEN cents >= 100000 THEN CAST(cents // 100000 AS VARCHAR) ELSE '' END
  || CASE WHEN cents >= 100000 THEN '.' || lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0') ELSE CAST(cents // 100 AS VARCHAR) END
  || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS txt
FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)""")
def _(d):
    return d("orders").select("o_orderkey", text.format_es("o_totalprice").alias("txt"))


@query("h18_total_movement", f"""
SELECT station_id, {day('date_reported')} AS date_reported, hora_dia, total_bikes_taken + total_bikes_returned AS rotacion FROM v_hourly""")
def _(d):
    return d("v_hourly").select("station_id", "date_reported", "hora_dia", status.rotation().alias("rotacion"))


@query("h19_impute_when_null", "SELECT snap_id, COALESCE(capacity, station_id % 9) AS capacity, COALESCE(address, 'day ' || EXTRACT(DAY FROM snap_date)) AS address FROM v_snapshot")
def _(d):
    out = clean.fill_expr(d("v_snapshot"), {
        "capacity": F.col("station_id") % 9,
        "address": F.concat(F.lit("day "), F.dayofmonth("snap_date").cast("string"))})
    return out.select("snap_id", "capacity", "address")


@query("h20_json_decode", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS INT) END AS k, -1 AS missing FROM events""")
def _(d):
    from pyspark.sql import types as T

    from docksense.catalog.a_sources import _messages
    from docksense.sources.landing import decode

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("missing", T.IntegerType())])
    return decode(_messages(d), "value", schema, {"missing": -1})


HAV_SQL = """2 * 6371000e0 * asin(sqrt(least(1e0, pow(sin(radians({b} - {a}) / 2), 2)
  + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({q} - {p}) / 2), 2))))"""


@query("h21_haversine", f"SELECT poi_id, round({HAV_SQL.format(a='lat', b='41.3874e0', p='lon', q='2.1686e0')}, 4) AS metres FROM v_poi")
def _(d):
    return d("v_poi").select("poi_id", F.round(geo.haversine("lon", "lat", F.lit(2.1686), F.lit(41.3874)), 4).alias("metres"))


def number_sql(v: float) -> str:
    """A DOUBLE literal; without an exponent it would be a decimal."""
    return f"{v!r}e0" if "e" not in repr(v) else repr(v)


def degrees_sql(source: str) -> str:
    """``source`` with ``lon`` and ``lat`` next to its UTM 31N ``x`` and ``y``."""
    r = number_sql(0.9996 * geo._RECT)
    b1, b2, b3 = map(number_sql, geo._BETA)
    d1, d2, d3 = map(number_sql, geo._DELTA)
    return f"""(SELECT * EXCLUDE (xi, eta, xi1, eta1, chi), 3 + degrees(atan2(sinh(eta1), cos(xi1))) AS lon,
  degrees(chi + {d1} * sin(2 * chi) + {d2} * sin(4 * chi) + {d3} * sin(6 * chi)) AS lat
  FROM (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM (SELECT *,
    xi - {b1} * sin(2 * xi) * cosh(2 * eta) - {b2} * sin(4 * xi) * cosh(4 * eta) - {b3} * sin(6 * xi) * cosh(6 * eta) AS xi1,
    eta - {b1} * cos(2 * xi) * sinh(2 * eta) - {b2} * cos(4 * xi) * sinh(4 * eta) - {b3} * cos(6 * xi) * sinh(6 * eta) AS eta1
  FROM (SELECT *, y / {r} AS xi, (x - 500000) / {r} AS eta FROM {source}))))"""


def utm_sql(source: str) -> str:
    """``source`` with UTM 31N ``x`` and ``y`` next to its ``lon`` and ``lat``."""
    n = geo._N
    a1, a2, a3 = map(number_sql, geo._ALPHA)
    k = f"{2 * n ** 0.5 / (1 + n)!r}e0"
    r = f"{0.9996 * geo._RECT!r}e0"
    return f"""(SELECT * EXCLUDE (sp, t, xi, eta),
  500000 + {r} * (eta + {a1} * cos(2 * xi) * sinh(2 * eta) + {a2} * cos(4 * xi) * sinh(4 * eta) + {a3} * cos(6 * xi) * sinh(6 * eta)) AS x,
  {r} * (xi + {a1} * sin(2 * xi) * cosh(2 * eta) + {a2} * sin(4 * xi) * cosh(4 * eta) + {a3} * sin(6 * xi) * cosh(6 * eta)) AS y
  FROM (SELECT *, atan2(t, cos(radians(lon) - radians(3e0))) AS xi, atanh(sin(radians(lon) - radians(3e0)) / sqrt(1 + t * t)) AS eta
  FROM (SELECT *, sinh(atanh(sp) - {k} * atanh({k} * sp)) AS t FROM (SELECT *, sin(radians(lat)) AS sp FROM {source}))))"""


@query("h22_project_utm", f"""
SELECT poi_id, round(x, 3) AS x, round(y, 3) AS y, round(lon, 5) AS lon, round(lat, 5) AS lat FROM {utm_sql('v_poi')}""")
def _(d):
    x, y = geo.to_utm31("lon", "lat")
    df = d("v_poi").select("poi_id", x.alias("x"), y.alias("y"))
    lon, lat = geo.from_utm31("x", "y")
    return df.select("poi_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"),
                     F.round(lon, 5).alias("lon"), F.round(lat, 5).alias("lat"))


@query("h23_geometry_json", """
SELECT poi_id, '{"type":"Point","coordinates":[' || (poi_id / 4.0e0) || ',' || (poi_id % 90 + 0.5e0) || ']}' AS doc,
  poi_id / 4.0e0 AS x, poi_id % 90 + 0.5e0 AS y FROM v_poi
UNION ALL SELECT area_id, '{"type":"Polygon","coordinates":[[[' || a || ',0.0],[' || b || ',0.0],[' || b || ',1.0],[' || a || ',1.0],['
  || a || ',0.0]]]}', a, 0 FROM (SELECT -1 - area_id AS area_id, area_id * 1e0 AS a, area_id + 1e0 AS b FROM v_area_wkt)
UNION ALL SELECT area_id, CASE kind WHEN 2 THEN '{"type":"LineString","coordinates":[[' || n || ',0.0],[' || (n + 1) || ',2.0]]}'
  WHEN 3 THEN '{"type":"MultiLineString","coordinates":[[[' || n || ',0.0],[' || n || ',1.0]],[[' || (n + 2) || ',0.0],['
    || (n + 2) || ',1.0],[' || (n + 3) || ',1.0]]]}'
  ELSE '{"type":"MultiPolygon","coordinates":[[[[' || n || ',0.0],[' || (n + 9) || ',0.0],[' || (n + 9) || ',9.0],[' || n
    || ',0.0]],[[' || (n + 6) || ',1.0],[' || (n + 7) || ',1.0],[' || (n + 7) || ',2.0],[' || (n + 6) || ',1.0]]],[[['
    || (n + 20) || ',0.0],[' || (n + 21) || ',0.0],[' || (n + 21) || ',1.0],[' || (n + 20) || ',0.0]]]]}' END, n, 0
FROM (SELECT -1 - (lane_id + kind * 1000000) AS area_id, kind, lane_id * 1e0 AS n FROM v_lane, (SELECT unnest([2, 3, 4]) AS kind))""")
def _(d):
    from docksense.catalog.b_cleaning import line_texts

    point = geom.from_pair(F.array(F.col("poi_id") / 4.0, F.col("poi_id") % 90 + 0.5))
    points = d("v_poi").select("poi_id", point.alias("geometry"))
    rest = geom.parse_geometry(d("v_area_wkt").union(line_texts(d))).select((-1 - F.col("area_id")).alias("poi_id"), "geometry")
    docs = points.union(rest).select("poi_id", geom.geometry_json("geometry").alias("doc"))
    # and back again
    p = F.get(F.get(geom.parse_geojson("doc").rings, F.lit(0)), F.lit(0))
    return docs.select("poi_id", "doc", p.x.alias("x"), p.y.alias("y"))


@query("h24_similarity", "SELECT event_id, round(CASE WHEN value = 0 THEN NULL ELSE 1 / value END, 9) AS similarity_score FROM events")
def _(d):
    return d("events").select("event_id", F.round(similarity("value"), 9).alias("similarity_score"))
