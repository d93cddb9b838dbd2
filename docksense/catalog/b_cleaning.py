"""Projections, filters, typing and cleaning."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query, ts
from docksense.functions import calendar as cal
from docksense.functions import geo
from docksense.functions import geometry as geom
from docksense.operators import aggs, clean
from docksense.sources import landing


@query("b01_select_alias", "SELECT event_id, num_bikes_available AS num_mechanical_available, status AS state FROM v_status")
def _(d):
    raw = d("v_status").withColumnRenamed("num_bikes_available", "num_bikes_available_types.mechanical")
    return clean.select_as(raw, {
        "event_id": "event_id", "num_mechanical_available": "num_bikes_available_types.mechanical", "state": "status"})


@query("b02_epoch_to_ts", f"SELECT event_id, {ts('date_trunc(' + chr(39) + 'second' + chr(39) + ', ts)')} AS last_reported_gmt FROM events")
def _(d):
    raw = d("events").select("event_id", cal.to_epoch("ts").alias("last_reported"))
    return clean.epoch_to_ts(raw, "last_reported", "last_reported_gmt").drop("last_reported")


@query("b03_utc_to_local", """
WITH r AS (SELECT o_orderkey, o_orderdate + INTERVAL 30 MINUTE AS t FROM orders)
SELECT o_orderkey, strftime(timezone('Europe/Madrid', timezone('UTC', t)), '%Y-%m-%d %H:%M:%S.%f') AS r_local,
  strftime(timezone('Europe/Madrid', timezone('UTC', t)), '%Y-%m-%d') AS date_r,
  strftime(timezone('Europe/Madrid', timezone('UTC', t)), '%H:%M:%S') AS hour_r FROM r""")
def _(d):
    raw = d("orders").select("o_orderkey", F.timestamp_add("MINUTE", F.lit(30), F.col("o_orderdate")).alias("t"))
    return clean.add_local_time(raw, {"t": "r"}).drop("t")


HOURLY_SQL = f"""
SELECT station_id, {day('date_reported')} AS date_reported, hora_dia, total_bikes_taken, total_bikes_returned,
  CAST(total_bikes_taken AS DOUBLE) AS temperatura FROM v_hourly"""


@query("b04_explode_struct", HOURLY_SQL)
def _(d):
    weather = F.struct(F.col("total_bikes_taken").cast("double").alias("temperatura")).alias("weather")
    docs = aggs.nest_hours(d("v_hourly").withColumn("weather", weather), ["station_id", "date_reported"],
                           ["hora_dia", "total_bikes_taken", "total_bikes_returned", "weather"])
    return clean.explode_status(docs)


@query("b05_feature_flatten", "SELECT name, category AS stop_description, lon, lat FROM v_poi")
def _(d):
    feature = F.struct(
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(F.col("name").alias("NOM_PARADA"), F.col("category").alias("DESC_PARADA")).alias("properties"))
    docs = d("v_poi").select(F.array(feature).alias("features"))
    rows = landing.flatten_features(docs, landing.LAYERS["bus_stops"], ["name", "geometry"])
    xy = F.col("geometry.coordinates")
    return rows.select("name", "stop_description", F.get(xy, F.lit(0)).alias("lon"), F.get(xy, F.lit(1)).alias("lat"))


@query("b06_latlon_to_wkt", """
SELECT poi_id, 'POINT(' || printf('%.5f', lon) || ' ' || printf('%.5f', lat) || ')' AS geometry FROM v_poi""")
def _(d):
    text = d("v_poi").select("poi_id", F.format_string("%.5f", "lon").alias("lon"), F.format_string("%.5f", "lat").alias("lat"))
    return text.select("poi_id", geo.wkt_point("lon", "lat").alias("geometry"))


@query("b07_require_fields", "SELECT snap_id, address, capacity FROM v_snapshot WHERE address IS NOT NULL AND capacity IS NOT NULL")
def _(d):
    return clean.require(d("v_snapshot"), ["address", "capacity"]).select("snap_id", "address", "capacity")


@query("b08_layer_rename", "SELECT area_id, geometry FROM v_area_wkt")
def _(d):
    raw = d("v_area_wkt").select("area_id", F.col("geometry").alias("geometria_wgs84"), F.lit("").alias("geometria_etrs89"),
                                 F.col("area_id").cast("string").alias("nom_barri"))
    layer = clean.area_layer(raw, "nom_barri", "geometria_wgs84", ["geometria_etrs89"])
    return layer.select("area_id", "geometry")


@query("b09_type_normalise", f"""
SELECT snap_id, TRY_CAST(CASE WHEN address IS NULL THEN NULL ELSE substr(address, 1, CAST(snap_id % 3 AS INT)) END AS INT) AS code,
  {day('snap_date')} AS d, CASE WHEN snap_id % 3 = 1 THEN TRY_CAST(substr(address, 1, 1) AS INT) END AS first_n
FROM v_snapshot""")
def _(d):
    text = F.expr("substr(address, 1, CAST(snap_id % 3 AS INT))")
    raw = d("v_snapshot").select(
        "snap_id", text.alias("code"), F.date_format("snap_date", "yyyy-MM-dd").alias("d"),
        F.array(F.struct(text.alias("n"))).alias("status"))
    out = clean.normalise_types(raw, {"code": "int", "d": "date"}, {"status": {"n": "int"}})
    return out.select("snap_id", "code", "d", F.get("status", F.lit(0))["n"].alias("first_n"))


@query("b10_drop_null_rows", f"""
SELECT snap_id, station_id, {day('snap_date')} AS snap_date, address, capacity FROM v_snapshot
WHERE address IS NOT NULL AND capacity IS NOT NULL""")
def _(d):
    return clean.drop_null_rows(d("v_snapshot"))


@query("b11_fill_constant", "SELECT snap_id, COALESCE(address, '?') AS address, COALESCE(capacity, 0) AS capacity FROM v_snapshot")
def _(d):
    return clean.fill_constant(d("v_snapshot"), {"address": "?", "capacity": 0}).select("snap_id", "address", "capacity")


@query("b12_distinct", f"SELECT DISTINCT station_id, {day('date_reported')} AS date_reported, status FROM v_status")
def _(d):
    return clean.dedupe(d("v_status").select("station_id", "date_reported", "status"))


@query("b13_dedupe_by_key", f"""
SELECT station_id, {day('snap_date')} AS snap_date, snap_id, address, capacity FROM v_snapshot
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id, snap_date ORDER BY snap_id) = 1""")
def _(d):
    return clean.dedupe_by(d("v_snapshot"), ["station_id", "snap_date"], ["snap_id"])


@query("b14_pad_code", "SELECT station_id, '0' || CAST(8000 + truck AS VARCHAR) AS post_code FROM v_station")
def _(d):
    return clean.pad_post_code(d("v_station").select("station_id", (F.col("truck") + 8000).alias("post_code")))


@query("b15_geo_point", "SELECT station_id, 'Point' AS kind, lon AS x, lat AS y, CAST(capacity AS DOUBLE) AS z FROM v_station")
def _(d):
    p = d("v_station").select("station_id", geo.geo_point("lon", "lat", "capacity").alias("g"))
    xyz = {n: F.get("g.coordinates", F.lit(i)).alias(n) for i, n in enumerate("xyz")}
    return p.select("station_id", F.col("g.type").alias("kind"), *xyz.values())


@query("b16_date_range_split", f"""
SELECT CASE WHEN date_reported <= DATE '2024-01-20' THEN 'train' ELSE 'test' END AS part, station_id,
  {day('date_reported')} AS date_reported, hora_dia FROM v_hourly
WHERE date_reported BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' OR date_reported BETWEEN DATE '2024-01-22' AND DATE '2024-01-30'""")
def _(d):
    train, test = clean.split_by_date(d("v_hourly"), "date_reported", ("2024-01-01", "2024-01-20"), ("2024-01-22", "2024-01-30"))
    cols = ["station_id", "date_reported", "hora_dia"]
    return train.select(F.lit("train").alias("part"), *cols).union(test.select(F.lit("test").alias("part"), *cols))


@query("b17_datetime_range", f"""
SELECT event_id, {ts('last_reported_local')} AS last_reported_local FROM v_status
WHERE last_reported_local BETWEEN TIMESTAMP '2024-01-05 06:30:00' AND TIMESTAMP '2024-01-19 18:00:00'""")
def _(d):
    df = clean.between_times(d("v_status"), "last_reported_local", "2024-01-05 06:30:00", "2024-01-19 18:00:00")
    return df.select("event_id", "last_reported_local")


@query("b18_holiday_select", f"""
SELECT DISTINCT CAST(EXTRACT(YEAR FROM snap_date) AS INT) AS "any", {day('snap_date')} AS data FROM v_snapshot
WHERE EXTRACT(YEAR FROM snap_date) BETWEEN 1996 AND 2024
UNION SELECT DISTINCT CAST(EXTRACT(YEAR FROM date_reported) AS INT), {day('date_reported')} FROM v_status
WHERE status = 'purchase' AND hora_dia = 7""")
def _(d):
    general = d("v_snapshot").select(F.year("snap_date").cast("string").alias("any"), F.col("snap_date").alias("data"))
    local = d("v_status").select(
        F.year("date_reported").cast("string").alias("any_calendari"), F.col("date_reported").alias("data"),
        F.col("status").alias("ajuntament_o_nucli_municipal"), F.col("hora_dia").cast("string").alias("festiu"))
    return clean.holiday_calendar(general, local, (1996, 2024), "purchase", "7")


LIFE_SQL = "SELECT station_id, MIN(snap_date) AS c, MAX(snap_date) AS e FROM v_snapshot GROUP BY 1"


@query("b19_service_filter", f"""
SELECT station_id, {day('c')} AS creation_date, {day('e')} AS end_date FROM ({LIFE_SQL})
WHERE e >= DATE '1998-07-31' OR date_diff('day', c, e) > 1500""")
def _(d):
    return clean.in_service(aggs.lifespan(d("v_snapshot"), "snap_date"), "1998-07-31", 1500)


LEVEL_SQL = """CASE WHEN {c} < 3 THEN 'low' WHEN {c} < 5 THEN 'medium' WHEN {c} < 7 THEN 'high' WHEN {c} < 8 THEN 'very_high' END"""


def _levels(d):
    def level(c):
        c = F.col(c)
        return F.when(c < 3, "low").when(c < 5, "medium").when(c < 7, "high").when(c < 8, "very_high")

    return d("v_status").select("event_id", level("num_docks_available").alias("shops"), level("hora_dia").alias("schools"))


@query("b20_min_level_filter", f"""
SELECT * FROM (SELECT event_id, {LEVEL_SQL.format(c='num_docks_available')} AS shops, {LEVEL_SQL.format(c='hora_dia')} AS schools FROM v_status)
WHERE shops IN ('medium', 'high', 'very_high') AND schools IN ('high', 'very_high')""")
def _(d):
    return clean.min_levels(_levels(d), {"shops": 2, "schools": 3})


@query("b21_array_contains", "SELECT event_id, station_id FROM v_status WHERE num_docks_available = 0")
def _(d):
    bikes = F.when(F.col("num_bikes_available") == 0, "No Bikes")
    docks = F.when(F.col("num_docks_available") == 0, "No Docks")
    df = d("v_status").withColumn("reason", F.array_compact(F.array(bikes, docks)))
    return clean.with_reason(df, "No Docks").select("event_id", "station_id")


@query("b22_flatten_class", f"""
SELECT event_id, COALESCE({LEVEL_SQL.format(c='num_docks_available')}, 'unknown') AS shops_class,
  CASE WHEN num_docks_available < 8 THEN num_docks_available ELSE 0 END AS shops_count FROM v_status""")
def _(d):
    df = _levels(d).join(d("v_status").select("event_id", "num_docks_available"), "event_id")
    value = F.when(F.col("shops").isNotNull(), F.struct(F.col("shops").alias("classification"), F.col("num_docks_available").alias("count")))
    return clean.flatten_class(df.select("event_id", value.alias("shops")), ["shops"])


@query("b23_existing_columns", "SELECT station_id, name FROM v_station")
def _(d):
    return clean.select_existing(d("v_station"), ["station_id", "metro_line", "name"])


def line_texts(d):
    """Lines, lines of two parts (WKT) and polygons of two parts, one with a hole (GeoJSON), beside each lane's number."""
    n = F.col("lane_id")
    line = F.format_string("LINESTRING (%d 0, %d 2)", n, n + 1)
    lines = F.format_string("MultiLineString((%d 0,%d 1), ( %d 0, %d 1, %d 1 ))", n, n, n + 2, n + 2, n + 3)
    polygons = F.format_string(
        '{"type":"MultiPolygon","coordinates":[[[[%d,0],[%d,0],[%d,9],[%d,0]],[[%d,1],[%d,1],[%d,2],[%d,1]]],'
        '[[[%d,0],[%d,0],[%d,1],[%d,0]]]]}', *[n + i for i in (0, 9, 9, 0, 6, 7, 7, 6, 20, 21, 21, 20)])
    texts = F.array(*[F.struct((n + 1000000 * i).alias("area_id"), t.alias("geometry"))
                      for i, t in enumerate((line, lines, polygons), 2)])
    return d("v_lane").select(F.inline(texts))


@query("b24_geometry_parse", """
WITH p AS (SELECT area_id, string_split(regexp_extract(geometry, '\\(\\((.*)\\)\\)', 1), ', ') AS pts FROM v_area_wkt),
v AS (SELECT area_id, unnest(pts) AS pt FROM p)
SELECT area_id, 'POLYGON' AS kind, COUNT(*) AS points, SUM(CAST(split_part(pt, ' ', 1) AS DOUBLE)) AS sum_x,
  SUM(CAST(split_part(pt, ' ', 2) AS DOUBLE)) AS sum_y FROM v GROUP BY 1
UNION ALL SELECT poi_id + 1000000, 'POINT', 1, round(lon, 5), round(lat, 5) FROM v_poi
UNION ALL SELECT lane_id + 2000000, 'LINESTRING', 2, 2 * lane_id + 1, 2 FROM v_lane
UNION ALL SELECT lane_id + 3000000, 'MULTILINESTRING', 5, 5 * lane_id + 7, 3 FROM v_lane
UNION ALL SELECT lane_id + 4000000, 'MULTIPOLYGON', 12, 12 * lane_id + 126, 15 FROM v_lane""")
def _(d):
    broken = d("v_lane").select((-F.col("lane_id") - 1).alias("area_id"), F.lit("POLYGON ((0 0, 1").alias("geometry"))
    text = F.concat(F.lit("POINT("), F.format_string("%.5f", "lon"), F.lit(" "), F.format_string("%.5f", "lat"), F.lit(")"))
    points = d("v_poi").select((F.col("poi_id") + 1000000).alias("area_id"), text.alias("geometry"))
    df = geom.parse_geometry(d("v_area_wkt").union(broken).union(points).union(line_texts(d)))
    pts = F.flatten("geometry.rings")

    def total(field):
        return F.aggregate(pts, F.lit(0.0), lambda a, p: a + p[field])

    return df.select("area_id", "geometry.kind", F.size(pts).cast("bigint").alias("points"),
                     total("x").alias("sum_x"), total("y").alias("sum_y"))


@query("b25_lookup_by_name", "SELECT area_id, name FROM v_area WHERE name = 'NATION_7'")
def _(d):
    return clean.area_named(d("v_area"), "NATION_7").select("area_id", "name")


@query("b26_drop_noise", "SELECT station_id, truck AS cluster FROM v_station WHERE capacity > 0")
def _(d):
    df = d("v_station").select("station_id", F.when(F.col("capacity") == 0, -1).otherwise(F.col("truck")).alias("cluster"))
    return clean.drop_noise(df)


@query("b27_distance_filters", """
SELECT event_id, value * 4 AS dist_bike_station, value AS dist_bike_lanes FROM events WHERE value * 4 > 200 AND value < 60""")
def _(d):
    df = d("events").select("event_id", (F.col("value") * 4).alias("dist_bike_station"), F.col("value").alias("dist_bike_lanes"))
    return clean.site_filters(df)


@query("b28_array_size_filter", f"""
SELECT station_id, {day('date_reported')} AS date_reported, COUNT(*) AS hours FROM v_hourly GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(d):
    docs = aggs.nest_hours(d("v_hourly"), ["station_id", "date_reported"], ["hora_dia"])
    return clean.min_entries(docs, "status").select("station_id", "date_reported", F.size("status").cast("bigint").alias("hours"))


@query("b29_default_flag", """
SELECT s.station_id, CASE WHEN t.station_id IS NULL THEN 'No' ELSE 'Yes' END AS Is_popular FROM v_station s LEFT JOIN
  (SELECT station_id FROM v_status GROUP BY 1 ORDER BY COUNT(*) DESC, station_id LIMIT 10) t ON s.station_id = t.station_id""")
def _(d):
    top = aggs.top_k(d("v_status").groupBy("station_id").agg(F.count("*").alias("n")), "n", 10, "station_id")
    return clean.flag_popular(d("v_station"), top).select("station_id", "Is_popular")
