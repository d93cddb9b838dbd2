"""Zones, regression, scaling, clusters, sites, tours and the demand table."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query, ts
from docksense.catalog.c_joins import CALENDAR_SQL, HAV_SQL, KNN, PLANE, UTC_BUCKET, WIDE_SQL, areas, features, plane, state, weather_series
from docksense.catalog.d_aggregates import documents, rotation_sql, shortage_sql
from docksense.catalog.h_scalars import degrees_sql, utm_sql
from docksense.catalog.i_streaming import TOUR
from docksense.functions import calendar as cal
from docksense.functions import geometry as geom
from docksense.operators import aggs, clean, density, joins, ml, routes, spatial
from docksense.plans import demand, expansion
from docksense.session import cut_lineage
from docksense.sources import readers


@query("j01_kmeans_zones")
def _(d):
    return ml.cluster_stations(d("v_station").select("station_id", "lat", "lon")).select("station_id", "truck")


@query("j01_zones_check", """
SELECT station_id, 0e0 AS gap, least(25, COUNT(*) OVER ()) AS zones FROM v_station""")
def _(d):
    # every station lies in the zone of its closest centre, and no zone is empty
    stations = d("v_station").select("station_id", "lat", "lon")
    out = cut_lineage(ml.zone_gaps(ml.fit_zones(stations), stations))
    zones = out.agg(F.count_distinct("truck")).scalar()
    return out.select("station_id", (F.round("gap", 9) + 0.0).alias("gap"), zones.alias("zones"))


@query("j02_truck_dim", """
SELECT CAST(n_nationkey AS INT) AS truck_id, 30 AS capacity, COUNT(station_id) AS stations FROM nation LEFT JOIN v_station ON truck = n_nationkey GROUP BY 1""")
def _(d):
    trucks = ml.truck_table(d.spark, d("nation").count())
    served = joins.serves_edges(trucks, d("v_station")).groupBy(F.col("src").alias("truck_id")).agg(F.count("*").alias("stations"))
    return trucks.join(served, "truck_id", "left").withColumn("stations", F.coalesce("stations", F.lit(0).cast("bigint")))


def demand_table(d):
    return demand.demand_dataset(d("v_status"), d("v_station"), d("v_holiday"), weather_series(d))


def prepared(d):
    # the series has no wind readings, which leaves nothing to average
    return clean.fill_constant(demand.preprocess(demand_table(d), None, None, "2024-01-25", 20), {"viento": 0.0})


def train_test(d):
    # all readings of the table: its first days train, the others are held out
    dated = prepared(d).withColumn("date_reported", F.make_date("year", "month", "day"))
    numbers = [F.col(c).cast("double").alias(c) for c in ml.NUMERIC]
    dated = cut_lineage(dated.select("station_id", "date_reported", "hora_dia", "season", *numbers, ml.LABEL))
    return ml.split_days(dated, "date_reported")


@query("j03_demand_regression")
def _(d):
    train, test = train_test(d)
    out = ml.fit_demand(train).transform(test)
    return out.select("station_id", "date_reported", "hora_dia", ml.LABEL, F.round("prediction", 4).alias("prediction"))


@query("j04_grid_search_cv")
def _(d):
    train, test = train_test(d)
    return ml.grid_scores(ml.tune(train), test)


@query("j05_regression_metrics", """
SELECT round(sqrt(avg(pow(l_quantity - p, 2))), 6) AS rmse, round(1 - SUM(pow(l_quantity - p, 2)) / (COUNT(*) * var_pop(l_quantity)), 6) AS r2
FROM (SELECT l_quantity, l_extendedprice / 1500 AS p FROM lineitem)""")
def _(d):
    out = aggs.regression_metrics(d("lineitem").withColumn("p", F.col("l_extendedprice") / 1500), "l_quantity", "p")
    return out.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("j06_scale_fit_apply", f"""
WITH e AS (SELECT vec_id, label, {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS {f}' for i, f in enumerate(KNN))} FROM embeddings),
s AS (SELECT {', '.join(f'avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}' for f in KNN)} FROM e WHERE label = 3)
SELECT vec_id, {', '.join(f'round(({f} - m_{f}) / s_{f}, 6) AS {f}' for f in KNN)} FROM e, s""")
def _(d):
    f = features(d)
    out = spatial.scale_like(f.filter(F.col("label") == 3), f, KNN)
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in KNN])


def plane_areas(d):
    box = [(F.col("xmin") * 83000), (F.col("ymin") * 111000), (F.col("xmax") * 83000), (F.col("ymax") * 111000)]
    return d("v_area").select("area_id", "name", geom.rectangle(*box).alias("geometry"))


@query("j07_candidate_grid", """
WITH b AS (SELECT MIN(xmin) * 83000 AS x0, MIN(ymin) * 111000 AS y0, MAX(xmax) * 83000 AS x1, MAX(ymax) * 111000 AS y1 FROM v_area),
n AS (SELECT *, CAST(ceil((x1 - x0) / 10) AS BIGINT) AS nx, CAST(ceil((y1 - y0) / 10) AS BIGINT) AS ny FROM b)
SELECT j * nx + i AS point_id, round(x0 + i * 10, 4) AS x, round(y0 + j * 10, 4) AS y
FROM n, (SELECT unnest(range(2000)) AS i), (SELECT unnest(range(2000)) AS j) WHERE i < nx AND j < ny""")
def _(d):
    box = aggs.total_bounds(plane_areas(d)).first()
    grid = spatial.candidate_grid(d.spark, (box["xmin"], box["ymin"], box["xmax"], box["ymax"]), 10.0)
    return grid.select("point_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def poi_points(d):
    return plane(d("v_poi")).select(F.col("poi_id").cast("bigint").alias("point_id"), "x", "y")


@query("j08_dbscan", f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT CAST(poi_id AS BIGINT) AS id, x, y FROM {PLANE.format(v='v_poi')}),
n AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON b.x BETWEEN a.x - 400 AND a.x + 400 AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 400),
core AS MATERIALIZED (SELECT a AS id FROM n GROUP BY 1 HAVING COUNT(*) >= 4),
e AS MATERIALIZED (SELECT a, b FROM n WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
named AS (SELECT a AS id, MIN(b) AS cluster FROM reach GROUP BY 1),
border AS (SELECT n.a AS id, MIN(m.cluster) AS cluster FROM n JOIN named m ON m.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY 1)
SELECT p.id AS point_id, COALESCE(m.cluster, b.cluster, -1) AS cluster FROM p LEFT JOIN named m ON m.id = p.id LEFT JOIN border b ON b.id = p.id""")
def _(d):
    return density.dbscan(poi_points(d), 400.0, 4).select("point_id", "cluster")


@query("j09_dbscan_sweep", f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT CAST(poi_id AS BIGINT) AS id, x, y FROM {PLANE.format(v='v_poi')}),
pairs AS MATERIALIZED (SELECT a.id AS a, b.id AS b, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d
  FROM p a JOIN p b ON b.x BETWEEN a.x - 500 AND a.x + 500 AND b.y BETWEEN a.y - 500 AND a.y + 500),
settings AS (SELECT CAST(e AS DOUBLE) AS eps, CAST(m AS INT) AS m FROM range(100, 501, 100) AS r(e), range(2, 6) AS q(m)),
near AS MATERIALIZED (SELECT eps, m, a, b FROM settings JOIN pairs ON d <= eps),
core AS MATERIALIZED (SELECT eps, m, a AS id FROM near GROUP BY ALL HAVING COUNT(*) >= m),
edges AS MATERIALIZED (SELECT near.* FROM near JOIN core x ON x.eps = near.eps AND x.m = near.m AND x.id = a
  JOIN core y ON y.eps = near.eps AND y.m = near.m AND y.id = b),
named(eps, m, id, cluster) USING KEY (eps, m, id) AS (
  SELECT eps, m, id, id FROM core
  UNION
  SELECT e.eps, e.m, e.b, MIN(n.cluster) FROM named n JOIN edges e ON e.eps = n.eps AND e.m = n.m AND e.a = n.id
  JOIN recurring.named o ON o.eps = e.eps AND o.m = e.m AND o.id = e.b WHERE n.cluster < o.cluster GROUP BY 1, 2, 3),
found AS (SELECT eps, m, COUNT(DISTINCT cluster) AS clusters FROM named GROUP BY 1, 2),
inside AS (SELECT near.eps, near.m, COUNT(DISTINCT a) AS n FROM near JOIN core ON core.eps = near.eps AND core.m = near.m AND core.id = b GROUP BY 1, 2)
SELECT s.eps, s.m AS min_samples, COALESCE(clusters, 0) AS clusters, total - COALESCE(n, 0) AS noise,
  COALESCE(clusters, 0) - (total - COALESCE(n, 0)) / total AS score
FROM settings s LEFT JOIN found USING (eps, m) LEFT JOIN inside USING (eps, m), (SELECT COUNT(*) AS total FROM p)""")
def _(d):
    return density.tune_dbscan(poi_points(d), [100.0, 200.0, 300.0, 400.0, 500.0], [2, 3, 4, 5]).select("eps", "min_samples", "clusters", "noise", "score")


POPULAR_SQL = f"""SELECT DISTINCT station_id FROM (SELECT station_id FROM ({shortage_sql('num_bikes_available')})
  UNION ALL SELECT station_id FROM ({shortage_sql('num_docks_available')}) UNION ALL SELECT station_id FROM ({rotation_sql(24)}))"""
LAYER_CUTS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6"]
LAYER_SQL = "SELECT kind, id, {cols} FROM near JOIN poi ON TRUE GROUP BY 1, 2".format(cols=", ".join(
    f"MIN(sqrt(pow(near.x - poi.x, 2) + pow(near.y - poi.y, 2))) FILTER (category >= '{lo}' AND category < '{hi}') AS {c}"
    for c, lo, hi in zip(expansion.POINT_LAYERS, LAYER_CUTS, LAYER_CUTS[1:])))


def corner_sql(lon: str, lat: str, name: str) -> str:
    return utm_sql(f"(SELECT area_id, '{name}' AS corner, {lon} AS lon, {lat} AS lat FROM v_area)")


#: Every step by its definition: all pairs of points and objects, all pairs of the best places for each setting.
SITES_SQL = f"""WITH RECURSIVE st AS MATERIALIZED (SELECT station_id, x, y FROM {utm_sql('v_station')}),
corner AS MATERIALIZED (SELECT * FROM {corner_sql('xmin', 'ymin', 'a')} UNION ALL SELECT * FROM {corner_sql('xmax', 'ymin', 'b')}
  UNION ALL SELECT * FROM {corner_sql('xmax', 'ymax', 'c')} UNION ALL SELECT * FROM {corner_sql('xmin', 'ymax', 'd')}),
quad AS MATERIALIZED (SELECT area_id, {', '.join(f"MAX({v}) FILTER (corner = '{c}') AS {v}{c}" for c in 'abcd' for v in 'xy')} FROM corner GROUP BY 1),
box AS (SELECT MIN(x) AS x0, MIN(y) AS y0, CAST(ceil((MAX(x) - MIN(x)) / 10) AS BIGINT) AS nx, CAST(ceil((MAX(y) - MIN(y)) / 10) AS BIGINT) AS ny FROM corner),
grid AS MATERIALIZED (SELECT j * nx + i AS id, x0 + i * 10 AS x, y0 + j * 10 AS y
  FROM box, (SELECT unnest(range(3000)) AS i), (SELECT unnest(range(3000)) AS j) WHERE i < nx AND j < ny),
seg AS MATERIALIZED (SELECT p.x AS x1, p.y AS y1, q.x - p.x AS dx, q.y - p.y AS dy
  FROM {utm_sql('(SELECT lane_id, x1 AS lon, y1 AS lat FROM v_lane)')} p JOIN {utm_sql('(SELECT lane_id, x2 AS lon, y2 AS lat FROM v_lane)')} q USING (lane_id)),
pop AS MATERIALIZED (SELECT station_id, x, y FROM st WHERE station_id IN ({POPULAR_SQL})),
place AS MATERIALIZED (SELECT 'site' AS kind, id, x, y FROM grid UNION ALL SELECT 'popular', CAST(station_id AS BIGINT), x, y FROM pop),
lane AS MATERIALIZED (SELECT kind, id, x, y, MIN(sqrt(pow(x - x1 - f * dx, 2) + pow(y - y1 - f * dy, 2))) AS dist_bike_lanes
  FROM (SELECT *, greatest(0e0, least(1e0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) AS f FROM place, seg) GROUP BY ALL),
inside AS MATERIALIZED (SELECT DISTINCT l.* FROM lane l JOIN quad q ON TRUE WHERE kind = 'site' AND dist_bike_lanes < 60
  AND {' AND '.join(f'(x{q} - x{p}) * (y - y{p}) > (y{q} - y{p}) * (x - x{p})' for p, q in ('ab', 'bc', 'cd', 'da'))}),
near AS MATERIALIZED (SELECT i.*, MIN(sqrt(pow(i.x - st.x, 2) + pow(i.y - st.y, 2))) AS dist_bike_station FROM inside i, st GROUP BY ALL HAVING dist_bike_station > 200
  UNION ALL SELECT l.*, MIN(sqrt(pow(l.x - st.x, 2) + pow(l.y - st.y, 2))) FROM lane l JOIN st ON st.station_id <> l.id WHERE kind = 'popular' GROUP BY ALL),
poi AS MATERIALIZED (SELECT x, y, category FROM {utm_sql('v_poi')}),
f AS MATERIALIZED (SELECT near.*, l.* EXCLUDE (kind, id) FROM near JOIN ({LAYER_SQL}) l ON l.kind = near.kind AND l.id = near.id),
s AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in aggs.DISTANCES)} FROM f WHERE kind = 'popular'),
z AS MATERIALIZED (SELECT kind, id, x, y, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in aggs.DISTANCES)} FROM f, s),
d AS (SELECT a.id, a.x, a.y, sqrt({' + '.join(f'pow(a.{c} - b.{c}, 2)' for c in aggs.DISTANCES)}) AS dist FROM z a JOIN z b ON a.kind = 'site' AND b.kind = 'popular'),
p AS MATERIALIZED (SELECT id, x, y, 1 / avg(dist) AS similarity_score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY dist) AS rn FROM d)
  WHERE rn <= 5 GROUP BY ALL ORDER BY 4 DESC, 1 LIMIT 100),
settings AS MATERIALIZED (SELECT CAST(e AS DOUBLE) AS eps, CAST(m AS INT) AS m FROM range(50, 251, 50) AS r(e), range(2, 6) AS q(m)),
near_p AS MATERIALIZED (SELECT eps, m, a.id AS a, b.id AS b FROM settings, p a, p b WHERE sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= eps),
core AS MATERIALIZED (SELECT eps, m, a AS id FROM near_p GROUP BY ALL HAVING COUNT(*) >= m),
edge AS MATERIALIZED (SELECT n.* FROM near_p n JOIN core x ON x.eps = n.eps AND x.m = n.m AND x.id = a JOIN core y ON y.eps = n.eps AND y.m = n.m AND y.id = b),
reach AS (SELECT eps, m, id AS a, id AS b FROM core UNION SELECT r.eps, r.m, r.a, e.b FROM reach r JOIN edge e ON e.eps = r.eps AND e.m = r.m AND e.a = r.b),
named AS (SELECT eps, m, a AS id, MIN(b) AS cluster FROM reach GROUP BY 1, 2, 3),
met AS (SELECT n.eps, n.m, n.a AS id, MIN(cluster) AS cluster FROM near_p n JOIN named c ON c.eps = n.eps AND c.m = n.m AND c.id = n.b GROUP BY 1, 2, 3),
every AS MATERIALIZED (SELECT eps, m, id, COALESCE(named.cluster, met.cluster) AS cluster FROM met LEFT JOIN named USING (eps, m, id)),
best AS (SELECT s.eps, s.m FROM settings s LEFT JOIN every e ON e.eps = s.eps AND e.m = s.m GROUP BY 1, 2
  ORDER BY COUNT(DISTINCT cluster) - ((SELECT COUNT(*) FROM p) - COUNT(id)) / (SELECT COUNT(*) FROM p) DESC, s.eps, s.m LIMIT 1),
site AS (SELECT cluster, p.* FROM every JOIN best USING (eps, m) JOIN p ON p.id = every.id QUALIFY ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY similarity_score DESC, p.id) = 1)
SELECT cluster, id AS point_id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(similarity_score, 6) AS similarity_score FROM {degrees_sql('site')}"""


@query("j10_site_selection", SITES_SQL)
def _(d):
    docs = cut_lineage(documents(d).select("station_id", "date", "status"))  # read by three rankings
    top = aggs.popular_stations(aggs.shortage_stations(docs, "num_bikes_available"), aggs.shortage_stations(docs, "num_docks_available"),
                                aggs.rotation_stations(aggs.complete_days(docs)))
    stations = expansion.with_plane(d("v_station")).select("station_id", "x", "y")
    poi = expansion.with_plane(d("v_poi")).select("x", "y", "category")
    layers = {
        name: poi.filter((F.col("category") >= lo) & (F.col("category") < hi)).select("x", "y")
        for name, lo, hi in zip(expansion.POINT_LAYERS.values(), LAYER_CUTS, LAYER_CUTS[1:])
    }
    zones = expansion.plane_geometry(areas(d))
    lines = d("v_lane").select("lane_id", F.array(
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))).alias("ring"))
    lines = expansion.plane_geometry(lines.select("lane_id", geom.geometry(F.lit("LINESTRING"), F.array("ring")).alias("geometry")))
    lines = geom.paths(lines)
    out = expansion.propose_sites(top.join(stations, "station_id"), stations, layers, lines, zones, step=10.0)
    return out.select("cluster", "point_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
                      F.round("similarity_score", 6).alias("similarity_score"))


@query("j11_truck_route", f"""{TOUR}
SELECT w.truck, COUNT(*) AS stops, round(SUM(leg), 2) AS distance, CAST(SUM(CASE WHEN seq = (SELECT MAX(seq) FROM whole m WHERE m.truck = w.truck) THEN 0
  WHEN check_status = 'low' THEN trunc(0.75e0 * capacity - num_bikes_available) ELSE -trunc(0.25e0 * capacity) END) AS BIGINT) AS balance_bicicletas
FROM whole w JOIN g ON g.station_id = w.station_id GROUP BY 1""")
def _(d):
    out = routes.route_totals(cut_lineage(routes.truck_routes(state(d))))
    return out.withColumn("distance", F.round("distance", 2))


@query("j12_pair_distances", f"""
SELECT a.station_id AS a, b.station_id AS b, round({HAV_SQL.format(a='a.lat', b='b.lat', p='a.lon', q='b.lon')}, 4) AS distance
FROM v_station a JOIN v_station b ON b.station_id = a.station_id + 1""")
def _(d):
    pairs = d("v_station").select(F.col("station_id").alias("a"), (F.col("station_id") + 1).alias("b"))
    return routes.pair_costs(pairs, d("v_station")).withColumn("distance", F.round("distance", 4))


DEMAND_SQL = f"""SELECT DISTINCT station_id, hora_dia, num_bikes_available, num_docks_available, num_bikes_error, total_bikes_taken, total_bikes_returned,
  status AS status_station, festivo, weekday, laborable, temperatura, precipitacion, CAST(humedad AS BIGINT) AS humedad, viento, last_reported_local,
  CAST(EXTRACT(YEAR FROM date_reported) AS INT) AS year, CAST(EXTRACT(MONTH FROM date_reported) AS INT) AS month, CAST(EXTRACT(DAY FROM date_reported) AS INT) AS day,
  CASE WHEN hora_dia <= 5 THEN 'night' WHEN hora_dia <= 9 THEN 'early_morning' WHEN hora_dia <= 14 THEN 'morning' WHEN hora_dia <= 19 THEN 'afternoon' ELSE 'evening' END AS hora_info,
  CASE WHEN strftime(date_reported, '%m-%d') BETWEEN '03-21' AND '06-20' THEN 'Primavera' WHEN strftime(date_reported, '%m-%d') BETWEEN '06-21' AND '09-22' THEN 'Verano'
    WHEN strftime(date_reported, '%m-%d') BETWEEN '09-23' AND '12-20' THEN 'Otoño' ELSE 'Invierno' END AS season
FROM (SELECT *, COUNT(*) OVER (PARTITION BY station_id, date_reported) AS entries FROM (
  SELECT *, CAST(SUM(CASE WHEN diff < 0 THEN -diff ELSE 0 END) OVER h AS INT) AS total_bikes_taken, CAST(SUM(CASE WHEN diff > 0 THEN diff ELSE 0 END) OVER h AS INT) AS total_bikes_returned,
    MAX(last_reported_local) OVER h AS newest
  FROM (SELECT c.*, CASE WHEN capacity > 0 THEN capacity - (num_bikes_available + num_docks_available) ELSE 0 END AS num_bikes_error, temperatura, precipitacion, humedad, viento,
      num_bikes_available - LAG(num_bikes_available) OVER (PARTITION BY c.station_id, date_reported ORDER BY last_reported_local, event_id) AS diff
    FROM ({CALENDAR_SQL}) c LEFT JOIN (SELECT station_id AS sid, capacity FROM v_station) ON c.station_id = sid
    LEFT JOIN ({WIDE_SQL}) ON bucket = {UTC_BUCKET})
  WINDOW h AS (PARTITION BY station_id, date_reported, hora_dia)) WHERE last_reported_local = newest) WHERE entries > 1"""

_COLS = ["station_id", "hora_dia", "num_bikes_available", "num_docks_available", "num_bikes_error", "total_bikes_taken",
         "total_bikes_returned", "status_station", "festivo", "weekday", "laborable", "temperatura", "precipitacion", "humedad", "viento",
         "last_reported_local", "year", "month", "day", "hora_info", "season"]


@query("j13_demand_dataset", f"SELECT * REPLACE ({ts('last_reported_local')} AS last_reported_local) FROM ({DEMAND_SQL})")
def _(d):
    return demand_table(d).select(*_COLS)


LANDED = {"station_id": "INT", "num_bikes_available": "INT", "num_bikes_available_types.mechanical": "INT",
          "num_bikes_available_types.ebike": "INT", "num_docks_available": "INT", "last_reported": "BIGINT", "is_charging_station": "BOOLEAN",
          "is_installed": "INT", "is_renting": "INT", "is_returning": "INT", "status": "STRING", "last_updated": "BIGINT"}


def landed_feed(d):
    """The status view as the feed lands: text files of one row per station and poll, epoch seconds, dotted names."""
    one = F.lit(1)
    values = {"num_bikes_available_types.mechanical": F.col("num_bikes_available"), "num_bikes_available_types.ebike": F.lit(0),
              "last_reported": cal.to_epoch(cal.local_to_utc("last_reported_local")), "is_charging_station": F.lit(True),
              "is_installed": one, "is_renting": one, "is_returning": one, "last_updated": 1704067200 + F.col("event_id")}
    path = d.path("landed")
    d("v_status").select(*[values.get(c, F.col(c) if "." not in c else one).alias(c) for c in LANDED]).write.option("header", True).csv(path)
    return readers.read_csv(d.spark, path, ", ".join(f"`{c}` {t}" for c, t in LANDED.items()))


def landed_weather(d):
    """The weather readings as they land, a table per variable."""
    long = weather_series(d)
    return {name: long.filter(F.col("variable") == name).select(
        F.lit(name).alias("codi"), F.to_date("ts").alias("fecha"), F.date_format("ts", "HH:mm:ss").alias("hora"), "valor")
        for name in ("temperatura", "precipitacion", "humedad")}


SECONDS = "(SELECT * REPLACE (date_trunc('second', last_reported_local) AS last_reported_local) FROM v_status)"


@query("j13_feed_to_demand", f"SELECT * REPLACE ({ts('last_reported_local')} AS last_reported_local) FROM ({DEMAND_SQL.replace('v_status', SECONDS)})")
def _(d):
    # from the files of the feed and the weather to the demand table; polls that say the same twice are read twice
    raw = landed_feed(d)
    status = demand.feed_readings(raw.unionByName(raw.filter("station_id % 3 = 0")))
    return demand.demand_dataset(status, d("v_station"), d("v_holiday"), demand.weather_series(**landed_weather(d))).select(*_COLS)


def _mean(c: str) -> str:
    return f"CAST(SUM({c}) OVER (PARTITION BY station_id) AS DOUBLE) / NULLIF(COUNT({c}) OVER (PARTITION BY station_id), 0)"


PREPARED_SQL = f"""
WITH dem AS MATERIALIZED (SELECT *, make_date(year, month, day) AS dr FROM ({DEMAND_SQL})),
life AS (SELECT station_id, MIN(dr) AS c, MAX(dr) AS e FROM dem GROUP BY 1),
grid AS (SELECT station_id, CAST(unnest(generate_series(c, e, INTERVAL 1 DAY)) AS DATE) AS dr FROM life WHERE e >= DATE '2024-01-25' OR date_diff('day', c, e) > 20),
full_ AS (SELECT g.station_id AS sid, g.dr AS gd, CAST(h AS INT) AS gh, dem.* EXCLUDE (station_id, hora_dia, dr, year, month, day) FROM grid g CROSS JOIN range(24) r(h)
  LEFT JOIN dem ON dem.station_id = g.station_id AND dem.dr = g.dr AND dem.hora_dia = h),
t AS (SELECT * EXCLUDE (sid), sid AS station_id, COALESCE(last_reported_local, gd + gh * INTERVAL 1 HOUR) AS hour_ts FROM full_),
u AS (SELECT *, LAST_VALUE(festivo IGNORE NULLS) OVER w AS f, LAST_VALUE(status_station IGNORE NULLS) OVER w AS st FROM t
  WINDOW w AS (PARTITION BY station_id ORDER BY hour_ts, gh ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT station_id, {day('gd')} AS d, gh AS hora_dia, {ts('hour_ts')} AS last_reported_local, st AS status_station, f AS festivo,
  COALESCE(weekday, CAST(isodow(hour_ts) AS INT)) AS weekday, COALESCE(num_bikes_error, 0) AS num_bikes_error,
  COALESCE(laborable, CASE WHEN f = 0 AND COALESCE(weekday, isodow(hour_ts)) <= 5 THEN 1 ELSE 0 END) AS laborable,
  COALESCE(hora_info, CASE WHEN gh <= 5 THEN 'night' WHEN gh <= 9 THEN 'early_morning' WHEN gh <= 14 THEN 'morning' WHEN gh <= 19 THEN 'afternoon' ELSE 'evening' END) AS hora_info,
  COALESCE(season, CASE WHEN strftime(gd, '%m-%d') BETWEEN '03-21' AND '06-20' THEN 'Primavera' WHEN strftime(gd, '%m-%d') BETWEEN '06-21' AND '09-22' THEN 'Verano'
    WHEN strftime(gd, '%m-%d') BETWEEN '09-23' AND '12-20' THEN 'Otoño' ELSE 'Invierno' END) AS season,
  COALESCE(num_docks_available, CAST(round({_mean('num_docks_available')}) AS INT)) AS num_docks_available,
  COALESCE(total_bikes_returned, CAST(round({_mean('total_bikes_returned')}) AS INT)) AS total_bikes_returned,
  round(COALESCE(precipitacion, {_mean('precipitacion')}), 6) AS precipitacion, viento,
  COALESCE(num_bikes_available, CAST(round({_mean('num_bikes_available')}) AS INT)) AS num_bikes_available,
  COALESCE(total_bikes_taken, CAST(round({_mean('total_bikes_taken')}) AS INT)) AS total_bikes_taken,
  COALESCE(humedad, CAST(round({_mean('humedad')}) AS INT)) AS humedad,
  round(COALESCE(temperatura, {_mean('temperatura')}), 6) AS temperatura
FROM u"""


@query("j14_preprocess", PREPARED_SQL)
def _(d):
    out = demand.preprocess(demand_table(d), None, None, "2024-01-25", 20)
    return out.select(
        "station_id", F.make_date("year", "month", "day").alias("d"), "hora_dia", "last_reported_local", "status_station", "festivo", "weekday",
        "num_bikes_error", "laborable", "hora_info", "season", "num_bikes_available", "num_docks_available", "total_bikes_taken",
        "total_bikes_returned", "humedad", "viento", *[F.round(c, 6).alias(c) for c in ("temperatura", "precipitacion")])


def split_sql(held_out: bool) -> str:
    """Readings of the demand table that ``train_test`` trains on, or holds out."""
    return f"""SELECT * FROM ({PREPARED_SQL}), (SELECT MIN(CAST(d AS DATE)) AS first_day, date_diff('day', MIN(CAST(d AS DATE)), MAX(CAST(d AS DATE))) + 1 AS days
  FROM ({PREPARED_SQL})) WHERE total_bikes_taken IS NOT NULL AND (date_diff('day', first_day, CAST(d AS DATE)) >= greatest(1, round(days * 2e0 / 3))) = {held_out}"""


@query("j03_normal_equations", f"""
WITH r AS MATERIALIZED ({split_sql(False)})
SELECT f AS feature, v AS "value", COUNT(*) AS readings, CAST(SUM(total_bikes_taken) AS BIGINT) AS taken, 0e0 AS gap
FROM (SELECT 'hour' AS f, CAST(hora_dia AS VARCHAR) AS v, total_bikes_taken FROM r UNION ALL SELECT 'season', season, total_bikes_taken FROM r
  UNION ALL SELECT 'station', CAST(station_id AS VARCHAR), total_bikes_taken FROM r UNION ALL SELECT 'intercept', '', total_bikes_taken FROM r) GROUP BY 1, 2""")
def _(d):
    # the model of j03 solves its equations: every gradient is 0
    train, _ = train_test(d)
    out = ml.normal_equations(ml.fit_demand(train), train)
    return out.withColumns({"taken": F.col("taken").cast("bigint"), "gap": F.round("gap", 6) + 0.0})  # no negative zero


@query("j04_holdout_check", f"""
SELECT CAST(r AS DOUBLE) AS reg_param, CAST(e AS DOUBLE) AS elastic_net, CAST(i AS INT) AS max_iter, TRUE AS least_chosen, round(v, 6) AS holdout_variance
FROM (SELECT unnest([0.01e0, 0.1e0]) AS r), (SELECT unnest([0e0, 1e0]) AS e), (SELECT unnest([10, 20]) AS i),
  (SELECT var_pop(total_bikes_taken) AS v FROM ({split_sql(True)}))""")
def _(d):
    # all points of the grid; the chosen one has the least error, and its two hold-out scores belong to the held-out readings
    train, test = train_test(d)
    out = cut_lineage(ml.grid_scores(ml.tune(train), test))
    best = out.filter("chosen").select(F.struct("rmse", (F.col("holdout_rmse") ** 2 / (1 - F.col("holdout_r2"))).alias("v")).alias("b")).scalar()
    return out.withColumn("b", best).select("reg_param", "elastic_net", "max_iter", (F.col("rmse") >= F.col("b.rmse")).alias("least_chosen"),
                                            F.round("b.v", 6).alias("holdout_variance"))
