"""Streams, keyed state, route messages and job metrics."""

from pyspark.sql import functions as F

from docksense.catalog.a_sources import status_messages
from docksense.catalog.base import query
from docksense.catalog.c_joins import FLAGGED, HAV_AB, state
from docksense.catalog.h_scalars import CLASS_SQL, JOINED
from docksense.functions.status import classify
from docksense.operators import routes
from docksense.operators.windows import latest_info
from docksense.session import cut_lineage
from docksense.sources import writers
from docksense.streaming import routes as route_stream
from docksense.streaming import status as live
from docksense.streaming.metrics import TriggerLog


def feed(d, files: int = 4) -> str:
    folder = d.path("feed")
    status_messages(d).select("value").repartition(files).write.text(folder)
    return folder


@query("i01_status_stream", f"""
SELECT check_status, COUNT(*) AS n, CAST(SUM(CASE WHEN check_status = 'low' THEN trunc(0.75e0 * capacity - num_bikes_available) ELSE 0 END) AS BIGINT) AS refill
FROM (SELECT *, {CLASS_SQL} AS check_status FROM {JOINED}) GROUP BY 1""")
def _(d):
    messages = live.read_status_stream(d.spark, feed(d))
    rows = live.run_to_table(live.status_stream(messages, d("v_station").drop("lon", "lat")), d.path("stream"), d.path("progress"))
    return rows.groupBy("check_status").agg(F.count("*").alias("n"), F.sum(F.coalesce("bikes_to_refill", F.lit(0))).alias("refill"))


NEWEST = f"""(SELECT *, {CLASS_SQL} AS check_status FROM {JOINED}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY floor(epoch(last_reported_local)) DESC, num_bikes_available DESC) = 1)"""


@query("i02_stream_upsert", f"SELECT station_id, num_bikes_available, CAST(floor(epoch(last_reported_local)) AS BIGINT) AS last_reported, check_status FROM {NEWEST}")
def _(d):
    messages = live.read_status_stream(d.spark, feed(d), files_per_trigger=1)
    target, order = d.path("state"), ("last_reported", "num_bikes_available")
    # polls that say the same reach the sink once; the tie on the number of bikes needs it in the key
    distinct = live.distinct_polls(live.decode_status(messages), key=("station_id", "last_reported", "num_bikes_available"))
    stream = live.stamp(classify(live.enrich_stream(distinct, d("v_station").drop("lon", "lat"))))
    live.start_upsert(stream, target, d.path("progress"), order=order).awaitTermination()
    now = live.current_state(d.spark, target, order=order)
    return now.select("station_id", "num_bikes_available", "last_reported", "check_status")


@query("i03_latest_state", """
SELECT station_id, event_id, num_bikes_available, status FROM v_status
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY last_reported_local DESC, event_id DESC) = 1""")
def _(d):
    out = latest_info(d("v_status"), "station_id", ["last_reported_local", "event_id"])
    return out.select("station_id", "event_id", "num_bikes_available", "status")


@query("i04_processing_stamp", "SELECT event_id, current_date - CAST(last_reported_local AS DATE) AS days_ago FROM v_status")
def _(d):
    return live.stamp(d("v_status")).select("event_id", F.datediff("lastUpdate", "last_reported_local").cast("bigint").alias("days_ago"))


TOUR = f"""WITH RECURSIVE f AS MATERIALIZED ({FLAGGED}), g AS (SELECT * FROM f WHERE truck IN (SELECT truck FROM f GROUP BY 1 HAVING COUNT(*) > 1)),
tour AS (
  SELECT truck, MIN(station_id) AS station_id, [MIN(station_id)] AS seen, 0 AS seq, 0e0 AS leg FROM g GROUP BY 1
  UNION ALL
  SELECT truck, station_id, seen, seq, leg FROM (
    SELECT t.truck, b.station_id, list_append(t.seen, b.station_id) AS seen, t.seq + 1 AS seq, {HAV_AB} AS leg,
      ROW_NUMBER() OVER (PARTITION BY t.truck ORDER BY round({HAV_AB}, 6), b.station_id) AS rn
    FROM tour t JOIN g a ON a.station_id = t.station_id JOIN g b ON b.truck = t.truck AND NOT list_contains(t.seen, b.station_id)) WHERE rn = 1),
ends AS (SELECT truck, MAX(seq) AS last_seq FROM tour GROUP BY 1),
whole AS (SELECT truck, station_id, seq, leg FROM tour
  UNION ALL SELECT z.truck, b.station_id, e.last_seq + 1, {HAV_AB} FROM ends e JOIN tour z ON z.truck = e.truck AND z.seq = e.last_seq
    JOIN tour s ON s.truck = e.truck AND s.seq = 0 JOIN g a ON a.station_id = z.station_id JOIN g b ON b.station_id = s.station_id)"""


def messages(d):
    return routes.route_messages(cut_lineage(routes.truck_routes(state(d)))).select("value")


@query("i05_route_messages", f"""{TOUR}
SELECT w.truck AS truck_id, CAST(seq + 1 AS INT) AS "order", w.station_id, g.check_status, g.num_bikes_available FROM whole w JOIN g ON g.station_id = w.station_id""")
def _(d):
    out = route_stream.explode_routes(route_stream.decode_routes(messages(d)))
    return out.select("truck_id", "order", "station_id", "check_status", "num_bikes_available")


@query("i06_route_paths", f"""{TOUR}
SELECT truck AS truck_id, COUNT(*) AS points, round(SUM(leg), 2) AS distance FROM whole GROUP BY 1""")
def _(d):
    decoded = route_stream.decode_routes(cut_lineage(messages(d).withColumn("arrival", F.monotonically_increasing_id())))
    paths = route_stream.route_paths(decoded).select("truck_id", F.size("path").cast("bigint").alias("points"))
    newest = route_stream.truck_summary(decoded, "arrival")
    return paths.join(newest, "truck_id").select("truck_id", "points", F.round("distance", 2).alias("distance"))


@query("i07_json_errors", """
SELECT CASE WHEN capacity = 0 THEN 'bad' ELSE 'good' END AS part, COUNT(*) AS n,
  CAST(SUM(CASE WHEN capacity = 0 THEN 0 ELSE station_id END) AS DOUBLE) AS distance FROM v_station GROUP BY 1""")
def _(d):
    raw = writers.to_messages(d("v_station").select(F.col("truck").alias("truck_id"), F.col("station_id").cast("double").alias("distance"), "capacity"),
                              "truck_id", ["truck_id", "distance", "capacity"])
    whole = F.get_json_object("value", "$.capacity").cast("int") != 0
    cut = raw.select(F.when(whole, F.col("value")).otherwise(F.expr("substring(value, 1, length(value) - 1)")).alias("value"))
    good, bad = route_stream.decode_routes(cut, on_error="split")
    return good.agg(F.lit("good").alias("part"), F.count("*").alias("n"), F.sum("distance").alias("distance")).union(
        bad.agg(F.lit("bad"), F.count("*"), F.lit(0.0)))


@query("i08_starting_point", "SELECT station_id, COUNT(*) AS n FROM v_status WHERE station_id % 2 = 1 GROUP BY 1")
def _(d):
    # a stream started at ``latest`` and stopped; what is delivered meanwhile is read when it is started again
    folder, rows, target, progress = d.path("feed"), status_messages(d), d.path("stream"), d.path("progress")
    odd = F.get_json_object("value", "$.station_id").cast("int") % 2 == 1
    rows.filter(~odd).select("value").repartition(2).write.text(folder)

    def run():
        messages = live.read_status_stream(d.spark, folder, start="latest", files_per_trigger=1, checkpoint=progress)
        return live.run_to_table(live.decode_status(messages).select("station_id"), target, progress)

    run()
    rows.filter(odd).select("value").repartition(2).write.mode("append").text(folder)
    return run().groupBy("station_id").agg(F.count("*").alias("n"))


@query("i09_job_metrics", """
SELECT 'status' AS job, COUNT(*) AS rows, CAST(SUM(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM v_status""")
def _(d):
    # counted by the running stream, trigger by trigger, and kept in a table
    messages = live.read_status_stream(d.spark, feed(d), files_per_trigger=1)
    bad = F.coalesce(F.sum(F.expr("status = 'error'").cast("bigint")), F.lit(0))
    watched = live.decode_status(messages).observe("status", F.count(F.lit(1)).alias("rows"), bad.alias("errors"))
    with TriggerLog(d.spark, d.path("triggers")) as log:
        query = watched.writeStream.format("noop").option("checkpointLocation", d.path("progress")).trigger(availableNow=True).start()
        query.awaitTermination()
        log.wait(str(query.runId))
    count = lambda name: F.sum(F.get_json_object("observed", f"$.status.{name}").cast("bigint")).alias(name)
    return log.table().filter(F.col("query") == str(query.id)).agg(F.lit("status").alias("job"), count("rows"), count("errors"))
