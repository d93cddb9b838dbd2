"""Sorts, top-k and unions."""

from pyspark.sql import functions as F

from docksense.catalog.base import day, query
from docksense.operators import aggs


@query("f01_top_k", "SELECT station_id, COUNT(*) AS n FROM v_status GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(d):
    return aggs.top_k(d("v_status").groupBy("station_id").agg(F.count("*").alias("n")), "n", 10, "station_id")


@query("f02_top_100_points", "SELECT event_id AS point_id, value AS similarity_score FROM events ORDER BY value DESC, event_id LIMIT 100")
def _(d):
    df = d("events").select(F.col("event_id").alias("point_id"), F.col("value").alias("similarity_score"))
    return aggs.top_k(df, "similarity_score", 100, "point_id")


@query("f03_multi_key_sort", f"SELECT station_id, {day('snap_date')} AS snap_date, snap_id FROM v_snapshot ORDER BY 1, 2, 3")
def _(d):
    return aggs.order_by(d("v_snapshot"), ["station_id", "snap_date", "snap_id"]).select("station_id", "snap_date", "snap_id")


@query("f04_sort_counts", """SELECT category, COUNT(*) AS "count" FROM v_poi GROUP BY 1 ORDER BY 2 DESC, 1""")
def _(d):
    return d("v_poi").groupBy("category").agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), "category")


@query("f05_row_cap", "SELECT station_id, name FROM v_station ORDER BY station_id LIMIT 7")
def _(d):
    return aggs.row_cap(d("v_station"), 7, ["station_id"]).select("station_id", "name")


@query("g01_union_all", f"SELECT {day('snap_date')} AS d FROM v_snapshot UNION ALL SELECT {day('data')} FROM v_holiday")
def _(d):
    return aggs.union_all(d("v_snapshot").select(F.col("snap_date").alias("d")), d("v_holiday"))


@query("g02_concat_years", """SELECT station_id, snap_id, address FROM v_snapshot""")
def _(d):
    cut = F.to_date(F.lit("1998-01-01"))
    early = d("v_snapshot").filter(F.col("snap_date") < cut).select("station_id", "snap_id", "address")
    late = d("v_snapshot").filter(F.col("snap_date") >= cut).select("address", "snap_id", "station_id")
    return aggs.union_all(early, late, by_name=True)
