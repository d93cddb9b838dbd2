"""Route messages back to rows, paths and truck summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docksense.functions.text import format_es, truck_colour
from docksense.schemas import STOP, TRUCK_ROUTE
from docksense.sources.landing import decode


def decode_routes(messages: DataFrame, on_error: str = "null"):
    """Typed route messages; distance, balance and stops default to 0, 0 and none."""
    out = decode(messages, "value", TRUCK_ROUTE, {"distance": 0.0, "balance_bicicletas": 0}, on_error)
    if on_error == "split":
        good, bad = out
        return _routes(good), bad
    return _routes(out)


def _routes(df: DataFrame) -> DataFrame:
    none = F.array().cast(TRUCK_ROUTE["optimal_route"].dataType)
    return df.filter(F.col("truck_id").isNotNull()).withColumn("optimal_route", F.coalesce("optimal_route", none))


def explode_routes(routes: DataFrame) -> DataFrame:
    """One row per stop with its order from 1 (its place in the message, if it carries none) and the truck's colour."""
    gone = ("optimal_route", "balance_bicicletas", "distance", "route_id", "part", "parts")
    rest = [c for c in routes.columns if c not in gone]
    stops = routes.select(*rest, F.posexplode("optimal_route").alias("_p", "_s"))
    order = F.coalesce(F.col("_s.seq") + 1, F.col("_p") + 1).cast("int").alias("order")
    fields = [f"_s.{f.name}" for f in STOP.fields if f.name != "seq"]
    return stops.select(*rest, order, truck_colour("truck_id").alias("color"), *fields)


def route_paths(routes: DataFrame) -> DataFrame:
    """[lon, lat] path of every tour with more than one stop, put together from all its parts.

    A message without a tour id is a tour of its own, named by what it holds; a part that comes twice counts once.
    """
    tour = F.coalesce("route_id", F.concat(F.lit("own "), F.sha2(F.to_json("optimal_route").cast("binary"), 256)))
    parts = routes.withColumn("_tour", tour).groupBy("truck_id", "_tour", F.coalesce("part", F.lit(0)).alias("part")).agg(
        F.first("optimal_route").alias("stops"))
    whole = parts.groupBy("truck_id", "_tour").agg(F.sort_array(F.collect_list(F.struct("part", "stops"))).alias("_parts"))
    stops = F.flatten(F.transform("_parts", lambda p: p["stops"]))
    path = F.transform(stops, lambda s: F.array(s["lon"], s["lat"]))
    return whole.select("truck_id", path.alias("path"), truck_colour("truck_id").alias("color")).filter(F.size("path") > 1)


def truck_summary(routes: DataFrame, arrival: str) -> DataFrame:
    """Latest distance and balance per truck."""
    newest = F.max_by(F.struct("distance", "balance_bicicletas"), F.col(arrival))
    out = routes.groupBy("truck_id").agg(newest.alias("_n")).select("truck_id", "_n.*")
    return out.withColumn("distance_text", format_es("distance"))
