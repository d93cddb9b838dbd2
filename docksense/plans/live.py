"""Live rebalancing: status, zones and tours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docksense.functions.status import classify
from docksense.operators import joins, routes
from docksense.operators.windows import latest_info


def classified_status(status: DataFrame, stations: DataFrame) -> DataFrame:
    return classify(joins.join_capacity(status, stations))


def status_summary(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings and bikes to move per class."""
    return classified_status(status, stations).groupBy("check_status").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("bikes_to_refill", F.lit(0))).alias("refill"),
        F.sum(F.coalesce("bikes_to_remove", F.lit(0))).alias("remove"),
    )


def station_state(status: DataFrame, stations: DataFrame, order: tuple = ("last_reported_local", "event_id")) -> DataFrame:
    """Current reading of every station that has attributes, with its class and place."""
    newest = latest_info(status, "station_id", list(order))
    return classify(newest.join(stations, "station_id"))


def plan_tours(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Tours of all trucks from the current state."""
    return routes.truck_routes(station_state(status, stations).select(*routes.STOP_FIELDS))
