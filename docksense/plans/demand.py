"""Hourly demand table and its preparation for regression."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docksense.functions import calendar as cal
from docksense.functions.status import bikes_error
from docksense.operators import clean, joins, windows
from docksense.session import cut_lineage

KEYS = ["station_id", "date_reported", "hora_dia"]
INT_GAPS = ["num_bikes_available", "num_docks_available", "total_bikes_taken", "total_bikes_returned", "humedad"]
DEC_GAPS = ["temperatura", "precipitacion", "viento"]


def format_status(raw: DataFrame, folder_year=None, folder_month=None) -> DataFrame:
    """Landed monthly status rows (dotted names, epoch seconds) to typed rows with local times."""
    out = raw.select(
        "station_id", "num_bikes_available",
        F.col("`num_bikes_available_types.mechanical`").alias("num_mechanical_available"),
        F.col("`num_bikes_available_types.ebike`").alias("num_ebike_available"),
        "num_docks_available", cal.from_epoch("last_reported").alias("last_reported_GMT"),
        "is_charging_station", "is_installed", "is_renting", "is_returning", "status",
        cal.from_epoch("last_updated").alias("last_updated_GMT"),
    )
    out = clean.add_local_time(out, {"last_reported_GMT": "last_reported", "last_updated_GMT": "last_updated"})
    out = out.withColumnsRenamed({"date_last_reported": "date_reported", "hour_last_reported": "hour_reported",
                                  "date_last_updated": "date", "hour_last_updated": "hour"})
    return out


def feed_readings(raw: DataFrame) -> DataFrame:
    """Landed monthly status rows to the readings that ``demand_dataset`` takes.

    Readings of one station and second are ordered by the time of their file, as ``event_id``.
    """
    rows = clean.dedupe(format_status(raw))
    return rows.withColumns({"hora_dia": F.hour("last_reported_local"), "event_id": cal.to_epoch("last_updated_GMT")})


def weather_series(**rows: DataFrame) -> DataFrame:
    """Weather rows (codi, fecha, hora, valor) of each variable to one long series (variable, ts, valor) in UTC."""
    parts = [df.select(F.lit(name).alias("variable"), F.to_timestamp_ntz(
        F.concat_ws(" ", F.date_format("fecha", "yyyy-MM-dd"), "hora"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"), "valor")
        for name, df in rows.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def status_variables(status: DataFrame, info: DataFrame | None, holidays: DataFrame, weather: DataFrame,
                     as_reference: bool = False) -> DataFrame:
    """Readings with capacity, calendar, unusable slots and weather."""
    df = joins.join_capacity(status, info)
    df = joins.join_calendar(df, holidays).withColumn("num_bikes_error", bikes_error())
    return joins.weather_struct(joins.join_bucketed(df, weather, joins.weather_clock(df, as_reference)))


def hourly_rows(status: DataFrame) -> DataFrame:
    """Last reading of each station hour (ties kept) with the hour's demand, for days with more than one entry.

    Demand is the difference to the previous reading of the station's day. All windows share one shuffle by station and
    day: a station's day holds what the feed polls in a day, so no group grows with the data.
    """
    day, hour = W.partitionBy("station_id", "date_reported"), W.partitionBy(*KEYS)
    bikes = F.col("num_bikes_available")
    rows = status.withColumn("_diff", bikes - F.lag(bikes).over(day.orderBy("last_reported_local", "event_id")))
    demand = {"total_bikes_taken": F.greatest(-F.col("_diff"), F.lit(0)), "total_bikes_returned": F.greatest("_diff", F.lit(0))}
    # a reading without a predecessor, or without a count, adds nothing
    sums = {c: F.sum(F.when(F.col("_diff").isNotNull(), v).otherwise(0)).over(hour).cast("int") for c, v in demand.items()}
    rows = rows.withColumns({**sums, "_newest": F.rank().over(hour.orderBy(F.desc("last_reported_local")))})
    last = rows.filter("_newest = 1").withColumn("_entries", F.count("*").over(day))
    return last.filter("_entries > 1").drop("_diff", "_newest", "_entries")


def demand_dataset(status: DataFrame, info: DataFrame | None, holidays: DataFrame, weather: DataFrame,
                   as_reference: bool = False) -> DataFrame:
    """The flat hourly demand table; attributes, calendar and weather meet the hours, not the readings."""
    hours = status_variables(hourly_rows(status), info, holidays, weather, as_reference)
    # equal rows meet while still partitioned by station and day, before the derived columns
    rows = clean.dedupe(hours.select(
        "station_id", "date_reported", "hora_dia", "num_bikes_available", "num_docks_available", "num_bikes_error",
        "total_bikes_taken", "total_bikes_returned", F.col("status").alias("status_station"), "festivo", "weekday",
        "laborable", "weather.*", "last_reported_local",
    ))
    return rows.withColumns({
        "year": F.year("date_reported"), "month": F.month("date_reported"), "day": F.dayofmonth("date_reported"),
        "hora_info": cal.hour_band("hora_dia"), "season": cal.season("date_reported"),
    }).drop("date_reported")


def complete_hours(demand: DataFrame, first: str | None = None, last: str | None = None,
                   cutoff: str | None = None, min_days: int = 365, values: DataFrame | None = None) -> DataFrame:
    """Null rows for the missing hours of every station's service days; only stations in service, if asked.

    The service filter runs on the one row per station, before any day is generated. The columns of ``values``, one row per
    station, come along from there, which spares the hours a shuffle of their own.
    """
    dated = demand.withColumn("date_reported", F.make_date("year", "month", "day"))
    stations = dated.groupBy("station_id").agg(
        F.min("date_reported").alias("creation_date"), F.max("date_reported").alias("end_date"))
    if cutoff is not None:
        stations = clean.in_service(stations, cutoff, min_days)
    if values is not None:
        stations = stations.join(values, "station_id", "left")
    lo, hi = F.col("creation_date"), F.col("end_date")
    lo = lo if first is None else F.greatest(lo, F.lit(first).cast("date"))
    hi = hi if last is None else F.least(hi, F.lit(last).cast("date"))
    full = joins.densify_days(dated.drop("year", "month", "day"), joins.calendar_days(stations, lo, hi), KEYS[:2])
    return full.withColumns({
        "year": F.year("date_reported"), "month": F.month("date_reported"), "day": F.dayofmonth("date_reported"),
        "day_weekday": cal.weekday("date_reported"), "day_season": cal.season("date_reported"),
    })


GAPS = (["status_station", "festivo"], INT_GAPS, DEC_GAPS)


def gap_values(facts: DataFrame) -> DataFrame:
    """One row per station of the demand table with its last and mean values, before or after completion: gap rows add nothing."""
    facts = clean.fill_expr(facts, {"last_reported_local": cal.ts_from_parts("year", "month", "day", "hora_dia")})
    return windows.gap_values(facts, "station_id", ["last_reported_local", "hora_dia"], *GAPS)


def fill_gaps(full: DataFrame) -> DataFrame:
    """Every null of the completed table from its own hour, or from the station's last or mean value that its rows carry."""
    hour = F.timestamp_add("HOUR", F.col("hora_dia"), F.col("date_reported").cast("timestamp_ntz"))
    df = clean.fill_expr(full, {
        "last_reported_local": hour, "hora_info": cal.hour_band("hora_dia"),
        "season": F.col("day_season"), "weekday": F.col("day_weekday"), "num_bikes_error": F.lit(0),
    }).drop("day_season", "day_weekday")
    df = windows.take_gap_values(df, *GAPS)
    return clean.fill_expr(df, {"laborable": cal.workday("festivo", "weekday")})


def preprocess(demand: DataFrame, first: str | None, last: str | None, cutoff: str, min_days: int = 365) -> DataFrame:
    """Completed, filtered and filled demand table. The demand table is written once, since three steps read it."""
    demand = cut_lineage(demand)
    if first is not None or last is not None:
        known = clean.between_dates(demand.withColumn("_d", F.make_date("year", "month", "day")), "_d",
                                    first or "0001-01-01", last or "9999-12-31").drop("_d")
    else:
        known = demand
    full = complete_hours(demand, first, last, cutoff, min_days, gap_values(known))
    return fill_gaps(full).drop("creation_date", "end_date", "date_reported")
