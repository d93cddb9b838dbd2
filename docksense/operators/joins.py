"""Equi-joins of status, attributes, calendar, weather and forecast tables.

No join carries a broadcast hint: Spark broadcasts a side whose measured size is under its threshold and
otherwise shuffles, where adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.functions import calendar as cal
from docksense.operators.layout import spread


def join_capacity(status: DataFrame, info: DataFrame | None, key: str = "station_id") -> DataFrame:
    """Left join of the capacity; 0 for all rows when there is no attribute table."""
    if info is None:
        return status.withColumn("capacity", F.lit(0))
    return status.join(info.select(key, "capacity"), key, "left")


def join_calendar(df: DataFrame, holidays: DataFrame, date_col: str = "date_reported") -> DataFrame:
    """``festivo``, ``weekday`` and ``laborable`` of each row's day."""
    days = holidays.select(F.col("data").cast("date").alias(date_col)).distinct().withColumn("_h", F.lit(1))
    out = df.join(days, date_col, "left").withColumn("festivo", F.coalesce("_h", F.lit(0))).drop("_h")
    out = out.withColumn("weekday", cal.weekday(date_col))
    return out.withColumn("laborable", cal.workday("festivo", "weekday"))


WEATHER = ["temperatura", "precipitacion", "humedad", "viento"]


def weather_clock(df: DataFrame, as_reference: bool = False) -> Column:
    """The readings' time on the clock of the weather series, which is UTC.

    ``as_reference`` takes the local time as it is, which joins weather that is one or two hours off.
    """
    if as_reference:
        return F.col("last_reported_local")
    return F.col("last_reported_GMT") if "last_reported_GMT" in df.columns else cal.local_to_utc("last_reported_local")


def join_bucketed(df: DataFrame, series: DataFrame, ts_col: Column | str | None = None, seconds: int = 1800,
                  variables: list[str] = WEATHER) -> DataFrame:
    """Left join of a long series (variable, ts, valor) on the time bucket; absent variables give null.

    Both sides are on the UTC clock, unless ``ts_col`` says otherwise. The series is made wide first, so all variables
    need one join.
    """
    ts_col = weather_clock(df) if ts_col is None else ts_col
    picked = [F.max(F.when(F.col("variable") == v, F.col("valor"))).alias(v) for v in variables]
    wide = series.groupBy(F.col("ts").alias("last_reported_rounded")).agg(*picked)
    return df.withColumn("last_reported_rounded", cal.floor_time(ts_col, seconds)).join(
        wide, "last_reported_rounded", "left"
    )


def weather_struct(df: DataFrame) -> DataFrame:
    fields = [F.col(v).cast("bigint" if v == "humedad" else "double").alias(v) for v in WEATHER]
    return df.withColumn("weather", F.struct(*fields))


def merge_snapshots(old: DataFrame, new: DataFrame, key: str = "station_id") -> DataFrame:
    """The newer value of each column, the older one where the newer is null or absent."""
    rest = [c for c in old.columns if c != key]
    right = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in rest if c in new.columns])
    value = [F.coalesce(f"_n_{c}", c).alias(c) if c in new.columns else F.col(c) for c in rest]
    return old.join(right, key, "full_outer").select(key, *value)


def consolidate_snapshots(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All dated snapshots merged at once: per column the newest value that is not null."""
    rest = [c for c in df.columns if c != key and c not in order]
    newest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in rest
    ]
    return df.groupBy(key).agg(*newest)


def calendar_grid(stations: DataFrame, first: str | None = None, last: str | None = None,
                  day_cols: dict[str, Column] | None = None) -> DataFrame:
    """station x day x hour between each station's first and last day, cut to [first, last].

    The limits bound the generated sequences, so no row outside them is ever made. ``day_cols`` of
    ``date_reported`` are computed once per day, before the hours are made.
    """
    lo, hi = F.col("creation_date"), F.col("end_date")
    if first is not None:
        lo = F.greatest(lo, F.lit(first).cast("date"))
    if last is not None:
        hi = F.least(hi, F.lit(last).cast("date"))
    grid = calendar_days(stations, lo, hi).withColumns(day_cols or {})
    return grid.withColumn("hora_dia", F.explode(F.sequence(F.lit(0), F.lit(23))))


def calendar_days(stations: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each station's row once for every day (``date_reported``) from ``lo`` to ``hi``."""
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY")))
    return spread(stations, "station_id").withColumn("date_reported", F.explode(days))


def densify_days(df: DataFrame, days: DataFrame, keys: list[str], hour: str = "hora_dia") -> DataFrame:
    """Left join of hourly facts to station days, with a null row for every hour (0 to 23) of a day that has no fact.

    The days meet the facts before the hours are made, so only days and facts are shuffled, never the hours. Equal facts are
    dropped. The keys of the days are unique; a station's day holds what the feed polls in a day.
    """
    rest = [c for c in df.columns if c not in (*keys, hour)]
    entry = F.struct(F.col(hour).cast("int").alias(hour), *rest)
    known = spread(df, *keys).distinct().filter(F.col(hour).between(0, 23)).groupBy(*keys).agg(F.collect_list(entry).alias("_facts"))
    kind = known.schema["_facts"].dataType
    blank = [F.lit(None).cast(kind.elementType[c].dataType).alias(c) for c in rest]
    facts = F.coalesce("_facts", F.array().cast(kind))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(23)), facts[hour])
    rows = F.concat(facts, F.transform(missing, lambda h: F.struct(h.alias(hour), *blank)))
    return spread(days, *keys).join(known, keys, "left").select(*days.columns, F.inline(rows))


def densify(df: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Grid left join facts; missing facts are null rows. The keys of the grid are unique.

    Equal facts are dropped before the join, in the partitioning that the join needs.
    """
    return grid.join(df.repartition(*keys).distinct(), keys, "left")


def join_dim(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Left join on differently named keys; the dimension's key is dropped."""
    return df.join(dim.withColumnRenamed(dim_key, "_dim_key"), F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def others(df: DataFrame, exclude: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row (the first in ``order``) of every key outside the list."""
    from docksense.operators.clean import dedupe_by

    return dedupe_by(df.join(exclude.select(key), key, "left_anti"), [key], order)


def existing_dates(df: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Dates of ``df`` for which the target already has rows."""
    return df.select(col).distinct().join(target.select(col), col, "left_semi")


def serves_edges(trucks: DataFrame, stations: DataFrame) -> DataFrame:
    """truck -> station edges."""
    s = stations.select(F.col("truck").alias("src"), F.col("station_id").alias("dst"))
    return s.join(trucks.select(F.col("truck_id").alias("src")), "src").select("src", "dst")


def compare_forecast(actual: DataFrame, forecast: DataFrame, n: int = 24) -> DataFrame:
    """Last ``n`` actual hours per station, in time order, next to the predictions of the same position."""
    from docksense.operators.windows import tail_per_key

    last = tail_per_key(actual, ["station_id"], ["last_reported_local"], n, position="pos")
    return last.join(forecast, ["station_id", "pos"], "left")


def attach_info(metric: DataFrame, info: DataFrame, key: str = "station_id") -> DataFrame:
    return metric.join(info, key, "left")
