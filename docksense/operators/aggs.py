"""Grouped summaries, rankings, profiles and set operations."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docksense.functions.status import efficiency, rotation

DISTANCES = ["dist_education", "dist_shopping", "dist_bike_lanes", "dist_cpoi", "dist_bus_stops",
             "dist_metro_stations", "dist_bike_station"]
REASONS = ["No Bikes", "No Docks", "High Rotation"]


def daily_info(df: DataFrame, keys: list[str], first_cols: list[str], order: list[str], max_col: str) -> DataFrame:
    """Per key: earliest attributes and the largest capacity."""
    at = F.struct(*order)
    first = F.min_by(F.struct(*first_cols), at)
    return df.groupBy(*keys).agg(first.alias("_f"), F.max(max_col).alias(f"max_{max_col}")).select(
        *keys, "_f.*", f"max_{max_col}"
    )


def hourly_demand(df: DataFrame) -> DataFrame:
    return df.groupBy("station_id", "date_reported", "hora_dia").agg(
        F.sum("bikes_taken").cast("int").alias("total_bikes_taken"),
        F.sum("bikes_returned").cast("int").alias("total_bikes_returned"),
        F.max("last_reported_local").alias("last_reported_local"),
    )


def nest_hours(df: DataFrame, keys: list[str], fields: list[str], out: str = "status") -> DataFrame:
    """Sorted array of entry structs per key; the input is at hour grain."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(out))


def mode_rows(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Most frequent combination of ``cols`` per group, ties to the smallest combination."""
    counted = df.groupBy(*group, *cols).agg(F.count("*").alias("_n"))
    best = F.min_by(F.struct(*cols), F.struct(-F.col("_n"), *cols))
    return counted.groupBy(*group).agg(best.alias("_b")).select(*group, "_b.*")


def station_documents(modes: DataFrame, info: DataFrame, key: str = "station_id") -> DataFrame:
    """Station-day documents with the hours in order, attributes joined to the nested result."""
    days = nest_hours(
        modes.select(key, "date", F.col("hora_dia").alias("hour"), "num_bikes_available", "num_docks_available"),
        [key, "date"], ["hour", "num_bikes_available", "num_docks_available"],
    )
    return days.join(info, key, "left")


def shortage_stations(docs: DataFrame, field: str, k: int | None = 10) -> DataFrame:
    """Stations by average monthly number of hours in which ``field`` is 0 (months without any do not count)."""
    hours = F.size(F.filter("status", lambda s: s[field] == 0))
    per_doc = docs.select("station_id", "date", hours.alias("n")).filter(F.col("n") > 0)
    monthly = per_doc.groupBy("station_id", F.year("date").alias("y"), F.month("date").alias("m")).agg(F.sum("n").alias("n"))
    out = monthly.groupBy("station_id").agg(
        (F.sum("n") / F.count("*")).alias("avg_monthly_count"), F.count("*").alias("months_count")
    )
    return top_k(out, "avg_monthly_count", k, "station_id") if k else out


def complete_days(docs: DataFrame) -> DataFrame:
    """Documents with all 24 hours: a missing hour has the values of the day's hour before it, or of its first hour."""
    def at(status, h):
        known = F.filter(status, lambda s: s.hour <= h)
        return F.coalesce(F.try_element_at(known, F.lit(-1)), F.get(status, F.lit(0))).withField("hour", h)

    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: at(F.col("status"), h))
    return docs.withColumn("status", hours)


def rotation_stations(docs: DataFrame, k: int | None = 10, positions: int = 24, skip_incomplete: bool = False) -> DataFrame:
    """Stations by average daily sum of absolute changes over the day's positions.

    A day with fewer entries adds 0 to the sum and 1 to the count, unless ``skip_incomplete``.
    """
    bikes = F.col("status.num_bikes_available")
    # the values are taken from the entries twice a day, not twice an hour
    steps = F.zip_with(F.slice(bikes, 1, positions - 1), F.slice(bikes, 2, positions - 1), lambda a, b: F.abs(b - a))
    moved = F.when(F.size(bikes) >= positions, F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, v: acc + v))
    days = docs.select("station_id", moved.alias("moved"))
    if skip_incomplete:
        days = days.filter(F.col("moved").isNotNull())
    out = days.groupBy("station_id").agg(
        (F.coalesce(F.sum("moved"), F.lit(0)) / F.count("*")).alias("avg_daily_rotation"), F.count("*").alias("count")
    )
    return top_k(out, "avg_daily_rotation", k, "station_id") if k else out


def popular_stations(bikes: DataFrame, docks: DataFrame, moved: DataFrame) -> DataFrame:
    """Three ranked lists (each of at most k rows) to one row per station with its reasons in list order."""
    parts = [
        df.select("station_id", F.lit(i).alias("_i"), F.lit(reason).alias("_r"))
        for i, (df, reason) in enumerate(zip((bikes, docks, moved), REASONS))
    ]
    tagged = functools.reduce(DataFrame.unionByName, parts)
    ordered = F.sort_array(F.collect_list(F.struct("_i", "_r")))
    return tagged.groupBy("station_id").agg(F.transform(ordered, lambda s: s["_r"]).alias("reason"))


def null_percentages(df: DataFrame) -> DataFrame:
    """Share of nulls per column in percent, one pass; no rows for empty input."""
    shares = [F.sum(F.col(f"`{c}`").isNull().cast("int")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count("*").alias("n"), *shares).filter(F.col("n") > 0)
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col(f"n{i}") * 100.0 / F.col("n")).cast("double").alias("null_pct"))
        for i, c in enumerate(df.columns)
    ])
    return row.select(F.inline(items))


def null_report(df: DataFrame, date_col: str, cols: list[str], text_cols: list[str] = ("name", "address")) -> DataFrame:
    """Rows with any missing attribute per station, year and month; empty text counts for ``text_cols``."""
    missing = functools.reduce(
        Column.__or__,
        [F.col(c).isNull() | ((F.col(c) == "") if c in text_cols else F.lit(False)) for c in cols],
    )
    out = df.filter(missing).groupBy("station_id", F.year(date_col).alias("year"), F.month(date_col).alias("month"))
    return order_by(out.agg(F.count("*").alias("count")), ["station_id", "year", "month"])


def lifespan(df: DataFrame, date: Column | str = "date_reported") -> DataFrame:
    return df.groupBy("station_id").agg(F.min(date).alias("creation_date"), F.max(date).alias("end_date"))


def rank_thresholds(df: DataFrame, col: str, shares: tuple = (0.25, 0.60, 0.75), by: list[str] = ()) -> DataFrame:
    """Per group one row: the value at 0-based position ``int(n * share)`` of the sorted column, per share.

    ``col`` is a count: the ranks are found on the histogram, and counts that sum to N have at most about sqrt(2N)
    distinct values, which bounds the ordered task of a group. For other columns there is ``exact_quantiles``.
    """
    hist = df.groupBy(*by, F.col(col).alias("v")).agg(F.count("*").alias("f"))
    upto = hist.withColumns({
        "hi": F.sum("f").over(W.partitionBy(*by).orderBy("v").rowsBetween(W.unboundedPreceding, 0)),
        "n": F.sum("f").over(W.partitionBy(*by)),
    })
    at = [F.floor(F.col("n") * F.lit(p)) for p in shares]
    return upto.groupBy(*by).agg(*[F.min(F.when(F.col("hi") > a, F.col("v"))).alias(f"t{i}") for i, a in enumerate(at)])


def density_class(df: DataFrame, col: str = "count", out: str = "classification",
                  shares: tuple = (0.25, 0.60, 0.75), by: list[str] = ()) -> DataFrame:
    """``low`` / ``medium`` / ``high`` / ``very_high`` by inclusive rank thresholds, within each group of ``by``."""
    limits = rank_thresholds(df, col, shares, by).select(*by, F.struct("t0", "t1", "t2").alias("_t"))
    graded = df.join(limits, list(by)) if by else df.withColumn("_t", limits.scalar())
    v, t = F.col(col), F.col("_t")
    label = F.when(v <= t.t0, "low").when(v <= t.t1, "medium").when(v <= t.t2, "high").otherwise("very_high")
    return graded.withColumn(out, label).drop("_t")


def station_means(df: DataFrame) -> DataFrame:
    """Mean total movement and mean efficiency per station."""
    eff = efficiency("num_bikes_available", "num_docks_available", "total_bikes_taken", "total_bikes_returned")
    return df.groupBy("station_id").agg(F.avg(rotation()).alias("rotacion"), F.avg(eff).alias("tasa_eficiencia_ajustada"))


def distance_summary(proposed: DataFrame, top: DataFrame, cols: list[str] = DISTANCES) -> DataFrame:
    """Mean distances (2 decimals) of proposed sites, popular stations and the popular ones of each reason."""
    from docksense.operators.clean import drop_noise

    groups = drop_noise(proposed).select(F.lit("Proposed").alias("grp"), *cols)
    groups = groups.unionByName(top.select(F.lit("Top Stations").alias("grp"), *cols))
    groups = groups.unionByName(top.select(F.explode("reason").alias("grp"), *cols))
    wide = groups.groupBy("grp").agg(*[F.avg(c).alias(c) for c in cols])
    long = wide.unpivot(["grp"], cols, "metric", "mean")
    return long.withColumn("mean", F.round("mean", 2))


def total_bounds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    from docksense.functions.geometry import bounds

    boxes = df.select(*[c.alias(n) for n, c in bounds(geometry).items()])
    return boxes.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                     F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def truck_balance(stations: DataFrame) -> DataFrame:
    """Bikes to bring minus bikes to take away per truck."""
    moved = (
        F.when(F.col("check_status") == "low", F.coalesce("bikes_to_refill", F.lit(0)))
        .when(F.col("check_status") == "full", -F.coalesce("bikes_to_remove", F.lit(0)))
        .otherwise(0)
    )
    return stations.groupBy("truck").agg(F.sum(moved).alias("balance_bicicletas"))


def audit_counts(**parts: DataFrame) -> DataFrame:
    """Row count per named table."""
    counted = [df.agg(F.lit(name).alias("part"), F.count("*").alias("rows")) for name, df in parts.items()]
    return functools.reduce(DataFrame.unionByName, counted)


def distinct_days(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.to_date(col).alias("day")).distinct()


def backfill_info(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """The earliest row's non-null attributes go to all rows of the key; keys whose earliest row has none drop out."""
    first = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_f"))
    any_value = functools.reduce(Column.__or__, [F.col("_f")[c].isNotNull() for c in cols])
    out = df.join(first.filter(any_value), key)
    return out.withColumns({c: F.coalesce(F.col("_f")[c], F.col(c)) for c in cols}).drop("_f")


def time_bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("first_ts"), F.max(col).alias("last_ts"))


def names(df: DataFrame, col: str = "name") -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def centroid(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def best_per_cluster(df: DataFrame, score: str = "similarity_score", tie: str = "point_id") -> DataFrame:
    rest = [c for c in df.columns if c != "cluster"]
    best = F.max_by(F.struct(*rest), F.struct(score, -F.col(tie)))
    return df.groupBy("cluster").agg(best.alias("_b")).select("cluster", "_b.*")


def top_k(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    """The k largest by ``col``; each task keeps k rows, so no global sort."""
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie)).limit(k)


def order_by(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.orderBy(*cols)


def row_cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame, by_name: bool = False) -> DataFrame:
    return functools.reduce(DataFrame.unionByName if by_name else DataFrame.union, dfs)


def is_empty(df: DataFrame) -> bool:
    """An action; for job edges only."""
    return df.isEmpty()


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and R2 in one pass plus the label mean."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.agg(F.count("*").alias("n"), F.sum((y - p) * (y - p)).alias("sse"), F.var_pop(y).alias("var"))
    return sums.select(
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (1 - F.try_divide(F.col("sse"), F.col("n") * F.col("var"))).alias("r2"),
    )
