"""Projections, filters, typing and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docksense.functions.calendar import from_epoch, utc_to_local

# fixed values: order of the density classes
LEVELS = {"low": 1, "medium": 2, "high": 3, "very_high": 4}


def select_as(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Choose columns, new name -> source name; source names are taken literally, dots included."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in mapping.items()])


def epoch_to_ts(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, from_epoch(col))


def add_local_time(df: DataFrame, cols: dict[str, str], zone: str = "Europe/Madrid") -> DataFrame:
    """For each UTC column -> stem: ``<stem>_local``, ``date_<stem>`` and ``hour_<stem>`` (HH:mm:ss)."""
    out = {}
    for src, stem in cols.items():
        local = utc_to_local(src, zone)
        out[f"{stem}_local"] = local
        out[f"date_{stem}"] = F.to_date(local)
        out[f"hour_{stem}"] = F.date_format(local, "HH:mm:ss")
    return df.withColumns(out)


def explode_status(df: DataFrame, col: str = "status", nested: str | None = "weather") -> DataFrame:
    """One row per array entry, entry fields as columns; the struct ``nested`` inside is flattened too."""
    rest = [c for c in df.columns if c != col]
    out = df.select(*rest, F.explode(col).alias("_s")).select(*rest, "_s.*")
    if nested and nested in out.columns:
        out = out.select(*[c for c in out.columns if c != nested], f"{nested}.*")
    return out


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def area_layer(df: DataFrame, name: str, geometry: str, drop: list[str]) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed({name: "name", geometry: "geometry"})


def normalise_types(df: DataFrame, spec: dict[str, str], nested: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Cast columns, and fields inside array columns; values that do not fit become null.

    Dates must read ``yyyy-MM-dd``; otherwise they are left out (null).
    """
    casts = {}
    for c, kind in spec.items():
        if kind == "date":
            casts[c] = F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
        else:
            casts[c] = F.col(c).try_cast(kind)
    for arr, fields in (nested or {}).items():
        casts[arr] = F.transform(arr, _cast_fields(fields))
    return df.withColumns(casts)


def _cast_fields(fields: dict[str, str]):
    def fix(entry: Column) -> Column:
        out = entry
        for f, kind in fields.items():
            out = out.withField(f, entry[f].try_cast(kind))
        return out

    return fix


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop()


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def dedupe(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedupe_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; a plain aggregate, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def pad_post_code(df: DataFrame, col: str = "post_code") -> DataFrame:
    return df.withColumn(col, F.concat(F.lit("0"), F.col(col).cast("string")))


def between_dates(df: DataFrame, col: str, first: str, last: str) -> DataFrame:
    return df.filter(F.col(col).cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def split_by_date(df: DataFrame, col: str, train: tuple[str, str], test: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Two inclusive date ranges."""
    return between_dates(df, col, *train), between_dates(df, col, *test)


def between_times(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return df.filter(F.col(col).between(lo, hi))


def holiday_calendar(general: DataFrame, local: DataFrame, years: tuple[int, int], town: str, kind: str) -> DataFrame:
    """National days of the given years plus the town's days of one kind, each date once."""
    def shape(df, year_col):
        year = F.col(year_col).cast("int")
        return df.filter(year.between(*years)).select(year.alias("any"), F.col("data").cast("date").alias("data"))

    picked = local.filter((F.col("ajuntament_o_nucli_municipal") == town) & (F.col("festiu") == kind))
    return shape(general, "any").union(shape(picked, "any_calendari")).distinct()


def in_service(df: DataFrame, cutoff: str, min_days: int) -> DataFrame:
    """Stations still seen at the cut-off or in service for more than ``min_days``."""
    lasting = F.datediff("end_date", "creation_date") > min_days
    return df.filter((F.col("end_date") >= F.lit(cutoff).cast("date")) | lasting)


def min_levels(df: DataFrame, thresholds: dict[str, int]) -> DataFrame:
    rank = F.create_map(*[F.lit(v) for kv in LEVELS.items() for v in kv])
    for field, least in thresholds.items():
        if least > 0:
            df = df.filter(F.try_element_at(rank, F.col(field)) >= least)
    return df


def with_reason(df: DataFrame, value: str, col: str = "reason") -> DataFrame:
    return df.filter(F.array_contains(col, value))


def flatten_class(df: DataFrame, fields: list[str]) -> DataFrame:
    out = {}
    for f in fields:
        out[f"{f}_class"] = F.coalesce(F.col(f).classification, F.lit("unknown"))
        out[f"{f}_count"] = F.coalesce(F.col(f)["count"], F.lit(0))
    return df.withColumns(out).drop(*fields)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def area_named(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("name") == name)


def drop_noise(df: DataFrame, col: str = "cluster") -> DataFrame:
    return df.filter(F.col(col) != -1)


def site_filters(df: DataFrame, min_station: float = 200, max_lane: float = 60) -> DataFrame:
    return df.filter((F.col("dist_bike_station") > min_station) & (F.col("dist_bike_lanes") < max_lane))


def min_entries(df: DataFrame, col: str, more_than: int = 1) -> DataFrame:
    return df.filter(F.size(col) > more_than)


def flag_popular(stations: DataFrame, top: DataFrame, key: str = "station_id") -> DataFrame:
    """``Is_popular`` = Yes for the listed stations, No elsewhere."""
    listed = top.select(key).distinct().withColumn("_hit", F.lit(True))
    return stations.join(listed, key, "left").withColumn(
        "Is_popular", F.when(F.col("_hit"), "Yes").otherwise("No")
    ).drop("_hit")


def fill_expr(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Computed values only where the column is null."""
    return df.withColumns({c: F.coalesce(F.col(c), e) for c, e in exprs.items()})


def null_if_text(df: DataFrame) -> DataFrame:
    """Empty text to null in all text columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})
