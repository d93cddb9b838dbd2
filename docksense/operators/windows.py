"""Ordered per-station work.

A station may hold a large part of all rows, so nothing here sorts a whole station in one task:
last / mean fills are aggregates joined back, rank filters are limited before the shuffle, and previous-row
work is split into time slices whose edges are carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docksense.functions import calendar as cal


def with_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str], slice_col: Column,
                  skip_nulls: bool = False, suffix: str = "_prev") -> DataFrame:
    """Add the value of the previous row (or of the last earlier non-null one) of the same keys.

    ``slice_col`` must not decrease along the first order column. Rows are shuffled by (keys, slice) only;
    one summary row per slice carries the last value into the next slice, and meets the rows in the
    partitioning they already have. Null keys are one key.
    """
    sliced = df.withColumn("_slice", slice_col)
    part = [*keys, "_slice"]
    inside = W.partitionBy(*part).orderBy(*order)
    carry_over = W.partitionBy(*keys).orderBy("_slice")
    at = F.struct(*order)
    if skip_nulls:
        before = inside.rowsBetween(W.unboundedPreceding, -1)
        local = {f"_l_{v}": F.last(v, ignorenulls=True).over(before) for v in values}
        ends = [F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(f"_e_{v}") for v in values]
        earlier = carry_over.rowsBetween(W.unboundedPreceding, -1)
        carried = {f"_c_{v}": F.last(f"_e_{v}", ignorenulls=True).over(earlier) for v in values}
    else:
        row = F.struct(*values)
        local = {"_l": F.lag(row).over(inside)}
        ends = [F.max_by(row, at).alias("_e")]
        carried = {"_c": F.lag("_e").over(carry_over)}
    edges = sliced.groupBy(*part).agg(*ends).withColumns(carried).select(*part, *carried)
    out = sliced.withColumns(local)
    names = {c: f"_k{i}" for i, c in enumerate(part)}
    edges = edges.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()]  # a null key is a key
    joined = out.join(edges, same, "left").drop(*names.values())
    if skip_nulls:
        prev = [F.coalesce(f"_l_{v}", f"_c_{v}").alias(f"{v}{suffix}") for v in values]
    else:
        joined = joined.withColumn("_p", F.coalesce("_l", "_c"))
        prev = [F.col(f"_p.{v}").alias(f"{v}{suffix}") for v in values]
    return joined.select(*df.columns, *prev)


def demand_from_lag(df: DataFrame, keys: list[str] = ("station_id", "file_date"), ts: str = "last_reported_local",
                    tie: str = "event_id", slice_seconds: int = 3600) -> DataFrame:
    """``bikes_taken`` / ``bikes_returned`` against the previous reading of the station in the same file day."""
    bikes = "num_bikes_available"
    slot = F.floor(cal.to_epoch(ts) / slice_seconds)
    out = with_previous(df, list(keys), [ts, tie], [bikes], slot, suffix="_lag")
    diff = F.col(bikes) - F.col(f"{bikes}_lag")
    return out.withColumn("diferencia_bicis", diff).withColumns({
        "bikes_taken": F.when(diff < 0, -diff).otherwise(0),
        "bikes_returned": F.when(diff > 0, diff).otherwise(0),
    })


def latest_info(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Newest row per key."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("_r")).select(key, "_r.*").select(*df.columns)


def gap_values(df: DataFrame, key: str, order: list[str], last_cols: list[str], int_cols: list[str],
               dec_cols: list[str]) -> DataFrame:
    """One row per key: the last non-null value of ``last_cols`` and the means of the others, each column as ``_g_<name>``."""
    at = F.struct(*order) if order else None
    stats = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_g_{c}") for c in last_cols]
    stats += [F.round(F.avg(c)).cast("int").alias(f"_g_{c}") for c in int_cols]
    stats += [F.avg(c).alias(f"_g_{c}") for c in dec_cols]
    return df.groupBy(key).agg(*stats)


def take_gap_values(df: DataFrame, last_cols: list[str], int_cols: list[str], dec_cols: list[str]) -> DataFrame:
    """Fill rows that carry the ``gap_values`` of their key, which are dropped."""
    filled = {c: F.col(f"_g_{c}") for c in last_cols}
    filled |= {c: F.coalesce(F.col(c), F.col(f"_g_{c}")) for c in [*int_cols, *dec_cols]}
    return df.withColumns(filled).drop(*[f"_g_{c}" for c in filled])


def fill_station_gaps(df: DataFrame, key: str, order: list[str], last_cols: list[str], int_cols: list[str],
                      dec_cols: list[str], facts: DataFrame | None = None) -> DataFrame:
    """Last-known and mean fills from one summary row per key.

    ``facts`` may hold just the rows with values, when ``df`` is those rows plus gaps.

    ``last_cols`` take the key's last non-null value in all rows; nulls of ``int_cols`` and ``dec_cols`` become the
    key's mean, rounded for the former.
    """
    values = gap_values(df if facts is None else facts, key, order, last_cols, int_cols, dec_cols)
    return take_gap_values(df.join(values, key, "left"), last_cols, int_cols, dec_cols).select(*df.columns)


def fill_last_known(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """Every row gets the key's last non-null value of each column."""
    return fill_station_gaps(df, key, order, cols, [], [])


def fill_partition_mean(df: DataFrame, key: str, int_cols: list[str], dec_cols: list[str]) -> DataFrame:
    """Nulls become the key's mean, rounded for integer columns."""
    return fill_station_gaps(df, key, [], [], int_cols, dec_cols)


def forward_fill_zero(df: DataFrame, key: str = "station_id", order: list[str] = ("last_reported_local", "event_id"),
                      slice_seconds: int = 86400) -> DataFrame:
    """Rows with neither bikes nor docks take the station's previous availability."""
    cols = ["num_bikes_available", "num_docks_available"]
    empty = (F.col(cols[0]) == 0) & (F.col(cols[1]) == 0)
    blanked = df.withColumns({c: F.when(~empty, F.col(c)) for c in cols})
    slot = F.floor(cal.to_epoch(order[0]) / slice_seconds)
    out = with_previous(blanked, [key], list(order), cols, slot, skip_nulls=True)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_prev")) for c in cols}).drop(*[f"{c}_prev" for c in cols])


def tail_per_key(df: DataFrame, keys: list[str], order: list[str], n: int = 24, position: str | None = None) -> DataFrame:
    """Last ``n`` rows per key; the rank filter keeps n rows per key and task before the shuffle.

    ``position`` numbers the kept rows from 1 in ascending order.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    kept = df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    if position:
        kept = kept.withColumn(position, F.row_number().over(W.partitionBy(*keys).orderBy(F.col("_rn").desc())))
    return kept.drop("_rn")


def first_per_bucket(df: DataFrame, keys: list[str], ts: str, tie: str, seconds: int = 1800) -> DataFrame:
    """First reading of each key and time bucket."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(ts, tie))
    bucket = cal.floor_time(ts, seconds).alias("bucket")
    return df.groupBy(*keys, bucket).agg(first.alias("_r")).select("bucket", *keys, "_r.*")


def last_in_group(df: DataFrame, keys: list[str], ts: str, sums: dict[str, str], keep_ties: bool = True,
                  tie: str | None = None) -> DataFrame:
    """Rows at the latest time of each group, with sums over the whole group.

    Both the rank filter and the sums shrink before their shuffle, which share the group keys.
    """
    order = [F.col(ts).desc()] + ([] if keep_ties else [F.col(tie).desc()])
    rank = F.rank() if keep_ties else F.row_number()
    last = df.withColumn("_rk", rank.over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_rk") == 1).drop("_rk")
    totals = df.groupBy(*keys).agg(*[F.sum(c).cast("int").alias(out) for out, c in sums.items()])
    return last.join(totals, keys)
