"""Station status, balance and efficiency columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: share of the capacity kept free, share that marks a station low, target fill
FREE_SHARE, LOW_SHARE, FILL_SHARE = 0.25, 0.4, 0.75


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_status(bikes="num_bikes_available", capacity="capacity") -> Column:
    """``undefined``, ``low``, ``full`` or ``sufficient``."""
    b, c = _col(bikes), _col(capacity)
    return (
        F.when(b.isNull() | c.isNull() | (c == 0), "undefined")
        .when(b <= LOW_SHARE * (c - FREE_SHARE * c), "low")
        .when(b == c, "full")
        .otherwise("sufficient")
    )


def bikes_to_refill(status="check_status", bikes="num_bikes_available", capacity="capacity") -> Column:
    return F.when(_col(status) == "low", (FILL_SHARE * _col(capacity) - _col(bikes)).cast("int"))


def bikes_to_remove(status="check_status", capacity="capacity") -> Column:
    return F.when(_col(status) == "full", (FREE_SHARE * _col(capacity)).cast("int"))


def classify(df: DataFrame) -> DataFrame:
    """Add ``check_status``, ``bikes_to_refill`` and ``bikes_to_remove``."""
    return df.withColumn("check_status", check_status()).withColumns(
        {"bikes_to_refill": bikes_to_refill(), "bikes_to_remove": bikes_to_remove()}
    )


def bikes_error(capacity="capacity", bikes="num_bikes_available", docks="num_docks_available") -> Column:
    """Slots neither free nor holding a usable bike; 0 for an unknown capacity."""
    c = _col(capacity)
    return F.when(c > 0, c - (_col(bikes) + _col(docks))).otherwise(0)


def efficiency(bikes, docks, taken, returned) -> Column:
    """Availability share damped by unbalanced flow and by empty or full stations."""
    b, d, t, r = (_col(x) for x in (bikes, docks, taken, returned))
    share = 0.5 + 0.5 * F.try_divide(b, b + d)
    balance = 1 - F.abs(t - r) / (t + r + 1)
    return share * balance * F.when(b == 0, 0.1).otherwise(1.0) * F.when(d == 0, 0.1).otherwise(1.0)


def rate_band(rate) -> Column:
    x = _col(rate)
    return (
        F.when(x < 0.4, "red").when(x < 0.5, "orange").when(x < 0.6, "blue").when(x.isNotNull(), "green")
    )


def rotation(taken="total_bikes_taken", returned="total_bikes_returned") -> Column:
    return _col(taken) + _col(returned)


def register_sql_functions(spark: SparkSession) -> None:
    """SQL forms of the scalar columns, inlined by the optimizer (no Python in the plan)."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION check_status(b INT, c INT) RETURNS STRING RETURN
        CASE WHEN b IS NULL OR c IS NULL OR c = 0 THEN 'undefined'
             WHEN b <= {LOW_SHARE}D * (c - {FREE_SHARE}D * c) THEN 'low'
             WHEN b = c THEN 'full' ELSE 'sufficient' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION hour_band(h INT) RETURNS STRING RETURN
        CASE WHEN h BETWEEN 0 AND 5 THEN 'night' WHEN h BETWEEN 6 AND 9 THEN 'early_morning'
             WHEN h BETWEEN 10 AND 14 THEN 'morning' WHEN h BETWEEN 15 AND 19 THEN 'afternoon'
             WHEN h BETWEEN 20 AND 23 THEN 'evening' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION season(d DATE) RETURNS STRING RETURN
        CASE WHEN month(d) * 100 + day(d) BETWEEN 321 AND 620 THEN 'Primavera'
             WHEN month(d) * 100 + day(d) BETWEEN 621 AND 922 THEN 'Verano'
             WHEN month(d) * 100 + day(d) BETWEEN 923 AND 1220 THEN 'Otoño'
             WHEN d IS NOT NULL THEN 'Invierno' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION
        haversine(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE RETURN
        2 * 6371000D * asin(sqrt(least(1D, pow(sin(radians(lat2 - lat1) / 2), 2)
          + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))""")
