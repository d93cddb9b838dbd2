"""Schemas of the landed inputs."""

from pyspark.sql import types as T

LIVE_STATUS = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("num_bikes_available", T.IntegerType()),
    T.StructField("num_bikes_available_types", T.StructType([
        T.StructField("mechanical", T.IntegerType()),
        T.StructField("ebike", T.IntegerType()),
    ])),
    T.StructField("num_docks_available", T.IntegerType()),
    T.StructField("last_reported", T.LongType()),
    T.StructField("is_charging_station", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("is_installed", T.IntegerType()),
    T.StructField("is_renting", T.IntegerType()),
    T.StructField("is_returning", T.IntegerType()),
    T.StructField("traffic", T.StringType()),
])

STATION_FEED = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("physical_configuration", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("address", T.StringType()),
    T.StructField("post_code", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("is_charging_station", T.BooleanType()),
    T.StructField("short_name", T.IntegerType()),
    T.StructField("nearby_distance", T.DoubleType()),
    T.StructField("_ride_code_support", T.BooleanType()),
    T.StructField("rental_uris", T.StringType()),
])

STOP = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("station_id", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("check_status", T.StringType()),
    T.StructField("num_bikes_available", T.IntegerType()),
    T.StructField("bikes_to_refill", T.IntegerType()),
    T.StructField("bikes_to_remove", T.IntegerType()),
    T.StructField("truck", T.IntegerType()),
])

TRUCK_ROUTE = T.StructType([
    T.StructField("truck_id", T.IntegerType()),
    T.StructField("optimal_route", T.ArrayType(STOP)),
    T.StructField("distance", T.DoubleType()),
    T.StructField("balance_bicicletas", T.LongType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("parts", T.IntegerType()),
])

WEATHER_FILE = T.StructType([
    T.StructField("codi", T.StringType()),
    T.StructField("lectures", T.ArrayType(T.StructType([
        T.StructField("data", T.StringType()),
        T.StructField("valor", T.DoubleType()),
    ]))),
])
