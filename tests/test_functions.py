import datetime as dt

import pytest
from pyspark.sql import functions as F

from docksense.functions import calendar as cal
from docksense.functions import geo, status, text
from docksense.functions import geometry as geom


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_status_thresholds(spark):
    df = spark.createDataFrame(
        [(6, 20), (7, 20), (20, 20), (6, 0), (6, None), (None, 20), (9, 30), (30, 30)], "num_bikes_available int, capacity int")
    got = [tuple(r)[2:] for r in status.classify(df).collect()]
    assert got == [("low", 9, None), ("sufficient", None, None), ("full", None, 5), ("undefined", None, None),
                   ("undefined", None, None), ("undefined", None, None), ("low", 13, None), ("full", None, 7)]


def test_sql_functions_agree(spark):
    status.register_sql_functions(spark)
    df = spark.range(24).selectExpr("cast(id as int) h", "cast(id as int) b", "20 c", "date_add(date'2024-03-10', cast(id * 15 as int)) d")
    same = df.select(
        (F.expr("hour_band(h)") == cal.hour_band("h")).alias("x"), (F.expr("season(d)") == cal.season("d")).alias("y"),
        (F.expr("check_status(b, c)") == status.check_status("b", "c")).alias("z"),
        (F.abs(F.expr("haversine(2D, 41D, 2.1D, 41.1D)") - geo.haversine(F.lit(2.0), F.lit(41.0), F.lit(2.1), F.lit(41.1))) < 1e-6).alias("w"))
    assert same.filter("x and y and z and w").count() == 24


def test_seasons_and_bands(spark):
    days = ["2024-03-20", "2024-03-21", "2024-06-20", "2024-06-21", "2024-09-22", "2024-09-23", "2024-12-20", "2024-12-21"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r[0] for r in df.select(cal.season(F.to_date("d"))).collect()]
    assert got == ["Invierno", "Primavera", "Primavera", "Verano", "Verano", "Otoño", "Otoño", "Invierno"]
    bands = [r[0] for r in spark.range(24).select(cal.hour_band(F.col("id"))).collect()]
    assert [bands.count(b) for b in ("night", "early_morning", "morning", "afternoon", "evening")] == [6, 4, 5, 5, 4]


def test_local_time_over_clock_changes(spark):
    utc = ["2024-03-31 00:59:59", "2024-03-31 01:00:00", "2024-10-27 00:30:00", "2024-10-27 01:30:00"]
    df = spark.createDataFrame([(u,) for u in utc], "u string").select(cal.utc_to_local(F.col("u").cast("timestamp_ntz")).alias("l"))
    assert [r["l"].strftime("%d %H:%M") for r in df.collect()] == ["31 01:59", "31 03:00", "27 02:30", "27 02:30"]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        got = one(spark, cal.from_epoch(F.lit(1711846800)), cal.floor_time(cal.from_epoch(F.lit(1711848599)), 1800),
                  cal.parse_iso(F.lit("2024-03-01T10:30Z")), cal.parse_iso(F.lit("no")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == (dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 3, 1, 10, 30), None)


def test_text(spark):
    assert one(spark, text.title_es(F.lit("PLAÇA DE LA sant-antoni  i l'eixample")), text.format_es(F.lit(1234567.5)),
               text.level_colour(F.lit("none")), text.truck_colour(F.lit(25)), text.truck_colour(F.lit(1))) == (
        "Plaça de la Sant-Antoni I L'Eixample", "1.234.567,50", "#808080", [255, 255, 255], [0, 255, 0])


def test_efficiency_without_slots_is_null(spark):
    assert one(spark, status.efficiency(F.lit(0), F.lit(0), F.lit(1), F.lit(1)), status.rate_band(F.lit(None).cast("double"))) == (None, None)


def test_utm_round_trip_and_known_point(spark):
    x, y = geo.to_utm31(F.lit(2.1686), F.lit(41.3874))
    lon, lat = geo.from_utm31(x, y)
    got = one(spark, x, y, lon, lat)
    assert abs(got[2] - 2.1686) < 5e-9 and abs(got[3] - 41.3874) < 5e-9
    on_axis = one(spark, *geo.to_utm31(F.lit(3.0), F.lit(0.0)))
    assert on_axis == pytest.approx((500000.0, 0.0), abs=1e-6)


def test_distance_of_nothing_is_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, geo.haversine(null, null, F.lit(1.0), F.lit(1.0))) == (None,)


@pytest.mark.parametrize("wkt, kind, sizes", [
    ("POINT(1 2)", "POINT", [1]),
    ("POLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON", [4]),
    ("polygon((0 0,4 0,4 4,0 4,0 0),( 1 1, 2 1, 2 2, 1 1 ))", "POLYGON", [5, 4]),
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "MULTIPOLYGON", [4, 4]),
    ("POLYGON ((0 0, 1", None, None), ("rubbish", None, None), ("POINT(a b)", None, None), ("", None, None),
])
def test_wkt(spark, wkt, kind, sizes):
    g = spark.createDataFrame([(wkt,)], "w string").select(geom.parse_wkt("w").alias("g")).first()["g"]
    if kind is None:
        assert g is None
    else:
        assert g["kind"] == kind and [len(r) for r in g["rings"]] == sizes


def test_hole_and_boundary(spark):
    poly = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    pts = [(0.5, 0.5), (1.5, 1.5), (0.0, 2.0), (4.0, 4.0), (5.0, 1.0), (3.0, 3.0)]
    df = spark.createDataFrame([(poly, x, y) for x, y in pts], "w string, x double, y double")
    df = df.withColumn("e", geom.edges(geom.parse_wkt("w")))
    got = df.select(geom.covers("e", "x", "y", False), geom.covers("e", "x", "y", True)).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, True]
    assert [r[1] for r in got] == [True, False, True, True, False, True]


def test_geojson_text(spark):
    g = geom.parse_wkt(F.lit("POLYGON ((0 0, 1 0, 1 1, 0 0))"))
    assert one(spark, geom.geometry_json(g)) == ('{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]]}',)


GEOJSON = {
    "Point": "[1.0,2.0]", "LineString": "[[0.0,0.0],[1.0,2.0]]", "MultiLineString": "[[[0.0,0.0],[1.0,2.0]],[[5.0,5.0],[6.0,6.0]]]",
    "Polygon": "[[[0.0,0.0],[4.0,0.0],[4.0,4.0],[0.0,0.0]],[[1.0,1.0],[2.0,1.0],[2.0,2.0],[1.0,1.0]]]",
    "MultiPolygon": "[[[[0.0,0.0],[4.0,0.0],[4.0,4.0],[0.0,0.0]],[[1.0,1.0],[2.0,1.0],[2.0,2.0],[1.0,1.0]]],"
                    "[[[9.0,0.0],[9.0,1.0],[8.0,1.0],[9.0,0.0]]]]",
}


@pytest.mark.parametrize("kind", GEOJSON)
def test_geojson_round_trip(spark, kind):
    doc = f'{{"type":"{kind}","coordinates":{GEOJSON[kind]}}}'
    df = spark.createDataFrame([(doc,), ('{"type":"%s"}' % kind,), ('{"type":"Circle","coordinates":[1]}',), ("{",), (None,)], "geometry string")
    # text; a struct of text coordinates; a struct whose arrays the reader has typed
    forms = [df, df.select(F.from_json("geometry", "type string, coordinates string").alias("geometry")),
             spark.read.json(spark.createDataFrame([(f'{{"geometry":{doc}}}',)], "v string").rdd.map(lambda r: r.v))]
    for form in forms:
        got = geom.parse_geometry(form).select(geom.geometry_json("geometry")).collect()
        assert [r[0] for r in got] == [doc]


def test_wkt_keeps_holes_with_their_polygon(spark):
    text = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1)), ((9 0, 9 1, 8 1, 9 0)))"
    g = geom.parse_wkt(F.lit(text))
    doc = f'{{"type":"MultiPolygon","coordinates":{GEOJSON["MultiPolygon"]}}}'
    assert one(spark, geom.geometry_json(g)) == (doc,)
    assert one(spark, geom.parse_wkt(F.lit("MULTIPOLYGON EMPTY"))) == (None,)
