"""Geometry values: ``struct<kind, rings array<array<struct<x,y>>>, parts array<int>>``.

A ring is any run of points: a point, a line, or the shell or a hole of a polygon. ``parts`` names the polygon (or line,
or point) that each ring belongs to, so that the holes of a multi-part geometry stay with their shell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# kind -> GeoJSON name and the depth of its coordinates
KINDS = {"POINT": ("Point", 1), "LINESTRING": ("LineString", 2), "POLYGON": ("Polygon", 3),
         "MULTILINESTRING": ("MultiLineString", 3), "MULTIPOLYGON": ("MultiPolygon", 4)}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_parts(rings: Column) -> Column:
    return F.transform(rings, lambda r, i: F.lit(0))


def geometry(kind: Column, rings: Column, parts: Column | None = None) -> Column:
    """A geometry value; without ``parts`` all rings are of one part."""
    parts = _first_parts(rings) if parts is None else parts
    return F.struct(kind.alias("kind"), rings.alias("rings"), parts.alias("parts"))


def _valid(kind: Column, grouped: Column) -> Column:
    """Geometry of a known kind from the rings of each part; null if a coordinate is missing."""
    def build(rings_of):
        rings = F.flatten(rings_of)
        parts = F.flatten(F.transform(rings_of, lambda g, i: F.transform(g, lambda r: i)))
        bad = F.exists(rings, lambda r: (F.size(r) == 0) | F.exists(r, lambda p: p.x.isNull() | p.y.isNull()))
        return F.when(kind.isin(*KINDS) & (F.size(rings) > 0) & ~bad, geometry(kind, rings, parts))

    # the parsed rings are bound once by a one-element transform
    return F.get(F.transform(F.array(grouped), build), F.lit(0))


def parse_wkt(text) -> Column:
    """WKT to a geometry; any text that does not parse gives null.

    Polygons of a multi-part text are parted by two closing and two opening brackets, rings by one of each.
    """
    wkt = _col(text)
    kind = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))
    opened = F.length(F.regexp_replace(wkt, r"[^(]", ""))
    whole = (opened > 0) & (opened == F.length(F.regexp_replace(wkt, r"[^)]", ""))) & F.rlike(wkt, F.lit(r"\)\s*$"))
    body = F.regexp_replace(F.regexp_replace(wkt, r"^[^(]*[\s(]*", ""), r"[\s)]*$", "")
    many = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")
    lines = F.split(body, r"\)\s*,\s*\(")

    def pair(p):
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(F.get(xy, F.lit(0)).try_cast("double").alias("x"), F.get(xy, F.lit(1)).try_cast("double").alias("y"))

    def ring(r):
        return F.transform(F.split(r, ","), pair)

    grouped = F.when(kind == "MULTIPOLYGON", F.transform(many, lambda m: F.transform(F.split(m, r"\)\s*,\s*\("), ring))).when(
        kind == "MULTILINESTRING", F.transform(lines, lambda x: F.array(ring(x)))).otherwise(F.array(F.transform(lines, ring)))
    return F.when(whole, _valid(kind, grouped))


def from_pair(coordinates) -> Column:
    """``[lon, lat]`` to a point geometry."""
    return from_coordinates(F.lit("POINT"), coordinates, 1)


def from_coordinates(kind: Column, coordinates, depth: int) -> Column:
    """GeoJSON coordinates (arrays nested ``depth`` deep) to a geometry of ``kind``; null if the two do not agree."""
    c = _col(coordinates)

    def pair(p):
        return F.struct(F.get(p, F.lit(0)).cast("double").alias("x"), F.get(p, F.lit(1)).cast("double").alias("y"))

    def ring(r):
        return F.transform(r, pair)

    grouped = {
        1: lambda: F.array(F.array(F.array(pair(c)))),
        2: lambda: F.array(F.array(ring(c))),
        3: lambda: F.when(kind == "MULTILINESTRING", F.transform(c, lambda x: F.array(ring(x)))).otherwise(F.array(F.transform(c, ring))),
        4: lambda: F.transform(c, lambda m: F.transform(m, ring)),
    }[depth]()
    kinds = [k for k, (_, d) in KINDS.items() if d == depth]
    return F.when(kind.isin(kinds), _valid(kind, grouped))


def parse_geojson(text) -> Column:
    """GeoJSON text of any known kind to a geometry; other text gives null."""
    doc = _col(text)
    kind = F.upper(F.get_json_object(doc, "$.type"))
    value = F.lit(None)
    for depth in range(4, 0, -1):
        nested = "array<" * depth + "double" + ">" * depth
        found = F.from_json(doc, f"coordinates {nested}")["coordinates"]
        kinds = [k for k, (_, d) in KINDS.items() if d == depth]
        value = F.when(kind.isin(kinds), from_coordinates(kind, found, depth)).otherwise(value)
    return value


def parse_geometry(df: DataFrame, name: str = "geometry") -> DataFrame:
    """Replace WKT or GeoJSON text, a ``[lon, lat]`` array or a GeoJSON struct by a geometry; drop rows without one.

    The coordinates of a struct may be arrays of any depth, or text (as a reader leaves them where kinds are mixed).
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        value = F.when(F.ltrim(name).startswith("{"), parse_geojson(name)).otherwise(parse_wkt(name))
    elif isinstance(kind, T.ArrayType):
        value = from_pair(name)
    elif "coordinates" in kind.fieldNames():
        g, inner, depth = F.col(name), kind["coordinates"].dataType, 0
        if isinstance(inner, T.StringType):
            value = parse_geojson(F.concat(F.lit('{"type":"'), g.type, F.lit('","coordinates":'), g.coordinates, F.lit("}")))
        else:
            while isinstance(inner, T.ArrayType):
                inner, depth = inner.elementType, depth + 1
            plain = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOLYGON"}[depth]
            value = from_coordinates(F.upper(g.type) if "type" in kind.fieldNames() else F.lit(plain), g.coordinates, depth)
    else:
        value = F.col(name)
    return df.withColumn(name, value).filter(F.col(name).isNotNull())


def point_json(lon, lat) -> Column:
    """GeoJSON text of a point."""
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(_col(lon), _col(lat)).alias("coordinates")))


def geometry_json(geometry) -> Column:
    """GeoJSON text of a geometry value."""
    g = _col(geometry)
    rings = F.transform(g.rings, lambda r: F.transform(r, lambda p: F.array(p.x, p.y)))
    polygons = F.transform(F.array_distinct(g.parts), lambda part: F.filter(rings, lambda r, i: F.get(g.parts, i) == part))
    label = F.try_element_at(F.create_map(*[F.lit(v) for k, (n, _) in KINDS.items() for v in (k, n)]), g.kind)
    body = (
        F.when(g.kind == "POINT", F.to_json(F.get(F.get(rings, F.lit(0)), F.lit(0))))
        .when(g.kind == "LINESTRING", F.to_json(F.get(rings, F.lit(0))))
        .when(g.kind.isin("POLYGON", "MULTILINESTRING"), F.to_json(rings))
        .otherwise(F.to_json(polygons))
    )
    return F.concat(F.lit('{"type":"'), label, F.lit('","coordinates":'), body, F.lit("}"))


def point_from_json(text) -> Column:
    """Point geometry of a GeoJSON text."""
    found = parse_geojson(text)
    return F.when(found.kind == "POINT", found)


def paths(df: DataFrame, name: str = "geometry", path: str = "path") -> DataFrame:
    """A row per line (or ring) of each geometry, as an array of (x, y) structs in column ``path``."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.col(name).rings).alias(path))


def edges(geometry) -> Column:
    """All ring edges as ``array<struct<x1,y1,x2,y2>>``."""
    g = _col(geometry)

    def ring_edges(r):
        steps = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            steps,
            lambda i: F.struct(
                F.get(r, i - 1).x.alias("x1"), F.get(r, i - 1).y.alias("y1"),
                F.get(r, i).x.alias("x2"), F.get(r, i).y.alias("y2"),
            ),
        )

    return F.flatten(F.transform(g.rings, ring_edges))


def rectangle(xmin, ymin, xmax, ymax) -> Column:
    """Closed rectangular polygon."""
    x0, y0, x1, y1 = (_col(c) for c in (xmin, ymin, xmax, ymax))
    pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in pts])
    return geometry(F.lit("POLYGON"), F.array(ring))


def bounds(geometry) -> dict[str, Column]:
    """Bounding box columns of one geometry."""
    pts = F.flatten(_col(geometry).rings)
    return {
        "xmin": F.array_min(F.transform(pts, lambda p: p.x)), "ymin": F.array_min(F.transform(pts, lambda p: p.y)),
        "xmax": F.array_max(F.transform(pts, lambda p: p.x)), "ymax": F.array_max(F.transform(pts, lambda p: p.y)),
    }


def covers(edge_list, px, py, boundary: bool) -> Column:
    """Even-odd test against all edges; points on an edge count only if ``boundary``."""
    es, px, py = _col(edge_list), _col(px), _col(py)

    def crossed(e):
        at = e.x1 + F.try_divide((e.x2 - e.x1) * (py - e.y1), e.y2 - e.y1)
        return ((e.y1 > py) != (e.y2 > py)) & F.coalesce(px < at, F.lit(False))

    def touching(e):
        cross = (e.x2 - e.x1) * (py - e.y1) - (px - e.x1) * (e.y2 - e.y1)
        return (
            (cross == 0)
            & px.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
            & py.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
        )

    inside = F.size(F.filter(es, crossed)) % 2 == 1
    on_edge = F.exists(es, touching)
    return (inside | on_edge) if boundary else (inside & ~on_edge)
