"""Points against polygons, lattices and scaling."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.functions import geometry as geom


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level))


#: Edges of a polygon for which it gets one horizontal band.
BAND_EDGES = 16


def _band(v: Column, low: Column, high: Column, bands: Column) -> Column:
    """Band of a height; it does not fall as the height grows, so an edge's bands are those between its ends'."""
    return F.least(F.coalesce(F.floor(F.try_divide((v - low) * bands, high - low)), F.lit(0).cast("bigint")), bands - 1)


def edge_bands(areas: DataFrame, geometry: str = "geometry") -> DataFrame:
    """_shape, _band, _edges: the edges of each different geometry that reach into each of its horizontal bands.

    A polygon has a band for every ``BAND_EDGES`` edges, so a point is compared with the edges at its height only.
    """
    box = geom.bounds(geometry)
    a = areas.select(_shape(geometry).alias("_shape"), geom.edges(geometry).alias("_edges"), box["ymin"].alias("_low"), box["ymax"].alias("_high"))
    a = a.dropDuplicates(["_shape"]).withColumn("_bands", _bands(F.size("_edges")))
    each = a.select("_shape", "_low", "_high", "_bands", F.explode("_edges").alias("_e"))
    ends = [_band(f(F.col("_e.y1"), F.col("_e.y2")), F.col("_low"), F.col("_high"), F.col("_bands")) for f in (F.least, F.greatest)]
    each = each.select("_shape", "_e", F.explode(F.sequence(*ends)).alias("_band"))
    return each.groupBy("_shape", "_band").agg(F.collect_list("_e").alias("_edges"))


def _bands(edges: Column) -> Column:
    return F.greatest(F.ceil(edges / BAND_EDGES), F.lit(1)).cast("bigint")


def _shape(geometry: str) -> Column:
    """128 bits that tell geometries apart."""
    return F.struct(F.xxhash64(geometry).alias("a"), F.xxhash64(F.lit(1), geometry).alias("b"))


def spatial_join_within(points: DataFrame, areas: DataFrame, boundary: bool = False, x: str = "x", y: str = "y",
                        geometry: str = "geometry") -> DataFrame:
    """Points joined with the areas that contain them.

    Each area lies in at most four cells of a grid whose size is the power of two above its longer side; a point
    is looked up once in every grid size in use. Pairs that share a cell, of which a point and an area have at most
    one, and whose box holds the point are joined with the area's edges in the point's band for the exact test.
    """
    box = geom.bounds(geometry)
    a = areas.withColumns({f"_{n}": c for n, c in box.items()}).withColumns(
        {"_shape": _shape(geometry), "_bands": _bands(F.size(geom.edges(geometry)))})
    side = F.greatest(F.col("_xmax") - F.col("_xmin"), F.col("_ymax") - F.col("_ymin"), F.lit(1e-9))
    a = a.filter(side.isNotNull()).withColumn("_level", F.ceil(F.log2(side)).cast("int"))
    a = a.withColumns({
        "_cx": F.explode(F.sequence(_cell(F.col("_xmin"), F.col("_level")), _cell(F.col("_xmax"), F.col("_level")))),
    }).withColumns({
        "_cy": F.explode(F.sequence(_cell(F.col("_ymin"), F.col("_level")), _cell(F.col("_ymax"), F.col("_level")))),
    })
    levels = a.select("_level").distinct().agg(F.collect_list("_level"))
    p = points.withColumn("_level", F.explode(levels.scalar()))
    p = p.withColumns({"_cx": _cell(F.col(x), F.col("_level")), "_cy": _cell(F.col(y), F.col("_level"))})
    met = p.join(a, ["_level", "_cx", "_cy"]).filter(
        F.col(x).between(F.col("_xmin"), F.col("_xmax")) & F.col(y).between(F.col("_ymin"), F.col("_ymax")))
    met = met.withColumn("_band", _band(F.col(y), F.col("_ymin"), F.col("_ymax"), F.col("_bands")))
    joined = met.join(edge_bands(areas, geometry), ["_shape", "_band"]).filter(geom.covers("_edges", x, y, boundary))
    return joined.drop("_level", "_cx", "_cy", "_edges", "_shape", "_band", "_bands", *[f"_{n}" for n in box]).select(
        *points.columns, *areas.columns)


def count_points(areas: DataFrame, points: DataFrame, key: str, out: str = "count", x: str = "x", y: str = "y") -> DataFrame:
    """Points per area, edges included; 0 for areas without any."""
    hits = spatial_join_within(points.select(x, y), areas.select(key, "geometry"), boundary=True, x=x, y=y)
    counts = hits.groupBy(key).agg(F.count("*").alias(out))
    return areas.join(counts, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))


def density_layers(areas: DataFrame, layers: dict[str, DataFrame], key: str) -> DataFrame:
    """Count and class of each point layer per area, as structs ``<layer>{classification, count}``.

    The points carry their layer's name, so that one join places all of them.
    """
    from docksense.operators.aggs import density_class

    tagged = functools.reduce(DataFrame.unionByName, [
        points.select(F.lit(name).alias("_layer"), "x", "y") for name, points in layers.items()])
    hits = spatial_join_within(tagged, areas.select(key, "geometry"), boundary=True)
    counts = hits.groupBy("_layer", key).agg(F.count("*").alias("count"))
    every = areas.select(key, F.explode(F.array(*[F.lit(name) for name in layers])).alias("_layer"))
    counted = every.join(counts, ["_layer", key], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
    graded = density_class(counted, "count", by=["_layer"])
    value = F.struct("classification", "count")
    wide = graded.groupBy(key).agg(*[F.max(F.when(F.col("_layer") == name, value)).alias(name) for name in layers])
    return areas.join(wide, key, "left")


def candidate_grid(spark, bounds: tuple[float, float, float, float], step: float) -> DataFrame:
    """Lattice points x = xmin + i*step, y = ymin + j*step, both below the upper bounds."""
    xmin, ymin, xmax, ymax = bounds
    nx = max(0, math.ceil((xmax - xmin) / step))
    ny = max(0, math.ceil((ymax - ymin) / step))
    ids = spark.range(nx * ny).withColumnRenamed("id", "point_id")
    i, j = F.col("point_id") % max(nx, 1), F.floor(F.col("point_id") / max(nx, 1))
    return ids.withColumns({"x": F.lit(xmin) + i * step, "y": F.lit(ymin) + j * step})


def scale_like(ref: DataFrame, other: DataFrame, cols: list[str]) -> DataFrame:
    """Standardise ``other`` with mean and population deviation of ``ref``; a deviation of 0 counts as 1."""
    stats = ref.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    row = stats.select(F.struct("*").alias("s")).scalar()
    out = other.withColumn("_s", row)
    scaled = {
        c: (F.col(c) - F.col(f"_s.m_{c}")) / F.when(F.col(f"_s.s_{c}") == 0, 1.0).otherwise(F.col(f"_s.s_{c}"))
        for c in cols
    }
    return out.withColumns(scaled).drop("_s")


def column_quantiles(df: DataFrame, cols: list[str], shares: list[float], buckets: int = 1024) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation of several columns, by narrowing value histograms.

    Each round reads the table once, whatever the number of columns and of ranks still sought, and returns at most
    ``buckets`` counts for each open range; equal values end a search at once, so neither the size nor a frequent value
    matters. Infinite values and NaN (the largest) are counted and set aside, so every range is finite.
    """
    value = {c: F.col(c).cast("double") for c in cols}
    finite = {c: F.when(~F.isnan(v) & (F.abs(v) < math.inf), v) for c, v in value.items()}
    head = df.agg(*[F.struct(
        F.count(v).alias("n"), F.min(finite[c]).alias("lo"), F.max(finite[c]).alias("hi"), F.count_if(v == -math.inf).alias("below"),
        F.count_if(v == math.inf).alias("above"), F.count_if(F.isnan(v)).alias("nan")).alias(f"c{i}") for i, (c, v) in enumerate(value.items())]).first()
    found: dict[str, dict[int, float]] = {}
    open_: list[tuple[str, float, float, int, list[int]]] = []
    for i, c in enumerate(cols):
        h = head[f"c{i}"]
        n = h["n"]
        ranks = sorted({r for s in shares for r in (int((n - 1) * s), min(int((n - 1) * s) + 1, n - 1))}) if n else []
        found[c] = {r: -math.inf for r in ranks if r < h["below"]}
        found[c] |= {r: math.inf for r in ranks if r >= n - h["nan"] - h["above"]}
        found[c] |= {r: math.nan for r in ranks if r >= n - h["nan"]}
        open_.append((c, h["lo"], h["hi"], h["below"], [r for r in ranks if r not in found[c]]))
    while open_:
        narrowed = []
        for c, lo, hi, before, wanted in open_:
            if wanted and lo == hi:
                found[c].update({r: lo for r in wanted})
            elif wanted:
                narrowed.append((c, lo, hi, before, wanted))
        if not narrowed:
            break
        slots = []
        for i, (c, lo, hi, _, _) in enumerate(narrowed):
            v, width = finite[c], hi / buckets - lo / buckets
            slot = F.least(F.floor((v - lo) / width), F.lit(buckets - 1)) if width > 0 else (v > lo).cast("bigint")
            slots.append(F.when(v.between(lo, hi), F.struct(F.lit(i).alias("i"), slot.alias("b"), v.alias("v"))))
        rows = df.select(F.explode(F.array_compact(F.array(*slots))).alias("s")).groupBy("s.i", "s.b").agg(
            F.count("*").alias("f"), F.min("s.v").alias("lo"), F.max("s.v").alias("hi")).collect()
        open_ = []
        for i, (c, _, _, before, wanted) in enumerate(narrowed):
            seen = before
            for h in sorted((r for r in rows if r["i"] == i), key=lambda r: r["b"]):
                inside = [r for r in wanted if seen <= r < seen + h["f"]]
                if inside:
                    open_.append((c, h["lo"], h["hi"], seen, inside))
                seen += h["f"]
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        n, at = head[f"c{i}"]["n"], found[c]
        out[c] = [None] * len(shares) if not n else []
        for pos in [(n - 1) * s for s in shares] if n else []:
            low, high = at[int(pos)], at[min(int(pos) + 1, n - 1)]
            out[c].append(low if low == high or pos == int(pos) else low + (high - low) * (pos - int(pos)))
    return out


def exact_quantiles(df: DataFrame, col: str, shares: list[float], buckets: int = 1024) -> list[float | None]:
    """``column_quantiles`` of one column."""
    return column_quantiles(df, [col], shares, buckets)[col]


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    quartiles = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for c in cols:
        v = F.col(c).cast("double")
        q1, q2, q3 = (F.lit(q).cast("double") for q in quartiles[c])
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), q1.alias("p25"), q2.alias("p50"), q3.alias("p75"), F.max(v).alias("max")))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
