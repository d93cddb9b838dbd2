"""Exact nearest-object search in any number of dimensions, without all-pairs joins.

Objects (points or boxes) are summarised in nested grid cells, each with the tight bounds and number of its
objects. A query first walks down one path of cells to get a distance within which its k nearest objects lie,
then walks down again through every cell that is not farther than that. Each step is an equi-join on the cell,
so the work per query does not depend on how many objects share a neighbourhood or a place.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docksense.operators.layout import spread
from docksense.session import cut_lineage

MAX_BITS = 48
#: Objects whose cells are summarised once and written.
MANY = 100_000
#: Places of a tile of ``close_rows``, and levels of tiles at most.
LEAF, DEEPEST = 256, 24


def _square(parts: list[Column]) -> Column:
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return total


def _near(q: list[Column], lo: list[Column], hi: list[Column]) -> Column:
    """Squared distance to the closest place of a box."""
    return _square([F.greatest(a - x, F.lit(0.0), x - b) for x, a, b in zip(q, lo, hi)])


def _far(q: list[Column], lo: list[Column], hi: list[Column]) -> Column:
    """Squared distance to the farthest place of a box."""
    return _square([F.greatest(F.abs(x - a), F.abs(x - b)) for x, a, b in zip(q, lo, hi)])


def _placed(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in dict.fromkeys(cols):
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


def candidates(queries: DataFrame, q_cols: list[str], objects: DataFrame, lo: list[str], hi: list[str],
               k: int = 1, weight: str | None = None, group: str | None = None, leaf: int = 64) -> DataFrame:
    """Join each query with a small set of objects that holds its k nearest ones.

    ``weight`` counts equal objects kept as one row. ``group`` limits each query to the objects of the same
    value (a column of both sides). Column names of the two sides must differ, except ``group``. Rows without
    a place are left out on both sides. Joins carry no hint: Spark broadcasts what it measures to be small.
    """
    d = len(q_cols)
    queries, objects = _placed(queries, q_cols), _placed(objects, [*lo, *hi])
    step = max(1, 6 // d)
    objects = objects.withColumn("_w", F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint"))
    lo_c, hi_c = [f"_lo{i}" for i in range(d)], [f"_hi{i}" for i in range(d)]
    objects = objects.withColumns({c: F.col(s).cast("double") for c, s in zip(lo_c + hi_c, lo + hi)})
    size = objects.agg(
        F.count("*").alias("n"), *[F.min(c).alias(c) for c in lo_c], *[F.max(c).alias(c) for c in hi_c]
    ).first()
    n = size["n"]
    own = [c for c in objects.columns if not c.startswith("_") and c != group]
    if n == 0:
        return queries.withColumn("_j", F.lit(0)).join(
            objects.select(*own).withColumn("_j", F.lit(1)), "_j"
        ).drop("_j")

    def cell(i: int, bits: int) -> Column:
        span = (size[hi_c[i]] - size[lo_c[i]]) or 1.0
        share = ((F.col(lo_c[i]) + F.col(hi_c[i])) / 2 - size[lo_c[i]]) / span
        return F.least(F.floor(share * float(2**bits)), F.lit(2**bits - 1))

    top = F.xxhash64(group) if group else F.lit(0).cast("bigint")

    def key(level: int) -> Column:
        if level == 0:
            return top
        return F.xxhash64(top, *[cell(i, level * step) for i in range(d)])

    # depth at which no cell holds more than ``leaf`` objects (or the grid is as fine as it gets)
    depth = max(1, math.ceil(math.log2(max(n / leaf, 2)) / (d * step)))
    while (depth + 1) * step <= MAX_BITS:
        fullest = objects.groupBy(key(depth).alias("c")).count().agg(F.max("count")).first()[0]
        if fullest <= leaf:
            break
        depth += 1

    keys = [f"_k{i}" for i in range(depth + 1)]
    keyed = objects.withColumns({keys[i]: key(i) for i in range(depth + 1)})
    shrink = [F.min(c).alias(c) for c in lo_c] + [F.max(c).alias(c) for c in hi_c] + [F.sum("_w").alias("_w")]
    nodes = {}
    below = keyed
    for level in range(depth, 0, -1):
        below = below.groupBy(*keys[: level + 1]).agg(*shrink)
        if depth > 3 or n > MANY:  # many levels, or objects, would repeat this plan in every step above
            below = cut_lineage(below)
        nodes[level] = below

    def children(level: int) -> DataFrame:
        kid = F.struct(F.col(keys[level]).alias("key"), *lo_c, *hi_c, "_w")
        kids = nodes[level].groupBy(F.col(keys[level - 1]).alias("_key")).agg(F.collect_list(kid).alias("_kids"))
        return kids

    q = [F.col(c).cast("double") for c in q_cols]

    def box(c: Column) -> tuple[list[Column], list[Column]]:
        return [c[x] for x in lo_c], [c[x] for x in hi_c]

    def descend(df: DataFrame, level: int, how: str) -> DataFrame:
        if level == 1 and not group:  # a single row
            return df.withColumn("_kids", children(1).select("_kids").scalar())
        return df.join(children(level), "_key", how)

    cols = queries.columns
    walk = queries.withColumns({"_key": top, "_far": F.lit(math.inf)})
    for level in range(1, depth + 1):
        walk = descend(walk, level, "left")
        # the path follows the closest cell; the limit may come from any of its siblings
        best = F.array_min(F.transform("_kids", lambda c: F.struct(
            _near(q, *box(c)).alias("near"), _far(q, *box(c)).alias("far"), c["key"].alias("key"))))
        if k == 1:
            limit = F.array_min(F.transform("_kids", lambda c: _far(q, *box(c))))
        else:
            scored = F.sort_array(F.transform("_kids", lambda c: F.struct(_far(q, *box(c)).alias("far"), c["_w"].alias("w"))))
            start = F.struct(F.lit(0).cast("bigint").alias("w"), F.lit(math.inf).alias("far"))
            limit = F.aggregate(
                scored, start,
                lambda a, c: F.when(a["w"] >= k, a).otherwise(F.struct((a["w"] + c["w"]).alias("w"), c["far"].alias("far"))),
                lambda a: F.when(a["w"] >= k, a["far"]).otherwise(math.inf),
            )
        walk = walk.withColumn("_best", best)
        walk = walk.select(
            *cols, F.least("_far", F.coalesce(limit, F.lit(math.inf))).alias("_far"), F.col("_best")["key"].alias("_key"),
        )
    walk = walk.withColumn("_key", top)
    reach = F.col("_far") * (1 + 1e-9) + 1e-12
    for level in range(1, depth + 1):
        walk = descend(walk, level, "inner")
        open_kids = F.filter("_kids", lambda c: _near(q, *box(c)) <= reach)
        walk = walk.select(*cols, "_far", F.explode(F.transform(open_kids, lambda c: c["key"])).alias("_key"))
    last = keyed.select(*own, *lo_c, *hi_c, F.col(keys[depth]).alias("_key"))
    close = walk.join(last, "_key").filter(_near(q, [F.col(c) for c in lo_c], [F.col(c) for c in hi_c]) <= reach)
    return close.select(*cols, *own)


def nearest_distance(a: DataFrame, b: DataFrame, name: str, key: str, x: str = "x", y: str = "y",
                     exclude_self: bool = False) -> DataFrame:
    """Plane distance of every point of ``a`` to the closest point of ``b`` as column ``name``.

    Equal places of ``b`` count as one. ``exclude_self`` takes the second closest, for an ``a`` that is part of
    ``b``.
    """
    a = spread(a, key)
    return a.join(_nearest(a, b, name, key, x, y, exclude_self), key, "left")


def nearest_distances(a: DataFrame, layers: dict[str, DataFrame], key: str, x: str = "x", y: str = "y") -> DataFrame:
    """Distance of every point of ``a`` to each layer, one column per layer; ``a`` is shuffled once for all."""
    a = spread(a, key)
    out = a
    for name, layer in layers.items():
        out = out.join(_nearest(a, layer, name, key, x, y, False), key, "left")
    return out


def _nearest(a: DataFrame, b: DataFrame, name: str, key: str, x: str, y: str, exclude_self: bool) -> DataFrame:
    k = 2 if exclude_self else 1
    places = b.select(F.col(x).alias("_bx"), F.col(y).alias("_by")).groupBy("_bx", "_by").agg(F.count("*").alias("_bn"))
    # the search reads its objects in every step, so a large layer is not to be grouped anew each time
    places = cut_lineage(places.withColumnsRenamed({"_bx": "b_x", "_by": "b_y", "_bn": "b_n"}))
    pairs = candidates(a.select(key, x, y), [x, y], places, ["b_x", "b_y"], ["b_x", "b_y"], k=k, weight="b_n")
    dx, dy = F.col(x) - F.col("b_x"), F.col(y) - F.col("b_y")
    pairs = pairs.withColumn("_d", F.sqrt(dx * dx + dy * dy))
    if exclude_self:
        pairs = pairs.filter((F.col("_d") > 0) | (F.col("b_n") > 1))
    return pairs.groupBy(key).agg(F.min("_d").alias(name))


def short_pieces(seg: DataFrame) -> DataFrame:
    """Rows (sx1, sy1, sx2, sy2) once for each piece of the segment, with the piece's box (slox, sloy, shix, shiy).

    A long segment's box is close to every point, so the search would meet it everywhere; the boxes of its pieces are
    not. A piece is at most 1/sqrt(n) of the extent of n segments, which leaves the short ones of a street network whole
    and cuts none into more than sqrt(n) pieces. The distance is still that to the whole segment, so it stays exact.
    """
    ends = ["sx1", "sy1", "sx2", "sy2"]
    for c in ends:
        seg = seg.filter(F.abs(F.col(c).cast("double")) < float("inf"))
    size = seg.agg(F.count("*").alias("n"), *[
        f(g(a, b)).alias(name) for name, f, g, a, b in (
            ("x0", F.min, F.least, "sx1", "sx2"), ("x1", F.max, F.greatest, "sx1", "sx2"),
            ("y0", F.min, F.least, "sy1", "sy2"), ("y1", F.max, F.greatest, "sy1", "sy2"))]).first()
    longest = max(size["x1"] - size["x0"], size["y1"] - size["y0"]) / math.sqrt(size["n"]) if size["n"] else 0.0
    dx, dy = F.col("sx2") - F.col("sx1"), F.col("sy2") - F.col("sy1")
    many = F.greatest(F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / longest), F.lit(1)) if longest > 0 else F.lit(1)
    cut = seg.withColumn("_m", many.cast("bigint")).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m"))))

    def at(start: str, d: Column, i: Column) -> Column:
        return F.col(start) + d * (i / F.col("_m"))

    xa, xb, ya, yb = (at(s, d, i) for s, d in (("sx1", dx), ("sy1", dy)) for i in (F.col("_i") - 1, F.col("_i")))
    return cut.select(*ends, F.least(xa, xb).alias("slox"), F.greatest(xa, xb).alias("shix"),
                      F.least(ya, yb).alias("sloy"), F.greatest(ya, yb).alias("shiy"))


def _segments(lines: DataFrame, path: str) -> DataFrame:
    """The different segments (sx1, sy1, sx2, sy2) of a line layer."""
    parts = lines.select(F.explode(F.arrays_zip(
        F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))).alias("s"))
    return parts.select(F.col("s.a.x").alias("sx1"), F.col("s.a.y").alias("sy1"),
                        F.col("s.b.x").alias("sx2"), F.col("s.b.y").alias("sy2")).distinct()


def _listed(df: DataFrame, box: list[Column], side: float) -> DataFrame:
    """``df`` once for each cell of the given side that its box (xlo, xhi, ylo, yhi) comes within one side of."""
    pad = side * (1 + 1e-9)  # a point exactly one side away still shares a cell
    span = lambda lo, hi: F.sequence(F.floor((lo - pad) / side), F.floor((hi + pad) / side))
    return df.withColumn("_cx", F.explode(span(box[0], box[1]))).withColumn("_cy", F.explode(span(box[2], box[3])))


def _in_cells(points: DataFrame, x: str, y: str, side: float) -> DataFrame:
    return points.withColumns({"_cx": F.floor(F.col(x) / side), "_cy": F.floor(F.col(y) / side)})


def farther_than(points: DataFrame, objects: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points without an object (``x``, ``y``) at ``radius`` or less.

    Objects are listed in the cells around them, so a point meets only those in its own cell; equal places count once
    and objects with an infinite or missing coordinate are left out. No distance is searched for.
    """
    places = objects.select(F.col(x).cast("double").alias("_bx"), F.col(y).cast("double").alias("_by")).distinct()
    places = places.filter((F.abs("_bx") < float("inf")) & (F.abs("_by") < float("inf")))
    places = _listed(places, [F.col("_bx"), F.col("_bx"), F.col("_by"), F.col("_by")], radius)
    places = places.withColumnsRenamed({"_cx": "_bcx", "_cy": "_bcy"})
    dx, dy = F.col(x) - F.col("_bx"), F.col(y) - F.col("_by")
    near = (F.col("_cx") == F.col("_bcx")) & (F.col("_cy") == F.col("_bcy")) & (F.sqrt(dx * dx + dy * dy) <= radius)
    return _in_cells(points, x, y, radius).join(places, near, "left_anti").select(*points.columns)


def line_distance_within(points: DataFrame, lines: DataFrame, name: str, key: str, radius: float, path: str = "path",
                         x: str = "x", y: str = "y") -> DataFrame:
    """Points less than ``radius`` from a line layer, with the distance to its closest segment as column ``name``.

    Segments are cut into pieces of at most ``radius``, listed in the at most 16 cells that lie within one radius; a point
    meets the segments listed in its own cell. One equi-join, where ``line_distance`` has to search outwards for points
    that are far from every line. Segments with an infinite or missing coordinate are left out.
    """
    from docksense.functions.geo import segment_distance

    ends = ["sx1", "sy1", "sx2", "sy2"]
    seg = _segments(lines, path).select(*[F.col(c).cast("double").alias(c) for c in ends])
    for c in ends:
        seg = seg.filter(F.abs(c) < float("inf"))
    dx, dy = F.col("sx2") - F.col("sx1"), F.col("sy2") - F.col("sy1")
    many = F.greatest(F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / radius), F.lit(1).cast("bigint"))
    cut = seg.withColumn("_m", many).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m"))))
    xa, xb, ya, yb = (F.col(s) + d * (i / F.col("_m")) for s, d in (("sx1", dx), ("sy1", dy)) for i in (F.col("_i") - 1, F.col("_i")))
    box = [F.least(xa, xb), F.greatest(xa, xb), F.least(ya, yb), F.greatest(ya, yb)]
    cells = _listed(cut, box, radius).select("_cx", "_cy", *ends).distinct()
    met = _in_cells(points.select(key, x, y), x, y, radius).join(cells, ["_cx", "_cy"])
    met = met.select(key, segment_distance(x, y, *ends).alias(name)).filter(F.col(name) < radius)
    return points.join(met.groupBy(key).agg(F.min(name).alias(name)), key)


def line_distance(points: DataFrame, lines: DataFrame, name: str, key: str, path: str = "path",
                  x: str = "x", y: str = "y") -> DataFrame:
    """Plane distance of every point to the closest segment of a line layer.

    ``path`` is an array of (x, y) structs. Segments with an infinite or missing coordinate are left out.
    """
    from docksense.functions.geo import segment_distance

    points = spread(points, key)
    seg = cut_lineage(short_pieces(_segments(lines, path)))
    pairs = candidates(points.select(key, x, y), [x, y], seg, ["slox", "sloy"], ["shix", "shiy"])
    dist = segment_distance(x, y, "sx1", "sy1", "sx2", "sy2")
    best = pairs.groupBy(key).agg(F.min(dist).alias(name))
    return points.join(best, key, "left")


def _tiles(objects: DataFrame, cols: list[str], most: int) -> tuple[list[DataFrame], DataFrame]:
    """Nested tiles of at most ``most`` objects: a table for each level, and the objects with their tile (``_tile``) of the last.

    A tile with more objects is cut at the quartiles (at the median, if half of it fits) of the feature of which its middle half is
    widest. A level has the tile's id, that of the tile around it (``_up``), its region (above ``_from``, up to ``_to``; the regions
    of a level cover all of space) and the bounds of its objects (``_lo``, ``_hi``). Only the largest count comes to the driver.
    """
    dims = range(len(cols))

    def summary(df: DataFrame) -> DataFrame:
        return df.groupBy("_tile").agg(
            F.count("*").alias("_n"), *[F.min(c).alias(f"_lo{i}") for i, c in enumerate(cols)],
            *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(cols)],
            *[F.percentile_approx(c, [0.25, 0.5, 0.75], 256).alias(f"_q{i}") for i, c in enumerate(cols)])

    def choice(i: int) -> Column:
        lo, hi, q = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_q{i}")
        cuts = F.array_distinct(F.filter(F.when(F.col("_n") > 2 * most, q).otherwise(F.slice(q, 2, 1)), lambda v: v < hi))
        mid = F.when(lo / 2 + hi / 2 < hi, lo / 2 + hi / 2).otherwise(lo)  # where equal values leave nothing to cut
        return F.struct((F.size(cuts) > 0).alias("any"), (q[2] - q[0]).alias("wide"), (hi - lo).alias("span"), F.lit(i).alias("i"),
                        F.when(F.size(cuts) > 0, cuts).otherwise(F.array(mid)).alias("cuts"))

    # written, so that the planner joins on the tile even where there is only one
    objects = cut_lineage(objects.withColumn("_tile", F.lit(0).cast("bigint")))
    every = {f"_from{i}": F.lit(-math.inf) for i in dims} | {f"_to{i}": F.lit(math.inf) for i in dims}
    levels = [cut_lineage(summary(objects).withColumns({"_up": F.lit(0).cast("bigint")} | every))]
    while len(levels) <= DEEPEST and (levels[-1].agg(F.max("_n")).first()[0] or 0) > most:
        cut = levels[-1].withColumn("_by", F.array_max(F.array(*[choice(i) for i in dims])))
        cuts = F.when(F.col("_n") > most, F.col("_by")["cuts"]).otherwise(F.array().cast("array<double>"))
        cut = cut.select(F.col("_tile").alias("_up"), *every, F.col("_by")["i"].alias("_i"), cuts.alias("_cuts"))
        cut = cut.withColumn("_c", F.explode(F.sequence(F.lit(0), F.size("_cuts"))))
        below, above = F.get("_cuts", F.col("_c") - 1), F.get("_cuts", F.col("_c"))
        regions = cut.select("_up", (F.col("_up") * 4 + F.col("_c")).alias("_tile"), *[
            F.when(F.col("_i") == i, F.coalesce(v, f"{n}{i}")).otherwise(F.col(f"{n}{i}")).alias(f"{n}{i}")
            for n, v in (("_from", below), ("_to", above)) for i in dims])
        objects = cut_lineage(_down(objects, regions, _inside(cols), "inner"))
        levels.append(cut_lineage(regions.join(summary(objects), "_tile")))
    return levels, objects


def _inside(cols: list[str]) -> Column:
    """The place lies in the region: exactly one of a level."""
    parts = [((F.col(f"_from{i}") == -math.inf) | (F.col(c) > F.col(f"_from{i}"))) & (F.col(c) <= F.col(f"_to{i}"))
             for i, c in enumerate(cols)]
    return functools.reduce(Column.__and__, parts)


def _down(df: DataFrame, level: DataFrame, into: Column, how: str) -> DataFrame:
    """From each row's tile to those of the next level that ``into`` holds for."""
    cols = [c for c in df.columns if c != "_tile"]
    kids = level.drop("_n").withColumnRenamed("_tile", "_kid")
    return df.join(kids, (F.col("_tile") == F.col("_up")) & into, how).select(*cols, F.col("_kid").alias("_tile"))


def close_rows(queries: DataFrame, features: list[str], places: DataFrame, named: list[str], k: int, most: int = LEAF) -> DataFrame:
    """Join each query with all different ``places`` as near as the k-th nearest of its own tile, its k nearest among them.

    For many dimensions, where the cells of a grid hold next to nothing and a query meets thousands of them. Tiles hold up to ``most``
    places however these lie. A query finds its own tile by one path, then meets every tile whose bounds lie within that distance.
    Columns of the two sides must differ. Rows without a place are left out on both sides; joins carry no hint.
    """
    queries, places = _placed(queries, features), _placed(places, named)
    levels, places = _tiles(places, named, most)
    cols, q = queries.columns, [F.col(f) for f in features]
    top = F.lit(0).cast("bigint")
    # three levels at a step, so that a stage stays small enough to be compiled
    stops = [0, *range(len(levels) - 1, 0, -3)[::-1]]
    steps = [levels[b].withColumn("_up", F.shiftright("_tile", 2 * (b - a))) for a, b in zip(stops, stops[1:])]

    own = cut_lineage(queries.withColumn("_tile", top))
    for level in steps:
        own = _down(own, level, _inside(features), "left")
    there = places.groupBy("_tile").agg(F.collect_list(F.struct(*named)).alias("_there"))
    far = F.sort_array(F.transform("_there", lambda o: _square([a - o[r] for a, r in zip(q, named)])))
    walk = own.join(there, "_tile", "left").select(*cols, F.coalesce(F.get(far, F.lit(k - 1)), F.lit(math.inf)).alias("_far"))
    walk = spread(cut_lineage(walk.withColumn("_tile", top)), *cols)

    reach = F.col("_far") * (1 + 1e-9) + 1e-12
    near = _near(q, [F.col(f"_lo{i}") for i in range(len(q))], [F.col(f"_hi{i}") for i in range(len(q))])
    for level in steps:
        walk = _down(walk, level, near <= reach, "inner")
    met = walk.join(places.withColumnRenamed("_tile", "_leaf"), (F.col("_tile") == F.col("_leaf")) & (
        _square([a - F.col(r) for a, r in zip(q, named)]) <= reach))
    return met.drop("_tile", "_leaf", "_far")


def knn_mean(queries: DataFrame, ref: DataFrame, key: str, features: list[str], k: int = 5,
             out: str = "mean_distance") -> DataFrame:
    """Mean distance to the k nearest rows of ``ref`` in feature space (all of them if fewer)."""
    queries = spread(queries, key)
    named = [f"r_{i}" for i in range(len(features))]
    places = ref.groupBy(*[F.col(f).cast("double").alias(r) for f, r in zip(features, named)]).agg(F.count("*").alias("r_n"))
    asked = queries.select(key, *[F.col(f).cast("double").alias(f) for f in features]).filter(F.col(key).isNotNull())
    pairs = close_rows(asked, features, places, named, k)
    dist = F.sqrt(_square([F.col(f) - F.col(r) for f, r in zip(features, named)]))
    pairs = pairs.select(key, dist.alias("_d"), F.explode(F.sequence(F.lit(1), F.least("r_n", F.lit(k)).cast("int"))).alias("_i"))
    ranked = pairs.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy("_d", "_i"))).filter(F.col("_rn") <= k)
    best = ranked.groupBy(key).agg(F.avg("_d").alias(out))
    return queries.join(best, key, "left")


def similarity(mean_distance: Column | str) -> Column:
    """1 / mean distance; null for 0."""
    c = F.col(mean_distance) if isinstance(mean_distance, str) else mean_distance
    return F.try_divide(F.lit(1.0), c)
