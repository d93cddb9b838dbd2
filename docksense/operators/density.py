"""Density clusters (DBSCAN) of plane points, for one setting or a sweep of them.

``eps`` is inclusive and a point counts itself. A cluster is named by its smallest core point id, noise is -1,
and a border point joins the cluster with the smallest name among its core neighbours.

Settings share all distances, if the points are few. Of a sorted list of ``eps`` only the first one that is not exceeded counts (a level), so every pair
of neighbours is found once. For each ``min_samples`` a point is core from a level on, two core points are linked from the largest
of their levels and the pair's on, and the links' spanning forest tells the clusters of every ``eps``.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.operators.nearest import candidates
from docksense.session import cut_lineage

#: Points that make a cell of side eps / sqrt(2) one node (all of them are neighbours), if ``min_samples`` is not larger. Thinner
#: cells keep their places apart, so this bounds the neighbours that a place is compared with.
FULL = 8
#: Up to so many points are searched once for all ``eps`` of a sweep. With more, each eps has cells of its own size: cells made for
#: the smallest eps would give a place as many neighbours as the square of the ratio of the largest to it.
FEW = 4096
#: Places of a full cell that are compared one by one; larger cells have a search tree.
CLOSE = 256
#: Search cells along a tile, whose links one task reduces to a forest.
TILE = 4
NODE = "struct<id:bigint,x:double,y:double>"


def _contractions(edges: DataFrame) -> list[DataFrame]:
    """Tables (n, root): in each round, for every node that still has an edge, the node that it is merged into.

    A round points every node at its smallest neighbour, follows the pointers once more and contracts the graph, so the
    rounds grow with the logarithm of the number of nodes. Edges are (a, b), each pair once.
    """
    rounds: list[DataFrame] = []
    open_edges = edges.select("a", "b").union(edges.select("b", "a"))
    while True:
        hook = open_edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        ahead = hook.select(F.col("a").alias("to"), F.col("to").alias("root"))
        root = cut_lineage(hook.join(ahead, "to").select(F.col("a").alias("n"), "root"))
        if root.isEmpty():
            return rounds
        rounds.append(root)
        at_a, at_b = root.withColumnsRenamed({"n": "a", "root": "ra"}), root.withColumnsRenamed({"n": "b", "root": "rb"})
        moved = open_edges.join(at_a, "a").join(at_b, "b").filter(F.col("ra") != F.col("rb"))
        open_edges = cut_lineage(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())


def _components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(v, label): one node id per connected component."""
    labels = nodes.select("v", F.col("v").alias("label"))
    for root in _contractions(edges.select("a", "b")):
        joined = labels.join(root, labels.label == root.n, "left")
        labels = joined.select("v", F.coalesce("root", "label").alias("label"))
    return cut_lineage(labels)


def _level(distance: Column, eps: list[float]) -> Column:
    """Index of the first eps that is not exceeded; null beyond the last."""
    out = F.lit(None).cast("int")
    for i in range(len(eps) - 1, -1, -1):
        out = F.when(distance <= eps[i], i).otherwise(out)
    return out


def _gap(px: str, py: str, box: list[str]) -> Column:
    """Distance of a place to the closest place of a box (x0, x1, y0, y1)."""
    x0, x1, y0, y1 = map(F.col, box)
    return F.hypot(F.greatest(x0 - F.col(px), F.lit(0.0), F.col(px) - x1), F.greatest(y0 - F.col(py), F.lit(0.0), F.col(py) - y1))


def _reach(px: str, py: str, box: list[str]) -> Column:
    """Distance of a place to the farthest place of a box."""
    x0, x1, y0, y1 = map(F.col, box)
    return F.hypot(F.greatest(F.col(px) - x0, x1 - F.col(px)), F.greatest(F.col(py) - y0, y1 - F.col(py)))


class Neighbours:
    """Places, nodes and the levels at which they are neighbours.

    * ``places``: x, y, w (points there), node, full;
    * ``nodes``: node, w, full. A node is a place of a thin cell or a whole full cell; its id is its smallest point id;
    * ``near``: a (node of a thin cell), b (node), level, w: so many points of b come within reach of a at this level, counted
      until ``most`` of them are;
    * ``links``: a, b, level, tile: pairs of nodes, each once, with the level of their closest points.
    """

    def __init__(self, df: DataFrame, eps: list[float], most: int) -> None:
        self.eps, self.most = sorted(eps), most
        full = max(FULL, most)
        side, self.search = self.eps[0] / math.sqrt(2.0), self.eps[-1] + self.eps[0]
        here = lambda c: F.abs(F.col(c).cast("double")) < float("inf")
        pts = df.filter("point_id IS NOT NULL").filter(here("x") & here("y")).select(
            F.col("point_id").cast("long").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
        places = pts.groupBy("x", "y").agg(F.count("*").alias("w"), F.min("id").alias("id"))
        places = places.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
        cells = places.groupBy("cx", "cy").agg(
            F.sum("w").alias("cell_w"), F.struct(F.min("id").alias("id"), F.min("x").alias("x"), F.min("y").alias("y")).alias("cell"))
        whole = F.col("cell_w") >= full
        own = F.struct("id", "x", "y")
        self.places = cut_lineage(places.join(cells, ["cx", "cy"]).select(
            "x", "y", "w", F.when(whole, F.col("cell")).otherwise(own).cast(NODE).alias("node"), whole.alias("full")))
        self.nodes = self.places.groupBy("node").agg(F.sum("w").alias("w"), F.first("full").alias("full"))
        near, links = self._thin_pairs()
        if not self.places.filter("full").isEmpty():
            more, also = self._full_pairs()
            near, links = near.unionByName(more), links.unionByName(also)
        self.near, self.links = near, links

    def _searched(self, df: DataFrame, x: str, y: str, prefix: str, around: bool) -> DataFrame:
        cell = {f"{prefix}x": F.floor(F.col(x) / self.search), f"{prefix}y": F.floor(F.col(y) / self.search)}
        df = df.withColumns(cell).withColumn("tile", F.struct(*[F.floor(F.col(c) / TILE) for c in cell]))
        if not around:
            return df.drop("tile")
        steps = F.sequence(F.lit(-1), F.lit(1))
        df = df.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
        return df.withColumns({c: F.col(c) + F.col(s) for c, s in zip(cell, ("_dx", "_dy"))}).drop("_dx", "_dy")

    def _thin_pairs(self) -> tuple[DataFrame, DataFrame]:
        thin = self.places.filter("NOT full")
        left = self._searched(thin.select(F.col("node").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay")), "ax", "ay", "c", True)
        right = self._searched(thin.select(F.col("node").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), "w"), "bx", "by", "c", False)
        level = _level(F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")), self.eps)
        near = left.join(right, ["cx", "cy"]).withColumn("level", level).filter("level IS NOT NULL AND a <> b")
        near = cut_lineage(near.select("a", "b", "level", "w", "tile"))
        return near.drop("tile"), near.filter("a < b").select("a", "b", "level", "tile")

    def _full_pairs(self) -> tuple[DataFrame, DataFrame]:
        """Places against full cells: where a cell's box does not decide the level, its closest places do."""
        box = ["x0", "x1", "y0", "y1"]
        cells = cut_lineage(self.places.filter("full").groupBy(F.col("node").alias("b")).agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("bn")))
        mid = cells.withColumns({"mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2})
        own = self.places.groupBy("node").agg(F.count("*").alias("an"))
        asked = self._searched(self.places.join(own, "node").select(
            F.col("node").alias("a"), "full", "an", F.col("x").alias("ax"), F.col("y").alias("ay")), "ax", "ay", "c", True)
        met = asked.join(self._searched(mid, "mx", "my", "c", False), ["cx", "cy"])
        # of two full cells the one with fewer places asks
        met = met.filter(~F.col("full") | (F.struct("an", "a") < F.struct("bn", "b")))
        met = met.withColumns({"low": _level(_gap("ax", "ay", box), self.eps), "high": _level(_reach("ax", "ay", box), self.eps)})
        met = cut_lineage(met.filter("low IS NOT NULL").select("a", "b", "bn", "full", "ax", "ay", "low", "high", "tile"))
        sure = met.filter("low = high").select("a", "b", "full", F.col("low").alias("level"), F.lit(self.most).cast("long").alias("w"), "tile")
        # a cell that is linked at the lowest level that another of its places may reach needs no closer look
        best = met.groupBy(F.col("a").alias("ka"), F.col("b").alias("kb")).agg(F.min("high").alias("known"))
        open_ = met.filter("NOT (low <=> high)").join(best, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb"))).filter(
            ~F.col("full") | F.col("known").isNull() | (F.col("low") < F.col("known"))).drop("ka", "kb", "known", "low", "high")
        objects = self.places.filter("full").select(F.col("node").alias("b"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("w").alias("ow"))
        found = open_.filter(F.col("bn") <= CLOSE).join(objects, "b")
        if not cells.filter(F.col("bn") > CLOSE).isEmpty():
            large = objects.join(cells.filter(F.col("bn") > CLOSE).select("b"), "b", "left_semi")
            found = found.unionByName(candidates(open_.filter(F.col("bn") > CLOSE), ["ax", "ay"], large, ["ox", "oy"], ["ox", "oy"],
                                                 k=self.most, weight="ow", group="b"))
        level = _level(F.hypot(F.col("ax") - F.col("ox"), F.col("ay") - F.col("oy")), self.eps)
        found = found.withColumn("level", level).filter("level IS NOT NULL").groupBy("a", "b", "full", "level", "tile").agg(F.sum("ow").alias("w"))
        both = cut_lineage(sure.unionByName(found))
        links = both.groupBy("a", "b").agg(F.min("level").alias("level"), F.min("tile").alias("tile"))
        return both.filter("NOT full").select("a", "b", "level", "w"), links

    def cores(self, min_samples: list[int]) -> DataFrame:
        """node, w, from: for each of ``min_samples`` the level from which the node is core, null if it never is."""
        levels = range(len(self.eps))
        counts = self.near.groupBy(F.col("a").alias("node")).agg(
            *[F.sum(F.when(F.col("level") <= i, F.col("w")).otherwise(0)).alias(f"n{i}") for i in levels])
        both = self.nodes.join(counts, "node", "left")
        at = []
        for m in min_samples:
            out = F.lit(None).cast("int")
            for i in reversed(levels):
                out = F.when(F.col("w") + F.coalesce(f"n{i}", F.lit(0)) >= m, i).otherwise(out)
            at.append(F.when(F.col("full"), 0).otherwise(out))
        return both.select("node", "w", F.array(*at).alias("from"))


def _forest(settings: int, levels: int):
    """For the links of a tile (a, b, at: level per setting) those of a spanning forest of lowest levels per setting."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = {}
        key = lambda c: np.array([nodes.setdefault((v["id"], v["x"], v["y"]), len(nodes)) for v in c])
        a, b = key(pdf.a), key(pdf.b)
        at = np.array([[levels if v is None or v != v else v for v in row] for row in pdf["at"]]).reshape(len(pdf), settings)
        out = []
        for s in range(settings):
            parent = list(range(len(nodes)))
            order = np.argsort(at[:, s], kind="stable")
            order = order[at[order, s] < levels]
            for i, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                while parent[y] != y:
                    parent[y] = y = parent[parent[y]]
                if x != y:
                    parent[x] = y
                    out.append((i, s, int(at[i, s])))
        rows, s, level = (np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pd.DataFrame({"a": pdf.a.to_numpy()[rows], "b": pdf.b.to_numpy()[rows], "setting": s.astype("int32"),
                             "level": level.astype("int32")})

    return run


def dbscan(df: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Add ``cluster`` to (point_id, x, y, ...). Points without id or place are noise; equal ids share a cluster."""
    near = Neighbours(df, [float(eps)], min_samples)
    cores = cut_lineage(near.cores([min_samples]).filter(F.col("from")[0].isNotNull()).select("node"))
    links = near.links.join(cores.select(F.col("node").alias("a")), "a").join(cores.select(F.col("node").alias("b")), "b")
    labels = _components(cut_lineage(links.select("a", "b")), cores.select(F.col("node").alias("v")))
    names = labels.groupBy("label").agg(F.min(F.col("v")["id"]).alias("cluster"))
    named = cut_lineage(labels.join(names, "label").select(F.col("v").alias("node"), "cluster"))
    border = near.near.join(named.withColumnRenamed("node", "b"), "b").join(cores, F.col("a") == F.col("node"), "left_anti").groupBy(
        F.col("a").alias("node")).agg(F.min("cluster").alias("cluster"))
    placed = near.places.join(named.unionByName(border), "node").select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("cluster").alias("_c"))
    at = df.select("point_id", F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"))
    found = at.join(placed, ["_x", "_y"]).filter("point_id IS NOT NULL").groupBy("point_id").agg(F.min("_c").alias("cluster"))
    return df.join(found, "point_id", "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1).cast("bigint")))


def searches(df: DataFrame, steps: list[float]) -> list[list[float]]:
    """The sorted ``eps`` that share a search of neighbours: all if the points are few, else each by itself."""
    return [steps] if df.limit(FEW + 1).count() <= FEW else [[e] for e in steps]


def _part(df: DataFrame, steps: list[float], ms: list[int], first: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For these eps, numbered from ``first`` (e), and every one of ``ms`` (setting): edges of core nodes that leave the same components
    (a, b), the number of core nodes, and that of the points inside a cluster."""
    near = Neighbours(df, steps, max(ms))
    cores = cut_lineage(near.cores(ms))
    at = cores.select(F.col("node").alias("b"), F.col("from").alias("from_b"))
    larger = lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y))
    # the level from which a place lies in a cluster: its own, or that of the first core point it meets
    met = near.near.join(at, "b").withColumn("at", F.transform("from_b", lambda v: larger(v, F.col("level")))).groupBy(F.col("a").alias("node")).agg(
        F.array(*[F.min(F.col("at")[i]) for i in range(len(ms))]).alias("met"))
    inside = cores.join(met, "node", "left").select("w", F.posexplode(F.zip_with(
        "from", F.coalesce("met", F.array(*[F.lit(None).cast("int")] * len(ms))), lambda x, y: F.least(x, y))).alias("s", "level"))
    each = F.explode(F.sequence(F.col("level") + first, F.lit(first + len(steps) - 1))).alias("e")
    inside = inside.groupBy("s", "level").agg(F.sum("w").alias("points")).filter("level IS NOT NULL").select("s", each, "points").groupBy("s", "e").agg(
        F.sum("points").alias("inside"))
    # links of core points, reduced to a forest tile by tile, then the components that are left for each setting
    tiled = near.links.join(at, "b").join(cores.select(F.col("node").alias("a"), F.col("from").alias("from_a")), "a")
    joined = F.zip_with("from_a", "from_b", larger)
    tiled = tiled.select("a", "b", "tile", F.transform(joined, lambda v: larger(v, F.col("level"))).alias("at")).filter(
        F.exists("at", lambda v: v.isNotNull()))
    forest = cut_lineage(tiled.groupBy("tile").applyInPandas(
        _forest(len(ms), len(steps)), f"a {NODE}, b {NODE}, setting int, level int"))
    key = lambda c: F.struct("setting", "e", F.col(c).alias("node"))
    edges = forest.select("setting", "a", "b", each).select(key("a").alias("a"), key("b").alias("b"))
    nodes = cores.select("node", F.posexplode("from").alias("setting", "level")).filter("level IS NOT NULL").select("setting", "node", each)
    alone = nodes.groupBy("setting", "e").agg(F.count("*").alias("nodes"))
    return edges, alone, inside


def tune_dbscan(df: DataFrame, eps: list[float], min_samples: list[int]) -> DataFrame:
    """Score (clusters - noise share) of every setting, best first; equal scores keep the order of the settings."""
    settings = [(float(e), m) for e in eps for m in min_samples]
    grid = df.sparkSession.createDataFrame([(i, e, m) for i, (e, m) in enumerate(settings)], "setting int, eps double, min_samples int")
    steps, ms = sorted({float(e) for e in eps}), sorted(set(min_samples))
    parts = [_part(df, part, ms, steps.index(part[0])) for part in searches(df, steps)]
    edges, alone, inside = (functools.reduce(DataFrame.unionByName, x) for x in zip(*parts))
    edges = cut_lineage(edges)
    linked = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    merged = _components(edges, linked).groupBy(F.col("v.setting").alias("setting"), F.col("v.e").alias("e")).agg(
        (F.count("*") - F.count_distinct("label")).alias("merged"))
    clusters = alone.join(merged, ["setting", "e"], "left").select(
        "setting", "e", (F.col("nodes") - F.coalesce("merged", F.lit(0))).alias("clusters"))
    pairs = df.sparkSession.createDataFrame([(s, i, e, m) for s, m in enumerate(ms) for i, e in enumerate(steps)], "s int, e int, eps double, min_samples int")
    per = pairs.join(inside, ["s", "e"], "left").join(clusters.withColumnRenamed("setting", "s"), ["s", "e"], "left").drop("s", "e")
    total = df.agg(F.count("*").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    out = grid.join(per, ["eps", "min_samples"], "left").withColumn("total", total.scalar()).withColumns(
        {"clusters": zero("clusters"), "noise": F.col("total") - zero("inside")})
    score = F.col("clusters") - F.try_divide("noise", "total")
    return out.withColumn("score", score).select("setting", "eps", "min_samples", "clusters", "noise", "score").orderBy(
        F.col("score").desc(), "setting")
