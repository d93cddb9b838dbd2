"""Embedding near-duplicates: tiles of PCA-ordered unit vectors compared by leading dimensions first."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docksense.llm.common import components, usable
from docksense.session import cut_lineage

#: Vectors in a tile, on average; a task holds two tiles and compares blocks of them.
TILE_ROWS = 4096
BLOCK_ROWS = 1024
#: Width of the strips along the first principal axis.
STRIP = 0.1
#: Dimensions accumulated before the first and between later bounds.
STEP = 8
_ROUNDING = 1e-9


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension count, the axes by falling variance, from the second moments of all vectors.

    The sums are d x d numbers whatever the number of rows.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, part in pdf.groupby(pdf.embedding.map(len)):
                x = _unit(part.embedding)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pd.DataFrame({"d": d, "pos": np.arange(d * d), "value": m.ravel()})

    total = (classes.select("embedding").mapInPandas(moments, "d int, pos int, value double")
             .groupBy("d", "pos").agg(F.sum("value").alias("value")).toPandas())
    axes = {}
    for d, part in total.groupby("d"):
        m = part.sort_values("pos").value.to_numpy().reshape(d, d)
        _, v = np.linalg.eigh((m + m.T) / 2)
        axes[int(d)] = np.ascontiguousarray(v[:, ::-1])
    return axes


def linked_pairs(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows whose product may reach ``least``, by partial products and suffix norms.

    After each step of dimensions a pair is dropped once its partial product plus the product of the norms of what is
    left cannot reach the limit. Full tiles are multiplied while most pairs are open, single pairs after that.
    """
    d = a.shape[1]
    left_a = np.sqrt(np.cumsum((a * a)[:, ::-1], axis=1)[:, ::-1])
    left_b = np.sqrt(np.cumsum((b * b)[:, ::-1], axis=1)[:, ::-1])
    partial, done, i = np.zeros((len(a), len(b))), 0, None
    while done < d:
        nxt = min(d, done + STEP)
        if i is None:
            partial += a[:, done:nxt] @ b[:, done:nxt].T
            rest = np.outer(left_a[:, nxt], left_b[:, nxt]) if nxt < d else 0.0
            open_ = partial + rest >= least
            count = int(np.count_nonzero(open_))
            if count == 0:
                return np.empty(0, int), np.empty(0, int)
            if count * 8 < open_.size or nxt == d:
                i, j = np.nonzero(open_)
                partial = partial[i, j]
        else:
            partial = partial + np.einsum("ij,ij->i", a[i, done:nxt], b[j, done:nxt])
            keep = partial + (left_a[i, nxt] * left_b[j, nxt] if nxt < d else 0.0) >= least
            i, j, partial = i[keep], j[keep], partial[keep]
        done = nxt
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable, for the graph of the pairs on 0..n-1."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        np.minimum.at(new, i, lab[j])
        np.minimum.at(new, j, lab[i])
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _block_links(pa_: np.ndarray, pb: np.ndarray, a: pd.Series, b: pd.Series, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks (axes, original vectors) with cosine >= ``threshold``."""
    i, j = linked_pairs(pa_, pb, threshold - _ROUNDING)
    close = np.abs(np.einsum("ij,ij->i", pa_[i], pb[j]) - threshold) <= 2 * _ROUNDING
    if close.any():  # at the limit the original vectors decide
        x = np.stack([np.asarray(v, np.float64) for v in a.iloc[i[close]]])
        y = np.stack([np.asarray(v, np.float64) for v in b.iloc[j[close]]])
        cos = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
        keep = np.ones(len(i), bool)
        keep[np.flatnonzero(close)[cos < threshold]] = False
        i, j = i[keep], j[keep]
    return i, j


def _compare(threshold: float):
    """Link counts and a spanning forest of two tiles, or of one with itself; pairs live for one block at a time."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("side", kind="stable").reset_index(drop=True)
        n, n_left = len(pdf), int((pdf.side == 0).sum())
        same = n_left == n
        x = np.stack(pdf.axes_.to_list())
        ids, copies = pdf.cls.to_numpy(), pdf.copies.to_numpy()
        links, trees = np.zeros(n, np.int64), []
        for at in range(0, n_left, BLOCK_ROWS):
            up = min(at + BLOCK_ROWS, n_left)
            for to in range(at if same else n_left, n, BLOCK_ROWS):
                end = min(to + BLOCK_ROWS, n)
                i, j = _block_links(x[at:up], x[to:end], pdf.embedding.iloc[at:up], pdf.embedding.iloc[to:end], threshold)
                i, j = i + at, j + to
                if same and at == to:
                    i, j = i[i < j], j[i < j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                root = _roots(n, i, j)
                child = np.flatnonzero(root != np.arange(n))
                trees.append((child, root[child]))
        root = _roots(n, np.concatenate([c for c, _ in trees]), np.concatenate([r for _, r in trees]))
        some = links > 0
        return pd.DataFrame({"cls": ids[some], "links": links[some], "root": ids[root[some]]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label (and length) with cosine >= ``threshold`` in double precision are linked. Equal vectors are
    one class with a number of copies before anything is compared, so a group of copies costs one comparison. Vectors
    that are null, zero, without label or with null or non-finite components have no links and are their own component.
    A row whose vec_id is null has no links, no component and is not kept; vec_id names one vector (repeated rows
    count as copies). An empty table gives an empty table; other columns are ignored.

    Classes lie in strips along the first principal axis; two unit vectors that far apart in one coordinate cannot
    reach the cosine, so only near strips meet. Tiles follow the axis: thin neighbouring strips share one, full strips
    are cut by a hash, whatever they hold. A task compares two tiles, block by block, and returns link counts and a
    spanning forest, never the pairs.
    """
    rows = vectors.select("vec_id", "embedding", "label", (F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                                                            & usable("embedding")).alias("ok"))
    classes = cut_lineage(rows.filter("ok").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("cls"), F.count("*").alias("copies")))
    axes = principal_axes(classes)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf.embedding.map(len)):
                x = _unit(part.embedding) @ axes[d]
                yield part.assign(d=d, strip=np.floor(x[:, 0] / STRIP).astype("int32"), axes_=list(x))

    placed = cut_lineage(classes.mapInPandas(
        project, classes.schema.simpleString()[7:-1] + ", d int, strip int, axes_ array<double>"))
    # neighbouring strips share a tile until it is full, fuller ones are cut by a hash
    by = Window.partitionBy("label", "d").orderBy("strip")
    counts = placed.groupBy("label", "d", "strip").count()
    before = F.coalesce(F.sum("count").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    strips = cut_lineage(counts.withColumn("range", F.floor(before / tile_rows).cast("int")))
    key = ["label", "d", "range"]
    ranges = strips.groupBy(*key).agg(F.min("strip").alias("low"), F.max("strip").alias("high"),
                                      F.ceil(F.sum("count") / tile_rows).cast("int").alias("n"))
    tiled = cut_lineage(placed.join(strips.drop("count"), ["label", "d", "strip"]).join(ranges, key).withColumn(
        "tile", F.pmod(F.xxhash64("cls"), F.col("n")).cast("int")).drop("n", "low", "high"))
    reach = math.ceil(math.sqrt(max(0.0, 2 - 2 * threshold)) / STRIP)
    near = ranges.withColumn("strip", F.explode(F.sequence(F.col("low"), F.col("high") + reach)))
    near = near.join(strips.select("label", "d", "strip", F.col("range").alias("range2")), ["label", "d", "strip"])
    near = near.filter("range2 >= range").select(*key, "range2").distinct()
    every = tiled.select(*key, "tile").distinct()
    other = every.withColumnsRenamed({"range": "range2", "tile": "tile2"})
    pairs = near.join(every, key).join(other, ["label", "d", "range2"]).filter("range2 > range or tile2 >= tile")
    pairs = cut_lineage(pairs.withColumn("pair", F.monotonically_increasing_id()))  # one number each, as written
    cols = ["pair", "side", "cls", "copies", "embedding", "axes_"]
    at = [*key, "tile"]
    left = tiled.join(pairs.select(*at, "pair"), at).withColumn("side", F.lit(0)).select(*cols)
    twin = pairs.filter("range2 <> range or tile2 <> tile").select(
        "label", "d", F.col("range2").alias("range"), F.col("tile2").alias("tile"), "pair")
    right = tiled.join(twin, at).withColumn("side", F.lit(1)).select(*cols)
    found = cut_lineage(left.union(right).groupBy("pair").applyInPandas(
        _compare(threshold), "cls long, links long, root long"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = (classes.join(links, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left").select(
        F.col("label").alias("l"), F.col("embedding").alias("e"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "cls").alias("component_id")))
    linked = rows.filter("ok").join(named, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")))
    out = linked.select("vec_id", "n_links", "component_id").union(rows.filter("not ok").select(
        "vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
