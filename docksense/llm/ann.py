"""Approximate nearest neighbours by randomly rotated one-bit codes, with error bounds that choose what is reranked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docksense.llm.common import usable

#: Bits per dimension of the code, through an orthonormal map into as many more dimensions.
BITS_PER_DIM = 4
#: Standard deviations of the estimate within which a product is taken to lie.
SPREAD = 2.0
SHARD_ROWS = 4096
QUERY_ROWS = 4096
_BLOCK = 256  # queries estimated at once


def rotation(dims: int, bits: int, seed: int = 7) -> np.ndarray:
    """``bits`` x ``dims`` matrix with orthonormal columns from a seeded Gaussian."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((bits, dims)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).astype(np.float32))


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, norm and correction scalar (product of the unit vector with its code) of each row."""
    norm = np.sqrt((x * x).sum(axis=1))
    y = (x / norm[:, None]).astype(np.float32) @ turn.T
    return np.packbits(y > 0, axis=1), norm, np.abs(y).sum(axis=1) / np.sqrt(y.shape[1], dtype=np.float32)


def estimate(codes: np.ndarray, norm: np.ndarray, scale: np.ndarray, turned: np.ndarray, q_norm: np.ndarray,
             spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products of queries (rows) with vectors (columns), and the half width of their bounds."""
    bits = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    value = (turned @ signs.T) * (norm / (scale * np.sqrt(bits))).astype(np.float32)
    width = norm * np.sqrt(np.maximum(0, 1 - scale ** 2)) / scale * spread / np.sqrt(bits - 1)
    return value, np.outer(q_norm, width).astype(np.float32)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, spread: float = SPREAD,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest vectors found for each query by largest inner product: query_id, rank, vec_id, score.

    Every vector is encoded. A task takes a shard of codes and a block of queries, estimates all products from the
    packed bits, takes the k-th largest lower bound as its limit, and computes the exact double-precision product of
    the vectors whose upper bound reaches it. Ties go to the smaller vec_id. The query's own id is no candidate.
    Vectors (and queries) that are null, zero, or hold null or non-finite components, and rows without an id, take no
    part; a query meets vectors of its own length only. Queries with fewer candidates get all. Repeated rows are
    candidates each. An empty table gives an empty table; other columns are ignored.
    """
    ok = usable("embedding") & F.col("vec_id").isNotNull()
    base = vectors.filter(ok).select("vec_id", "embedding", F.size("embedding").alias("d"))
    asked = queries.filter(ok).select(F.col("vec_id").alias("vec_id"), "embedding", F.size("embedding").alias("d"))
    n_shards = max(1, -(-base.count() // shard_rows))
    n_blocks = max(1, -(-asked.count() // query_rows))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby("d"):
                codes, norm, scale = encode(_matrix(part.embedding), rotation(d, d * BITS_PER_DIM))
                yield part.assign(code=[c.tobytes() for c in codes], norm=norm, scale=scale.astype("float64"))

    def part(df: DataFrame, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))

    def each(n: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    index = part(base, n_shards, "shard").mapInPandas(
        coded, "vec_id long, embedding array<float>, d int, shard int, code binary, norm double, scale double")
    index = index.select("*", each(n_blocks, "block"))
    asked = part(asked, n_blocks, "block").select("*", each(n_shards, "shard"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if left.empty or right.empty:
            return empty
        d = int(left.d.iloc[0])
        turn, x, ids = rotation(d, d * BITS_PER_DIM), _matrix(left.embedding), left.vec_id.to_numpy()
        codes = np.frombuffer(b"".join(left.code), np.uint8).reshape(len(left), -1)
        norm, scale = left.norm.to_numpy(), left.scale.to_numpy()
        out = []
        for at in range(0, len(right), _BLOCK):
            some = right.iloc[at:at + _BLOCK]
            q = _matrix(some.embedding)
            q_norm = np.sqrt((q * q).sum(axis=1))
            value, width = estimate(codes, norm, scale, (q.astype(np.float32) @ turn.T), q_norm, spread)
            low, high = value - width, value + width
            for r, own in enumerate(some.vec_id.to_numpy()):
                other = ids != own
                lows = low[r][other]
                limit = np.partition(lows, len(lows) - k)[len(lows) - k] if len(lows) > k else -np.inf
                near = np.flatnonzero(other & (high[r] >= limit))
                score = (x[near] * q[r]).sum(axis=1)  # row by row, so equal vectors have equal scores
                best = np.lexsort((ids[near], -score))[:k]
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(out) if out else empty

    keys = ["shard", "block", "d"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
