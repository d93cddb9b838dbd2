"""SimHash near-duplicates: fingerprints of word shingles, linked within a bit radius by BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.llm.common import components, utf8
from docksense.session import cut_lineage

BITS = 64
#: Fingerprints in one tree; a fuller shard is dealt out once more by further bits.
SHARD_ROWS = 4096
_STEP = 1 << 16  # shingles whose bits are counted at once


def fingerprint_bytes(text: bytes, words: int, seed: int = 42) -> int:
    """Signed 64-bit fingerprint: a bit is set if more than half of the shingle hashes have it."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        shingles = [line]
    else:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        shingles = [line[s:e] for s, e in zip(starts, ends[words - 1:].tolist())]
    digest = xxhash.xxh64_digest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(shingles), _STEP):
        hashes = b"".join([digest(s, seed) for s in shingles[i:i + _STEP]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(shingles)).tobytes(), "big", signed=True)


def fingerprint(text: str | Column, words: int) -> Column:
    """Fingerprint of a text column as a long. Null, empty and blank texts have fingerprint zero."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_bytes(bytes(t), words) for t in texts], dtype="int64")

    return run(utf8(text))


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of values at most ``radius`` bits away; only edges that can lead to one are followed."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            d = (value ^ self.values[node]).bit_count()
            if d <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found

    def add(self, value: int) -> int:
        node, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while new:
            d = (value ^ self.values[node]).bit_count()
            child = self.children[node].get(d)
            if child is None:
                self.children[node][d] = new
                break
            node = child
        return new


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges of a forest that connects the same values as all links within the radius."""
    tree, parent, edges = BKTree(), [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for value in values:
        near = tree.within(value, radius)
        new = tree.add(value)
        parent.append(new)
        for other in near:
            a, b = root(new), root(other)
            if a != b:
                parent[a] = b
                edges.append((value, tree.values[other]))
    return edges


def _links(radius: int):
    """Arrow batches sorted by shard key -> edges. One shard is held at a time; shards of one or two need no tree."""
    mask = (1 << BITS) - 1

    def signed(v: int) -> int:
        return v - (1 << BITS) if v >> (BITS - 1) else v

    def of(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        twos = starts[sizes == 2]
        a, b = fps[twos], fps[twos + 1]
        near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
        left, right = [a[near].view(np.int64)], [b[near].view(np.int64)]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            values = sorted(set(fps[s:s + n].tolist()))
            edges = shard_links(values, radius)
            left.append(np.array([signed(x & mask) for x, _ in edges], np.int64))
            right.append(np.array([signed(y & mask) for _, y in edges], np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.r_[keys, batch.column(0).to_numpy()]
            fps = np.r_[fps, batch.column(1).to_numpy().view(np.uint64)]
            done = int(np.searchsorted(keys == keys[-1], True))  # the last shard may go on in the next batch
            if done:
                yield of(keys[:done], fps[:done])
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield of(keys, fps)

    return run


def _deal(shards: DataFrame, bits: int, radius: int) -> DataFrame:
    """Cut the ``bits`` bits of ``rest`` into radius + 1 blocks; a row goes to the shard of each block's value.

    Two values within the radius agree in one block at least, so they meet in one of the new shards.
    """
    width, parts = bits // (radius + 1), []
    for i in range(radius + 1):
        low = i * width
        size = bits - low if i == radius else width
        block = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        rest = F.col("rest").bitwiseAND(F.lit((1 << low) - 1))
        if low + size < bits:
            rest = rest.bitwiseOR(F.shiftleft(F.shiftrightunsigned("rest", low + size), low))
        parts.append(F.struct(F.xxhash64("key", F.lit(i), block).alias("key"), rest.alias("rest")))
    return shards.select("fp", F.explode(F.array(*parts)).alias("s")).select("fp", "s.key", "s.rest")


def fingerprint_links(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) that connect the fingerprints (distinct longs, column ``fp``) as all links within ``radius`` do.

    Shards hold the fingerprints that agree in a block of a block (pigeonhole, twice), each with its own BK-tree.
    A shard above ``shard_rows`` is dealt out again by its remaining bits until it fits; few bits are left then, so
    the size of a tree is bounded however many near copies a corpus holds.
    """
    shards = prints.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    bits = BITS
    for _ in range(2):
        shards, bits = _deal(shards, bits, radius), bits - bits // (radius + 1)
    out = None
    while True:
        full = None
        if bits // (radius + 1) >= 1 and (1 << bits) > shard_rows:
            full = cut_lineage(shards.groupBy("key").count().filter(F.col("count") > shard_rows).select("key"))
            if full.isEmpty():
                full = None
        fit = shards if full is None else shards.join(full, "key", "left_anti")
        links = fit.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(
            _links(radius), "a long, b long")
        out = links if out is None else out.union(links)
        if full is None:
            return out
        # a block of the remaining bits narrows the last block to what is left after even cuts
        shards = cut_lineage(_deal(shards.join(full, "key", "left_semi"), bits, radius))
        bits -= bits // (radius + 1)


def link_fingerprints(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``fp`` -> ``root`` for fingerprints that have a link."""
    return components(fingerprint_links(prints, radius)).select(F.col("node").alias("fp"), "root")


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; component_id is the smallest doc_id that
    links reach. Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows are
    returned as often as they come; a null doc_id is no component_id unless the whole group has none. An empty table
    gives an empty table; other columns are ignored.
    """
    rows = cut_lineage(docs.select("doc_id", fingerprint("text", words).alias("fp")))
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = link_fingerprints(firsts.select("fp"), radius)
    groups = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = groups.join(lowest, "root").select("fp", "component_id")
    return rows.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                          "component_id")


def drop_near_copies(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """Keep one document of each group: the one with the smallest doc_id (null last, ties: smaller text hash).

    Repeated rows of the kept document are one row in the result. All columns are returned as they are.
    """
    # 128 bits name a row; with 64, unrelated rows of a very large corpus would share a name
    key = [F.xxhash64("doc_id", "text").alias("_row"), F.xxhash64(F.lit(1), "text", "doc_id").alias("_more")]
    named = docs.select("doc_id", "text", *key)
    rows = cut_lineage(named.select(F.col("doc_id").alias("_id"), "_row", "_more", fingerprint("text", words).alias("fp")).distinct())
    order = F.struct(F.col("_id").isNull().alias("n"), "_id", "_row", "_more")
    firsts = rows.groupBy("fp").agg(F.min(order).alias("first"))
    roots = link_fingerprints(firsts.select("fp"), radius)
    kept = firsts.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
    # the caller's row travels as one column, and once: the copies of a kept row lie where the join has put them
    marked = docs.select(F.struct(*docs.columns).alias("doc"), *key)
    both = marked.join(kept.select("first._row", "first._more"), ["_row", "_more"])
    return both.dropDuplicates(["_row", "_more"]).select("doc.*")
