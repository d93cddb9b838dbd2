"""Repeated passages by level-wise doubling: only windows that repeat at one length are looked at at twice that length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docksense.llm.common import utf8
from docksense.session import cut_lineage

#: Windows of an anchor that lies in more documents than this are pre-aggregated instead of gathered.
HOT = 5000
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bits of an anchor's hash; it only chooses candidates, so a chance match costs a row and changes nothing.
ANCHOR_BITS = 48


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), "<u8")


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes: an odd multiplier for each place, then two mixing steps."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for j in range(n):
        out += h[j:j + len(out)] * np.uint64((_MIX * (2 * j + 3) * (2 * j + 1) | 1) & _MASK)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n neighbours, by doubling."""
    size = 1
    while size < n:
        step = min(size, n - size)
        h = np.minimum(h[:-step], h[step:])
        size += step
    return h


def anchors(h: np.ndarray, words: int) -> np.ndarray:
    """For each window of ``words`` words the smallest hash of a half-length window in it.

    Equal windows have equal anchors, so a window can only repeat if its anchor does. Neighbouring windows mostly share
    theirs: about a quarter of the half-length windows are anchors.
    """
    half = (words + 1) // 2
    if len(h) < words:
        return np.empty(0, np.int64)
    short = window_hashes(h, half) >> np.uint64(64 - ANCHOR_BITS)
    return sliding_min(short, words - half + 1).astype(np.int64)


def _anchor_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(anchors(word_hashes(t.as_py().split()), words)) for t in batch.column(2)]
            sizes = np.array([len(f) for f in found], np.int64)
            rows = pa.array(np.repeat(np.arange(len(found)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found) if found else np.empty(0, np.int64)), batch.column(0).take(rows),
                 batch.column(1).take(rows)], ["anchor", "doc", "row"])

    return run


def _window_rows(words: int):
    """doc, row, text, repeated anchors -> for each run of windows with one repeated anchor: their hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows, texts, hot, cold = (batch.column(i) for i in range(5))
            out: list[list] = [[], [], [], [], []]
            values = []
            for i in range(batch.num_rows):
                h = word_hashes(texts[i].as_py().split())
                a = anchors(h, words)
                hot_i, cold_i = (c[i].values.to_numpy() if c[i].is_valid else np.empty(0, np.int64) for c in (hot, cold))
                known = np.concatenate([hot_i, cold_i])
                at = np.flatnonzero(np.isin(a, known))
                if not len(at):
                    continue
                w = window_hashes(h, words)[at].view(np.int64)
                new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (a[at[1:]] != a[at[:-1]])])
                ends = np.r_[new[1:], len(at)]
                first = a[at[new]]
                out[0].append(first)
                out[1].append(np.full(len(new), i))
                out[2].append(at[new])
                out[3].append(np.isin(first, hot_i))
                out[4].append(ends - new)
                values.append(w)
            if not values:
                continue
            anchor, index, start, is_hot, size = (np.concatenate(x) for x in out)
            index = pa.array(index)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), docs.take(index), rows.take(index), pa.array(start.astype(np.int32)), pa.array(is_hot),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(np.concatenate(values)))],
                ["anchor", "doc", "row", "start", "hot", "hashes"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (id, null last), row (hash of id and text), words' bytes."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                       F.xxhash64("doc_id", "text").alias("row"), utf8("text").alias("bytes"))


def repeated_windows(docs: DataFrame, words: int = 13) -> DataFrame:
    """doc, row, starts: the places (in words) of windows whose words also start in a document with a smaller id.

    Level one: anchors, windows of half the length, with the smallest and largest document that has them (pre-aggregated
    before the shuffle). Level two: only windows around anchors in two documents or more are hashed at full length. No
    candidate is left after that, as the windows asked for have this length. A window's key is its anchor and its
    64-bit hash, 112 bits together. Anchors in very many documents are aggregated before they are joined back, the
    others are gathered with their documents.
    """
    keyed = _keyed(docs)
    rows = keyed.mapInArrow(_anchor_rows(words), "anchor long, doc long, row long").persist()
    seen = rows.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n"))
    again = seen.filter("a < b").select("anchor", (F.col("n") > HOT).alias("hot"))
    marked = rows.select("anchor", "row").join(again, "anchor").groupBy("row").agg(
        F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("hot"),
        F.collect_list(F.when(~F.col("hot"), F.col("anchor"))).alias("cold"))
    texts = keyed.join(marked, "row").select("doc", "row", "bytes", "hot", "cold")
    found = texts.mapInArrow(_window_rows(words), "anchor long, doc long, row long, start int, hot boolean, hashes array<long>")
    found = cut_lineage(found)
    rows.unpersist()

    def windows(df: DataFrame) -> DataFrame:
        return df.select("anchor", "doc", "row", "start", F.posexplode("hashes").alias("k", "w")).select(
            "anchor", "w", "doc", "row", (F.col("start") + F.col("k")).alias("start"))

    first = F.min("doc").over(Window.partitionBy("anchor", "w"))
    cold = windows(found.filter("not hot").repartition("anchor")).withColumn("first", first)
    hot = windows(found.filter("hot"))
    lowest = hot.groupBy("anchor", "w").agg(F.min("doc").alias("first"))
    hot = hot.join(lowest, ["anchor", "w"])
    cols = ["doc", "row", "start", "first"]
    both = cold.select(*cols).union(hot.select(*cols)).filter("first < doc")
    return both.groupBy("doc", "row").agg(F.collect_list("start").alias("starts"))


def _kept(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                tokens = text.as_py().split()
                removed = 0
                if starts.is_valid:
                    edge = np.zeros(len(tokens) + 1, np.int32)
                    at = np.unique(starts.values.to_numpy())
                    edge[at] += 1
                    edge[at + words] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    kept = b" ".join([tokens[i] for i in np.flatnonzero(~gone).tolist()])
                else:
                    kept = b" ".join(tokens)
                n_words.append(len(tokens))
                n_removed.append(removed)
                digests.append(hashlib.sha256(kept).hexdigest() if len(batch.schema) == 3 else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def _with_starts(docs: DataFrame, words: int, *more: Column) -> DataFrame:
    found = repeated_windows(docs, words).select(F.col("doc").alias("_d"), F.col("row").alias("_r"), "starts")
    keyed = _keyed(docs.select("doc_id", "text")).withColumn("null_id", F.col("doc") == (1 << 63) - 1)
    both = keyed.join(found, (F.col("doc") == F.col("_d")) & (F.col("row") == F.col("_r")), "left")
    return both.select(F.when(~F.col("null_id"), F.col("doc")).alias("doc_id"), "bytes", "starts", *more)


def drop_repeats(docs: DataFrame, words: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a blank).

    Every word that lies in a window of ``words`` words which also starts in a document with a smaller doc_id goes; the
    first document keeps its own. Null, blank and short texts have no windows and keep what they have. A null doc_id
    ranks after all others and never before another null one. Rows with one id do not remove from each other, and
    repeated rows all get the same result. An empty table gives an empty table; other columns are ignored.
    """
    return _with_starts(docs, words).mapInArrow(
        _kept(words), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def kept_texts(docs: DataFrame, words: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, text: the words that ``drop_repeats`` keeps, joined by a blank."""
    return _with_starts(docs, words, F.lit(True).alias("as_text")).mapInArrow(
        _kept(words), "doc_id long, n_words long, n_removed long, text string")
