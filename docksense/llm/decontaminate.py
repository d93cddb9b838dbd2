"""Benchmark decontamination: a prefix-filtered set join of item windows with whole texts, verified word by word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docksense.llm.words import Words, split_words, text_slices, translated
from docksense.session import cut_lineage

#: Words of a window, and of the shingles by which windows are found.
WINDOW, SHINGLE = 10, 3
#: Bits of the filter over shingles that tasks get (8 MB), a power of two; the more shingles, the more it lets through.
FILTER_BITS = 1 << 26
#: A long text is looked at in parts of about so many bytes, each with the last words of the one before.
PART_BYTES = 4 << 20
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: A word: a run of digits, lower-case letters a-z and all code points from U+0080 on, after A-Z are lower-cased.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in words.to_pylist()]), "<u8")


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words from the hashes of the words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out += hashes[j:j + len(out)] * np.uint64((_MIX * (2 * j + 1) * (2 * n + 1) | 1) & _MASK)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id (string), window (its words joined by spaces), n (words), shingles (hashes in order).

    A row for each run of ``window`` words of an item; an item with fewer words, but not none, is one window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = translated(batch.column(1), WORD_BYTES)
            for lo, hi in text_slices(texts):
                got = split_words(texts.slice(lo, hi - lo))
                names, hashes = got.distinct.to_pylist(), word_hashes(got.distinct)
                out: list[list] = [[], [], [], []]
                for i in range(hi - lo):
                    codes = got.codes[got.starts[i]:got.starts[i + 1]]
                    n = min(window, len(codes))
                    for s in range(len(codes) - n + 1 if n else 0):
                        one = codes[s:s + n]
                        out[0].append(batch.column(0)[lo + i].as_py())
                        out[1].append(" ".join(names[c] for c in one))
                        out[2].append(n)
                        out[3].append(shingle_hashes(hashes[one], min(shingle, n)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], pa.list_(pa.int64()))], ["item_id", "window", "n", "shingles"])

    named = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    return named.mapInArrow(run, "item_id string, window string, n int, shingles array<long>")


def shingle_filter(shingles: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for each value that a shingle's hash may take modulo ``bits``; its size does not depend on the shingles."""
    place = F.pmod(F.col("shingle"), F.lit(bits)) + 1  # bitmaps count from 1
    found = shingles.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in found:
        at = (r.bucket - 1) * len(r.bits)
        out[at:at + len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)[:len(out) - at]
    return out


def _passing(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of hashes that the filter lets through."""
    place = h & np.uint64(len(bits) * 8 - 1)
    return np.flatnonzero(bits[(place >> np.uint64(3)).view(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)


class _Part(NamedTuple):
    """Whole texts, or a part of one: rows, words, global places of the first word and of the shingles from ``done`` on."""

    rows: np.ndarray
    words: Words
    base: int
    done: int
    again: int
    more: bool


def _parts(texts: pa.Array, window: int) -> Iterator[_Part]:
    """Texts in batches, long ones in parts.

    A part of a long text begins with the last words of the one before, so that every shingle is seen once with all the
    words that a window around it may cover.
    """
    for lo, hi in text_slices(texts, PART_BYTES):
        data = texts[lo].as_buffer().to_pybytes() if hi - lo == 1 else b""
        if len(data) <= PART_BYTES:
            yield _Part(np.arange(lo, hi), split_words(texts.slice(lo, hi - lo)), 0, 0, 0, False)
            continue
        at, tail, base, done = 0, [], 0, 0
        while at < len(data):
            end = data.find(b" ", at + PART_BYTES)
            end = len(data) if end < 0 else end
            part = b" ".join([*tail, data[at:end]])
            words = split_words(pa.array([part.decode()], pa.string()))
            yield _Part(np.array([lo]), words, base, done, len(tail), end < len(data))
            n = len(words.codes)
            tail = part.split()[-2 * window:]
            at, done, base = end, max(done, base + n - window), base + n - len(tail)


def _shingles(texts: pa.Array, lengths: list[int], bits: np.ndarray, window: int) -> Iterator[tuple[_Part, np.ndarray, list]]:
    """For each part: the text of each word, and for each length the hashes of shingles and the places that pass."""
    for part in _parts(translated(texts, WORD_BYTES), window):
        words = part.words
        hashes = word_hashes(words.distinct)[words.codes] if len(words.codes) else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(part.rows)), np.diff(words.starts))
        found = []
        for n in lengths:
            h = shingle_hashes(hashes, n)
            at = _passing(h, bits)
            at = at[(owner[at] == owner[at + n - 1]) & (at + part.base >= part.done)]
            found.append((n, h, at[at < len(owner) - window] if part.more else at))
        yield part, owner, found


def shingle_counts(docs: DataFrame, lengths: list[int], bits: np.ndarray, window: int) -> DataFrame:
    """shingle, seen: how often each shingle that passes the filter occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found in _shingles(batch.column(0), lengths, bits, window):
                hit = np.concatenate([np.empty(0, np.uint64), *(h[at] for _, h, at in found)])
                value, n = np.unique(hit.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n.astype(np.int64))], ["shingle", "seen"])

    part = docs.select("text").mapInArrow(run, "shingle long, seen long")
    return part.groupBy("shingle").agg(F.sum("seen").alias("seen"))


def shingle_places(docs: DataFrame, lengths: list[int], bits: np.ndarray, window: int) -> DataFrame:
    """doc_id, row, words, shingle, place, first, context: where a shingle that passes the filter begins, and the words around.

    ``context`` holds the words from ``first`` on that any window around the shingle may cover. A row of each text
    without a shingle has its number of words (a long text has one for each part).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, owner, found in _shingles(batch.column(2), lengths, bits, window):
                words, starts = part.words, part.words.starts
                row = [part.rows]
                sizes, where = np.diff(starts) - part.again, [[], [], []]
                around = []
                for n, h, at in found:
                    lo, hi = starts[owner[at]], starts[owner[at] + 1]
                    first = np.maximum(lo, at - (window - n))
                    row.append(part.rows[owner[at]])
                    for c, x in zip(where, (h[at].view(np.int64), at - lo + part.base, first - lo + part.base)):
                        c.append(x)
                    last = np.minimum(hi, at + window)
                    around += [" ".join(words.distinct.take(pa.array(words.codes[a:b])).to_pylist())
                               for a, b in zip(first.tolist(), last.tolist())]
                take = pa.array(np.concatenate(row))
                none = pa.nulls(len(sizes), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     pa.concat_arrays([pa.array(sizes, pa.int64()), pa.nulls(len(take) - len(sizes), pa.int64())]),
                     *(pa.concat_arrays([none, *(pa.array(x, pa.int64()) for x in c)]) for c in where),
                     pa.array([*[None] * len(sizes), *around], pa.string())],
                    ["doc_id", "row", "words", "shingle", "place", "first", "context"])

    schema = StructType([docs.schema["doc_id"], *_places_schema()])
    return docs.select("doc_id", "row", "text").mapInArrow(run, schema)


def _places_schema() -> StructType:
    return StructType.fromDDL("row long, words long, shingle long, place long, first long, context string")


def rare_prefixes(docs: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """window, n, shingle, at, size: the one shingle of each window that a text holding it must have, its rarest.

    A window is found whole or not at all, so of its shingles in order of rarity a prefix of one is enough. ``at`` is its
    place in the window, ``size`` its words. Windows with a shingle that no text has are left out.
    """
    each = windows.select("window", "n", F.posexplode("shingles").alias("at", "shingle"), F.size("shingles").alias("k"))
    each = each.withColumn("size", F.col("n") - F.col("k") + 1)
    lengths = [r.size for r in each.select("size").distinct().collect()]
    counts = shingle_counts(docs, lengths, shingle_filter(each.select("shingle")), window)
    rarest = each.join(counts, "shingle").groupBy("window", "n").agg(
        F.min_by(F.struct("shingle", "at", "size"), F.struct("seen", "shingle", "at")).alias("p"),
        F.count("*").alias("found"), F.first("k").alias("k"))
    return rarest.filter("found = k").select("window", "n", "p.shingle", "p.at", "p.size")


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[
        DataFrame, DataFrame, DataFrame]:
    """Texts, spans and items: what of the benchmark occurs where.

    * texts: ``row`` (a number for each row of ``docs``), doc_id, n_words;
    * spans: ``row``, start, end (words, end exclusive), window: every occurrence of a window in a text;
    * items: item_id (string), window.

    A window is ``window`` consecutive words of an item, or the whole of an item with fewer. Items' shingles of
    ``shingle`` words are counted over all texts; each window is looked up by its rarest one only (prefix filter), in a
    join on the shingle's hash. The shingle's place tells where the window would begin and end; that must lie within the
    text (positional and length bounds), and there its words must be the window's, one by one.
    """
    known = cut_lineage(item_windows(items, window, shingle).distinct())
    windows = known.select("window", "n", "shingles").distinct()
    docs = docs.select("doc_id", "text")
    prefixes = cut_lineage(rare_prefixes(docs, windows, window))
    lengths = [r.size for r in prefixes.select("size").distinct().collect()]
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    # numbers of rows hold within this one written table
    places = cut_lineage(shingle_places(numbered, lengths, shingle_filter(prefixes.select("shingle")), window))
    start = F.col("place") - F.col("at")
    skip = (start - F.col("first")).cast("int")
    around = F.split("context", " ")
    fits = (skip >= 0) & (skip + F.col("n") <= F.size(around))
    same = F.concat_ws(" ", F.slice(around, F.greatest(skip, F.lit(0)) + 1, F.col("n"))) == F.col("window")
    spans = places.filter("shingle is not null").join(prefixes, "shingle").filter(fits & same).select(
        "row", start.alias("start"), (start + F.col("n")).alias("end"), "window")
    texts = places.filter("shingle is null").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sum("words").alias("n_words"))
    return texts, cut_lineage(spans), known.select("item_id", "window").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` words lie in an occurrence of a window of an item, ``n_items`` items have such a window; the digest is of
    their ids as sorted strings, joined by commas (the digest of the empty string if there is none). Null and empty texts
    have no words. A repeated row of documents gives a row each; repeated items, and items with one id, count once; an
    item without id hits words but is not counted. Empty tables give no rows (documents) or no hits (items); other
    columns are ignored.
    """
    texts, spans, named = contaminated_spans(docs, items, window, shingle)
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max("end").over(before)
    own = spans.select("row", "start", "end").distinct().withColumn(
        "new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(covered, F.lit(0)))))
    hit = own.groupBy("row").agg(F.sum("new").alias("n_hit"))
    held = spans.select("row", "window").distinct().join(named, "window").select("row", "item_id").distinct().groupBy(
        "row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return texts.join(hit, "row", "left").join(held, "row", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


#: The contract in SQL: every run of words of a document is compared with every window of that length.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_places AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s
  FROM item_words WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS t FROM item_places),
places AS (
  SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
  FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
runs AS (SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS t FROM places),
found AS (SELECT r, s, runs.n, item_id FROM runs JOIN windows ON runs.n = windows.n AND runs.t = windows.t),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM found) GROUP BY r),
held AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""
