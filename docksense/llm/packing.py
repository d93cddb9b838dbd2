"""Best-fit packing planned on the histogram of lengths; documents take the planned slots by rank within length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docksense.llm.words import Known, Ragged, per_process, split_words, text_slices
from docksense.session import cut_lineage

CAPACITY = 2048
#: Hash buckets that a length is dealt into for ranking, so that no length is ranked in one task.
RANK_BUCKETS = 64
#: Distinct words whose ids a task keeps; when there are more, those met in one batch only go.
CACHE_WORDS = 250_000
#: Slots that one row of the plan is opened to at once.
SLOT_STEP = 1 << 16
_TEXT_STEP = 1 << 20  # characters of a long text that are laid out at once

#: Classes of bytes: 1 letter, 2 digit, 3 sign, 4 apostrophe, 0 all else. The tokenizer's rules end a token between two
#: classes, but a letter may belong to an apostrophe before it.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_CLASS[39] = 4
_ENDS = np.zeros(25, bool)
for _x, _y in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)):
    _ENDS[_x * 5 + _y] = True
#: ASCII lower case; all ASCII white space is a space.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: A word that is one token to merge: letters of the first two Unicode blocks, or signs.
_ONE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-/:-@\\[-`{-~]+")


def parted(texts: pa.Array) -> pa.Array:
    """The texts in lower case (ASCII) with a space wherever a token surely ends, so that fewer words differ.

    The tokenizer drops white space and case, so its ids stay the same. Texts that may name a special token are left alone.
    """
    special = pc.match_substring(texts, "<|")
    if pc.any(special).as_py():
        out = pc.if_else(special, texts, parted(pc.if_else(special, "", texts)))
        return out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(bytes(whole).translate(_LOWER) if whole is not None else b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets.astype(np.int64) - offsets[0]
    kind = _CLASS[data]
    ends = _ENDS[kind[:-1] * 5 + kind[1:]]
    # a letter of two bytes before a sign; the multiplication and division signs are not letters
    two = (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7) & (kind[2:] >= 3)
    ends[1:] |= two[:len(ends[1:])]
    at = np.flatnonzero(ends) + 1
    moved = offsets + np.searchsorted(at, offsets, side="left")
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(moved.astype(np.int32).tobytes()),
                                       pa.py_buffer(np.insert(data, at, 32).tobytes()))


class WordIds(Known):
    """Token ids of texts, word by word.

    The tokenizer never joins what white space parts, so the ids of a text are the ids of its words in a row. New words
    are tokenized many at a time: a word of letters, digits or signs only has as many tokens with a word's end as it has
    parts, which tells where its ids end. Every other word is tokenized alone.
    """

    def __init__(self, path: str) -> None:
        super().__init__(CACHE_WORDS)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ids = Ragged("I")

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def add(self, words: list[str]) -> None:
        parts = [len(w) if w.isdigit() and w.isascii() else 1 if _ONE.fullmatch(w) else 0 for w in words]
        ids = self._encoded(" ".join([w for w, n in zip(words, parts) if n]))
        last = np.flatnonzero(self.ends[ids]) + 1
        ends = np.r_[0, last][np.cumsum(parts)].tolist()
        out, at = [], 0
        for word, n, end in zip(words, parts, ends):
            out.append(ids[at:end] if n else self._encoded(word))
            at = end
        self.ids.extend(np.concatenate(out), np.array(list(map(len, out)), np.int64))

    def keep(self, kept: np.ndarray) -> None:
        self.ids.keep(kept)

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (none null)."""
        for lo, hi in text_slices(texts):
            got = split_words(parted(texts.slice(lo, hi - lo)))
            numbers = self.numbers(got.distinct.to_pylist())[got.codes]
            flat = self.ids.take(numbers)
            ends = np.r_[0, np.cumsum(self.ids.sizes(numbers))][got.starts].tolist()
            for a, b in zip(ends, ends[1:]):
                yield flat[a:b]


def _in_parts(texts: pa.Array) -> tuple[pa.Array, list[int]]:
    """The texts, long ones cut at spaces or line feeds, and the text that each part belongs to."""
    texts = pc.fill_null(texts, "")
    sizes = np.asarray(pc.binary_length(texts))
    if not len(sizes) or sizes.max() <= _TEXT_STEP:
        return texts, list(range(len(texts)))
    parts, owner = [], []
    for i, text in enumerate(texts.to_pylist()):
        at = 0
        while at < len(text) or at == 0:
            end = at + _TEXT_STEP
            if end < len(text):
                cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                if cut <= at:  # one endless word
                    found = [p for p in (text.find(" ", end), text.find("\n", end)) if p >= 0]
                    cut = min(found, default=len(text))
                end = cut
            parts.append(text[at:end])
            owner.append(i)
            at = end + 1
    return pa.array(parts, pa.string()), owner


def word_ids(path: str) -> WordIds:
    return per_process(f"word ids {path}", lambda: WordIds(path))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end id, cut after every ``capacity`` ids.

    ``path`` is the tokenizer's file, at the same place on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for batch in batches:
            texts, owner = _in_parts(batch.column(1))
            rows = []
            rest, piece = np.zeros(0, np.uint32), 0
            for i, ids in enumerate(known.of(texts)):
                ended = i + 1 == len(owner) or owner[i + 1] != owner[i]
                rest = np.concatenate([rest, ids, np.full(int(ended), end_id, np.uint32)])
                for at in range(0, len(rest) if ended else len(rest) - capacity + 1, capacity):
                    one = rest[at:at + capacity]
                    rows.append((owner[i], piece, piece * capacity, len(one), zlib.crc32(one.astype("<u4").tobytes())))
                    piece += 1
                rest, piece = (rest[:0], 0) if ended else (rest[len(rest) // capacity * capacity:], piece)
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in columns[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("piece int, start long, length long, ids_crc32 long")])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: slots (length, first rank, number, first sequence, offset).

    Sequences that were filled alike are one group with a number, so the work depends on the number of lengths only.
    Each length, longest first, goes to the sequences with the least room that takes it; what no open sequence takes
    opens new ones, which take the same length as often as it fits. The slot's k-th piece (by rank) lies in the k-th of
    the ``number`` sequences from the first on.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, number)
    slots, sequences = [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        for space in sorted(r for r in room if r >= length):
            while left and space >= length and room.get(space):
                first, number = room[space].pop()
                fits = min(space // length, -(-left // number))  # times that the group takes the length
                for t in range(fits):
                    take = min(number, left)
                    slots.append((length, rank, take, first, capacity - space + t * length))
                    rank, left = rank + take, left - take
                    if take < number or left == 0 and t < fits - 1:
                        break
                if take < number:
                    room.setdefault(space - (t + 1) * length, []).append((first, take))
                    room.setdefault(space - t * length, []).append((first + take, number - take))
                else:
                    room.setdefault(space - (t + 1) * length, []).append((first, number))
            if not left:
                break
        while left:
            per = capacity // length
            number = left // per or 1
            per = min(per, left)
            for t in range(per):
                slots.append((length, rank, number, sequences, t * length))
                rank, left = rank + number, left - number
            room.setdefault(capacity - per * length, []).append((sequences, number))
            sequences += number
    return slots


def ranked(rows: DataFrame, by: str, order: list[str | Column], bucket: Column) -> DataFrame:
    """``rows`` with a column ``rank`` from 0 within ``by``, computed in buckets so that no group is sorted in one task."""
    spread = rows.withColumn("_bucket", F.pmod(bucket, F.lit(RANK_BUCKETS)))
    sizes = spread.groupBy(by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(by).alias("_by"), F.col("_bucket").alias("_of"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy(*order)) - 1
    spread = spread.withColumn("_own", own)
    joined = spread.join(F.broadcast(sizes), (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_of")))
    return joined.withColumn("rank", (F.col("_before") + F.col("_own")).cast("long")).drop(
        "_bucket", "_by", "_of", "_before", "_own")


def planned_slots(spark: SparkSession, counts: dict[int, int], capacity: int = CAPACITY) -> DataFrame:
    """length, rank, sequence_id, offset: the place of each piece, opened from the plan's rows in steps."""
    plan = spark.createDataFrame(best_fit(counts, capacity), "length long, first long, number long, sequence long, offset long")
    steps = plan.select("*", F.explode(F.sequence(F.lit(0), F.col("number") - 1, F.lit(SLOT_STEP))).alias("at"))
    k = F.explode(F.sequence(F.col("at"), F.least(F.col("at") + SLOT_STEP, F.col("number")) - 1)).alias("k")
    return steps.repartition("length", "first", "at").select("*", k).select(
        "length", (F.col("first") + F.col("k")).alias("rank"), (F.col("sequence") + F.col("k")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document has the ids of its whole text (null: none) and ``end_id``; only one with more than ``capacity`` ids is
    cut. Sequences are filled without gaps from offset 0. An empty text is a piece of one id. Repeated rows are packed
    each; their equal pieces may swap slots between runs, which changes no row. Null ids are kept. An empty table gives
    an empty table; other columns are ignored. The plan has a bounded size whatever the corpus: the driver sees one
    count per length and makes a few rows per length. Pieces take their slots by a join on length and rank.
    """
    cut = cut_lineage(pieces(docs, path, capacity, end_id))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    order = ["doc_id", "piece", "start", "ids_crc32"]
    rows = ranked(cut, "length", order, F.xxhash64("doc_id", "piece"))
    return rows.join(planned_slots(docs.sparkSession, counts, capacity), ["length", "rank"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
