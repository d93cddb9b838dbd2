"""Words of a whole Arrow batch at once, numbered in C; small helpers for tasks that work on them."""

from __future__ import annotations

import sys
import types
from array import array
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split at once; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


class Words(NamedTuple):
    """Words of several texts: text i has ``codes[starts[i]:starts[i + 1]]``, numbers of words in ``distinct``."""

    starts: np.ndarray
    codes: np.ndarray
    distinct: pa.Array


def text_slices(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text each (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, to
        at = to


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with every byte replaced by the table's; the table must map ASCII to ASCII and keep all else."""
    texts = pc.fill_null(texts, "")
    texts = pa.concat_arrays([texts])  # offsets from 0
    data = texts.buffers()[2]
    data = bytes(data).translate(table) if data is not None else b""
    return pa.StringArray.from_buffers(len(texts), texts.buffers()[1], pa.py_buffer(data), offset=texts.offset)


def split_words(texts: pa.Array, blanks: bool = False) -> Words:
    """The texts (without nulls) cut at each space; empty words are left out unless ``blanks``."""
    lists = pc.split_pattern(texts, " ")
    starts = np.asarray(lists.offsets, np.int64)
    coded = lists.values.dictionary_encode()
    codes, distinct = np.asarray(coded.indices, np.int32), coded.dictionary
    starts, codes = starts - starts[0], codes[starts[0]:starts[-1]]
    empty = pc.index(distinct, "").as_py() if len(distinct) else -1
    if not blanks and empty >= 0:
        kept = codes != empty
        starts = np.r_[0, np.cumsum(kept)][starts]
        codes = codes[kept]
    return Words(starts, codes, distinct)


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (sizes[0] numbers), then the same for the next range."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def per_process(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returned for the key in this worker process, kept for its later tasks."""
    store = sys.modules.setdefault("docksense_worker_store", types.ModuleType("docksense_worker_store"))
    if key not in store.__dict__:
        store.__dict__[key] = make()
    return store.__dict__[key]


class Known:
    """Numbers of words that a task has met, kept while they repeat.

    ``numbers`` gives the numbers of distinct words; a subclass computes what belongs to new ones in ``add`` and moves its
    arrays in ``keep``. When there are more than ``limit`` words, those met in one batch only are dropped.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.number: dict[str, int] = {}
        self.batches = np.zeros(0, np.int32)  # batches that a word was met in

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > self.limit:
            self._drop()
        out = list(map(self.number.get, words))
        if None in out:
            new = [w for w, n in zip(words, out) if n is None]
            self.add(new)
            first = len(self.number)
            self.number.update(zip(new, range(first, first + len(new))))
            self.batches = np.concatenate([self.batches, np.zeros(len(new), np.int32)])
            out = list(map(self.number.get, words))
        found = np.array(out, np.int64)
        self.batches[found] += 1
        return found

    def _drop(self) -> None:
        kept = np.flatnonzero(self.batches > 1)
        if len(kept) > self.limit // 2:
            kept = kept[:0]  # nearly all repeat: begin anew rather than sort out again and again
        words = list(self.number)
        self.number = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.batches = np.zeros(len(kept), np.int32)
        self.keep(kept)

    def add(self, words: list[str]) -> None:
        raise NotImplementedError

    def keep(self, kept: np.ndarray) -> None:
        raise NotImplementedError


class Ragged:
    """Rows of numbers of different lengths, one after the other; grows in place."""

    def __init__(self, code: str) -> None:
        self.flat, self.bounds = array(code), array("q", [0])

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Rows of the given sizes, their numbers in a row."""
        self.bounds.frombytes((np.cumsum(sizes, dtype=np.int64) + len(self.flat)).tobytes())
        self.flat.frombytes(flat.astype(self.flat.typecode).tobytes())

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        bounds = np.frombuffer(self.bounds, np.int64)
        return bounds[rows + 1] - bounds[rows]

    def take(self, rows: np.ndarray) -> np.ndarray:
        """The numbers of the rows, row after row."""
        flat = np.frombuffer(self.flat, self.flat.typecode) if len(self.flat) else np.zeros(0, self.flat.typecode)
        return flat[spread(np.frombuffer(self.bounds, np.int64)[rows], self.sizes(rows))]

    def keep(self, rows: np.ndarray) -> None:
        flat, sizes = self.take(rows), self.sizes(rows)
        self.flat, self.bounds = array(self.flat.typecode), array("q", [0])
        self.extend(flat, sizes)
