"""Alignment of two tokenizers' tokens over the bytes of a text, and how often their ids are linked in a corpus.

Where tokens of both end, a group ends. Words that stand between simple spaces are tokenized alike wherever they stand, so a
task aligns each distinct one once. Very long texts are cut into byte ranges, each a fragment of an associative monoid: tokens
up to the first common end (open prefix), closed groups, tokens after the last common end (open suffix). Fragments are
composed by a tree of Spark tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docksense.llm.words import Known, Ragged, per_process, spread, split_words, text_slices
from docksense.session import cut_lineage

#: Texts with more characters are cut into ranges of so many.
CHUNK = 1 << 16
#: Fragments composed at once.
FAN = 16
#: Distinct words that a task keeps, words tokenized in one call, pairs of ids that a task gets at once (16 bytes each).
KNOWN_WORDS, AT_ONCE, BLOCK_PAIRS = 500_000, 2048, 4_000_000
#: Bytes of text that are split into words at once.
SPLIT_BYTES = 8 << 20
#: A group with more links than this is counted by its distinct ids.
LARGE_GROUP = 1 << 12

#: Fixed value: the pattern by which byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {chr(b) if b in shown else chr(next(hidden)): b for b in range(256)}


class Tokenizers:
    """Tokenizer A (byte-level BPE, a JSON file) and B (sentence pieces, a model file) with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            known = json.load(file)
        letters, special = byte_letters(), {t["id"] for t in known.get("added_tokens", [])}
        vocabulary, merges = known["model"]["vocab"], known["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if i not in special}
        if [vocabulary[x + y] for x, y in pairs] != list(range(256, 256 + len(pairs))):
            raise ValueError("ids of tokenizer A must follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in ranks.items():
            self.a_bytes[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        if any(re.search("[^▁]▁|\n", p) for p in pieces):
            raise ValueError("pieces of tokenizer B must not go over a space or a line feed")
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # what a token is written as within a group and at its end
        self.written = [f"{i}{end}".encode() for n, last in ((len(self.a_bytes), "|"), (len(self.b_bytes), ";"))
                        for i in range(n) for end in (",", last)]

    def tokens(self, text: str) -> Tokens | None:
        """Ids and ends (in bytes) of a text that begins with a space; None if either's bytes are not the text's."""
        a, b, data = self.a.encode_ordinary(text), self.b.encode(text[1:]), text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b]))


class Tokens(NamedTuple):
    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def part(self, after: int, to: int) -> Tokens:
        """Tokens that end after ``after`` and not after ``to``."""
        i, j = np.searchsorted(self.a_ends, [after, to], side="right")
        k, m = np.searchsorted(self.b_ends, [after, to], side="right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def then(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other)))


NO_TOKENS = Tokens(*[np.zeros(0, np.int64)] * 4)


class Groups:
    """Closed groups of tokens whose last ends are equal."""

    def __init__(self, t: Tokens, ends: np.ndarray, written: list[bytes], a_ids: int, b_ids: int) -> None:
        self.t, self.ends, self.table, self.a_ids, self.b_ids = t, ends, written, a_ids, b_ids
        self.of_a, self.of_b = np.searchsorted(ends, t.a_ends), np.searchsorted(ends, t.b_ends)
        self.n_a, self.n_b = np.bincount(self.of_a, minlength=len(ends)), np.bincount(self.of_b, minlength=len(ends))
        self.links = self.n_a * self.n_b

    def written(self, bounds: np.ndarray) -> list[bytes]:
        """The groups as text, ``a,a|b;`` each, cut before the groups in ``bounds``."""
        a_before, b_before = np.r_[0, np.cumsum(self.n_a)], np.r_[0, np.cumsum(self.n_b)]
        out = np.empty(len(self.t.a) + len(self.t.b), np.int64)
        last_a = np.arange(len(self.t.a)) + 1 == a_before[self.of_a + 1]
        last_b = np.arange(len(self.t.b)) + 1 == b_before[self.of_b + 1]
        out[np.arange(len(self.t.a)) + b_before[self.of_a]] = self.t.a * 2 + last_a
        out[np.arange(len(self.t.b)) + a_before[self.of_b + 1]] = (self.a_ids + self.t.b) * 2 + last_b
        parts = list(map(self.table.__getitem__, out.tolist()))
        at = (a_before + b_before)[bounds].tolist()
        return [b"".join(parts[i:j]) for i, j in zip(at, [*at[1:], len(parts)])]

    def pairs(self, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner (of the group), pair of ids and number of links, a row for each pair of an owner."""
        small = self.links <= LARGE_GROUP
        a_at = np.flatnonzero(small[self.of_a])
        group = self.of_a[a_at]
        times = self.n_b[group]
        b_first = np.cumsum(self.n_b) - self.n_b
        owners = [np.repeat(owner[group], times)]
        found = [np.repeat(self.t.a[a_at], times) * self.b_ids + self.t.b[spread(b_first[group], times)]]
        weights = [np.ones(len(owners[0]), np.int64)]
        a_first = np.cumsum(self.n_a) - self.n_a
        for g in np.flatnonzero(~small).tolist():
            a, n = np.unique(self.t.a[a_first[g]:a_first[g] + self.n_a[g]], return_counts=True)
            b, m = np.unique(self.t.b[b_first[g]:b_first[g] + self.n_b[g]], return_counts=True)
            found.append((a[:, None] * self.b_ids + b).ravel())
            weights.append((n[:, None] * m).ravel())
            owners.append(np.full(len(found[-1]), owner[g]))
        owners, found, weights = (np.concatenate(x) for x in (owners, found, weights))
        order = np.lexsort((found, owners))
        return _summed(owners[order], found[order], weights[order])


def _summed(owners: np.ndarray, found: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    new = np.flatnonzero(np.r_[True, (owners[1:] != owners[:-1]) | (found[1:] != found[:-1])][:len(found)])
    return owners[new], found[new], np.add.reduceat(weights, new) if len(new) else weights[:0]


class Aligner(Known):
    """Aligned words: numbers of tokens, groups and links, the groups as text, pairs of ids with their links."""

    def __init__(self, a_path: str, b_path: str) -> None:
        super().__init__(KNOWN_WORDS)
        self.by = Tokenizers(a_path, b_path)
        self.a_ids, self.b_ids = len(self.by.a_bytes), len(self.by.b_bytes)
        self.totals = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.good = np.zeros(0, bool)
        self.texts: list[bytes] = []
        self.pair, self.times = Ragged("q"), Ragged("q")
        self.local: dict[int, int] = {}  # pair -> number in this process
        self.codes = array_of()

    def groups(self, t: Tokens, ends: np.ndarray) -> Groups:
        return Groups(t, ends, self.by.written, self.a_ids, self.b_ids)

    def add(self, words: list[str]) -> None:
        for i in range(0, len(words), AT_ONCE):
            self._add(words[i:i + AT_ONCE])

    def _add(self, words: list[str]) -> None:
        """Words begin with a space or line feed; a word in front keeps B's own space away from them."""
        text = " a" + "".join(words)
        t = self.by.tokens(text)
        sizes = np.array([len(w.encode()) for w in words], np.int64)
        ends = 2 + np.cumsum(sizes)
        if t is not None:
            t = t.part(2, int(ends[-1]))
            common = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
        if t is None or not np.isin(ends, common).all():
            if len(words) > 1:
                self._add(words[:len(words) // 2])
                self._add(words[len(words) // 2:])
            else:
                self._append(np.zeros((1, 4), np.int64), [False], [b""], *[np.zeros(0, np.int64)] * 3)
            return
        got = self.groups(t, common)
        owner = np.searchsorted(ends, common)
        n = len(words)
        totals = np.stack([np.bincount(owner, w, n) for w in (got.n_a, got.n_b, np.ones(len(common)), got.links)], axis=1)
        texts = got.written(np.searchsorted(owner, np.arange(n)))
        self._append(totals.astype(np.int64), [True] * n, texts, *got.pairs(owner))

    def _append(self, totals: np.ndarray, good: list[bool], texts: list[bytes], owner: np.ndarray, pair: np.ndarray,
                times: np.ndarray) -> None:
        sizes = np.bincount(owner, minlength=len(good))
        self.totals = np.concatenate([self.totals, totals])
        self.good = np.concatenate([self.good, good])
        self.texts += texts
        self.pair.extend(self.numbered(pair), sizes)
        self.times.extend(times, sizes)

    def numbered(self, pair: np.ndarray) -> np.ndarray:
        """Numbers of the pairs in this process."""
        distinct, back = np.unique(pair, return_inverse=True)
        out = np.empty(len(distinct), np.int64)
        for i, p in enumerate(distinct.tolist()):
            n = self.local.get(p)
            if n is None:
                n = self.local[p] = len(self.local)
                self.codes.append(p)
            out[i] = n
        return out[back]

    def keep(self, kept: np.ndarray) -> None:
        codes = np.array(self.codes, np.int64)
        pair, sizes, times = codes[self.pair.take(kept)], self.pair.sizes(kept), self.times.take(kept)
        self.totals, self.good = self.totals[kept], self.good[kept]
        self.texts = [self.texts[i] for i in kept.tolist()]
        self.local, self.codes, self.pair, self.times = {}, array_of(), Ragged("q"), Ragged("q")
        self.pair.extend(self.numbered(pair), sizes)
        self.times.extend(times, sizes)
        self.version = getattr(self, "version", 0) + 1

    def words_of(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For texts without nulls, some at a time: the first row, where each text's words start, their numbers.

        A text with its leading space is cut before each space or line feed that stands between two characters that are
        not white space. Both tokenizers end a token there whatever follows or precedes.
        """
        for lo, hi in text_slices(texts, SPLIT_BYTES):
            got = split_words(pc.replace_substring(texts.slice(lo, hi - lo), "\n", " \n"), blanks=True)
            names = [w if w[:1] == "\n" else " " + w for w in got.distinct.to_pylist()]
            opens = np.array([len(w) > 1 and not w[1].isspace() for w in names], bool)
            closes = np.array([not w[-1].isspace() for w in names], bool)
            codes, starts = got.codes, got.starts
            begins = np.ones(len(codes), bool)
            begins[1:] = opens[codes[1:]] & closes[codes[:-1]]
            begins[starts[:-1]] = True
            at = np.flatnonzero(begins)
            length = np.diff(np.r_[at, len(codes)])
            single = np.zeros(len(names), bool)
            single[codes[at[length == 1]]] = True
            longer = ["".join([names[c] for c in codes[i:i + n].tolist()]) for i, n in zip(at[length > 1], length[length > 1])]
            distinct = [names[i] for i in np.flatnonzero(single).tolist()]
            merged = list(dict.fromkeys([*distinct, *longer]))
            numbers = self.numbers(merged)
            place = dict(zip(merged, numbers.tolist()))
            by_code = np.zeros(len(names), np.int64)
            by_code[single] = [place[w] for w in distinct]
            words = np.empty(len(at), np.int64)
            words[length == 1] = by_code[codes[at[length == 1]]]
            words[length > 1] = [place[w] for w in longer]
            yield lo, np.searchsorted(at, starts), words


def array_of() -> Any:
    from array import array

    return array("q")


def aligner(a_path: str, b_path: str) -> Aligner:
    return per_process(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))


def _rows(known: Aligner, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and word numbers of each text that both tokenizers give back; others, and empty ones, are left out."""
    filled = np.asarray(pc.binary_length(texts)) > 0
    for lo, starts, words in known.words_of(texts):
        bad = np.r_[0, np.cumsum(~known.good[words])]
        for i in range(len(starts) - 1):
            if filled[lo + i] and bad[starts[i + 1]] == bad[starts[i]]:
                yield lo + i, words[starts[i]:starts[i + 1]]


def short_pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """pair, n: in how many texts (``text``, not empty) each pair of ids is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_path, b_path)
        counts, mark = np.zeros(0, np.int64), np.zeros(0, np.int64)
        state: tuple = ()

        def out() -> pa.RecordBatch:
            at = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays([pa.array(codes[at]), pa.array(counts[at])], ["pair", "n"])

        codes = np.zeros(0, np.int64)
        for batch in batches:
            for _, words in _rows(known, batch.column(0)):
                now = (getattr(known, "version", 0), len(known.local))
                if now != state:
                    if state and now[0] != state[0]:  # pairs have new numbers
                        yield out()
                        counts = mark = np.zeros(0, np.int64)
                    codes = np.array(known.codes, np.int64)
                    more = np.zeros(len(codes) - len(counts), np.int64)
                    counts, mark, state = np.concatenate([counts, more]), np.concatenate([mark, more]), now
                pairs = known.pair.take(np.unique(words))
                order = np.arange(len(pairs))
                mark[pairs] = order
                counts[pairs[mark[pairs] == order]] += 1
        yield out()

    return docs.select("text").mapInArrow(run, "pair long, n long")


def _summary(n: np.ndarray, text: bytes) -> list:
    return [*n.tolist(), hashlib.sha256(text[:-1]).hexdigest()]


class PairCounts:
    """How often pairs are linked, for the ids of A from ``first`` to before ``end``; a pair that is not listed counts once."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, most: np.ndarray, first: int, end: int, b_ids: int) -> None:
        order = np.argsort(pairs)
        self.pairs, self.counts, self.most = pairs[order], counts[order], most
        self.first, self.end, self.b_ids = first, end, b_ids

    def values(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair whether its count is its A id's highest, and the count (both 0 outside of the range of ids)."""
        a = pairs // self.b_ids
        n = np.ones(len(pairs), np.int64)
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            n = np.where(self.pairs[at] == pairs, self.counts[at], 1)
        inside = (a >= self.first) & (a < self.end)
        return (n == self.most[a]) & inside, n * inside


def short_alignments(docs: DataFrame, counts: PairCounts, a_path: str, b_path: str) -> DataFrame:
    """One row for each of ``docs`` (doc_id, row, text; texts not null): the contract's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_path, b_path)
        state, best, count = None, None, None
        for batch in batches:
            rows = [[0, 0, 0, 0, "", 0, 0] for _ in range(batch.num_rows)]
            for i, words in _rows(known, batch.column(2)):
                now = (getattr(known, "version", 0), len(known.good))
                if now != state:
                    begun = state[1] if state and state[0] == now[0] else 0
                    new = np.arange(begun, now[1])
                    is_best, n = counts.values(np.array(known.codes, np.int64)) if len(known.codes) else (np.zeros(0, bool),) * 2
                    pairs, times = known.pair.take(new), known.times.take(new)
                    of = np.repeat(new - begun, known.pair.sizes(new))
                    sums = [np.bincount(of, is_best[pairs] * times, len(new)), np.bincount(of, n[pairs] * times, len(new))]
                    sums = [s.astype(np.int64) for s in sums]
                    best, count = (sums if not begun else [np.concatenate([x, s]) for x, s in zip((best, count), sums)])
                    state = now
                text = b"".join(map(known.texts.__getitem__, words.tolist()))
                rows[i] = [*_summary(known.totals[words].sum(axis=0), text), int(best[words].sum()), int(count[words].sum())]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield _result(batch.column(0), batch.column(1), columns)

    return docs.select("doc_id", "row", "text").mapInArrow(run, _schema(docs))


_COLUMNS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
            "n_best": pa.int64(), "count_sum": pa.int64()}


def _schema(docs: DataFrame) -> StructType:
    names = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _COLUMNS.items())
    return StructType([docs.schema["doc_id"], *StructType.fromDDL(f"row long, {names}")])


def _result(doc_id: pa.Array, row: pa.Array, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, row, *(pa.array(c, t) for c, t in zip(columns, _COLUMNS.values()))], ["doc_id", "row", *_COLUMNS])


# --- very long texts: fragments of byte ranges ---


class Fragment(NamedTuple):
    """What a range of a text's bytes knows of the groups.

    ``prefix``: tokens up to and with the first common end, ``suffix``: tokens after the last one; without a common end all
    tokens are in ``suffix`` and ``closed`` is False. Between them closed groups: their text, pairs and links. ``good`` is
    False if a tokenizer does not give the text back.
    """

    good: bool
    closed: bool
    totals: np.ndarray
    text: bytes
    pairs: np.ndarray
    times: np.ndarray
    prefix: Tokens
    suffix: Tokens


def fragment(known: Aligner, t: Tokens) -> Fragment:
    """The fragment of some tokens in a row."""
    ends = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
    if not len(ends):
        return Fragment(True, False, np.zeros(4, np.int64), b"", *[np.zeros(0, np.int64)] * 2, NO_TOKENS, t)
    start = t.a_ends[0] if len(t.a_ends) else 0
    start = min(int(start), int(t.b_ends[0]) if len(t.b_ends) else 0) - 1
    prefix, suffix = t.part(start, int(ends[0])), t.part(int(ends[-1]), int(max(t.a_ends[-1], t.b_ends[-1])))
    return Fragment(True, True, *_closed(known, t.part(int(ends[0]), int(ends[-1])), ends[1:]), prefix, suffix)


def _closed(known: Aligner, t: Tokens, ends: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Totals, text, pairs and links of closed groups with these ends."""
    if not len(ends):
        return np.zeros(4, np.int64), b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = known.groups(t, ends)
    _, pairs, times = got.pairs(np.zeros(len(ends), np.int64))
    return np.array([len(t.a), len(t.b), len(ends), got.links.sum()]), got.written(np.zeros(1, np.int64))[0], pairs, times


def _merged(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pairs, times = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(pairs, kind="stable")
    _, pairs, times = _summed(np.zeros(len(order), np.int64), pairs[order], times[order])
    return pairs, times


def compose(known: Aligner, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges. Associative: groups depend only on the tokens in a row."""
    if not (x.good and y.good):
        return Fragment(False, False, np.zeros(4, np.int64), b"", *[np.zeros(0, np.int64)] * 2, NO_TOKENS, NO_TOKENS)
    between = fragment(known, x.suffix.then(y.prefix if y.closed else y.suffix))
    if not between.closed:
        return x._replace(suffix=between.suffix)  # y holds no common end either
    if not x.closed:
        x, first = between, NO_TOKENS
    else:
        first = between.prefix
        group = _closed(known, first, first.a_ends[-1:])
        x = Fragment(True, True, x.totals + group[0] + between.totals, x.text + group[1] + between.text,
                     *_merged((x.pairs, x.times), group[2:], (between.pairs, between.times)), x.prefix, between.suffix)
    if not y.closed:
        return x
    return Fragment(True, True, x.totals + y.totals, x.text + y.text, *_merged((x.pairs, x.times), (y.pairs, y.times)), x.prefix,
                    y.suffix)


def whole(known: Aligner, x: Fragment) -> Fragment:
    """The fragment of a whole text: its prefix, from the beginning on, is a group as well."""
    if not x.good or not x.closed:
        return x._replace(good=False)
    group = _closed(known, x.prefix, x.prefix.a_ends[-1:])
    return Fragment(True, True, group[0] + x.totals, group[1] + x.text, *_merged(group[2:], (x.pairs, x.times)), NO_TOKENS, NO_TOKENS)


_SPACE = re.compile(r"(?<=\S) (?=\S)")


def ranges(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """Byte ranges (after, to) of a text of about ``size`` characters each, and what must be tokenized for each: its first
    byte and the text from the last simple space before the range to the first one after it.

    A range ends where it falls, in the middle of a word or a character's group of tokens, but not within a run of ``size``
    characters without a simple space, which would be tokenized again for each of its ranges.
    """
    cuts: list[tuple[int, int, int]] = [(0, 0, 0)]  # place of a cut, simple spaces around it
    for at in range(size, len(text), size):
        after = _SPACE.search(text, at, min(len(text), at + size))
        before = [m.start() for m in _SPACE.finditer(text, max(cuts[-1][0], at - size), at)]
        if after and before:
            cuts.append((at, before[-1], after.start()))
    cuts.append((len(text), len(text), len(text)))
    at_byte, at_char = 0, 0
    offsets = {}
    for c in sorted({c for cut in cuts for c in cut}):
        at_byte, at_char = at_byte + len(text[at_char:c].encode()), c
        offsets[c] = at_byte
    for (lo, first, _), (hi, _, last) in zip(cuts, cuts[1:]):
        yield offsets[lo], offsets[hi], offsets[first], text[first:last]


_PARTS = {"good": pa.bool_(), "closed": pa.bool_(), "totals": pa.list_(pa.int64()), "text": pa.binary(),
          "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()), "prefix": pa.list_(pa.list_(pa.int64())),
          "suffix": pa.list_(pa.list_(pa.int64()))}
_FRAGMENT = ("row long, k long, good boolean, closed boolean, totals array<long>, text binary, pairs array<long>, times array<long>, "
             "prefix array<array<long>>, suffix array<array<long>>")


def _cells(x: Fragment) -> list:
    plain = lambda t: [c.tolist() for c in t]
    return [x.good, x.closed, x.totals.tolist(), x.text, x.pairs.tolist(), x.times.tolist(), plain(x.prefix), plain(x.suffix)]


def _fragment_of(cells: Any) -> Fragment:
    ints = lambda c: np.array(c, np.int64)
    good, closed, totals, text, pairs, times, prefix, suffix = cells
    return Fragment(bool(good), bool(closed), ints(totals), bytes(text), ints(pairs), ints(times),
                    Tokens(*map(ints, prefix)), Tokens(*map(ints, suffix)))


def long_fragments(docs: DataFrame, a_path: str, b_path: str, size: int, fan: int) -> DataFrame:
    """doc_id, row and the fragment of each whole text of ``docs``, composed by tasks in a tree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row", "k", "after", "to", "begin", "part"]
        types = [pa.int64()] * 4 + [pa.string()]
        for batch in batches:
            for i in range(batch.num_rows):
                for k, part in enumerate(ranges(" " + batch.column(2)[i].as_py(), size)):
                    one = [pa.array([v], t) for v, t in zip((k, *part), types)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), *one], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_path, b_path)
        for batch in batches:
            rows = []
            for after, to, begin, part in zip(*(batch.column(i).to_pylist() for i in range(3, 7))):
                t = known.by.tokens(part)
                if t is None:
                    rows.append(_cells(fragment(known, NO_TOKENS)._replace(good=False)))
                else:
                    t = t._replace(a_ends=t.a_ends + begin, b_ends=t.b_ends + begin).part(after, to)
                    rows.append(_cells(fragment(known, t)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, kind) for c, kind in zip(zip(*rows), _PARTS.values()))] if rows else
                [*batch.columns[:3], *(pa.array([], kind) for kind in _PARTS.values())], ["doc_id", "row", "k", *_PARTS])

    def composed(pdf: pd.DataFrame) -> pd.DataFrame:
        known = aligner(a_path, b_path)
        pdf = pdf.sort_values("k")
        out = None
        for cells in pdf[list(_PARTS)].itertuples(index=False, name=None):
            one = _fragment_of(cells)
            out = one if out is None else compose(known, out, one)
        head = pdf.iloc[:1][["doc_id", "row", "k"]].assign(k=lambda d: d.k // fan)
        for name, cell in zip(_PARTS, _cells(out)):
            head[name] = pd.Series([cell], index=head.index, dtype=object)
        return head

    id_field = docs.schema["doc_id"]
    parts = docs.select("doc_id", "row", "text").mapInArrow(
        cut, StructType([id_field, *StructType.fromDDL("row long, k long, after long, to long, begin long, part string")]))
    schema = StructType([id_field, *StructType.fromDDL(_FRAGMENT)])
    level = cut_lineage(parts.repartition("row", "k").mapInArrow(read, schema))
    while (level.agg(F.max("k").alias("k")).first().k or 0) > 0:
        level = cut_lineage(level.groupBy("row", F.floor(F.col("k") / fan).alias("of")).applyInPandas(composed, schema))
    return level


def long_alignments(fragments: DataFrame, counts: PairCounts, a_path: str, b_path: str) -> DataFrame:
    """The contract's columns from the fragments of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_path, b_path)
        for batch in batches:
            rows = []
            for cells in zip(*(c.to_pylist() for c in batch.columns[3:])):
                x = whole(known, _fragment_of(cells))
                best, n = counts.values(x.pairs)
                rows.append([*_summary(x.totals, x.text), int((best * x.times).sum()), int((n * x.times).sum())] if x.good else
                            [0, 0, 0, 0, "", 0, 0])
            yield _result(batch.column(0), batch.column(1), list(zip(*rows)) if rows else [[]] * 7)

    return fragments.mapInArrow(run, _schema(fragments))


def long_pair_counts(fragments: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """pair, n (1): the pairs linked in each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_path, b_path)
        for batch in batches:
            for cells in zip(*(c.to_pylist() for c in batch.columns[3:])):
                x = whole(known, _fragment_of(cells))
                if x.good:
                    yield pa.RecordBatch.from_arrays([pa.array(x.pairs), pa.array(np.ones(len(x.pairs), np.int64))], ["pair", "n"])

    return fragments.mapInArrow(run, "pair long, n long")


def pair_blocks(counts: DataFrame, b_ids: int, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of A ids whose pairs counted twice or more are at most ``limit`` (one id at least, so at most B's vocabulary)."""
    sizes = {r.a: r.k for r in counts.filter("n > 1").groupBy(F.floor(F.col("pair") / b_ids).alias("a")).agg(
        F.count("*").alias("k")).collect()}
    first, held = 0, 0
    for a in sorted(sizes):
        if held and held + sizes[a] > limit:
            yield first, a
            first, held = a, 0
        held += sizes[a]
    yield first, 1 << 40


def align(docs: DataFrame, a_path: str, b_path: str, size: int | None = None, fan: int | None = None) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A's tokens of a space and the text, B's tokens of the text (B adds the space). Every token pair of a group is a link. A
    pair of ids counts the documents that hold it linked; ``count_sum`` adds that up over a document's links, ``n_best`` is
    the number of its links whose count is the highest of their A id. Null and empty texts, and those that a tokenizer does
    not give back byte by byte, have zeros and an empty digest. A repeated row of documents counts, and gives a row, each
    time; ids may be null. An empty table gives an empty table, other columns are ignored.

    Two passes over the texts: counts of pairs, then their sums. A task gets counts of at most BLOCK_PAIRS pairs; if the
    corpus has more, the second pass is made for one range of A ids after the other. Pairs counted once need no entry.
    """
    size, fan = size or CHUNK, fan or FAN
    known = aligner(a_path, b_path)
    b_ids, a_ids = known.b_ids, known.a_ids
    numbered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    is_long = F.length("text") >= size
    short = numbered.filter(~is_long)
    fragments = long_fragments(numbered.filter(is_long), a_path, b_path, size, fan)
    filled = short.filter("text <> ''")
    counts = cut_lineage(short_pair_counts(filled, a_path, b_path).unionByName(
        long_pair_counts(fragments, a_path, b_path)).groupBy("pair").agg(F.sum("n").alias("n")))
    most = np.zeros(a_ids, np.int64)
    for r in counts.groupBy(F.floor(F.col("pair") / b_ids).alias("a")).agg(F.max("n").alias("n")).collect():
        most[r.a] = r.n
    blocks = list(pair_blocks(counts, b_ids, BLOCK_PAIRS))
    if len(blocks) > 1:
        short = cut_lineage(short)  # several passes: numbers of rows must not change
    out = None
    for first, end in blocks:
        listed = counts.filter((F.col("n") > 1) & (F.col("pair") >= first * b_ids) & (F.col("pair") < end * b_ids)).toArrow()
        block = PairCounts(*(np.asarray(listed[c].combine_chunks(), np.int64) for c in ("pair", "n")), most, first, end, b_ids)
        part = short_alignments(short, block, a_path, b_path).unionByName(long_alignments(fragments, block, a_path, b_path))
        if len(blocks) > 1:
            part = cut_lineage(part)
        out = part if out is None else out.unionByName(part)
    if len(blocks) > 1:
        same = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        out = out.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in same],
                                     F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
