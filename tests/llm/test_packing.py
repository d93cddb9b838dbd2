"""Packing: ids against the tokenizer, gapless sequences, best fit against the row-by-row algorithm."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docksense.llm.packing import WordIds, best_fit, pack
from docksense.llm.queries import op5_packing, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, tokenizer, capacity=2048):
    by, seqs = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want = [(k, s, len(ids[s:s + capacity]), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()))
                for k, s in enumerate(range(0, len(ids), capacity))]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[doc_id])
        assert got == want * (len(got) // len(want))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def plain(counts, capacity):
    """Best-fit decreasing, a piece at a time."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - length)
            else:
                rooms.append(capacity - length)
    return len(rooms)


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op5_packing(spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(texts)
    used = check(rows, texts, tokenizer)
    counts = {}
    for r in rows:
        counts[r.length] = counts.get(r.length, 0) + 1
    assert used <= plain(counts, 2048) and used <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_texts(spark, tokenizer):
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "don't STOP it's we'll 42 <|endoftext|>x <|startoftext|>"),
             (5, "éä ﬁ İstanbul  x\x85y \x1c\x1d ΑΣ Σας"), (6, "word " * 700000), (7, "😀👍🏽 日本語 текст ½ ªº"),
             (8, "x" * 3000), (9, "a b  c\r\nd"), (None, "no id"), (10, "!!! ??? ...a b...c 'tis '"), (11, "ß ÿ ø Ÿ À×÷")]
    df = spark.createDataFrame([(d, t, 1) for d, t in [*texts, texts[3], texts[3]]], "doc_id long, text string, length int")
    check(pack(df, tokenizer_path()).collect(), texts, tokenizer)
    assert pack(df.limit(0), tokenizer_path()).count() == 0


def test_word_ids_equal_the_tokenizer(tokenizer):
    rng, known = random.Random(2), WordIds(tokenizer_path())
    letters = "abcXYZéÀßøñç'’.,;-_#0189 \n\t ́日😀"
    letters += "<|endoftext|>&(\"*=^~Aa\x85\x1c\u00a0\u0338×÷İſKΣ\U0001d400"
    known.limit = 700
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    texts += ["<|EndOfText|> x<|endoftext|>y", "don't 'tis i'll we've 'S", "a=\u0338b", "x\u0301, é, É; ÷, ×! ñ'll", "12.5%3,000a1b2"]
    texts += [a + b for a in "aé1,'÷ß日\u0301" for b in "aé1,'÷ß日\u0301"]
    for i in range(0, len(texts), 200):
        for text, ids in zip(texts[i:i + 200], known.of(pa.array(texts[i:i + 200]))):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(known.number) < 2000


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_over_counts(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    counts = {rng.randint(1, capacity): rng.choice([1, 2, 7, 100]) for _ in range(rng.randint(1, 40))}
    ends, taken = {}, {}
    for length, first, number, sequence, offset in sorted(best_fit(counts, capacity), key=lambda s: (s[3], s[4])):
        taken.setdefault(length, []).append((first, number))
        for k in range(number):
            ends.setdefault(sequence + k, []).append((offset, length))
    for length, parts in taken.items():
        at = 0
        for first, number in sorted(parts):
            assert first == at
            at += number
        assert at == counts[length]
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(ends) <= plain(counts, capacity)
