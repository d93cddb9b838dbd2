"""Tokenizer alignment against the tokenizers on whole texts and plain loops."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from docksense.llm import alignment
from docksense.llm.alignment import Aligner, NO_TOKENS, align, byte_letters, compose, fragment, ranges, whole
from docksense.llm.queries import op13_align_tokenizers, tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def known():
    return Aligner(tokenizer_path(A), tokenizer_path(B))


class Plain:
    """The tokenizers' own results for whole texts."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
        self.letters = byte_letters()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                   for p in map(self.b.id_to_piece, b)]
        data = (" " + text).encode()
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return []
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        common, out, i, j = sorted(set(a_ends) & set(b_ends)), [], 0, 0
        for end in common:
            one = ([], [])
            while i < len(a) and a_ends[i] <= end:
                one[0].append(a[i])
                i += 1
            while j < len(b) and b_ends[j] <= end:
                one[1].append(b[j])
                j += 1
            out.append(one)
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, docs):
    grouped = [(d, plain.groups(t)) for d, t in docs]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in grouped]
    counts = Counter(p for one in links for p in one)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (d, g), one in zip(grouped, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
                    sum(n for p, n in one.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in one.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=str)


def test_query(spark, plain):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op13_align_tokenizers(spark, sf)) == expected(plain, docs)


ODD = [None, "", " ", "\n", "  a", "a ", "a\n", "\n\na", "a\n\nb c\n d", "don't we'll 'tis 's\n's", "<|endoftext|> </s><s> <0x0A> x",
       "a▁b", "▁", "é ü ﬁ ＡＢ", "日本語 の テキスト　全角", "😀👍🏽 x😀y", "\x00 a\x00b", "\x1c x \x1d\x1ey\x85 z w v", "a \t b\r\nc",
       "x" * 3000, "=-" * 500, "1234567 89 0", "é ẹ̈", "​ ‍﻿ x", "words and\twords   and more\n\n\nwords"]


def odd_docs(rng):
    letters = "abcXYZéÀß'’.,;-_#018  \n\t▁ 日😀"
    docs = [(i // 2, t) for i, t in enumerate(ODD)] + [(None, "no id here"), (None, "no id here")]
    docs += [(1000 + i, "".join(rng.choice(letters[:-3] if i % 3 else letters) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    docs += [(2000 + i, " ".join(rng.choice(["the", "wordy", "Überfluß,", "\n", "naïve", "日本"]) for _ in range(200))) for i in range(8)]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(t, 7, d, "x") for d, t in docs], "text string, row int, doc_id long, pair string")


@pytest.mark.parametrize(("seed", "size", "fan"), [(0, 1 << 16, 16), (1, 64, 2), (2, 17, 3), (3, 1, 2)])
def test_odd_texts(spark, plain, seed, size, fan):
    docs = odd_docs(random.Random(seed))
    assert result(align(frame(spark, docs).repartition(3), tokenizer_path(A), tokenizer_path(B), size, fan)) == expected(plain, docs)


def test_few_pairs_at_once_and_few_words_kept(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 40)
    docs = odd_docs(random.Random(8))
    got = align(frame(spark, docs), tokenizer_path(A), tokenizer_path(B), 200, 2)
    assert result(got) == expected(plain, docs)


def test_dropped_words(known, plain):
    """Words met once are dropped, the others keep what belongs to them."""
    import pyarrow as pa

    one = Aligner(tokenizer_path(A), tokenizer_path(B))
    one.limit = 40
    rng = random.Random(4)
    for i in range(12):
        texts = [" ".join(["again and", *(str(rng.random()) for _ in range(6)), "again"]) for _ in range(4)]
        for _, starts, words in one.words_of(pa.array(texts)):
            for t, a, b in zip(texts, starts, starts[1:]):
                want = plain.groups(t)
                text = b"".join(one.texts[w] for w in words[a:b].tolist())
                assert text.decode() == "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in want)
                codes = np.array(one.codes)[one.pair.take(words[a:b])]
                got = Counter(dict.fromkeys(codes.tolist(), 0))
                for c, n in zip(codes.tolist(), one.times.take(words[a:b]).tolist()):
                    got[c] += n
                assert got == Counter(x * one.b_ids + y for g in want for x in g[0] for y in g[1])
    assert one.version > 0


def test_empty_table(spark):
    assert align(frame(spark, odd_docs(random.Random(1))).limit(0), tokenizer_path(A), tokenizer_path(B)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_fragments_compose_in_any_order(known, seed):
    rng = random.Random(seed)
    text = " " + "".join(rng.choice("aé日 xyz'.\n") for _ in range(400))
    t = known.by.tokens(text)
    end = int(t.a_ends[-1])
    want = whole(known, fragment(known, t))
    cuts = sorted({0, end, *(rng.randint(0, end) for _ in range(60))})
    parts = [fragment(known, t.part(a, b)) for a, b in zip(cuts, cuts[1:])]
    while len(parts) > 1:
        i = rng.randrange(len(parts) - 1)
        parts[i:i + 2] = [compose(known, parts[i], parts[i + 1])]
    got = whole(known, parts[0])
    assert got.text == want.text and (got.totals == want.totals).all() and len(parts[0].suffix.a) == 0
    assert (got.pairs == want.pairs).all() and (got.times == want.times).all()
    assert fragment(known, NO_TOKENS).closed is False


def test_ranges(known):
    text = " " + "word, wörd\n" * 50 + "x" * 300 + " end of it"
    for size in (1, 10, 64, 1000):
        got = list(ranges(text, size))
        assert got[0][0] == 0 and got[-1][1] == len(text.encode())
        for (_, to, _, _), (after, *_) in zip(got, got[1:]):
            assert to == after
        data = text.encode()
        for after, to, begin, part in got:
            assert data[begin:begin + len(part.encode())] == part.encode() and begin <= after <= to <= begin + len(part.encode())
