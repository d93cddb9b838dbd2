"""The pipeline's stages: decisions take effect, columns stay, the result is what the parts give by brute force."""

import corpus_pipeline
from docksense.llm import mixing, quality
from docksense.llm.common import read
from test_secrets import KINDS
from test_simhash import brute_print, brute_roots

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns, labels = docs.columns, read(spark, SF, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = corpus_pipeline.good(spark, docs, SF)
    accepted = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == accepted
    single = corpus_pipeline.without_copies(spark, good, SF)
    prints = {d: brute_print(texts[d]) for d in accepted}
    lab, first = brute_roots(set(prints.values())), {}
    for d in sorted(accepted):
        first.setdefault(lab[prints[d]], d)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(first.values())
    safe = corpus_pipeline.without_secrets(spark, single, SF)
    rows = safe.collect()
    assert safe.columns == columns and {r.doc_id for r in rows} == set(first.values())
    for r in rows:
        assert not any(ok(m) for _, p, ok in KINDS for m in p.finditer(r.text) if "[secret]" not in m[0])
        assert r.n_chars == len(r.text)
    mixed = corpus_pipeline.mixed(spark, safe, SF)
    took = {r.doc_id: r.taken for r in mixing.mix_plan(safe).collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert mixed.columns == columns and words == {d: n for d, n in took.items() if n}


def test_run(spark):
    from tokenizers import Tokenizer

    from docksense.llm.queries import tokenizer_path

    rows = corpus_pipeline.run(spark, SF).collect()
    docs = read(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r.length for r in rows) == want
