"""Secret scans against Python's regular expressions and plain entropy."""

import hashlib
import math
import re

from docksense.llm.queries import op10_secrets
from docksense.llm.secrets import WINDOW, redact, secret_report, window_entropy
from pyspark.sql import functions as F

KINDS = [("assign", re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
          lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def brute(text):
    text = text or ""
    spans = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(KINDS) for m in p.finditer(text) if ok(m))
    joined = ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans)
    names = [n for *_, n in spans]
    return (*[names.count(k[0]) for k in KINDS], hashlib.sha256(joined.encode()).hexdigest()), joined


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op10_secrets(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        digest, joined = brute(texts[r.doc_id])
        assert tuple(r)[1:5] == digest
        kept = [s for s in r.spans.split(",") if s and not s.startswith("entropy")]
        assert ",".join(kept) == joined


ODD = [None, "", "token=abc", "token=token = abcdefgh", "API_KEY: 'Zz9+/_.=-x' apikey='short' pAsSwOrD=\"abcdef",
       "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "é😀 AKIAAKIA" + "C1" * 9, "😀" * 3 + "ab" * 12 + "é" + "0" * 23 + "x" + "f" * 24,
       "secret = AKIA" + "Q" * 20 + " token=" + "a" * 30, "x" * 50000 + " " + "deadbeef" * 4 + " y" * 20000,
       "ſecret=abcdefgh toKen=abcdefgh", "secret==abcdef token : :abcdef", "token=\nabcdefgh", "key " * 10]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(ODD)] + [(None, "token=abcdefgh", "z")],
                               "doc_id long, text string, spans string")
    for r in secret_report(df).collect():
        digest, joined = brute(ODD[r.doc_id] if r.doc_id is not None else "token=abcdefgh")
        assert tuple(r)[1:5] == digest, r
    assert secret_report(df.limit(0)).count() == 0


def test_long_candidates(spark):
    # one string of very many parts must not use up the regex engine's stack
    texts = ["Ab1/" * 30000, "x/" * 30000 + "Zk3mQ9vT7xLp2WcR8sYbN4dF", "token=" + "a.b/" * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secret_report(df).collect()}
    for i, text in enumerate(texts):
        assert tuple(got[i])[1:5] == brute(text)[0]
    assert got[0].spans == "" and got[1].spans == ""


def test_entropy_adds(spark):
    texts = ["id Zk3mQ9vT7xLp2WcR8sYbN4dF end", "id 550e8400-e29b-41d4-a716-446655440000 end", "Chheitschaueinbeenstverheit",
             "see DEADBEEF0123A7C4E5F69B81 ok", "EXAMPLE_Key123456789_dummyA1", "path a1B/c2D/e3F/g4H/i5J/k6L/m7N"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_report(df).collect()}
    assert got == {0: "entropy_base64:3:27", 1: "", 2: "", 3: "entropy_hex:4:28", 4: "", 5: ""}
    clean = {r.doc_id: r.text for r in redact(df).collect()}
    assert clean[0] == "id [secret] end" and clean[1] == texts[1]


def test_random_base64_is_no_path(spark):
    import random

    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choices(letters, k=n)) for n in (40, 88, 200, 256, 344) for _ in range(100)]
    keys = [k for k in keys if k.count("/") > 2 and "//" not in k and k[0] not in "/+" and k[-1] != "/"]
    paths = ["usr/local/lib/python3.13/site-packages/PySpark/Sql/4.1.2", "Photos/2024/IMG_20240501/DSC0123.JPG",
             "com/acme/Billing/src/InvoiceController/V2/quickBrownFox_jumps/2nd-lazyDog"]
    df = spark.createDataFrame(list(enumerate(f"see {x} ok" for x in keys + paths)), "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in secret_report(df).collect()}
    assert len(keys) > 200
    for i, k in enumerate(keys):
        assert f"entropy_base64:4:{4 + len(k)}" in got[i], k
    for i, p in enumerate(paths, len(keys)):
        assert got[i] == [""], p


def test_spans_that_a_base_span_covers_in_part(spark):
    access, key, run = "AKIA" + "Q7" * 8, "Zk3mQ9vT7xLp2WcR8sYbN4dFhJ6gKqMw1XzTrVs5", "0123abcd4567ef89" * 2
    run = run.replace("0123", "9a1c")
    texts = [f"{access}/{key} x", f"id Zk3mQ9vT7xLp2WcR8sYbN4dF{run}Zq end", f"token={key}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_report(df).collect()}
    # the access pattern is greedy: it stops at the slash
    assert got[0] == "access:0:20,entropy_base64:0:61" and got[2] == "assign:0:46"
    at = texts[1].index("F" + run) + 1
    assert f"hex:{at}:{at + 32}" in got[1].split(",") and "entropy_base64:3:61" in got[1].split(",")
    assert {r.doc_id: r.text for r in redact(df).collect()} == {0: "[secret] x", 1: "id [secret] end", 2: "[secret]"}


def test_tokens_of_one_letter_case(spark):
    import random

    rng = random.Random(6)
    alphabets = {"entropy_lower": "abcdefghijklmnopqrstuvwxyz0123456789", "entropy_upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"}
    rows = [(kind, "".join(rng.choices(a, k=n))) for kind, a in alphabets.items() for n in (24, 32, 52) for _ in range(30)]
    words = ["AAAAAAAAAAAAAAAAAAAAAAAA1111", "ouleleelleouoneaument", "KONTROLLAUSSCHUSSVORSITZ"]
    df = spark.createDataFrame([(i, f"see {t} ok") for i, (_, t) in enumerate(rows + [("", w) for w in words])], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_report(df).collect()}
    found = sum(got[i] == f"{kind}:4:{4 + len(t)}" for i, (kind, t) in enumerate(rows))
    assert found >= 0.97 * len(rows)
    assert [got[len(rows) + i] for i in range(len(words))] == [""] * 3


def test_redact(spark):
    df = spark.createDataFrame([(1, "é token=abcdef0123456789abcdef012345 x", 1), (2, "clean", 5), (3, None, None)],
                               "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, redact(df).collect())) == [(1, "é [secret] x", 12), (2, "clean", 5), (3, None, None)]


def test_allowed_parts_hide_no_key(spark):
    key = "Zk3mQ9vT7xLp2WcR8sYbN4dFhJ6gKqMw1XzTrVs5"
    tokens = [f"2024-01-01-{key}", f"{key}example", f"{key[:17]}123456789{key[17:]}", f"2024-01-01T12-30-45Z-{key}", f"{key}xxxx",
              f"dummy_{key}_placeholder", f"{key[:20]}qwerty{key[20:]}"]
    none = ["2024-01-01T12-30-45-example-A1", "Your-Example-Token-Placeholder-123456789", "ABCDEFGHIJ0123456789abcdefghij",
            "550e8400-e29b-41d4-a716-446655440000"]
    df = spark.createDataFrame(list(enumerate(f"see {t} ok" for t in tokens + none)), "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in secret_report(df).collect()}
    for i, t in enumerate(tokens):
        assert f"entropy_base64:4:{4 + len(t)}" in got[i], t
    assert [got[len(tokens) + i] for i in range(len(none))] == [[""]] * len(none)
    clean = {r.doc_id: r.text for r in redact(df).collect()}
    assert all(clean[i] == "see [secret] ok" for i in range(len(tokens)))


def test_redact_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "token=abcdef99 x", "a", 7, 2.5, "d", 3)],
                               "doc_id long, text string, _spans string, _base int, _added double, doc string, hit int")
    assert [tuple(r) for r in redact(df).collect()] == [(1, "[secret] x", "a", 7, 2.5, "d", 3)] and redact(df).columns == df.columns


def test_window_entropy(spark):
    runs = ["abcdefghijklmnopqrstuvwxyz", "a" * 30, "abab" * 10, "short", "aaaaaaaaaaaaaaaaaaaabcdefghijklmnopqrst"]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def h(w):
        return -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))

    df = spark.createDataFrame([(r,) for r in runs], "r string").select("r", window_entropy(F.col("r"), letters).alias("h"))
    for r in df.collect():
        want = [h(r.r[i:i + WINDOW]) for i in range(len(r.r) - WINDOW + 1)]
        assert (r.h is None) == (not want) and (not want or abs(r.h - max(want)) < 1e-9)


def test_no_shuffle_no_python(spark, sf_dir):
    plan = op10_secrets(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
