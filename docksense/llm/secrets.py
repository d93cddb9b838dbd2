"""Secret scans with SQL functions only: three patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
           r"([A-Za-z0-9+/_.=-]+)")
#: kind -> pattern, in the order that breaks ties. The minimum lengths of access and hex are part of the pattern: their
#: matches are whole runs, so a match that is too short is not found at all.
BASE = {"assign": _ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
ASSIGN_VALUE = 6
#: Characters in a window, and for each class its alphabet, candidate pattern, what a candidate must hold besides, and
#: the bits per character that a window must reach. The limits of one letter case are reached by 99 of 100 random strings of
#: 20 characters over 36 and 32 signs (simulated); a digit is asked for, since words run together come close to them.
WINDOW = 20
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", r"(?<![A-Za-z0-9])[0-9a-fA-F]{20,}(?![A-Za-z0-9])",
                    ("[0-9]", "[a-fA-F]"), 3.0),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
                       r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}", ("[0-9]", "[a-z]", "[A-Z]"), 3.8),
    "entropy_lower": ("0123456789abcdefghijklmnopqrstuvwxyz", r"(?<![A-Za-z0-9])[a-z0-9]{20,}(?![A-Za-z0-9])",
                      ("[0-9]", "[a-z]"), 3.4),
    "entropy_upper": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"(?<![A-Za-z0-9])[A-Z0-9]{20,}(?![A-Za-z0-9])",
                      ("[0-9]", "[A-Z]"), 3.3),
}
#: Candidates that are no secrets as a whole: ids.
ALLOWED = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
#: Parts that say nothing: a date in front with its time, words of placeholders, rows of signs. They are taken out and what is
#: left is judged, so a key beside such a part is found.
ALLOWED_PARTS = (r"(?i)^\d{4}-\d\d-\d\d(?:[t_-]?\d\d[-_]?\d\d(?:[-_]?\d\d)?z?(?![a-z0-9]))?"
                 r"|example|sample|dummy|placeholder|x{4,}|0?123456789|abcdefghij|qwerty")
#: Paths and addresses are none either if at most this share of their characters lies in segments that do not look like
#: words: random base64 has slashes too. A word is of one case but for its first letter, or several such words run together,
#: with a number behind it or before it. The repeats are possessive: they are matched in a loop, where a greedy group would
#: take a stack frame for each part of a long path.
PATH = r"(?i)^[a-z0-9_.+-]++(?:/[a-z0-9_.+-]++){3,}+/?$"
WORDS = (r"(?<![^/])(?:[._+-]|(?:[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+[0-9]*+|[A-Z]++[0-9]*+|[0-9]++[a-z]*+)(?=[._+/-]|$))++(?=/|$)")
ODD_SHARE = 0.25
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _located(text: Column, pattern: str, keep, rank: int, kind: str) -> Column:
    """Spans, in code points, of all leftmost non-overlapping matches that ``keep(whole, groups)`` accepts.

    Matches and the gaps between them alternate, so running lengths give the places. Most texts have no match and end
    after one scan.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(gaps, whole, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"), m.alias("t")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,t:string>>)").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["g"]
        one = F.struct(at.alias("start"), (at + x["m"]).alias("end"), x["t"].alias("t"))
        return F.struct((at + F.coalesce(x["m"], F.lit(0))).alias("at"),
                        F.when(x["m"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(one))).alias("found"))

    placed = F.aggregate(sizes, start, step, lambda acc: acc["found"])
    spans = F.transform(F.filter(placed, lambda s: keep(s["t"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.when(F.size(whole) > 0, spans).otherwise(F.expr(f"cast(array() as {SPANS})"))


def window_entropy(run: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits per character) of any window of the run; null if it is shorter than a window.

    One pass: a step adds one character's count and takes away the one that leaves, and keeps the sum of c * log2(c).
    """
    size = len(alphabet)
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c))
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    zero = F.struct(F.array_repeat(F.lit(0), size + 1).alias("n"), F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("best"))

    def f(c: Column) -> Column:
        return F.get(table, c)

    def merged(code: Column):
        def step(acc: Column, i: Column) -> Column:
            new = F.get(code, i)
            old = F.when(i >= window, F.get(code, i - window))
            gone = F.when(old.isNotNull(), f(F.get(acc["n"], old)) - f(F.get(acc["n"], old) - 1)).otherwise(0.0)
            n_new = F.get(acc["n"], new) - F.when(old == new, 1).otherwise(0)
            s = acc["s"] - gone + f(n_new + 1) - f(n_new)
            counts = F.transform(acc["n"], lambda v, k: v + F.when(k == new, 1).otherwise(0)
                                 - F.when(k == old, 1).otherwise(0))
            full = F.when(i >= window - 1, math.log2(window) - s / window)
            return F.struct(counts.alias("n"), s.alias("s"), F.greatest(acc["best"], full).alias("best"))

        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), zero, step, lambda acc: acc["best"])

    # the codes are bound once by a one-element transform
    return F.get(F.transform(F.array(codes), merged), F.lit(0))


def _is_path(run: Column) -> Column:
    odd = F.length(F.regexp_replace(F.regexp_replace(run, WORDS, ""), "/", ""))
    return F.rlike(run, F.lit(PATH)) & (odd <= F.length(F.regexp_replace(run, "/", "")) * ODD_SHARE)


def secret_spans(text: Column) -> tuple[Column, Column]:
    """Base spans, and the spans that entropy adds: candidates with a window of high entropy that are not on the allow
    list. ``scan`` leaves out those that lie within another span."""
    text = F.coalesce(text, F.lit(""))
    keep = {"assign": lambda t: F.length(F.regexp_extract(t, _ASSIGN, 2)) >= ASSIGN_VALUE}
    base = F.array_sort(F.concat(*[
        _located(text, pattern, keep.get(kind, lambda t: F.lit(True)), rank, kind)
        for rank, (kind, pattern) in enumerate(BASE.items())]))
    added = []
    for rank, (kind, (alphabet, pattern, holds, least)) in enumerate(CLASSES.items(), len(BASE)):
        def high(t: Column, alphabet=alphabet, holds=holds, least=least) -> Column:
            rest = F.regexp_replace(t, F.lit(ALLOWED_PARTS), F.lit(""))
            ok = ~F.rlike(t, F.lit(ALLOWED)) & ~_is_path(t)
            for h in holds:
                ok = ok & F.rlike(rest, F.lit(h))
            return F.when(ok, F.coalesce(window_entropy(F.rtrim(rest, F.lit("=")), alphabet) >= least, F.lit(False))
                          ).otherwise(False)

        added.append(_located(text, pattern, high, rank, kind))
    return base, F.concat(*added)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and two more: ``_base`` and ``_spans`` (base and added), arrays of start, rank, end, kind by start."""
    base, added = secret_spans(F.col(text))
    both = docs.withColumn("_base", base).withColumn("_added", added)
    # a span within another adds nothing; of equal ones the first class has the place
    own = F.filter("_added", lambda a: ~F.exists("_base", lambda b: (b["start"] <= a["start"]) & (a["end"] <= b["end"]))
                   & ~F.exists("_added", lambda b: (b["start"] <= a["start"]) & (a["end"] <= b["end"]) & (
                       (b["end"] - b["start"] > a["end"] - a["start"]) | (b["rank"] < a["rank"]))))
    return both.withColumn("_spans", F.when(F.size("_added") == 0, F.col("_base")).otherwise(
        F.array_sort(F.concat("_base", own)))).drop("_added")


def _joined(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Places are code points, the end is exclusive, an assignment's span is its whole match. Null and empty texts have no
    spans and the digest of the empty string. Repeated rows are reported each, null ids too. An empty table gives an
    empty table; other columns are ignored. Nothing is shuffled.
    """
    found = scan(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined("_base"), 256).alias("base_sha256"),
                        _joined("_spans").alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mask``; overlapping spans become one. Other texts stay as they are.

    A column n_chars, if there is one, follows the text. All other columns are returned as they are.
    """
    found = scan(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text")))  # the caller's columns keep their names
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when((s["start"] < acc["at"]), acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mask))).alias("out"))

    clean = F.aggregate("_spans", zero, step, lambda acc: F.concat(acc["out"], F.substring(
        F.col("text"), acc["at"] + 1, F.length("text"))))
    hit = F.size("_spans") > 0
    out = found.select(F.col("doc"), hit.alias("hit"), F.when(hit, clean).otherwise(F.col("text")).alias("text"))

    def column(name: str) -> Column:
        own = F.col("doc").getField(name)
        if name == "n_chars":
            own = F.when(F.col("hit"), F.length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return (F.col("text") if name == "text" else own).alias(name)

    return out.select(*[column(c) for c in docs.columns])
