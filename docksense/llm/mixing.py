"""Mixing sources to target weights with DataFrame operations only: capped shares, Sainte-Lague seats, seeded blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docksense.llm.common import WORD
from docksense.session import cut_lineage

#: Words in a block, and in a shard on average.
BLOCK = 16
SHARD_WORDS = 1 << 18
#: Weights of the sources in their order, repeating; the mix's size as a multiple of the input's; epochs at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 12345
_PRIME, _FACTOR = 2147483647, 48271


def seeded(doc_id: str) -> Column:
    """Pseudo-random order of ids (a null id counts as 0)."""
    start = F.pmod(F.coalesce(F.col(doc_id).cast("long"), F.lit(0)) % _PRIME + SEED, F.lit(_PRIME))
    return F.pmod(F.pmod(start * _FACTOR, F.lit(_PRIME)) * _FACTOR + SEED, F.lit(_PRIME))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, pos, source_size, target for rows (source, size): one row per source.

    A source's share follows its weight but stops at ``EPOCHS`` times its size; what is left is shared among the others
    by weight until none is above. By rising cap per weight the capped sources come first, so one pass decides: a
    source is capped if the level that all later ones could have reaches its cap.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          F.pmod(F.col("pos") - 1, F.lit(len(WEIGHTS))).cast("int") + 1)
    got = total.withColumn("pos", F.row_number().over(by_name)).withColumn("w", weight)
    got = got.withColumn("cap", F.col("source_size") * float(EPOCHS)).withColumn(
        "all", F.sum("source_size").over(every) * SHARE)
    fill = Window.orderBy(F.col("cap") / F.col("w"), "pos")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    got = got.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("w"))
    left = F.col("all") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    return got.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(
        left * F.col("w") / open_weight)).select("source", "pos", "source_size", "target")


def sainte_lague(parts: DataFrame, group: list[str], order: str, weight: str, seats: str) -> DataFrame:
    """``parts`` with a column ``quota``: the group's ``seats`` go to the highest quotients weight / (s + 1/2).

    The seats that are certain come from a divisor just too large for all seats; the at most three candidates per row
    that remain are ranked. Ties go to the smaller ``order``.
    """
    by = Window.partitionBy(*group)
    w, n = F.col(weight).cast("double"), F.col(seats)
    sized = parts.withColumn("_all", F.sum(w).over(by)).withColumn("_k", F.count("*").over(by))

    def at(slack: Column) -> Column:
        return F.when(F.col("_all") > 0, F.floor(w * F.greatest(n + slack, F.lit(0.0)) / F.col("_all") + 0.5)).otherwise(0)

    sized = sized.withColumn("_low", at(-F.col("_k") / 2)).withColumn("_high", at(F.col("_k") / 2) + 1)
    sized = sized.withColumn("_sure", F.sum("_low").over(by))
    key = [*group, order]
    tries = sized.filter(w > 0).select(*key, "_sure", n.alias("_n"), w.alias("_w"),
                                      F.explode(F.sequence("_low", "_high")).alias("_s"))
    rank = F.row_number().over(by.orderBy(F.desc(F.col("_w") / (F.col("_s") + 0.5)), order))
    won = tries.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_n") - F.col("_sure"))
    won = won.groupBy(*key).agg(F.count("*").alias("_won"))
    out = sized.join(won, key, "left")
    return out.withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0))).drop(
        "_all", "_k", "_low", "_high", "_sure", "_won")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_size", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"))


def _planned(sized: DataFrame) -> DataFrame:
    """``sized`` (documents with their _size) with _source_size, _target, _start (words before it in its shard), _whole
    (times the mix takes the whole document) and _extra (words of its beginning that it takes once more)."""
    targets = source_targets(sized.select("source", F.col("_size").alias("size")))
    targets = targets.withColumn("n_blocks", F.sum("target").over(Window.partitionBy()) / BLOCK)
    targets = targets.withColumn("n_blocks", F.round("n_blocks").cast("long")).withColumn("one", F.lit(1))
    quotas = sainte_lague(targets, ["one"], "pos", "target", "n_blocks").select(
        F.col("source").alias("_source"), "pos", F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"), F.col("quota").alias("_blocks"),
        F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).alias("_shards"))
    placed = sized.join(quotas, sized["source"].eqNullSafe(quotas["_source"])).drop("_source")
    placed = placed.withColumn("_order", seeded("doc_id"))
    placed = placed.withColumn("_shard", F.col("_order") % F.col("_shards"))
    shards = placed.groupBy("pos", "_shard").agg(F.sum("_size").alias("_shard_size"), F.first("_blocks").alias("_blocks"))
    shards = sainte_lague(shards, ["pos"], "_shard", "_shard_size", "_blocks")
    # words of a shard that are taken: full epochs, and its first blocks once more
    n = F.ceil(F.col("_shard_size") / BLOCK)
    quota = F.least(F.col("quota"), n * EPOCHS)
    shards = shards.filter("_shard_size > 0").select(
        F.col("pos").alias("_pos"), F.col("_shard").alias("_of"), F.floor(quota / n).alias("_epochs"),
        (quota % n * BLOCK).alias("_first"))
    within = Window.partitionBy("pos", "_shard").orderBy("_order", "doc_id", "_size")
    placed = placed.withColumn("_start", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    placed = placed.join(shards, (F.col("pos") == F.col("_pos")) & (F.col("_shard") == F.col("_of")), "left")
    extra = F.greatest(F.least(F.col("_first") - F.col("_start"), F.col("_size")), F.lit(0))
    return placed.withColumn("_whole", F.coalesce("_epochs", F.lit(0))).withColumn("_extra", F.coalesce(extra, F.lit(0)))


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words that the mix takes of it).

    Sources in order of code points (null last, a source of its own) have the weights 3, 1, 2, repeating, and share 150
    % of all words; a target stops at twice its source's size. Equal blocks of words are given to sources and then to
    the shards of a source by highest quotients. Within a shard the documents lie in a seeded order; the quota takes
    all blocks as often as it can and the first ones once more. So no document is taken more than twice, most are taken
    whole, and a source misses its target by a block or so. Null and blank texts have size 0 and nothing is taken.
    Repeated rows are documents each; null ids are ordered like 0. An empty table gives an empty table; other columns
    are ignored. Shards have ``SHARD_WORDS`` words on average whatever a source holds.
    """
    # words are counted once: the counts are read for the sources' totals and again for the documents
    got = _planned(cut_lineage(_sized(docs.select("doc_id", "text", "source")).drop("text")))
    return got.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                      F.col("_target").alias("target"), (F.col("_size") * F.col("_whole") + F.col("_extra")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: a row for each time that a document is taken, with all columns of ``docs``.

    Where a quota ends within a document, the last row has its first words only, and n_chars (if there) follows.
    """
    # the rest of the caller's row travels as one column, so that its names meet none of the plan's
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc")
    got = _planned(_sized(docs.select("doc_id", "text", "source", rest)))
    parts = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(parts, 1, F.col("_extra").cast("int")), "")
    cut = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_size"))
    copies = F.col("_whole") + F.when(F.col("_extra") > 0, 1).otherwise(0)
    rows = got.filter((F.col("_size") > 0) & (copies > 0)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    short = cut & (F.col("_copy") > F.col("_whole"))
    rows = rows.select("_doc", short.alias("short"), F.when(short, head).otherwise(F.col("text")).alias("text"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        own = F.col("_doc").getField(name)
        if name == "n_chars":
            own = F.when(F.col("short"), F.length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return rows.select(*[column(c) for c in docs.columns])


#: The same plan in DuckDB SQL.
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS pos FROM t),
w AS (SELECT *, CAST(CASE (pos - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w,
        source_size * {float(EPOCHS)}e0 AS cap, (SELECT sum(source_size) FROM t) * {SHARE}e0 AS al FROM p),
l AS (SELECT *, (al - coalesce(sum(cap) OVER (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
f AS (SELECT *, cap <= lev * w AS fl FROM l),
g AS (SELECT *, CASE WHEN fl THEN cap ELSE
        (al - (SELECT coalesce(sum(cap), 0) FROM f WHERE fl)) * w / (SELECT sum(w) FROM f WHERE NOT fl) END AS target FROM f),
n AS (SELECT CAST(round(sum(target) / {BLOCK}) AS BIGINT) AS n FROM g),
q AS (SELECT pos, row_number() OVER (ORDER BY target / (s.s + 0.5) DESC, pos) AS r
      FROM g, range(0, 1000000) AS s(s) WHERE s.s <= target / {BLOCK} + 2),
b AS (SELECT g.*, (SELECT count(*) FROM q WHERE q.pos = g.pos AND r <= (SELECT n FROM n)) AS blocks,
        greatest(ceil(source_size / {SHARD_WORDS}.0), 1) AS shards FROM g),
o AS (SELECT d.doc_id, d.size, b.*, ((coalesce(d.doc_id, 0) % {_PRIME} + {SEED}) % {_PRIME} + {_PRIME}) % {_PRIME} AS u0
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
u AS (SELECT *, ((u0 * {_FACTOR}) % {_PRIME} * {_FACTOR} + {SEED}) % {_PRIME} AS u FROM o),
v AS (SELECT *, CAST(u % shards AS BIGINT) AS shard FROM u),
h AS (SELECT pos, shard, sum(size) AS shard_size, max(blocks) AS blocks, max(source_size) AS whole, max(shards) AS shards_of FROM v GROUP BY pos, shard),
hq AS (SELECT pos, shard, blocks, row_number() OVER (PARTITION BY pos ORDER BY shard_size / (s.s + 0.5) DESC, shard) AS r
      FROM h, range(0, 1000000) AS s(s) WHERE shard_size > 0 AND s.s <= shard_size * blocks / whole + shards_of + 2),
hb AS (SELECT h.*, ceil(shard_size / {BLOCK}.0) AS nb, least((SELECT count(*) FROM hq WHERE hq.pos = h.pos AND hq.shard = h.shard
        AND r <= hq.blocks), ceil(shard_size / {BLOCK}.0) * {EPOCHS}) AS quota FROM h),
x AS (SELECT v.*, nb, quota, sum(size) OVER (PARTITION BY v.pos, v.shard ORDER BY u, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)
        - size AS start FROM v JOIN hb ON hb.pos = v.pos AND hb.shard = v.shard)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN nb = 0 THEN 0 ELSE
  size * floor(quota / nb) + greatest(least((quota % nb) * {BLOCK} - start, size), 0) END AS BIGINT) AS taken FROM x
"""
