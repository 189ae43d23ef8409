"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 10, native).

Every source gets a budget of words; a source smaller than its budget is read in
whole epochs first, and what is left of the budget is a weighted sample without
replacement: each document draws the exponential key ``-ln(u) / quality`` from a
keyed hash ``u`` of its id, documents are taken in key order, and the sizes are
summed up to the budget. The document that crosses the budget is cut there, so a
source's words meet its target to less than one word.

The order within a source is never sorted in one task: keys fall into ranges (an
equal step of the key's logarithm), sizes are summed per range, the running sum
goes over the ranges, and only the range that crosses the budget is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import SPACE_WORD, saved, text_rows

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
JUNK = r"[!%$#&*|]"


def quality_weight(text: Column) -> Column:
    """1 for clean text, falling with the share of symbols in it, 0.1 at least."""
    junk = F.regexp_count(text, F.lit(JUNK)) / F.nullif(F.length(text), F.lit(0))
    return F.coalesce(F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * junk), F.lit(0.1))


def exponential_key(doc_id: Column, quality: Column, seed: str) -> Column:
    """-ln(u) / quality; u in (0, 1) from 52 bits of an MD5 keyed with the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))
    return -F.log(u) / quality


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> plus weight and target. One row per source: small.

    Sources by code point, null last, take the weights in turn. A target is
    weight * level, but ``max_epochs`` times the source's size at most; the level
    is such that the targets add up to all words.
    """
    alone = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)) + 1)
    s = (sizes.withColumn("rank", (F.row_number().over(alone) - 1).cast("int"))
         .withColumn("weight", w)
         .withColumn("cap", (F.col("source_size") * max_epochs).cast("double")))
    # Sources in order of the level at which they reach their cap: those capped are the first ones.
    before = (Window.orderBy(F.col("cap") / F.col("weight"), "rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    every = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / left_weight)
    s = s.withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    # The level of the first source that is not capped holds for all that are not.
    s = s.withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level"))))
                     .over(every)["level"])
    return s.select("source", "source_size", "weight",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, with_hash: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of it, repeats included: complete
    epochs of the source, plus the words that its budget still has when the
    document's turn in key order comes. ``quality``: a column of positive weights
    (default: :func:`quality_weight`). Null text: size 0, takes nothing. A null
    source is a source, the last. Documents of equal key (repeated ids) are
    ordered by size; repeated rows are separate documents. An empty table gives an
    empty result. Only the three named columns are read. ``with_hash`` adds ``t_hash``, which tells texts of one id apart.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
                       (quality if quality is not None else quality_weight(text)).alias("quality"),
                       *([F.xxhash64(text).alias("t_hash")] if with_hash else []))
    more = ["t_hash"] if with_hash else []
    rows = saved(rows.select("doc_id", "source", "size", *more,
                             exponential_key(F.col("doc_id"), F.col("quality"), seed).alias("key")), "mix-sizes")
    n = rows.count()
    steps = max(128, math.isqrt(n) // 8)  # both the ranges of a source and the rows of a range grow as the root
    rows = rows.withColumn("span", F.floor(F.log("key") * steps))
    ranges = rows.groupBy("source", "span").agg(F.sum("size").alias("span_size"))
    ranges = saved(ranges, "mix-ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("span_size").alias("source_size")), weights, max_epochs)
    ranges = ranges.join(targets, ranges["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    upto = (Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ranges = (ranges.withColumn("epochs", epochs)
              .withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
              .withColumn("budget", F.col("budget") - F.coalesce(F.sum("span_size").over(upto), F.lit(0)))  # left for this range
              .select("source", F.col("span").alias("at"), "source_size", "target", "epochs", "budget", "span_size"))
    ranges = saved(ranges, "mix-budgets")
    # (source, range) keys are spread: a hot source is as many keys as it has ranges.
    met = (rows.join(ranges.withColumnRenamed("source", "of"),
                     rows["source"].eqNullSafe(F.col("of")) & (F.col("span") == F.col("at"))))
    crossing = (F.col("budget") > 0) & (F.col("budget") < F.col("span_size"))
    done = met.filter(~crossing).withColumn("part", F.when(F.col("budget") > 0, F.col("size")).otherwise(F.lit(0)).cast("long"))
    order = (Window.partitionBy("source", "span").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    cut = (met.filter(crossing)
           .withColumn("ahead", F.coalesce(F.sum("size").over(order), F.lit(0)))
           .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("ahead"))).cast("long"))
           .drop("ahead"))
    out = done.unionByName(cut)
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), *more)


MIXED = ["size", "source_size", "target", "taken", "copies", "part"]


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as training text: the rows of ``docs`` that it takes, with size, source_size, target, taken, copies, part.

    A row stands for ``copies`` times its whole text and then ``part``, the beginning of the text
    with the words that are still due ('' if none): ``taken`` words together. The column of
    the text stays whole, also where only ``part`` is taken (copies 0). Columns of ``docs`` with one of the
    added names keep their place and take the new value. Repeated rows of one id and text take what their mix rows
    take together, on one row; ids and texts may be null, and a text without words is never taken.
    """
    taken = mix(docs, id_col, text_col, source_col, with_hash=True, **options).filter("taken > 0")
    # repeated rows draw one key: their shares are added up
    taken = taken.groupBy(F.col("doc_id").alias("of"), F.col("t_hash").alias("of_hash"), F.col("source").alias("of_source")).agg(
        F.max("size").alias("m_size"), F.max("source_size").alias("m_source_size"), F.max("target").alias("m_target"), F.sum("taken").cast("long").alias("m_taken"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("body"), F.col(f"`{source_col}`").alias("src"), F.xxhash64(F.col(f"`{text_col}`")).alias("t_hash"))
    one = rows.dropDuplicates(["doc_id", "t_hash", "src"])
    # a shuffle join whatever the size: texts meet one row each
    met = one.join(taken.hint("merge"), one["doc_id"].eqNullSafe(F.col("of")) & (one["t_hash"] == F.col("of_hash")) & one["src"].eqNullSafe(F.col("of_source")))
    due = F.col("m_taken") % F.col("m_size")
    # words with the white space behind them, as many as are due
    words = F.regexp_extract_all("body", F.lit(r"([^\x20\x09-\x0D]++[\x20\x09-\x0D]*+)"), F.lit(1))
    part = F.when(due > 0, F.array_join(F.slice(words, F.lit(1), due.cast("int")), "")).otherwise("")
    new = {"size": F.col("m_size"), "source_size": F.col("m_source_size"), "target": F.col("m_target"), "taken": F.col("m_taken"),
           "copies": F.floor(F.col("m_taken") / F.col("m_size")).cast("long"), "part": part}
    kept = [new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns]
    return met.select(*kept, *[new[c].alias(c) for c in MIXED if c not in docs.columns])




ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(greatest(0.1, 1.0 - 4.0 * ((length(text) - length(regexp_replace(text, '[!%$#&*|]', '', 'g')))::DOUBLE
                                             / CASE WHEN length(text) > 0 THEN length(text) END)), 0.1)::DOUBLE AS q,
         (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM {{docs}}),
k AS (SELECT doc_id, source, size, -ln(u) / q AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS w FROM k GROUP BY source),
-- the water level: the one at which the capped shares add up to all words
levels AS (
  SELECT (t.total - coalesce(sum(b.source_size * 3.0::DOUBLE), 0)) / (t.weights - coalesce(sum(b.w), 0)) AS level
  FROM (SELECT sum(source_size)::DOUBLE AS total, sum(w) AS weights FROM s) t, s a
  LEFT JOIN s b ON b.source_size * 3.0::DOUBLE / b.w < a.source_size * 3.0::DOUBLE / a.w
  GROUP BY a.source, t.total, t.weights, a.source_size, a.w
  HAVING a.source_size * 3.0::DOUBLE / a.w > (t.total - coalesce(sum(b.source_size * 3.0::DOUBLE), 0)) / (t.weights - coalesce(sum(b.w), 0))
  ORDER BY a.source_size * 3.0::DOUBLE / a.w LIMIT 1),
g AS (SELECT source, source_size, least(source_size * 3.0::DOUBLE, w * (SELECT level FROM levels)) AS target FROM s),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
o AS (SELECT k.*, e.source_size, e.target, e.epochs, floor(e.target - e.epochs * e.source_size)::BIGINT AS budget,
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - ahead)))::BIGINT AS taken
FROM o
"""
