"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.llm.common import saved, table

WORD = r"[^\x20\x09-\x0D]+"
#: Sources are few, but the table of them is only broadcast up to this many rows.
FEW_SOURCES = 10_000
#: Bounds of a document's inclusion odds over those of a document of its source's mean size.
LEAST_ODDS, MOST_ODDS = 0.25, 4.0


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) of a (source, size) table.

    Sources in code-point order (null last) take the weights in turn and share ``budget`` times all sizes; a target
    stops at ``most`` times its source's size and the excess is shared again by weight until none is above. With the
    sources ordered by cap / weight that is one level: the largest of (what is left) / (weights left) over prefixes.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    s = s.select("source", "source_size", "n_docs", rank.alias("rank"), weight.alias("w"), (most * F.col("source_size")).alias("cap"))
    everything = W.partitionBy().orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    s = s.select("*", F.coalesce(F.sum("cap").over(everything), F.lit(0.0)).alias("cap_before"), F.coalesce(F.sum("w").over(everything), F.lit(0)).alias("w_before"), (budget * F.sum("source_size").over(whole)).alias("all"), F.sum("w").over(whole).alias("w_all"))
    level = F.max((F.col("all") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))).over(whole)
    return s.select("source", "source_size", "n_docs", F.least("cap", level * F.col("w")).alias("target"))


def chance(seed: str) -> Column:
    """A number in [0, 1) from a digest of the seed and the document's id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def words_in(text: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def place(seed: str, size: Column, source_size: Column, n_docs: Column) -> Column:
    """Where a document stands in its source's order, in [0, 1): k / (1 + k) of Pareto's key k, random odds over inclusion odds.

    The odds of a document's inclusion are in proportion to its size over the mean size of its source, within
    ``LEAST_ODDS`` and ``MOST_ODDS``. A factor common to a source's documents changes no order and is left out.
    """
    u = chance(seed)
    odds = F.least(F.greatest(size / (F.greatest(source_size, F.lit(1)) / n_docs), F.lit(LEAST_ODDS)), F.lit(MOST_ODDS))
    key = u / (1 - u) / odds
    return key / (1 + key)


def mix(docs: DataFrame, seed: str = "mix", rows_per_range: int = 4096, cut: bool = True, **shares) -> DataFrame:
    """Each document with its size, its source's size and target, and the words that the mix takes of it.

    Every document gets floor(target / source_size) whole copies for certain. What is left of the target is a
    fixed-size sample of one more copy: documents are ranked by Pareto's key, random odds over inclusion odds (which rise with the
    document's size, see ``place``), and taken in that order until the source's words are reached. ``cut`` takes of the last document only the words
    that fit, so the target is met to the word; without it that document is taken whole if at least half of it fits.

    The random number of a document is a digest of ``seed`` and its id, so reruns agree. Ranges of the places (about
    ``rows_per_range`` documents, as the odds' bounds allow) are summed first and the words before a document follow from
    the sums before its range, so a source of any share of the rows is never one window. A null text has size 0; a null source is a source of its own; an empty table gives
    no rows; repeated rows are separate documents. Extra columns are ignored.
    """
    narrow = docs.select("doc_id", "source", words_in("text").alias("size"))
    sizes = saved(narrow, "sizes")
    targets = saved(source_targets(sizes, **shares), "targets")
    few = targets.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES
    t = targets.withColumnRenamed("source", "t_source")
    t = F.broadcast(t) if few else t
    d = sizes.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select("doc_id", "source", "size", "source_size", "n_docs", "target", place(seed, F.col("size"), F.col("source_size"), F.col("n_docs")).alias("place"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    d = d.withColumn("copies", copies).withColumn("quota", F.round("target").cast("long") - F.col("copies") * F.col("source_size"))
    d = d.withColumn("range", F.floor(F.col("place") * F.ceil(F.col("n_docs") / rows_per_range)))
    before = F.sum("words").over(W.partitionBy("r_source").orderBy("r_range").rowsBetween(W.unboundedPreceding, -1))
    ranges = d.groupBy(F.col("source").alias("r_source"), F.col("range").alias("r_range")).agg(F.sum("size").alias("words")).select("r_source", "r_range", F.coalesce(before, F.lit(0)).alias("before"))
    d = d.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
    inside = F.sum("size").over(W.partitionBy("source", "range").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    left = F.col("quota") - F.col("before") - inside
    extra = F.greatest(F.least(left, F.col("size")), F.lit(0)) if cut else F.when(left * 2 >= F.col("size"), F.when(left > 0, F.col("size"))).otherwise(0)
    extra = F.coalesce(extra, F.lit(0))
    return d.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size") + extra).cast("long").alias("taken"), "copies", "n_docs", F.when(extra > 0, F.col("place")).alias("in"))


def mixed(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """The documents, all columns, each as often as the mix takes it (whole documents only).

    A document is in its source's sample if its place is at most the last one taken there, so the decision joins the few
    sources, and no text is shuffled. Nulls, ties, repeated rows and empty tables as in ``mix``; columns may have any names.
    """
    own = f"_{uuid.uuid4().hex}_"  # columns of docs may have any names
    source, copies, inside, times, size, n = (F.col(own + x) for x in ("source", "copies", "in", "times", "size", "n"))
    cuts = saved(mix(docs, seed, cut=False, **shares).groupBy(F.col("source").alias(own + "source")).agg(F.max("copies").alias(own + "copies"), F.max("in").alias(own + "in"), F.max("source_size").alias(own + "size"), F.max("n_docs").alias(own + "n")), "cuts")
    few = cuts.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES
    d = docs.join(F.broadcast(cuts) if few else cuts, F.col("source").eqNullSafe(source))
    at = place(seed, words_in("text"), size, n)
    d = d.withColumn(own + "times", copies + F.when(at <= inside, 1).otherwise(0)).where(times > 0)
    return d.select(*docs.columns, F.explode(F.sequence(F.lit(1), times.cast("int"))).alias(own + "copy")).select(docs.columns)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "copies", "n_docs", "in")


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS w, 2.0 :: DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT *, max((1.5 :: DOUBLE * all_size - cap_before) / (w_all - w_before)) OVER () AS level FROM (
    SELECT *, sum(source_size) OVER () AS all_size, sum(w) OVER () AS w_all,
      coalesce(sum(cap) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before
    FROM w WINDOW b AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
t AS (SELECT source, source_size, n_docs, least(cap, level * w) AS target FROM l),
d AS (
  SELECT doc_id, sizes.source, size, source_size, n_docs, target,
    CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 :: DOUBLE AS u,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
  FROM sizes JOIN t ON sizes.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CAST(round(target) AS BIGINT) - copies * source_size AS quota FROM d),
k AS (
  SELECT *, u / (1 - u) / least(greatest(size / (greatest(source_size, 1) / n_docs), 0.25 :: DOUBLE), 4.0 :: DOUBLE) AS key FROM q)
SELECT doc_id, size, source_size, target,
  CAST(copies * size + greatest(least(quota - (sum(size) OVER (PARTITION BY source ORDER BY key / (1 + key), doc_id ROWS UNBOUNDED PRECEDING) - size), size), 0) AS BIGINT) AS taken
FROM k
"""
