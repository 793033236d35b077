"""Mixing sources to target weights.

Each source's words are counted; its target is its share of all words by weight,
at most ``most`` times what it has, the excess shared anew by weight. The ratio of
target and words is a source's repetition rate: every document comes floor(rate)
times, and once more if a number drawn from a hash of its id and text falls below
the fraction.

Everything is DataFrame functions. Sources are counted before documents move, and
a table of sources is broadcast only while it has at most ``BROADCAST`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stage

#: Weights by rank of the source, and how often a document may come.
WEIGHTS, MOST = (5, 2, 1), 3
#: Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST = 20_000


def words(text: str = "text") -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: str = "doc_id", text: str = "text") -> Column:
    """A number in [0, 1) that depends on the row's key and text only."""
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def rates(sizes: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """``(source, source_size, target, rate)``, one row per source.

    Sources rank by code point, null last. A source of no words has target and
    rate 0. Targets are settled by rounds over the table of sources: those above
    their bound are fixed at it, until none is above.
    """
    sums = stage(sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size")), "mix-sources")
    # a global rank without gathering: range partitions, then places inside each
    ranged = stage(
        sums.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()), "mix-ranged"
    )
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(W.partitionBy("part").orderBy(F.asc_nulls_last("source"))) - 1 + F.col("before")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("long")
    weighted = stage(ranged.join(before, "part").select("source", "source_size", weight.alias("weight")), "mix-weights")

    whole = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = int(whole[0] or 0), int(whole[1] or 1)
    free, left = total, weights
    exact = "decimal(38,0)"
    while True:
        above = F.lit(free).cast(exact) * F.col("weight") > F.lit(MOST).cast(exact) * F.col("source_size") * F.lit(left)
        held = weighted.where(above).agg(F.sum("source_size"), F.sum("weight")).first()
        now = (total - MOST * int(held[0] or 0), weights - int(held[1] or 0))
        if now == (free, left):
            break
        free, left = now
    bound = F.lit(MOST) * F.col("source_size")
    target = F.when(above, bound.cast("double")).otherwise(F.lit(float(free)) * F.col("weight") / F.lit(float(max(left, 1))))
    rate = (
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .when(above, F.lit(float(MOST)))
        .otherwise(F.least(target / F.col("source_size"), F.lit(float(MOST))))
    )
    return weighted.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def with_rates(docs: DataFrame, found: DataFrame, source: str = "source") -> DataFrame:
    """``docs`` with the columns of their source's rate; a hot source is not shuffled."""
    right = found.withColumnRenamed("source", "__source")
    right = F.broadcast(right) if found.count() <= BROADCAST else right
    return docs.join(right, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")


def copies(drawn: Column) -> Column:
    """How often a document comes at its ``rate``."""
    rate = F.col("rate")
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(key, source, size, source_size, target, rate, copies)`` for each document.

    Null texts have size 0, null sources are a source of their own. Identical rows
    share one draw. An empty table gives an empty plan.
    """
    sized = stage(
        docs.select(F.col(key).alias(key), F.col(source).alias(source), words(text).alias("size"), draw(key, text).alias("__draw")), "mix-sizes"
    )
    return with_rates(sized, rates(sized, source), source).withColumn("copies", copies(F.col("__draw"))).drop("__draw")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents: the columns of ``docs``, each row as often as the mix takes it."""
    sizes = docs.select(F.col(source).alias("source"), words(text).alias("size"))
    found = with_rates(docs.select(F.struct("*").alias("__doc"), F.col(source).alias("__of"), draw(key, text).alias("__draw")), rates(sizes), "__of")
    times = F.sequence(F.lit(1), F.col("__copies"))
    return (
        found.select("__doc", copies(F.col("__draw")).alias("__copies"))
        .where("__copies > 0")
        .select("__doc", F.explode(times).alias("__copy"))
        .select("__doc.*")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || md5(COALESCE(text, ''))), 1, 8) AS BIGINT) / 4294967296.0 AS draw
  FROM documents
), sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size * (10 // weight), source NULLS LAST) AS k,
    SUM(source_size) OVER () AS total, SUM(weight) OVER () AS weights FROM weighted
), sums AS (
  SELECT *, COALESCE(SUM(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_before,
    COALESCE(SUM(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before FROM ordered
), stop AS (
  SELECT k, total - 3 * size_before AS free, weights - weight_before AS rest FROM sums
  WHERE NOT (total - 3 * size_before) * weight > 3 * source_size * (weights - weight_before) ORDER BY k LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN s.k < stop.k THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(free AS DOUBLE) * weight / CAST(rest AS DOUBLE) END AS target,
    CASE WHEN source_size = 0 THEN 0.0 WHEN s.k < stop.k THEN 3.0
      ELSE least(CAST(free AS DOUBLE) * weight / CAST(rest AS DOUBLE) / source_size, 3.0) END AS rate
  FROM sums s, stop
)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
"""
