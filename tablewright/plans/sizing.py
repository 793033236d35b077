"""Measured sizes: what may be broadcast, and which keys are too frequent.

Both answers only choose between plans that give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import exact
from ..functions.types import byte_size, quote

# Frequencies below this are not looked for: the list of hot keys stays short.
_LEAST_SHARE = 5e-4
# Tasks are sketched in this many groups, each listing its own frequent keys.
_SKETCH_GROUPS = 512
# A group lists keys down to this fraction of the share, and tracks more.
_LISTED_PER_SHARE = 4
_TRACKED_PER_LISTED = 16
# A task reads about this much of small splits, unless that makes fewer tasks than this for each core.
_TASK_BYTES = 32 << 20
_TASKS_PER_CORE = 4


@dataclass(frozen=True)
class Limits:
    """When a plan changes form.

    A side is broadcast only after its rows and bytes were counted and found
    within ``broadcast_rows`` and ``broadcast_bytes``; zero rows forbids it.
    Up to ``literal_values`` distinct keys may become a literal list. A key
    with more than ``hot_share`` of the rows is joined apart from the rest;
    by default that is a quarter of one shuffle partition's fair share. With
    ``list_keys`` a change names the few keys it reaches even where their range
    is narrow: planning costs one more pass over the keys, but stored rows
    between them are not written again, so stored tables are changed that way.
    ``filed`` holds a stored target's rows with the file of each (see
    ``touched.FILE``): a change of more keys then rewrites the files that hold them,
    unless these are more than ``files``.
    """

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 << 20
    literal_values: int = 200
    hot_share: float | None = None
    list_keys: bool = False
    filed: DataFrame | None = None
    files: int = 500

    def share(self, spark: SparkSession) -> float:
        if self.hot_share is not None:
            return self.hot_share
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return max(_LEAST_SHARE, 1 / (4 * partitions))


@dataclass(frozen=True)
class Size:
    """Counted rows and bytes, and the range of one column (see ``literals.exact``)."""

    rows: int
    bytes: int
    low: Any = None
    high: Any = None

    def fits_broadcast(self, limits: Limits) -> bool:
        return 0 < limits.broadcast_rows >= self.rows and self.bytes <= limits.broadcast_bytes


def measure(df: DataFrame, ranged: str | None = None) -> Size:
    """Count the rows and bytes of ``df`` in one pass, with the range of a column."""
    size = sum((byte_size(field) for field in df.schema), F.lit(0).cast("long"))
    wanted = [F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")]
    if ranged is not None:
        column, dtype = F.col(quote(ranged)), df.schema[ranged].dataType
        wanted += [
            exact(F.min(column), dtype).alias("low"),
            exact(F.max(column), dtype).alias("high"),
        ]
    seen = df.agg(*wanted).first()
    ends = (seen["low"], seen["high"]) if ranged is not None else (None, None)
    return Size(seen["rows"], seen["bytes"] or 0, *ends)


def in_few_tasks(rows: DataFrame) -> DataFrame:
    """Rows of files whose splits are small: they stay as they are, but a task reads many, one after the other."""
    spark = rows.sparkSession
    splits = rows.rdd.getNumPartitions()
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(_TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-splits * size // _TASK_BYTES))
    return rows.coalesce(tasks) if tasks < splits else rows


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(quote(key)) for key in keys])


def hot_hashes(sides: Sequence[DataFrame], keys: Sequence[str], limits: Limits) -> list[int]:
    """Hashes of the keys that hold more than the allowed share of all rows.

    One pass over the key columns of both sides: groups of tasks list their
    frequent keys from a bounded sketch, then the lists are added up. No key
    above the share is missed, as groups list less frequent ones too; the
    answer has at most ``2 / share`` entries. Sides must have equal key types,
    or their hashes would differ.
    """
    share = limits.share(sides[0].sparkSession)
    listed = max(100, int(_LISTED_PER_SHARE / share))
    tracked = _TRACKED_PER_LISTED * listed
    hashes = sides[0].select(key_hash(keys).alias("h"))
    for side in sides[1:]:
        hashes = hashes.union(side.select(key_hash(keys).alias("h")))
    group = F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("g")
    lists = hashes.groupBy(group).agg(
        F.expr(f"approx_top_k(h, {listed}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    # The number of all rows goes along as the count of no key, and sorts first.
    total = F.struct(F.lit(None).cast("long").alias("item"), F.col("n").alias("count"))
    counts = lists.select(F.inline(F.concat("top", F.array(total)))).groupBy("item")
    most = int(2 / share) + 1
    seen = counts.agg(F.sum("count").alias("n")).orderBy(F.desc("n"), F.col("item")).limit(most)
    found = {row["item"]: row["n"] for row in seen.collect()}
    least = max(share / 2 * found.pop(None, 0), 1)
    return [item for item, n in found.items() if n > least]
