"""Counts per window of event time, of rows that may come late, twice and in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import quote
from ..spec import SpecError


def window_counts(
    stream: DataFrame,
    time: str,
    by: Sequence[str],
    *,
    late_by: str,
    once_by: Sequence[str],
    width: str | None = None,
    slide: str | None = None,
    gap: str | None = None,
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """``(window_start, window_end, *by, n, *aggregates)`` of a stream, for windows of event time.

    ``width`` makes tumbling windows, with ``slide`` sliding ones; ``gap`` makes
    sessions, which end that long after their last row. ``aggregates`` are further
    columns beside the count ``n``.

    A row is taken if it is not more than ``late_by`` behind the latest time seen in
    earlier batches (the watermark, by Spark's rule of two batches back while new rows
    come). Later ones are left out and counted one by one by ``late_rows``: the step
    that drops them is the one that takes rows with the same ``once_by`` once, before
    any are added up. Rows without a time are in no window and are dropped unseen.

    Windows that tumble or slide can be merged into a table in output mode ``update``
    as they grow, or appended once closed; sessions are appended once closed. State
    is one row per open window and group, and the ``once_by`` of rows not older than
    ``late_by``; groups are added up within tasks before they are shuffled.
    """
    if (width is None) == (gap is None) or (slide and not width):
        raise SpecError("give a width, a width and a slide, or a gap")
    if not once_by:
        raise SpecError("once_by names the columns that tell rows apart")
    named = [quote(c) for c in by]
    at = F.window("__time", width, slide) if width else F.session_window("__time", gap)
    dated = stream.filter(F.col(quote(time)).isNotNull()).withColumn("__time", F.col(quote(time)).cast("timestamp"))
    seen = dated.withWatermark("__time", late_by).dropDuplicatesWithinWatermark(list(once_by))
    counted = seen.groupBy(at.alias("__window"), *[F.col(c) for c in named]).agg(
        F.count(F.lit(1)).alias("n"), *[column.alias(name) for name, column in (aggregates or {}).items()]
    )
    return counted.select(
        F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"), *named, "n", *[quote(a) for a in aggregates or {}]
    )
