"""Joins over time without inequality joins: as-of and overlapping intervals.

Both cut time into bins, so that every join and window works on equal keys and
no key's whole history meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote
from ..plans.match import any_null
from ..spec import SpecError

# An interval covers at most this many bins of its own level; the next level's are as much wider.
FAN_OUT = 64
# Bins of time per shuffle partition where no width is given.
_BINS_PER_PARTITION = 4


def micros(column: Column, dtype: T.DataType) -> Column:
    """A date or timestamp as microseconds, a whole number as it is."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        # Without a zone: the distance from midnight of the first day, whatever the session's zone.
        first = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", first, column)
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("long") * 86_400_000_000
    if isinstance(dtype, T.IntegralType):
        return column.cast("long")
    raise SpecError(f"{dtype.simpleString()} is no time")


def _times(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [micros(F.col(quote(name)), df.schema[name].dataType) for name in names]


def _width(bins: int | None, frames: Sequence[tuple[DataFrame, Column]]) -> int:
    """A width that cuts the time covered into ``bins``; by default a few per shuffle partition."""
    spark = frames[0][0].sparkSession
    bins = bins or _BINS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = [frame.agg(F.min(time), F.max(time)).first() for frame, time in frames]
    known = [value for end in ends for value in end if value is not None]
    return max(1, (max(known) - min(known)) // bins + 1) if known else 1


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    until: str | None = None,
    prefix: str = "",
    width: int | None = None,
    bins: int | None = None,
) -> DataFrame:
    """Each left row with the last right row of its key whose time is not after its own.

    All left rows stay, with the right columns other than ``on`` (``prefix`` put
    before their names), NULL where there is no such row. With ``until`` the right
    row must also end after the left time: for versions of a key that do not
    overlap, this is the version valid at that time. Of right rows at one time the
    one with the greatest values counts, column by column, NULL being least. NULL
    keys and times match nothing; NULL ``until`` is an open end.

    Both sides go into one shuffle by key and time bin, ``width`` wide (as many
    microseconds, or units of a whole number). The last right row of each key and
    bin, and where it is still the last known, is found on one row per key and bin
    and joins that shuffle as a first row of the bin. So a key with a third of all
    rows is as many tasks as it has bins.
    """
    clash = {c.lower() for c in left.columns} & {(prefix + c).lower() for c in right.columns if c not in on}
    if clash:
        raise SpecError(f"both sides have {', '.join(sorted(clash))}; give a prefix")
    l_time, r_time = _times(left, [left_time])[0], _times(right, [right_time])[0]
    values = [c for c in right.columns if c not in on]
    key = F.struct(*[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate(on)]).alias("key")
    whole = left.select(F.struct("*").alias("row"), key, l_time.alias("time"), any_null(on).alias("loose"))
    own = F.struct(*[F.col(quote(c)).alias(f"v{i}") for i, c in enumerate(values)])
    found = right.filter(~any_null(on)).select(own.alias("value"), key, r_time.alias("time")).filter("time IS NOT NULL")
    if whole.schema["key"].dataType.simpleString() != found.schema["key"].dataType.simpleString():
        raise SpecError("the keys of both sides must have the same types")
    loose = F.col("loose") | F.col("time").isNull()
    width = width or _width(bins, [(found, F.col("time")), (whole.filter(~loose), F.col("time"))])
    at = F.expr(f"(time - pmod(time, {width}L)) div {width}L")
    dated, found = whole.filter(~loose).withColumn("bin", at), found.withColumn("bin", at)

    # One row per key and bin: the bin's last right row, then the last one of the bins before.
    last = F.max_by("value", F.struct("time", "value"))
    seen = found.groupBy("key", "bin").agg(last.alias("value")).withColumn("used", F.lit(False))
    asked = dated.select("key", "bin").distinct().select(
        "key", "bin", F.lit(None).cast(found.schema["value"].dataType).alias("value"), F.lit(True).alias("used")
    )
    bins_of = seen.unionByName(asked).groupBy("key", "bin").agg(
        F.max(F.struct(F.col("value").isNotNull().alias("there"), "value"))["value"].alias("value"), F.max("used").alias("used")
    )
    before = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins_of.withColumn("value", F.last("value", ignorenulls=True).over(before)).filter("used AND value IS NOT NULL")

    no_row, no_value = (F.lit(None).cast(df.schema[c].dataType).alias(c) for df, c in ((whole, "row"), (found, "value")))
    earliest = F.lit(None).cast("long").alias("time")
    both = (
        carried.select("key", "bin", earliest, F.lit(0).alias("side"), no_row, "value")
        .unionByName(found.select("key", "bin", "time", F.lit(1).alias("side"), no_row, "value"))
        .unionByName(dated.select("key", "bin", "time", F.lit(2).alias("side"), "row", no_value))
    )
    running = (
        Window.partitionBy("key", "bin")
        .orderBy(F.col("time").asc_nulls_first(), "side", F.col("value").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = both.withColumn("value", F.last("value", ignorenulls=True).over(running)).filter("side = 2").select("row", "time", "value")
    if until is not None:
        end = micros(F.col(f"value.v{values.index(until)}"), right.schema[until].dataType)
        joined = joined.withColumn("value", F.when(end.isNull() | (end > F.col("time")), F.col("value")))
    joined = joined.unionByName(whole.filter(loose).select("row", "time", no_value))
    return joined.select(
        *[F.col(f"row.{quote(c)}").alias(c) for c in left.columns], *[F.col(f"value.v{i}").alias(prefix + c) for i, c in enumerate(values)]
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    *,
    prefix: str = "",
    width: int | None = None,
    bins: int | None = None,
) -> DataFrame:
    """The pairs of rows of equal keys whose intervals overlap; starts belong to them, ends do not.

    The result has the left columns and the right ones other than ``on``
    (``prefix`` put before their names). Intervals without an instant, and rows with
    a NULL key, start or end, overlap with nothing.

    Rows are repeated in the bins they cover and meet in the one bin where the later
    of the two starts, by an equality join. A long interval lies on a level of wider
    bins, so it is repeated at most ``FAN_OUT`` + 1 times; shorter ones come to it
    there, in the one or two bins they touch.
    """
    clash = {c.lower() for c in left.columns} & {(prefix + c).lower() for c in right.columns if c not in on}
    if clash:
        raise SpecError(f"both sides have {', '.join(sorted(clash))}; give a prefix")

    def sided(df: DataFrame, span: tuple[str, str], mark: str) -> DataFrame:
        start, end = _times(df, span)
        keys = [F.col(quote(k)).alias(f"{mark}k{i}") for i, k in enumerate(on)]
        own = df.filter(~any_null(on)).select(F.struct("*").alias(f"{mark}row"), *keys, start.alias(f"{mark}start"), end.alias(f"{mark}end"))
        return own.filter(F.col(f"{mark}start") < F.col(f"{mark}end"))

    a, b = sided(left, left_span, "l"), sided(right, right_span, "r")
    length = lambda mark: F.col(f"{mark}end") - F.col(f"{mark}start")
    seen = [side.agg(F.max(length(m)), F.avg(length(m)), F.min(f"{m}start"), F.max(f"{m}end")).first() for side, m in ((a, "l"), (b, "r"))]
    if any(row[0] is None for row in seen):
        longest, width = 1, width or 1
    else:
        longest = max(row[0] for row in seen)
        # Bins as wide as intervals are on average: most rows are in one or two of them.
        covered = max(row[3] for row in seen) - min(row[2] for row in seen)
        width = width or (max(1, covered // bins) if bins else max(1, int(max(row[1] for row in seen))))
    widths = [width]
    while widths[-1] * FAN_OUT < longest:
        widths.append(widths[-1] * FAN_OUT)

    def binned(side: DataFrame, mark: str) -> DataFrame:
        """Each row on its own level, and on those above, where longer rows are."""
        own = F.lit(len(widths) - 1)
        for level in reversed(range(len(widths) - 1)):
            own = F.when(length(mark) <= F.lit(widths[level] * FAN_OUT), F.lit(level)).otherwise(own)
        levels = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(w).cast("long").alias("wide")) for i, w in enumerate(widths)])
        side = side.withColumn(f"{mark}level", own).select("*", F.inline(levels)).filter(F.col("level") >= F.col(f"{mark}level"))
        first, last = (F.expr(f"({x} - pmod({x}, wide)) div wide") for x in (f"{mark}start", f"({mark}end - 1L)"))
        side = side.withColumn(f"{mark}first", first)
        side = side.withColumn(f"{mark}bin", F.explode(F.sequence(F.col(f"{mark}first"), last)))
        return side.withColumnRenamed("level", f"{mark}at").drop("wide")

    x, y = binned(a, "l"), binned(b, "r")
    same = (F.col("lat") == F.col("rat")) & (F.col("lbin") == F.col("rbin"))
    for i in range(len(on)):
        same = same & (F.col(f"lk{i}") == F.col(f"rk{i}"))
    once = (F.col("lat") == F.greatest("llevel", "rlevel")) & (F.col("lbin") == F.greatest("lfirst", "rfirst"))
    overlap = (F.col("lstart") < F.col("rend")) & (F.col("rstart") < F.col("lend"))
    pairs = x.join(y, same & once & overlap)
    return pairs.select(
        *[F.col(f"lrow.{quote(c)}").alias(c) for c in left.columns],
        *[F.col(f"rrow.{quote(c)}").alias(prefix + c) for c in right.columns if c not in on],
    )
