"""Funnels: how far a key gets through steps in order, by a table function.

The events of a key and bin of time come to a Python table function in order, one after
the other; it remembers the open funnel only, so memory does not grow with the events. A
bin also gets the events just after its end, which its last funnels may reach. So
funnels do not cross bins, and a key with a third of all events is as many tasks as
it has bins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from ..functions.types import quote
from ..spec import SpecError
from .temporal import micros

# A bin is as wide as so many funnels may last, so an eighth of the events goes to two bins.
_LASTS_PER_BIN = 8
_MICRO = timedelta(microseconds=1)


def _function() -> Any:
    """The table function; made here so that it travels to workers as it is, not by its module's name."""

    class Cut:
        """Events ``(key, bin, at, step, own)`` of a key and bin become ``(key, began, reached, ended)``."""

        @staticmethod
        def analyze(events: AnalyzeArgument, within: AnalyzeArgument) -> AnalyzeResult:
            if not events.isTable:
                raise ValueError("funnels are cut from a table")
            of = events.dataType["key"].dataType
            return AnalyzeResult(
                T.StructType().add("key", of).add("began", T.LongType()).add("reached", T.IntegerType()).add("ended", T.LongType()),
                partitionBy=[PartitioningColumn("key"), PartitioningColumn("bin")],
                orderBy=[OrderingColumn("at"), OrderingColumn("step")],
            )

        def __init__(self) -> None:
            self.funnel: list | None = None  # key, began, reached, ended

        def eval(self, event: Any, within: int) -> Iterator[tuple]:
            if event["step"] == 0:
                if self.funnel:
                    yield tuple(self.funnel)
                # those that begin after the bin belong to the next
                self.funnel = [event["key"], event["at"], 1, event["at"]] if event["own"] else None
            elif self.funnel and event["step"] == self.funnel[2] and event["at"] - self.funnel[1] <= within:
                self.funnel[2] += 1
                self.funnel[3] = event["at"]

        def terminate(self) -> Iterator[tuple]:
            if self.funnel:
                yield tuple(self.funnel)

    return F.udtf(Cut)


def _time(column: Column, dtype: T.DataType) -> Column:
    """Microseconds, or a whole number, as a time of the type they came from."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", column, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date((column / 86_400_000_000).cast("int"))  # whole days: exact
    return column.cast(dtype)


def funnels(
    events: DataFrame, on: Sequence[str], time: str, steps: Sequence[str], within: timedelta | int, *, width: timedelta | int | None = None
) -> DataFrame:
    """``(*on, began, reached, ended)``: a row for each event of the first step.

    ``steps`` are conditions in SQL; an event is of the first one that holds. Each event of the
    first step begins a funnel and ends the one before. ``reached`` is the number of steps
    that followed in order, the first included, none more than ``within`` after
    ``began``; ``ended`` is the time of the last. Each step needs an event of its own; events of
    one time come in the order of their steps, and others between do no harm. Rows with a NULL key
    or time belong to no funnel.

    ``within`` and the ``width`` of a bin, at least ``within``, are spans of time, or units of a
    time that is a whole number.
    """
    names = [*on, "began", "reached", "ended"]
    if not on or len(steps) < 2 or len({n.lower() for n in names}) < len(names):
        raise SpecError(f"a funnel needs keys, two steps or more, and columns with names of their own: {', '.join(names)}")
    dtype = events.schema[time].dataType
    at = micros(F.col(quote(time)), dtype)
    if isinstance(within, timedelta) == isinstance(dtype, T.IntegralType) or (width is not None and type(width) is not type(within)):
        raise SpecError("within and width are spans of a time, or whole numbers as the time is")
    last, wide = (v // _MICRO if isinstance(v, timedelta) else v for v in (within, within if width is None else width))
    wide = max(1, last * _LASTS_PER_BIN) if width is None else wide
    if last < 0 or wide < max(1, last):
        raise SpecError("within is 0 or more, and a bin is at least as wide")
    step = F.coalesce(*[F.when(F.expr(f"({condition})"), F.lit(i)) for i, condition in enumerate(steps)])
    key = F.struct(*[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate(on)])
    known = events.select(key.alias("key"), at.alias("at"), step.alias("step")).where("at IS NOT NULL AND step IS NOT NULL")
    for i in range(len(on)):
        known = known.where(F.col(f"key.k{i}").isNotNull())
    known = known.withColumn("bin", F.expr(f"(at - pmod(at, {wide}L)) div {wide}L"))
    own = F.struct("bin", F.lit(True).alias("own"))
    before = F.struct((F.col("bin") - 1).alias("bin"), F.lit(False).alias("own"))
    bins = F.when(F.expr(f"pmod(at, {wide}L) < {last}L"), F.array(own, before)).otherwise(F.array(own))
    dealt = known.withColumn("to", F.explode(bins)).select("key", "to.bin", "at", "step", "to.own")
    found = _function()(dealt.asTable(), F.lit(last))
    keys = [F.col(f"key.k{i}").alias(k) for i, k in enumerate(on)]
    return found.select(*keys, _time(F.col("began"), dtype).alias("began"), "reached", _time(F.col("ended"), dtype).alias("ended"))
