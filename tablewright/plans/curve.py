"""A space-filling curve over several columns, for layouts that serve filters on any of them.

Each column is cut into ranges of about equally many rows; the numbers of a row's
ranges, their bits interleaved, are its place on the curve (Z order). Rows that are
near on the curve are near in every column, so a file that holds a stretch of it
covers a narrow range of each, not of the first alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote

#: Bits of a column's range numbers; fewer where many columns share the curve's 60 bits.
BITS = 6
# Bytes of a text, after the part that all of its column share, that order it.
_TEXT_BYTES = 7


def curve(rows: DataFrame, columns: Sequence[str]) -> Column | None:
    """A row's place on the curve; ``None`` if a column's type has no numbers in its order.

    Reads the columns once for their quantiles, and those of texts once before for what
    all values begin with. NULLs lie in the first range.
    """
    fields = [rows.schema[name] for name in columns]
    if not all(isinstance(field.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.StringType)) for field in fields):
        return None
    bits = min(BITS, 60 // len(columns))
    shared = _shared_lengths(rows, [f.name for f in fields if isinstance(f.dataType, T.StringType)])
    numbers = [_number(field, shared.get(field.name, 0)) for field in fields]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(number, steps, 10_000).alias(f"c{i}") for i, number in enumerate(numbers)]).first()
    place = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        rank = _rank(number, sorted(set(cuts[i] or [])))
        for bit in range(bits):
            at = bit * len(numbers) + len(numbers) - 1 - i  # the first column has the highest bit of each round
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), at))
    return place


def _shared_lengths(rows: DataFrame, texts: Sequence[str]) -> dict[str, int]:
    """How many bytes all values of each column begin with: those its least and greatest share."""
    if not texts:
        return {}
    raw = [F.encode(F.col(quote(name)), "UTF-8") for name in texts]
    ends = rows.agg(*[f(value).alias(f"{f.__name__}{i}") for i, value in enumerate(raw) for f in (F.min, F.max)]).first()
    lengths = {}
    for i, name in enumerate(texts):
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        both = zip(low or b"", high or b"")
        lengths[name] = next((at for at, (a, b) in enumerate(both) if a != b), min(len(low or b""), len(high or b"")))
    return lengths


def _number(field: T.StructField, shared: int) -> Column:
    """A number that orders as the column's values do; texts by some of their bytes."""
    value, dtype = F.col(quote(field.name)), field.dataType
    if isinstance(dtype, T.StringType):
        head = F.substring(F.encode(value, "UTF-8"), shared + 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(head), 2 * _TEXT_BYTES, "0"), 16, 10).cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(dtype, T.BooleanType):
        return value.cast("long")
    return value.cast("double") if isinstance(dtype, (T.FractionalType, T.DecimalType)) else value.cast("long")


def _rank(number: Column, cuts: Sequence) -> Column:
    """The number of cuts at or below a value, by halving; 0 for NULL."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("long")
        middle = (low + high) // 2
        return F.when(number >= F.lit(cuts[middle]), among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(cuts))
