"""Typed SQL literals for predicates that are stored in a view's text.

A predicate that says which target rows stay is used twice: as a filter on a
DataFrame and, when the table is published, inside the view over its parts.
Text is the one form that serves both.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LITERAL_TYPES = (
    T.StringType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def has_literal(dtype: T.DataType) -> bool:
    """True when every value of the type can be written exactly as a literal."""
    return isinstance(dtype, _LITERAL_TYPES)


def exact(value: Column, dtype: T.DataType) -> Column:
    """``value`` in a form that reaches the driver unchanged, for ``sql_literal``.

    Python's own dates have fewer years, and its timestamps depend on the time
    zone of the driver's machine.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(dtype, (T.DateType, T.TimestampNTZType, T.DecimalType)):
        return value.cast("string")
    return value


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_literal(value: Any, dtype: T.DataType, zone: str = "UTC") -> str:
    """``value`` as a literal of ``dtype``: a Python value, or one from ``exact``.

    Zoned timestamps are written as instants, so that a view means the same
    whatever time zone its reader's session has.
    """
    if isinstance(dtype, T.StringType):
        return text_literal(value)
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if value else "FALSE"
    if isinstance(dtype, T.DateType):
        return f"DATE'{value if isinstance(value, str) else as_date(value).isoformat()}'"
    if isinstance(dtype, T.TimestampNTZType):
        text = value if isinstance(value, str) else as_datetime(value).replace(tzinfo=None)
        return f"TIMESTAMP_NTZ'{text}'"
    if isinstance(dtype, T.TimestampType):
        if isinstance(value, int):
            return f"timestamp_micros({value})"
        stamp = as_datetime(value)
        if stamp.tzinfo is None:
            stamp = stamp.replace(tzinfo=ZoneInfo(zone))
        return f"TIMESTAMP'{stamp.astimezone(timezone.utc)}'"
    if isinstance(dtype, T.DecimalType):
        return f"CAST('{value}' AS {dtype.simpleString()})"
    return f"CAST({int(value)} AS {dtype.simpleString()})"


def as_datetime(value: Any) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def as_date(value: Any) -> date:
    return as_datetime(value).date()
