"""Declared column types and store assignment.

A column type is free text in an asset definition; it ends up as a Spark type
here.  ``text`` is accepted as a synonym of ``string``, ``char(n)`` and
``varchar(n)`` become length-checked strings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIZED_TEXT = re.compile(r"^(char|character|varchar)\s*\(\s*(\d+)\s*\)$", re.IGNORECASE)
_INTERVALS = (T.DayTimeIntervalType, T.YearMonthIntervalType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)
# Types whose values have no bound of size.
_UNSIZED = tuple(getattr(T, name) for name in ("VariantType",) if hasattr(T, name))


def is_text_type(declared: str | None) -> bool:
    """True for types whose empty cells stay empty strings when seeding."""
    name = (declared or "").strip().lower()
    return name in ("", "string") or "char" in name or "text" in name


def parse_type(declared: str | None) -> T.DataType:
    """Spark type of a declared column type; undeclared means string."""
    if is_text_type(declared):
        return T.StringType()
    return T.DataType.fromDDL(declared)


def sized_text(col: Column, declared: str | None) -> Column:
    """Enforce the length of a declared ``char(n)`` / ``varchar(n)`` column.

    Trailing blanks beyond the length are dropped, anything else too long
    raises, and ``char`` values are padded: what a Spark table does on write.
    """
    sized = _SIZED_TEXT.match((declared or "").strip())
    if not sized:
        return col
    size = int(sized.group(2))
    trimmed = F.rpad(F.rtrim(col), size, " ") if sized.group(1)[0] in "cC" else F.substring(col, 1, size)
    too_long = F.length(F.rtrim(col)) > size
    message = F.format_string(f"value longer than {declared}: %s", col)
    return F.when(too_long, F.raise_error(message).cast("string")).otherwise(trimmed)


def strict_cast(value: Column, target: T.DataType) -> Column:
    """``value`` as ``target``; one that does not fit raises, whatever the session says of casts."""
    fitting = value.try_cast(target)
    message = F.format_string(f"%s does not fit {target.simpleString()}", value.try_cast("string"))
    lost = value.isNotNull() & fitting.isNull()
    return F.when(lost, F.raise_error(message).cast(target)).otherwise(fitting)


def is_sized_text(declared: str | None) -> bool:
    return bool(_SIZED_TEXT.match((declared or "").strip()))


def can_store(source: T.DataType, target: T.DataType) -> bool:
    """ANSI store assignment: may a ``source`` value be written to ``target``?"""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(source, _NESTED) or isinstance(target, _NESTED):
        if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
            return can_store(source.elementType, target.elementType)
        if isinstance(source, T.MapType) and isinstance(target, T.MapType):
            return can_store(source.keyType, target.keyType) and can_store(source.valueType, target.valueType)
        if isinstance(source, T.StructType) and isinstance(target, T.StructType):
            return len(source) == len(target) and all(
                can_store(s.dataType, t.dataType) for s, t in zip(source, target)
            )
        return False
    if isinstance(target, T.StringType):
        return not isinstance(source, T.BinaryType)
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        return True
    if isinstance(source, _TEMPORAL) and isinstance(target, _TEMPORAL):
        return True
    return any(isinstance(source, kind) and isinstance(target, kind) for kind in _INTERVALS)


def byte_size(field: T.StructField) -> Column:
    """Approximate in-memory bytes of one value, for broadcast size checks."""
    col = F.col(quote(field.name))
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("long") + 16
    if not isinstance(field.dataType, T.AtomicType) or isinstance(field.dataType, _UNSIZED):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("long") + 16
    return F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8).cast("long")


def quote(name: str) -> str:
    """Backtick-quoted column name, safe for odd names in the Column API."""
    return "`" + name.replace("`", "``") + "`"


def quote_table(name: str) -> str:
    """Backtick-quoted ``table`` or ``schema.table`` name."""
    return ".".join(quote(part) for part in name.split("."))
