"""Bind source columns to the columns of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import can_store, quote, strict_cast
from ..spec import SpecError


def stored(source: T.StructField, target: T.StructField) -> Column:
    """One source column as a value of the target column, under its name."""
    if not can_store(source.dataType, target.dataType):
        raise SpecError(
            f"cannot store {source.name} ({source.dataType.simpleString()}) "
            f"in {target.name} ({target.dataType.simpleString()})"
        )
    value = F.col(quote(source.name))
    if source.dataType != target.dataType:
        value = strict_cast(value, target.dataType)
    return value.alias(target.name)


def find(schema: T.StructType, name: str) -> T.StructField:
    """The field called ``name``, whatever its case."""
    for field in schema:
        if field.name == name:
            return field
    for field in schema:
        if field.name.lower() == name.lower():
            return field
    raise SpecError(f"column {name} is missing; there are {', '.join(schema.names)}")


def bind(source: DataFrame, target: T.StructType, by_name: bool = False) -> DataFrame:
    """``source`` with the target's columns, by position unless ``by_name``."""
    fields = list(source.schema)
    if len(fields) != len(target):
        raise SpecError(f"the query has {len(fields)} columns, the table has {len(target)}")
    if by_name:
        fields = [find(source.schema, column.name) for column in target]
    else:
        lowered = [field.name.lower() for field in fields]
        if len(set(lowered)) != len(lowered):
            # Positions stay unambiguous where names are not.
            source = source.toDF(*[f"_c{i}" for i in range(len(fields))])
            fields = list(source.schema)
    return source.select(*[stored(f, t) for f, t in zip(fields, target)])


def pick(source: DataFrame, target: T.StructType, names: Sequence[str]) -> DataFrame:
    """The named source columns, typed and spelled as the target has them."""
    wanted = [(find(source.schema, name), find(target, name)) for name in names]
    return source.select(*[stored(s, t) for s, t in wanted])
