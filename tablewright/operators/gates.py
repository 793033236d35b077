"""Readiness conditions: may the work that depends on a table begin?"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote, quote_table
from ..spec import SpecError


class NotReady(RuntimeError):
    """A gate was asked once and its condition does not hold."""


def gate_query(spark: SparkSession, query: str, args: dict[str, Any] | None = None) -> DataFrame:
    """One row ``ready``: the query's first value is true or above zero.

    A query without rows, or with NULL, is not ready.
    """
    found = spark.sql(query, args=args) if args else spark.sql(query)
    holds = _truth(F.col(quote(found.columns[0])), found.schema[0].dataType)
    return found.limit(1).agg(F.coalesce(F.first(holds), F.lit(False)).alias("ready"))


def _truth(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("boolean"), value.try_cast("double") > 0)
    return value > 0


def gate_table(spark: SparkSession, name: str, having: str | None = None) -> DataFrame:
    """One row ``ready``: the table exists and, with ``having``, has such a row.

    ``having`` is a condition on the table's columns; the scan ends at the
    first row that meets it.
    """
    parts = name.split(".")
    if len(parts) > 2 or not all(part.strip() for part in parts):
        raise SpecError(f"expected `table` or `schema.table`, got {name!r}")
    if not spark.catalog.tableExists(quote_table(name)):
        return spark.range(1).select(F.lit(False).alias("ready"))
    if having is None:
        return spark.range(1).select(F.lit(True).alias("ready"))
    rows = spark.table(quote_table(name)).filter(having).limit(1)
    return rows.agg((F.count(F.lit(1)) > 0).alias("ready"))


def require_ready(gate: DataFrame, mode: str = "once") -> None:
    """Raise ``NotReady`` unless the gate is open; ``skip`` does not look."""
    if mode == "skip":
        return
    if mode not in ("once", ""):
        raise SpecError(f"unknown gate mode {mode!r}: waiting is left to the scheduler")
    if not gate.first()["ready"]:
        raise NotReady("the condition does not hold yet")
