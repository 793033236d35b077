"""Tables made by a Python function on the session's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PythonTransform = Callable[[SparkSession], "DataFrame | None"]


class TransformError(RuntimeError):
    """A Python transform failed; the message names its table."""


def run_transform(
    spark: SparkSession, name: str, transform: PythonTransform | None
) -> DataFrame | None:
    """The rows the function returns; without a function nothing happens."""
    if transform is None:
        return None
    try:
        rows = transform(spark)
    except Exception as error:
        raise TransformError(f"python transform {name} failed: {error}") from error
    if rows is not None and not isinstance(rows, DataFrame):
        raise TransformError(f"python transform {name} must return a DataFrame or None")
    return rows
