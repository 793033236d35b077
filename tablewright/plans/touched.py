"""The part of a target that a keyed change can reach.

Rows outside it need no join, no shuffle and no rewrite: the predicate found
here prunes partitions and row groups of the target's scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import exact, has_literal, sql_literal, text_literal
from ..functions.types import quote
from .sizing import Limits, Size

#: Column of ``Limits.filed``: the name of the file a stored row lies in.
FILE = "__file"


def session_zone(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def one_of(df: DataFrame, field: T.StructField, values: Sequence[Any]) -> str:
    """The column has one of the values, which are as ``literals.exact`` gives them."""
    zone = session_zone(df)
    listed = sorted(sql_literal(value, field.dataType, zone) for value in values)
    return f"{quote(field.name)} IN ({', '.join(listed)})" if listed else "FALSE"


def distinct_values(df: DataFrame, field: T.StructField, most: int) -> list[Any]:
    """Up to ``most`` distinct non-NULL values of a column, for ``one_of``."""
    value = F.col(quote(field.name))
    found = df.select(value).filter(value.isNotNull()).distinct().limit(most)
    return [row[0] for row in found.select(exact(value, field.dataType)).collect()]


def reachable(
    target: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    size: Size,
    limits: Limits,
    counted: bool = True,
) -> str | None:
    """A predicate all target rows with a key of ``keyed`` satisfy.

    If the first partition column is a key, the partitions that ``keyed``
    names, unless they are many; if ``keyed`` has few rows, the values of the
    first key, too. Otherwise the range of the first key, which
    ``size`` has, if less than half of the target lies in it (not ``counted``:
    in any case). ``None`` stands for the whole target.
    """
    fields = {field.name: field for field in target.schema}
    first = next((f for f in fields if partition_by and f.lower() == partition_by[0].lower()), None)
    named = [first] if first in keys else []
    if limits.list_keys and 0 < size.rows <= limits.literal_values and keys[0] not in named:
        named.append(keys[0])  # few rows: scattered keys reach their own rows only
    found = []
    for name in named:
        if has_literal(fields[name].dataType):
            values = distinct_values(keyed, fields[name], limits.literal_values + 1)
            if len(values) <= limits.literal_values:
                found.append(one_of(target, fields[name], values))
    if found:
        return " AND ".join(found)
    key = fields[keys[0]]
    if not has_literal(key.dataType):
        return None
    if size.low is None:
        return "FALSE"
    zone = session_zone(target)
    inside = (
        f"{quote(key.name)} BETWEEN {sql_literal(size.low, key.dataType, zone)} "
        f"AND {sql_literal(size.high, key.dataType, zone)}"
    )
    if not counted:
        return inside
    seen = target.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.expr(inside)).alias("inside")).first()
    return inside if seen["inside"] * 2 < seen["all"] else None


def file_names(rows: DataFrame, file: str, limits: Limits) -> list[str] | None:
    """The distinct file names of ``rows``; ``None`` if they are more than ``limits.files``."""
    found = rows.select(file).distinct().limit(limits.files + 1).collect()
    return sorted(row[0] for row in found) if len(found) <= limits.files else None


def in_files(names: Sequence[str]) -> str:
    """A predicate of the stored rows of these files; it reaches the listing of a part's files."""
    return f"_metadata.file_name IN ({', '.join(text_literal(name) for name in names)})" if names else "FALSE"


def rewritten(
    target: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    size: Size,
    limits: Limits,
) -> tuple[str | None, DataFrame]:
    """What a change of the keys of ``keyed`` replaces: a predicate (``None``: all) and the rows.

    Few keys are listed. The files that hold more are found by a semi join that
    reads the target's keys only; it needs keys that can be broadcast.
    """
    reached = reachable(target, keyed, keys, partition_by, size, limits)
    touched = target if reached is None else target.filter(F.expr(reached))
    if limits.filed is None or size.rows <= limits.literal_values or not size.fits_broadcast(limits):
        return reached, touched
    within = limits.filed if reached is None else limits.filed.filter(F.expr(reached))
    names = [f"k{i}" for i in range(len(keys))]
    stored = within.select(*[F.col(quote(key)).alias(name) for key, name in zip(keys, names)], FILE)
    wanted = keyed.select(*[F.col(quote(key)).alias(name) for key, name in zip(keys, names)]).distinct()
    files = file_names(stored.join(F.broadcast(wanted), names, "left_semi"), FILE, limits)
    if files is None:
        return reached, touched
    return in_files(files), limits.filed.filter(F.col(FILE).isin(files)).drop(FILE)
