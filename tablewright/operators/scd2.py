"""Versioned history (slowly changing dimension, type 2).

Each key has at most one open version. A run closes versions that changed or
vanished and opens new ones; closed versions are not read, and if few keys are
touched only their versions are written, else those in the files that hold them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import has_literal
from ..functions.types import quote
from ..plans.bind import find, stored
from ..plans.change import Change
from ..plans.match import match_rows
from ..plans.sizing import Limits
from ..plans.touched import FILE, distinct_values, file_names, in_files, one_of
from ..spec import IS_CURRENT, OPEN_END, SCD2_BY_COLUMN, VALID_FROM, VALID_UNTIL, SpecError, TableSpec


def _instant(value: datetime, dtype: T.DataType) -> Column:
    """``value`` as date or timestamp; a naive value is local to the session."""
    if isinstance(dtype, T.TimestampType) and value.tzinfo is None:
        text = value.isoformat(sep=" ")
        return F.lit(text).cast("timestamp")
    return F.lit(value).cast(dtype)


def _run_time(now: datetime | None) -> datetime:
    if now is None:
        raise SpecError("this run needs `now`, its one idea of the current time")
    return now


def rebuilt(spec: TableSpec, source: DataFrame, now: datetime | None) -> DataFrame:
    """Every source row as the open version of its key."""
    until: T.DataType = T.TimestampType()
    if spec.incremental_key:
        key = find(source.schema, spec.incremental_key)
        start = F.col(quote(key.name))
        if isinstance(key.dataType, T.TimestampNTZType):
            until = T.TimestampNTZType()
    else:
        start = _instant(_run_time(now), until)
    return source.select(
        start.alias(VALID_FROM),
        *[F.col(quote(c)) for c in source.columns],
        _instant(OPEN_END, until).alias(VALID_UNTIL),
        F.lit(True).alias(IS_CURRENT),
    )


def change(
    spec: TableSpec, target: DataFrame, source: DataFrame, now: datetime | None, limits: Limits
) -> Change:
    """Close and open versions; one match of the open versions with the source.

    Per key: changed gives a closed and a new version, vanished a version
    closed at ``now``, new (or back again) a new version, unchanged stays.
    """
    schema = target.schema
    keys = [find(schema, key).name for key in spec.keys]
    declared = [find(schema, name).name for name in spec.column_names]
    cols = [stored(find(source.schema, name), find(schema, name)) for name in declared]
    start_at = None
    if spec.incremental_key:
        given = find(source.schema, spec.incremental_key)
        start_at = next((i for i, n in enumerate(declared) if n.lower() == given.name.lower()), None)
        if start_at is None or find(schema, given.name).dataType != given.dataType:
            # The start of a version need not be a table column of its type.
            start_at = len(cols)
            cols.append(F.col(quote(given.name)).alias("_start"))
    rows = source.select(*cols)

    t_of = {field.name: F.col(f"t{i}") for i, field in enumerate(schema)}
    s_of = {name: F.col(f"s{i}") for i, name in enumerate(declared)}
    from_type = find(schema, VALID_FROM).dataType
    until_type = find(schema, VALID_UNTIL).dataType
    ended = _instant(_run_time(now), until_type)
    if start_at is not None:
        start = F.col(f"s{start_at}")
        started, superseded = start.cast(from_type), start.cast(until_type)
    else:
        start = started = _instant(now, from_type)
        superseded = ended
    if spec.strategy == SCD2_BY_COLUMN:
        changed = _differs(declared, keys, t_of, s_of, spec.null_safe)
    else:
        changed = t_of[VALID_FROM] < start

    new = {name: s_of[name] for name in declared}
    new.update(
        {VALID_FROM: started, VALID_UNTIL: _instant(OPEN_END, until_type), IS_CURRENT: F.lit(True)}
    )

    def version(values: dict[str, Column]) -> Column:
        return F.struct(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        )

    def closed(end: Column) -> Column:
        return version({**t_of, VALID_UNTIL: end, IS_CURRENT: F.lit(False)})

    versions = (
        F.when(~F.col("in_target"), F.array(version(new)))
        .when(~F.col("in_source"), F.array(closed(ended)))
        .when(F.coalesce(changed, F.lit(False)), F.array(closed(superseded), version(new)))
        .otherwise(F.array(version(t_of)))
    )
    given = target if limits.filed is None else limits.filed
    current = given.filter(F.col(quote(IS_CURRENT)))
    matched = match_rows(current, rows, keys, limits)
    key, file = f"t{schema.names.index(keys[0])}", f"t{len(schema)}"
    touched = F.col("in_target") & (~F.col("in_source") | F.coalesce(changed, F.lit(False)))
    goes, own = _touched(target, matched.filter(touched), keys[0], key, file, limits)
    if own is not None:
        matched = matched.filter(~F.col("in_target") | own)
    return Change(goes, matched.select(F.inline(versions)))


def _touched(
    target: DataFrame, touched: DataFrame, key: str, t_key: str, t_file: str, limits: Limits
) -> tuple[str, Column | None]:
    """The stored versions to write again, and the same of a match; with ``None`` all open ones.

    Versions with the touched values of the first key, if these are few; else those of the files
    with a touched version, if the target's files are known and not too many of them are touched.
    NULL keys match nothing, so all of them close.
    """
    current, field = quote(IS_CURRENT), find(target.schema, key)
    if not limits.list_keys:
        return current, None
    stored = [] if limits.filed is None else [F.col(t_file)]
    rows = touched.select(F.col(t_key).alias(key), *stored).persist()
    try:
        if has_literal(field.dataType):
            values = distinct_values(rows, field, limits.literal_values + 1)
            if len(values) <= limits.literal_values:
                reached = f"{one_of(target, field, values)} OR {quote(key)} IS NULL"
                return f"{current} AND ({reached})", F.expr(reached.replace(quote(key), t_key))
        if stored:
            names = file_names(rows, t_file, limits)
            if names is not None:
                return f"{current} AND {in_files(names)}", F.col(t_file).isin(names)
    finally:
        rows.unpersist()
    return current, None


def _differs(
    declared: list[str],
    keys: list[str],
    t_of: dict[str, Column],
    s_of: dict[str, Column],
    null_safe: bool,
) -> Column:
    """Some declared column other than the key has another value."""
    differs = F.lit(False)
    for name in declared:
        if name in keys:
            continue
        if null_safe:
            differs = differs | ~t_of[name].eqNullSafe(s_of[name])
        else:
            differs = differs | (t_of[name] != s_of[name])
    return differs
