"""Every materialization strategy as a ``Change`` of the target.

``plan_change`` picks the strategy of a spec; ``next_state`` applies its change
to the target. Nothing is written here. The keyed strategies run small
counting jobs while planning (see ``plans.sizing``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec as names
from ..functions.literals import has_literal
from ..functions.types import quote
from ..plans.bind import bind, find, pick
from ..plans.change import EVERYTHING, NOTHING, Change
from ..plans.match import any_null, match_rows, unmatched
from ..plans.sizing import Limits, measure
from ..plans.touched import distinct_values, one_of, reachable, rewritten, session_zone
from ..spec import RunWindow, SpecError, TableSpec
from . import scd2


class MissingTarget(SpecError):
    """An incremental strategy ran before its table was made."""


def plan_change(
    spec: TableSpec,
    target: DataFrame | None,
    source: DataFrame | None,
    *,
    window: RunWindow | None = None,
    now: datetime | None = None,
    full_refresh: bool = False,
    limits: Limits = Limits(),
) -> Change:
    """How ``spec`` turns ``target`` into its next state, given the new rows.

    ``now`` is the run's one idea of the current time; ``target`` is ``None``
    when the table does not exist yet. The keyed strategies read both inputs
    more than once, so a source that gives other rows each time must be stored
    first, which ``materialize`` does.
    """
    if spec.kind != "table":
        raise SpecError(f"{spec.kind} is not a table")
    strategy = spec.strategy
    if strategy == names.DDL:
        if target is not None:
            return Change(NOTHING, target.limit(0))
        spark = source.sparkSession if source is not None else None
        if spark is None:
            raise SpecError("ddl on a new table goes through TableStore.declare")
        return Change(EVERYTHING, spark.createDataFrame([], spec.schema()))
    if source is None:
        raise SpecError(f"{strategy} needs a query")
    if full_refresh or strategy == names.CREATE_REPLACE:
        return Change(EVERYTHING, rebuilt(spec, source, now))
    if target is None:
        if not spec.bootstrap:
            raise MissingTarget(f"{spec.name} does not exist; run a full refresh or ddl first")
        return Change(EVERYTHING, rebuilt(spec, source, now))
    if spec.needs_window and window is None:
        raise SpecError(f"{strategy} needs a run window")
    if strategy == names.APPEND:
        return Change(NOTHING, bind(source, target.schema, spec.by_name))
    if strategy == names.TRUNCATE_INSERT:
        return Change(EVERYTHING, bind(source, target.schema, spec.by_name))
    if strategy == names.TIME_INTERVAL:
        return time_interval(spec, target, source, window)
    if strategy == names.DELETE_INSERT:
        return delete_insert(spec, target, source, limits)
    if strategy == names.ANTI_JOIN:
        return anti_join(spec, target, source, window, limits)
    if strategy == names.MERGE:
        return merge(spec, target, source, limits)
    return scd2.change(spec, target, source, now, limits)


def next_state(
    spec: TableSpec, target: DataFrame | None, source: DataFrame | None, **options
) -> DataFrame:
    """The table as it is after the run; options as for ``plan_change``."""
    return plan_change(spec, target, source, **options).apply(target)


def rebuilt(spec: TableSpec, source: DataFrame, now: datetime | None) -> DataFrame:
    """The table made anew from the query alone."""
    if spec.newer_by:
        return newest(source, [find(source.schema, key).name for key in spec.keys], find(source.schema, spec.newer_by).name)
    return scd2.rebuilt(spec, source, now) if spec.is_scd2 else source


def newest(rows: DataFrame, keys: list[str], newer_by: str) -> DataFrame:
    """Of the rows of each key the one with the largest ``newer_by``, then the largest other values.

    Rows with a NULL key match nothing, so all of them stay.
    """
    by = [newer_by, *[c for c in rows.columns if c not in (*keys, newer_by)]]
    folded = rows.filter(~any_null(keys)).groupBy(*[F.col(quote(k)) for k in keys]).agg(
        F.max(F.struct(*[F.col(quote(c)).alias(f"c{i}") for i, c in enumerate(by)])).alias("newest")
    )
    values = {c: F.col(f"newest.c{i}") for i, c in enumerate(by)} | {k: F.col(quote(k)) for k in keys}
    return folded.select(*[values[c].alias(c) for c in rows.columns]).union(rows.filter(any_null(keys)))


def _in_window(spec: TableSpec, target: DataFrame, window: RunWindow) -> str:
    key = find(target.schema, spec.incremental_key)
    return window.predicate(key.name, key.dataType, spec.time_granularity, session_zone(target))


def time_interval(
    spec: TableSpec, target: DataFrame, source: DataFrame, window: RunWindow
) -> Change:
    """Replace the rows of the run window; NULL keys lie in no window."""
    inside = _in_window(spec, target, window)
    rows = bind(source, target.schema, spec.by_name)
    if spec.clip:
        rows = rows.filter(F.expr(inside))
    return Change(inside, rows)


def delete_insert(
    spec: TableSpec, target: DataFrame, source: DataFrame, limits: Limits
) -> Change:
    """Replace all rows whose key occurs in the source; NULL keys never do.

    Few distinct keys become a literal list, which reaches the target's scan
    and leaves stored rows where they are. Beyond that the rows that stay in the
    touched part or files are found with an anti join and written again.
    """
    key = find(target.schema, spec.incremental_key)
    rows = bind(source, target.schema, spec.by_name)
    return replace_keys(target, rows.select(quote(key.name)), rows, spec.partition_by, limits)


def replace_keys(
    target: DataFrame, keys: DataFrame, rows: DataFrame, partition_by: Sequence[str], limits: Limits
) -> Change:
    """``rows`` in place of the target's rows that have a key of ``keys``, which has the key's column only."""
    key = target.schema[keys.columns[0]]
    name = F.col(quote(key.name))
    keys = keys.filter(name.isNotNull()).distinct()
    size = measure(keys, key.name)
    if not size.rows:
        return Change(NOTHING, rows)
    if size.rows <= limits.literal_values and has_literal(key.dataType):
        return Change(one_of(target, key, distinct_values(keys, key, size.rows)), rows)
    reached, touched = rewritten(target, keys, [key.name], partition_by, size, limits)
    kept = unmatched(
        touched, keys, [key.name], False, limits=limits, known_is_smaller=True, size=size
    )
    return Change(reached or EVERYTHING, kept.union(rows))


def anti_join(
    spec: TableSpec,
    target: DataFrame,
    source: DataFrame,
    window: RunWindow | None,
    limits: Limits,
) -> Change:
    """Add the source rows whose key is new, NULL being a key value like others.

    With an incremental key only the run window's part of the target is
    compared with. The source's own repeats are all added.
    """
    keys = [find(target.schema, key).name for key in spec.keys]
    known = target
    if spec.needs_window:
        known = known.filter(F.expr(_in_window(spec, target, window)))
    rows = bind(source, target.schema, spec.by_name)
    known = _narrowed(known, rows, keys, spec, limits, null_safe=True)
    return Change(NOTHING, unmatched(rows, known, keys, null_safe=True, limits=limits))


def _narrowed(
    target: DataFrame, rows: DataFrame, keys: list[str], spec: TableSpec, limits: Limits, null_safe: bool
) -> DataFrame:
    """The target rows that can have a key of ``rows``, by a predicate that reaches the scan."""
    reached = reachable(target, rows, keys, spec.partition_by, measure(rows, keys[0]), limits, counted=False)
    if reached is None:
        return target
    if null_safe:
        reached = " OR ".join([f"({reached})", *(f"{quote(key)} IS NULL" for key in keys)])
    return target.filter(F.expr(reached))


def merge(spec: TableSpec, target: DataFrame, source: DataFrame, limits: Limits) -> Change:
    """Update the marked columns of matched rows and insert unmatched source rows."""
    schema = target.schema
    keys = [find(schema, key).name for key in spec.keys]
    declared = [find(schema, name).name for name in spec.column_names]
    updated = [find(schema, name).name for name in spec.update_columns]
    rows = pick(source, schema, declared)
    if spec.newer_by:
        rows = newest(rows, keys, find(schema, spec.newer_by).name)
    if not updated:
        known = _narrowed(target, rows, keys, spec, limits, null_safe=False)
        new = unmatched(rows, known, keys, null_safe=False, limits=limits)
        return Change(NOTHING, _widened(new, schema))
    size = measure(rows, keys[0])
    reached, touched = rewritten(target, rows, keys, spec.partition_by, size, limits)
    matched = match_rows(touched, rows, keys, limits, size)
    both = F.col("in_target") & F.col("in_source")
    if spec.newer_by:
        at = find(schema, spec.newer_by).name
        had, has = F.col(f"t{schema.names.index(at)}"), F.col(f"s{declared.index(at)}")
        both = both & F.coalesce(has >= had, had.isNull())
    cols = []
    for i, field in enumerate(schema):
        old = F.col(f"t{i}")
        new = F.col(f"s{declared.index(field.name)}") if field.name in declared else F.lit(None)
        replaced = F.when(both, new) if field.name in updated else F.when(both, old)
        value = replaced.when(F.col("in_target"), old).otherwise(new)  # older source rows change nothing
        cols.append(value.cast(field.dataType).alias(field.name))
    return Change(reached or EVERYTHING, matched.select(*cols))


def _widened(rows: DataFrame, schema) -> DataFrame:
    """``rows`` with the table's other columns as NULL."""
    return rows.select(
        *[
            F.col(quote(f.name)) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
