"""Run an asset: get its rows, work out the table's next state, publish, check."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import spec as names
from .functions.types import is_sized_text, quote, sized_text
from .operators.checks import Watch, require_passed, run_checks
from .operators.rollup import Measure, refresh, rollup
from .operators.strategies import MissingTarget, plan_change
from .plans.bind import find
from .plans.change import EVERYTHING, Change
from .plans.sizing import Limits
from .sources.seed import read_seed
from .sources.store import TableStore
from .sources.transform import PythonTransform, run_transform
from .spec import RunWindow, SpecError, TableSpec

_log = logging.getLogger(__name__)

# Strategies whose plans read the source more than once.
_READ_TWICE = (
    names.DELETE_INSERT,
    names.MERGE,
    names.ANTI_JOIN,
    names.SCD2_BY_COLUMN,
    names.SCD2_BY_TIME,
)


def run_query(
    store: TableStore,
    spec: TableSpec,
    query: str | DataFrame | None,
    *,
    window: RunWindow | None = None,
    now: datetime | None = None,
    args: dict[str, Any] | None = None,
    full_refresh: bool = False,
    limits: Limits = Limits(),
    check: bool = True,
) -> DataFrame | None:
    """Materialize a query as ``spec`` says and return what its name now gives.

    The window's bounds are the query's parameters ``:start_date``,
    ``:end_date``, ``:start_timestamp`` and ``:end_timestamp``. An empty query
    does nothing, save for ddl, which needs none. With ``check`` the table's
    checks run after it was published.
    """
    if spec.kind == "view":
        if not isinstance(query, str):
            raise SpecError("a view needs its query as text")
        if window is not None or args:
            raise SpecError("a view is evaluated on read and takes no window and no arguments")
        store.create_view(spec.name, query)
        return store.read(spec.name)
    if spec.kind == "table" and spec.strategy == names.DDL:
        if full_refresh:
            _log.warning("%s is declared by ddl and stays as it is on a full refresh", spec.name)
        store.declare(spec)
        return store.read(spec.name)
    if query is None or (isinstance(query, str) and not query.strip()):
        return None
    rows = query if isinstance(query, DataFrame) else bound_query(store, query, window, args)
    if spec.kind == "none":
        return rows
    return materialize(
        store,
        spec,
        rows,
        window=window,
        now=now,
        full_refresh=full_refresh,
        limits=limits,
        check=check,
    )


def bound_query(
    store: TableStore,
    query: str,
    window: RunWindow | None = None,
    args: dict[str, Any] | None = None,
) -> DataFrame:
    """The query's rows with the run window and further arguments as typed parameters."""
    zone = store.spark.conf.get("spark.sql.session.timeZone")
    values = {**(window.params(zone) if window else {}), **(args or {})}
    return store.spark.sql(query, args=values) if values else store.spark.sql(query)


def materialize(
    store: TableStore,
    spec: TableSpec,
    rows: DataFrame,
    *,
    window: RunWindow | None = None,
    now: datetime | None = None,
    full_refresh: bool = False,
    limits: Limits = Limits(),
    check: bool = True,
    batch: tuple[str, int] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Change the published table by ``rows``, check it and return it.

    ``batch`` names a stream and its batch: one that is in the table already
    changes nothing. ``stored`` rows give the same rows each time they are read.
    """
    if batch is not None and store.has_batch(spec.name, batch):
        return store.read(spec.name)
    target = store.target(spec.name)
    if target is None and not spec.bootstrap and not full_refresh:
        if spec.strategy != names.CREATE_REPLACE:
            raise MissingTarget(f"{spec.name} does not exist; run a full refresh or ddl first")
    fresh = full_refresh or target is None or spec.strategy == names.CREATE_REPLACE
    staged = not stored and (spec.cluster_by or (not fresh and spec.strategy in _READ_TWICE))
    if staged:
        rows = store.stage(rows)
    try:
        filed = None if fresh or spec.strategy not in _READ_TWICE else store.filed(spec.name)
        change = plan_change(
            spec,
            target,
            rows,
            window=window,
            now=now,
            full_refresh=full_refresh,
            limits=replace(limits, list_keys=True, filed=filed),
        )
        if not fresh:
            change = Change(change.goes, _sized(spec, change.rows))
        watch = _watch(store, spec, check and change.goes == EVERYTHING)
        store.commit(spec, change, new_layout=fresh and change.goes == EVERYTHING, batch=batch, watch=watch)
    finally:
        if staged:
            store.unstage(rows)
    return _checked(store, spec, check, watch)


def _watch(store: TableStore, spec: TableSpec, wanted: bool) -> Watch | None:
    """Counts the row checks of a table that is written whole."""
    if not wanted:
        return None
    before = store.state(spec.name)
    return Watch(spec, [*spec.partition_by, *(before.partition_by if before else ())])


def _checked(store: TableStore, spec: TableSpec, check: bool, watch: Watch | None) -> DataFrame:
    """The published table, whose checks passed; those not counted by the write are counted now."""
    table = store.read(spec.name)
    if check and (spec.custom_checks or any(c.checks for c in spec.columns)):
        require_passed(run_checks(table, spec, watch.counts if watch else None))
    return table


def _sized(spec: TableSpec, rows: DataFrame) -> DataFrame:
    """Rows within the declared lengths of ``char(n)`` and ``varchar(n)`` columns."""
    for column in spec.columns:
        if is_sized_text(column.type):
            field = find(rows.schema, column.name)
            if isinstance(field.dataType, T.StringType):
                checked = sized_text(rows[quote(field.name)], column.type)
                rows = rows.withColumn(field.name, checked)
    return rows


def run_python(
    store: TableStore, spec: TableSpec, transform: PythonTransform | None, **options: Any
) -> DataFrame | None:
    """Materialize what a Python function returns; options as for ``materialize``."""
    rows = run_transform(store.spark, spec.name, transform)
    if rows is None or spec.kind == "none":
        return rows
    if spec.kind != "table":
        raise SpecError("a python transform gives rows, not a view")
    return materialize(store, spec, rows, **options)


def run_seed(
    store: TableStore,
    spec: TableSpec,
    path: str | list[str],
    on_bad_cell: str = "raise",
    check: bool = True,
) -> DataFrame:
    """Replace a table by the rows of a seed file."""
    rows = read_seed(store.spark, path, spec, on_bad_cell)
    watch = _watch(store, spec, check)
    try:
        store.replace(spec, rows, watch)
    finally:
        store.unstage(rows)
    return _checked(store, spec, check, watch)


def run_rollup(
    store: TableStore,
    spec: TableSpec,
    facts: DataFrame,
    by: Sequence[str],
    measures: Sequence[Measure],
    changed: DataFrame | None = None,
    limits: Limits = Limits(),
    check: bool = True,
) -> DataFrame:
    """Publish the rollup of ``facts``; with ``changed`` leaf groups, only these and what contains them.

    A table that does not exist yet is made whole.
    """
    target = store.target(spec.name)
    staged: list[DataFrame] = []

    def stage(rows: DataFrame) -> DataFrame:
        staged.append(store.stage(rows))
        return staged[-1]

    whole = target is None or changed is None
    try:
        if whole:
            change = Change(EVERYTHING, rollup(facts, by, measures))
        else:
            known = replace(limits, list_keys=True, filed=store.filed(spec.name))
            change = refresh(target, facts, changed, by, measures, known, stage)
        watch = _watch(store, spec, check and change.goes == EVERYTHING)
        store.commit(spec, change, new_layout=whole, watch=watch)
    finally:
        for rows in staged:
            store.unstage(rows)
    return _checked(store, spec, check, watch)
