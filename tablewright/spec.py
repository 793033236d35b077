"""What a table is and how it is kept up to date.

A ``TableSpec`` is checked when it is made, so a combination that cannot work
fails before any data is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

from .functions.literals import as_date, as_datetime, sql_literal
from .functions.types import parse_type, quote

# Names of the strategies, check kinds and bookkeeping columns (fixed values).
CREATE_REPLACE = "create+replace"
APPEND = "append"
DELETE_INSERT = "delete+insert"
TRUNCATE_INSERT = "truncate+insert"
MERGE = "merge"
TIME_INTERVAL = "time_interval"
ANTI_JOIN = "anti_join"
DDL = "ddl"
SCD2_BY_COLUMN = "scd2_by_column"
SCD2_BY_TIME = "scd2_by_time"
TABLE_STRATEGIES = (
    CREATE_REPLACE,
    APPEND,
    DELETE_INSERT,
    TRUNCATE_INSERT,
    MERGE,
    TIME_INTERVAL,
    ANTI_JOIN,
    DDL,
    SCD2_BY_COLUMN,
    SCD2_BY_TIME,
)
GRANULARITIES = ("date", "timestamp")
VALID_FROM = "_valid_from"
VALID_UNTIL = "_valid_until"
IS_CURRENT = "_is_current"
RESERVED = (VALID_FROM, VALID_UNTIL, IS_CURRENT)
OPEN_END = datetime(9999, 12, 31)
CHECK_KINDS = (
    "not_null",
    "unique",
    "positive",
    "non_negative",
    "negative",
    "min",
    "max",
    "accepted_values",
    "pattern",
)


class SpecError(ValueError):
    """A table definition that cannot be carried out."""


@dataclass(frozen=True)
class Check:
    """One quality check of a column; ``value`` is its argument, if it has one."""

    kind: str
    value: Any = None

    def __post_init__(self) -> None:
        if self.kind not in CHECK_KINDS:
            raise SpecError(f"unknown check {self.kind!r}")
        if self.kind in ("min", "max") and (self.value is None or isinstance(self.value, bool)):
            raise SpecError(f"check {self.kind} needs a value")
        if self.kind == "pattern" and not isinstance(self.value, str):
            raise SpecError(f"check pattern needs a string, got {self.value!r}")
        if self.kind == "accepted_values":
            values = self.value
            if isinstance(values, (str, bytes)) or not isinstance(values, Sequence):
                raise SpecError(f"check accepted_values needs a list, got {values!r}")
            if not values:
                raise SpecError("check accepted_values needs at least one value")
            whole = all(isinstance(v, int) and not isinstance(v, bool) for v in values)
            if not whole and not all(isinstance(v, str) for v in values):
                raise SpecError("check accepted_values takes strings or whole numbers")


@dataclass(frozen=True)
class CustomCheck:
    """A query whose single value must equal ``expected``."""

    name: str
    query: str
    expected: int = 0


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str | None = None
    description: str = ""
    primary_key: bool = False
    update_on_merge: bool = False
    checks: tuple[Check, ...] = ()

    def to_field(self) -> T.StructField:
        metadata = {"comment": self.description} if self.description else {}
        return T.StructField(self.name, parse_type(self.type), True, metadata)


@dataclass(frozen=True)
class RunWindow:
    """The time span one run is for; both ends belong to it.

    With ``date`` granularity whole days are meant: on a timestamp column the
    end day counts until midnight.  ``literal_end=True`` compares with the
    bare end date instead, which leaves out all but the first instant of it.
    """

    start: Any
    end: Any
    literal_end: bool = False

    def params(self, zone: str = "UTC") -> dict[str, Any]:
        """Named parameters for ``spark.sql(query, args=window.params(zone))``.

        Timestamps without a time zone are taken to be in ``zone``.
        """
        stamps = [as_datetime(self.start), as_datetime(self.end)]
        stamps = [s if s.tzinfo else s.replace(tzinfo=ZoneInfo(zone)) for s in stamps]
        return {
            "start_date": as_date(self.start),
            "end_date": as_date(self.end),
            "start_timestamp": stamps[0],
            "end_timestamp": stamps[1],
        }

    def predicate(self, key: str, dtype: T.DataType, granularity: str, zone: str) -> str:
        """``key`` lies in the window, with bounds of the key's own type."""
        by_day = granularity == "date"
        low: date | datetime = as_date(self.start) if by_day else as_datetime(self.start)
        high: date | datetime = as_date(self.end) if by_day else as_datetime(self.end)
        name = quote(key)
        if isinstance(dtype, T.StringType):
            return f"{name} BETWEEN {sql_literal(str(low), dtype)} AND {sql_literal(str(high), dtype)}"
        stamped = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
        if not stamped and not isinstance(dtype, T.DateType):
            raise SpecError(f"{key} is {dtype.simpleString()}, not a date, timestamp or string")
        if stamped and by_day and not self.literal_end:
            after = sql_literal(high + timedelta(days=1), dtype, zone)
            return f"({name} >= {sql_literal(low, dtype, zone)} AND {name} < {after})"
        return f"{name} BETWEEN {sql_literal(low, dtype, zone)} AND {sql_literal(high, dtype, zone)}"


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    if not value:
        return ()
    if isinstance(value, str):
        return tuple(part.strip() for part in value.split(",") if part.strip())
    return tuple(value)


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and materialization of one table.

    ``by_name`` binds source columns by name instead of position, ``null_safe``
    lets a change from or to NULL open a new version, ``clip`` drops source
    rows outside the run window, ``bootstrap`` lets an incremental strategy
    create the table on its first run. With ``newer_by`` a merge takes, of several
    source rows of a key, the one with the largest value of that column, and
    replaces a matched row only if the source's is not older.
    """

    name: str
    columns: tuple[ColumnSpec, ...] = ()
    kind: str = "table"
    strategy: str | None = None
    incremental_key: str | None = None
    time_granularity: str | None = None
    partition_by: str | Sequence[str] = ()
    cluster_by: str | Sequence[str] = ()
    custom_checks: tuple[CustomCheck, ...] = ()
    by_name: bool = False
    null_safe: bool = False
    clip: bool = False
    bootstrap: bool = False
    newer_by: str | None = None
    keys: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        put = object.__setattr__
        put(self, "columns", tuple(self.columns))
        put(self, "partition_by", _names(self.partition_by))
        put(self, "cluster_by", _names(self.cluster_by))
        put(self, "keys", tuple(c.name for c in self.columns if c.primary_key))
        self._check_name()
        self._check_strategy()
        if self.partition_by and self.cluster_by:
            raise SpecError("partition_by and cluster_by cannot be used together")

    def _check_name(self) -> None:
        parts = self.name.split(".")
        if len(parts) > 2 or not all(part.strip() for part in parts):
            raise SpecError(f"expected `table` or `schema.table`, got {self.name!r}")
        lowered = [c.name.lower() for c in self.columns]
        if len(set(lowered)) != len(lowered):
            raise SpecError("a column is declared twice")

    def _check_strategy(self) -> None:
        if self.kind not in ("none", "view", "table"):
            raise SpecError(f"unknown materialization {self.kind!r}")
        if self.kind != "table":
            if self.strategy is not None:
                raise SpecError(f"strategy {self.strategy} does not apply to {self.kind}")
            return
        if self.strategy is None:
            object.__setattr__(self, "strategy", CREATE_REPLACE)
        if self.strategy not in TABLE_STRATEGIES:
            raise SpecError(f"unknown strategy {self.strategy!r}")
        needs_keys = (MERGE, ANTI_JOIN, SCD2_BY_COLUMN, SCD2_BY_TIME)
        if self.strategy in needs_keys and not self.keys:
            raise SpecError(f"{self.strategy} needs a primary_key column")
        if self.strategy == DDL and not self.columns:
            raise SpecError("ddl needs columns")
        if self.strategy in (DELETE_INSERT, TIME_INTERVAL, SCD2_BY_TIME) and not self.incremental_key:
            raise SpecError(f"{self.strategy} needs incremental_key")
        if self.strategy in (TIME_INTERVAL, ANTI_JOIN):
            if self.incremental_key and not self.time_granularity:
                raise SpecError(f"{self.strategy} needs time_granularity with incremental_key")
            if self.time_granularity and self.time_granularity not in GRANULARITIES:
                raise SpecError("time_granularity must be 'date' or 'timestamp'")
        if self.newer_by is not None:
            named = [c.name.lower() for c in self.columns if c.update_on_merge]
            if self.strategy != MERGE or self.newer_by.lower() not in named:
                raise SpecError("newer_by names an update_on_merge column of a merge")
        if self.is_scd2:
            self._check_scd2()

    def _check_scd2(self) -> None:
        for column in self.columns:
            if column.name.lower() in RESERVED:
                raise SpecError(f"column name {column.name} is reserved for validity tracking")
            if self.strategy == SCD2_BY_TIME and column.name == self.incremental_key:
                if (column.type or "").lower() not in ("timestamp", "timestamp_ntz", "date"):
                    raise SpecError("incremental_key of scd2_by_time must be a timestamp or date")

    @property
    def is_scd2(self) -> bool:
        return self.strategy in (SCD2_BY_COLUMN, SCD2_BY_TIME)

    @property
    def needs_window(self) -> bool:
        """Only these forms bind the run window into their own plan."""
        return self.strategy == TIME_INTERVAL or (
            self.strategy == ANTI_JOIN and self.incremental_key is not None
        )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def update_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.update_on_merge]

    def schema(self) -> T.StructType:
        return T.StructType([c.to_field() for c in self.columns])
