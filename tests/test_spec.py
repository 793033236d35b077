"""Definitions that cannot work are refused when they are made."""

from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import types as T

from tablewright import Check, ColumnSpec, RunWindow, SpecError, TableSpec

KEY = (ColumnSpec("id", "bigint", primary_key=True), ColumnSpec("name", "string"))


@pytest.mark.parametrize("strategy", ["append", "create+replace", "delete+insert", "merge"])
def test_views_take_no_strategy(strategy):
    with pytest.raises(SpecError, match="does not apply to view"):
        TableSpec("v", kind="view", strategy=strategy)


def test_table_without_strategy_is_replaced():
    assert TableSpec("t").strategy == "create+replace"


@pytest.mark.parametrize(
    "options, message",
    [
        ({"strategy": "upsert"}, "unknown strategy"),
        ({"kind": "materialized"}, "unknown materialization"),
        ({"strategy": "merge"}, "primary_key"),
        ({"strategy": "merge", "columns": (ColumnSpec("a"),)}, "primary_key"),
        ({"strategy": "anti_join"}, "primary_key"),
        ({"strategy": "anti_join", "columns": KEY, "incremental_key": "ts"}, "time_granularity"),
        (
            {"strategy": "anti_join", "columns": KEY, "time_granularity": "hour"},
            "'date' or 'timestamp'",
        ),
        ({"strategy": "delete+insert"}, "incremental_key"),
        ({"strategy": "time_interval"}, "incremental_key"),
        ({"strategy": "time_interval", "incremental_key": "dt"}, "time_granularity"),
        (
            {"strategy": "time_interval", "incremental_key": "dt", "time_granularity": "month"},
            "'date' or 'timestamp'",
        ),
        ({"strategy": "scd2_by_column"}, "primary_key"),
        ({"strategy": "scd2_by_time", "columns": KEY}, "incremental_key"),
        ({"strategy": "scd2_by_time", "incremental_key": "at"}, "primary_key"),
        (
            {
                "strategy": "scd2_by_time",
                "columns": (*KEY, ColumnSpec("at", "string")),
                "incremental_key": "at",
            },
            "timestamp or date",
        ),
        ({"strategy": "ddl"}, "needs columns"),
        ({"partition_by": "a", "cluster_by": ("b",)}, "together"),
        ({"columns": (ColumnSpec("a"), ColumnSpec("A"))}, "twice"),
    ],
)
def test_refused(options, message):
    with pytest.raises(SpecError, match=message):
        TableSpec("t", **options)


@pytest.mark.parametrize("name", ["_valid_from", "_valid_until", "_is_current", "_IS_CURRENT"])
@pytest.mark.parametrize("strategy", ["scd2_by_column", "scd2_by_time"])
def test_bookkeeping_names_are_reserved(strategy, name):
    with pytest.raises(SpecError, match="reserved"):
        TableSpec("t", (*KEY, ColumnSpec(name)), strategy=strategy, incremental_key="x")


@pytest.mark.parametrize("name", ["", "a.b.c", ".t", "s."])
def test_names_have_one_or_two_parts(name):
    with pytest.raises(SpecError, match="schema.table"):
        TableSpec(name)


def test_partition_names_may_come_as_text():
    assert TableSpec("t", partition_by="a, b").partition_by == ("a", "b")


@pytest.mark.parametrize(
    "kind, value",
    [
        ("accepted_values", "abc"),
        ("accepted_values", []),
        ("accepted_values", [1.5]),
        ("accepted_values", ["a", 1]),
        ("pattern", 5),
        ("min", None),
        ("median", None),
    ],
)
def test_checks_with_wrong_arguments(kind, value):
    with pytest.raises(SpecError):
        Check(kind, value)


def test_window_parameters_are_typed():
    zone = ZoneInfo("Asia/Tokyo")
    assert RunWindow("2024-01-01", datetime(2024, 1, 2, 10)).params("Asia/Tokyo") == {
        "start_date": date(2024, 1, 1),
        "end_date": date(2024, 1, 2),
        "start_timestamp": datetime(2024, 1, 1, tzinfo=zone),
        "end_timestamp": datetime(2024, 1, 2, 10, tzinfo=zone),
    }


@pytest.mark.parametrize(
    "dtype, granularity, expected",
    [
        (T.DateType(), "date", "`k` BETWEEN DATE'2024-01-01' AND DATE'2024-01-02'"),
        (T.DateType(), "timestamp", "`k` BETWEEN DATE'2024-01-01' AND DATE'2024-01-02'"),
        (
            T.TimestampNTZType(),
            "timestamp",
            "`k` BETWEEN TIMESTAMP_NTZ'2024-01-01 00:00:00' AND TIMESTAMP_NTZ'2024-01-02 10:00:00'",
        ),
        (
            T.TimestampNTZType(),
            "date",
            "(`k` >= TIMESTAMP_NTZ'2024-01-01 00:00:00' AND `k` < TIMESTAMP_NTZ'2024-01-03 00:00:00')",
        ),
        (
            T.TimestampType(),
            "timestamp",
            "`k` BETWEEN TIMESTAMP'2023-12-31 23:00:00+00:00' AND TIMESTAMP'2024-01-02 09:00:00+00:00'",
        ),
        (T.StringType(), "date", "`k` BETWEEN '2024-01-01' AND '2024-01-02'"),
    ],
)
def test_window_bounds_have_the_keys_type(dtype, granularity, expected):
    window = RunWindow("2024-01-01", "2024-01-02 10:00:00")
    assert window.predicate("k", dtype, granularity, "Europe/Amsterdam") == expected


def test_window_on_a_number_is_refused():
    with pytest.raises(SpecError, match="not a date"):
        RunWindow("2024-01-01", "2024-01-02").predicate("k", T.LongType(), "date", "UTC")
