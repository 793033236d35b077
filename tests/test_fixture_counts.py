"""Known row counts of target and source pairs cut from the given tables at sf0.01."""

import pytest

from conftest import MEDIUM
from registry.inputs import spark_sql
from registry.spark_queries import BOUNDED, DIM_DATED_COLUMNS, EVENT_KEY_COLUMNS, NOW, ORDER_COLUMNS
from tablewright import Check, ColumnSpec, Limits, RunWindow, TableSpec, next_state, run_checks

ORDERS_T = "SELECT * FROM {orders} WHERE o_orderkey % 3 <> 0"
ORDERS_S = """SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
    o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 2 = 0"""
EVENTS = """SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_key, event_type,
    CAST(ts AS DATE) AS event_date, event_id, ts, value FROM {events} WHERE """
DIM_T = """SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
    c_acctbal, TIMESTAMP '2024-01-01' + INTERVAL '1' DAY * (c_custkey % 30) AS updated_at,
    TIMESTAMP '2024-01-01' AS _valid_from, TIMESTAMP '9999-12-31 00:00:00' AS _valid_until,
    TRUE AS _is_current FROM {customer} WHERE c_custkey % 5 <> 0
    UNION ALL SELECT c_custkey, 'OLD', c_acctbal, TIMESTAMP '2023-01-01', TIMESTAMP '2023-01-01',
    TIMESTAMP '2024-01-01', FALSE FROM {customer} WHERE c_custkey % 4 = 0"""
DIM_S = """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment,
    c_acctbal, TIMESTAMP '2024-01-01' + INTERVAL '1' DAY *
    (c_custkey % 30 + CASE WHEN c_custkey % 6 = 0 THEN 40 ELSE 0 END) AS updated_at
    FROM {customer} WHERE c_custkey % 7 <> 0"""
DIM_COLUMNS = (*DIM_DATED_COLUMNS, ColumnSpec("c_acctbal"))
FORMS = pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)], ids=["small", "large"])


def rows(spark, template):
    return spark.sql(spark_sql(template, MEDIUM))


def orders(spark, strategy, source=ORDERS_S, window=None, limits=Limits(), **options):
    spec = TableSpec("orders", ORDER_COLUMNS, strategy=strategy, **options)
    return next_state(
        spec, rows(spark, ORDERS_T), rows(spark, source), window=window, limits=limits, now=NOW
    )


def test_append_and_truncate(spark):
    assert orders(spark, "append").count() == 17500
    assert orders(spark, "truncate+insert").count() == 7500


@FORMS
def test_delete_insert(spark, limits):
    source = ORDERS_S + " AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'"
    got = orders(spark, "delete+insert", source, limits=limits, incremental_key="o_orderdate")
    assert got.count() == 9414
    assert got.filter("o_orderstatus <> 'U'").count() == 7586


@FORMS
def test_merge(spark, limits):
    got = orders(spark, "merge", limits=limits)
    assert got.count() == 12500
    assert got.filter("o_orderstatus = 'U'").count() == 7500


def test_time_interval(spark):
    inside = " AND o_orderdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'"
    got = orders(
        spark,
        "time_interval",
        ORDERS_S + inside,
        RunWindow("1998-01-01", "1998-12-31"),
        incremental_key="o_orderdate",
        time_granularity="timestamp",
    )
    assert got.count() == 9610


@FORMS
@pytest.mark.parametrize("bounded, expected", [(False, 6159), (True, 7603)])
def test_anti_join(spark, limits, bounded, expected):
    spec = TableSpec("e", EVENT_KEY_COLUMNS, strategy="anti_join", **(BOUNDED if bounded else {}))
    got = next_state(
        spec,
        rows(spark, EVENTS + "event_id % 2 = 0"),
        rows(spark, EVENTS + "event_id % 3 = 0"),
        window=RunWindow("2024-01-10", "2024-01-20"),
        limits=limits,
    )
    assert got.count() == expected


@FORMS
@pytest.mark.parametrize(
    "strategy, key, expected",
    [
        ("scd2_by_column", None, 2159),
        ("scd2_by_column", "updated_at", 2159),
        ("scd2_by_time", "updated_at", 2860),
    ],
)
def test_scd2(spark, limits, strategy, key, expected):
    spec = TableSpec("d", DIM_COLUMNS, strategy=strategy, incremental_key=key)
    got = next_state(spec, rows(spark, DIM_T), rows(spark, DIM_S), now=NOW, limits=limits)
    assert got.count() == expected
    assert got.filter("_is_current").count() == 1285


@pytest.mark.parametrize("strategy", ["scd2_by_column", "scd2_by_time"])
def test_scd2_full_refresh(spark, strategy):
    spec = TableSpec("d", DIM_DATED_COLUMNS, strategy=strategy, incremental_key="updated_at")
    assert next_state(spec, None, rows(spark, DIM_S), full_refresh=True).count() == 1285


@pytest.mark.parametrize(
    "source, column, check, bad",
    [
        ("SELECT * FROM {events}", "event_type", Check("accepted_values", ["click", "view", "purchase"]), 4031),
        ("SELECT * FROM {part}", "p_brand", Check("pattern", "^Brand#[0-9]$"), 1261),
        ("SELECT * FROM {customer}", "c_acctbal", Check("non_negative"), 122),
        ("SELECT * FROM {lineitem}", "l_orderkey", Check("unique"), 45257),
        (EVENTS + "TRUE", "user_key", Check("not_null"), 1429),
        ("SELECT * FROM {lineitem}", "l_quantity", Check("min", 5), 4787),
        ("SELECT * FROM {lineitem}", "l_quantity", Check("max", 45), 5967),
    ],
)
def test_checks(spark, source, column, check, bad):
    spec = TableSpec("t", (ColumnSpec(column, checks=(check,)),))
    assert run_checks(rows(spark, source), spec).first()["bad_rows"] == bad
