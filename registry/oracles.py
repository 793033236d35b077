"""The registered queries as SQL, in another shape than the Spark plans.

Row-level changes are spelled out as "what stays" UNION ALL "what comes in",
with NOT EXISTS in place of joins.
"""

from __future__ import annotations

from . import inputs, journeys, streams, temporal, totals
from .inputs import plain_sql

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_EVENTS = "user_key, event_type, event_date, event_id, ts, value"
_SAME_EVENT = (
    "t.user_key IS NOT DISTINCT FROM s.user_key AND t.event_type IS NOT DISTINCT FROM s.event_type "
    "AND t.event_date IS NOT DISTINCT FROM s.event_date"
)
_OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"
_NOW = "TIMESTAMP '2024-06-01 00:00:00'"


def _with(target: str, source: str, body: str) -> str:
    return plain_sql(f"WITH t AS ({target}), s AS ({source}) {body}")


def _append() -> str:
    return _with(inputs.ORDERS_T, inputs.ORDERS_S, "SELECT * FROM t UNION ALL SELECT * FROM s")


def _delete_insert(target: str, source: str, key: str) -> str:
    return _with(
        target,
        source,
        f"SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.{key} = t.{key}) "
        "UNION ALL SELECT * FROM s",
    )


def _merge(target: str, source: str, keys: list[str], columns: dict[str, str], inserted: list[str]) -> str:
    """``columns``: every target column with its expression for a matched or kept row."""
    on = " AND ".join(f"s.{key} = t.{key}" for key in keys)
    kept = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    new = ", ".join(f"s.{name}" if name in inserted else f"NULL AS {name}" for name in columns)
    return _with(
        target,
        source,
        f"SELECT {kept} FROM t LEFT JOIN s ON {on} UNION ALL "
        f"SELECT {new} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})",
    )


def _updated(name: str, key: str) -> str:
    return f"CASE WHEN s.{key} IS NULL THEN t.{name} ELSE s.{name} END"


def _merge_orders(source: str = inputs.ORDERS_S) -> str:
    columns = {name: f"t.{name}" for name in _ORDERS.split(", ")}
    for name in ("o_orderstatus", "o_totalprice"):
        columns[name] = _updated(name, "o_orderkey")
    return _merge(inputs.ORDERS_T, source, ["o_orderkey"], columns, list(columns))


def _merge_insert_only() -> str:
    columns = {name: f"t.{name}" for name in _ORDERS.split(", ")}
    return _merge(inputs.ORDERS_T, inputs.ORDERS_S, ["o_orderkey"], columns, list(columns)[:4])


def _merge_hot() -> str:
    columns = {name: f"t.{name}" for name in ("group_id", "event_id", "event_type")}
    columns["seen"] = _updated("seen", "group_id")
    return _merge(
        inputs.EVENTS_HOT_T, inputs.EVENTS_HOT_S, ["group_id"], columns, list(columns)
    )


def _merge_counts() -> str:
    columns = {
        "event_date": "t.event_date",
        "event_type": "t.event_type",
        "event_count": _updated("event_count", "event_date"),
    }
    return _merge(
        inputs.COUNTS_T, inputs.COUNTS_S, ["event_date", "event_type"], columns, list(columns)
    )


def _time_interval_orders() -> str:
    return _with(
        inputs.ORDERS_T,
        inputs.ORDERS_1998,
        "SELECT * FROM t WHERE o_orderdate IS NULL OR o_orderdate < TIMESTAMP '1998-01-01' "
        "OR o_orderdate > TIMESTAMP '1998-12-31' UNION ALL SELECT * FROM s",
    )


def _time_interval_by_day() -> str:
    inside = "CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
    return _with(
        inputs.EVENTS_T,
        inputs.EVENTS_S,
        f"SELECT * FROM t WHERE NOT ({inside}) UNION ALL SELECT * FROM s WHERE {inside}",
    )


def _anti_join(bound: str = "") -> str:
    return _with(
        inputs.EVENTS_T,
        inputs.EVENTS_S,
        f"SELECT {_EVENTS} FROM t UNION ALL SELECT {_EVENTS} FROM s "
        f"WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_SAME_EVENT}{bound})",
    )


def _scd2(
    changed: str,
    ended: str,
    started: str,
    insert_updated: bool = True,
    target: str = inputs.DIM_T,
) -> str:
    """Versions kept or closed, then versions opened."""
    text = "CAST({} AS VARCHAR) AS {}".format
    new_updated = "s.updated_at" if insert_updated else "CAST(NULL AS TIMESTAMP)"
    state = (
        "CASE WHEN NOT t._is_current THEN 'closed' WHEN s.c_custkey IS NULL THEN 'gone' "
        f"WHEN {changed} THEN 'changed' ELSE 'same' END"
    )
    until = f"CASE state WHEN 'gone' THEN {_NOW} WHEN 'changed' THEN {ended} ELSE _valid_until END"
    return _with(
        target,
        inputs.DIM_S,
        f"""
        , j AS (SELECT t.*, s.updated_at AS s_updated_at, {state} AS state
                FROM t LEFT JOIN s ON s.c_custkey = t.c_custkey)
        SELECT c_custkey, c_mktsegment, {text("updated_at", "updated_at")},
               {text("_valid_from", "_valid_from")},
               {text(until, "_valid_until")},
               state = 'same' AS _is_current
        FROM j
        UNION ALL
        SELECT s.c_custkey, s.c_mktsegment, {text(new_updated, "updated_at")},
               {text(started, "_valid_from")}, {text(_OPEN_END, "_valid_until")}, TRUE
        FROM s
        WHERE NOT EXISTS (SELECT 1 FROM t WHERE t._is_current AND t.c_custkey = s.c_custkey)
           OR EXISTS (SELECT 1 FROM t WHERE t._is_current AND t.c_custkey = s.c_custkey AND ({changed}))
        """,
    )


_SEGMENT = "t.c_mktsegment <> s.c_mktsegment"
_SEGMENT_OR_DATE = f"{_SEGMENT} OR t.updated_at <> s.updated_at"


def _scd2_two_runs() -> str:
    first = (
        "SELECT c_custkey, c_mktsegment, updated_at, updated_at AS _valid_from, "
        f"{_OPEN_END} AS _valid_until, TRUE AS _is_current FROM ({inputs.DIM_T}) WHERE _is_current"
    )
    return _scd2(_SEGMENT_OR_DATE, "s_updated_at", "s.updated_at", target=first)


def _full_refresh(started: str) -> str:
    return plain_sql(
        f"SELECT {started} AS _valid_from, s.*, CAST({_OPEN_END} AS VARCHAR) AS _valid_until, "
        "TRUE AS _is_current FROM (SELECT c_custkey, c_mktsegment, "
        f"CAST(updated_at AS VARCHAR) AS updated_at FROM ({inputs.DIM_S})) s"
    )


def _check(table: str, column: str, check: str, bad: str) -> str:
    return plain_sql(
        f"SELECT '{column}' AS \"column\", '{check}' AS \"check\", n AS bad_rows, n = 0 AS passed "
        f"FROM (SELECT CAST({bad} AS BIGINT) AS n FROM {table})"
    )


def _bad(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _repeats(column: str) -> str:
    return f"COUNT({column}) - COUNT(DISTINCT {column})"


def _check_suite() -> str:
    counts = [
        ("l_orderkey", "not_null", _bad("l_orderkey IS NULL")),
        ("l_orderkey", "unique", _repeats("l_orderkey")),
        ("l_orderkey", "non_negative", _bad("l_orderkey < 0")),
        ("l_linenumber", "positive", _bad("l_linenumber <= 0")),
        ("l_linenumber", "unique", _repeats("l_linenumber")),
        ("l_quantity", "min", _bad("l_quantity < 5")),
        ("l_quantity", "max", _bad("l_quantity > 45")),
        ("l_tax", "negative", _bad("l_tax >= 0")),
        ("l_returnflag", "accepted_values", _bad("l_returnflag NOT IN ('A', 'R')")),
        ("l_linestatus", "pattern", _bad("NOT regexp_matches(l_linestatus, '^[OF]$')")),
    ]
    parts = [_check("lineitem", *count) for count in counts]
    parts.append(
        "SELECT '' AS \"column\", 'any_rows' AS \"check\", CAST(COUNT(*) > 0 AS BIGINT) AS bad_rows, "
        "COUNT(*) > 0 AS passed FROM lineitem"
    )
    return " UNION ALL ".join(parts)


def all_oracles() -> dict[str, str]:
    rebuilt = plain_sql(inputs.ORDERS_S)
    delete_orders = _delete_insert(inputs.ORDERS_T, inputs.ORDERS_LATER, "o_orderdate")
    delete_status = _delete_insert(
        inputs.ORDERS_STATUS_T, inputs.ORDERS_STATUS_S, "o_orderstatus"
    )
    by_column = _scd2(_SEGMENT, _NOW, _NOW, insert_updated=False)
    null_safe = _scd2(
        "t.c_mktsegment IS DISTINCT FROM s.c_mktsegment", _NOW, _NOW, insert_updated=False
    )
    events = "SELECT *, event_type = 'purchase' AS is_conversion FROM events"
    return {
        "create_replace_daily_counts": plain_sql(inputs.COUNTS_S),
        "create_replace_partitioned": plain_sql(inputs.EVENTS_T),
        "create_replace_clustered": plain_sql(inputs.ORDERS_T),
        "append_orders": _append(),
        "truncate_insert_orders": rebuilt,
        "delete_insert_orders": delete_orders,
        "delete_insert_orders_shuffled": delete_orders,
        "delete_insert_few_keys": delete_status,
        "delete_insert_few_keys_published": delete_status,
        "append_orders_published": _append(),
        "truncate_insert_orders_published": rebuilt,
        "delete_insert_orders_published": delete_orders,
        "merge_orders_published": _merge_orders(),
        "merge_urgent_orders_published": _merge_orders(inputs.ORDERS_URGENT),
        "delete_insert_urgent_orders_published": _delete_insert(inputs.ORDERS_T, inputs.ORDERS_URGENT, "o_orderkey"),
        "merge_orders": _merge_orders(),
        "merge_orders_shuffled": _merge_orders(),
        "merge_hot_key": _merge_hot(),
        "merge_hot_key_shuffled": _merge_hot(),
        "merge_insert_only": _merge_insert_only(),
        "merge_daily_counts": _merge_counts(),
        "merge_daily_counts_published": _merge_counts(),
        "time_interval_orders": _time_interval_orders(),
        "time_interval_orders_published": _time_interval_orders(),
        "time_interval_events_by_day": _time_interval_by_day(),
        "anti_join_events": _anti_join(),
        "anti_join_events_shuffled": _anti_join(),
        "anti_join_events_bounded": _anti_join(
            " AND t.ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"
        ),
        "anti_join_events_published": _anti_join(),
        "scd2_by_column": by_column,
        "scd2_by_column_keyed": _scd2(_SEGMENT_OR_DATE, "s_updated_at", "s.updated_at"),
        "scd2_by_column_null_safe": null_safe,
        "scd2_by_column_shuffled": by_column,
        "scd2_by_time": _scd2("t._valid_from < s.updated_at", "s_updated_at", "s.updated_at"),
        "scd2_two_runs_published": _scd2_two_runs(),
        "scd2_full_refresh_column": _full_refresh(f"CAST({_NOW} AS VARCHAR)"),
        "scd2_full_refresh_time": _full_refresh("s.updated_at"),
        "full_refresh_merge": rebuilt,
        "query_passthrough": (
            "SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM events GROUP BY event_type"
        ),
        "view_purchases": (
            "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'"
        ),
        "ddl_then_append": (
            "SELECT event_id AS id, event_type, CAST(ts AS DATE) AS event_date, "
            "CAST(value AS DECIMAL(12,2)) AS amount FROM events"
        ),
        "window_params": (
            "SELECT o_orderkey, o_orderdate FROM orders "
            "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
        ),
        "check_not_null": _check(
            f"({inputs.EVENTS_T})", "user_key", "not_null", _bad("user_key IS NULL")
        ),
        "check_unique": _check("lineitem", "l_orderkey", "unique", _repeats("l_orderkey")),
        "check_positive": _check("lineitem", "l_discount", "positive", _bad("l_discount <= 0")),
        "check_non_negative": _check("customer", "c_acctbal", "non_negative", _bad("c_acctbal < 0")),
        "check_negative": _check("customer", "c_acctbal", "negative", _bad("c_acctbal >= 0")),
        "check_min": _check("lineitem", "l_quantity", "min", _bad("l_quantity < 5")),
        "check_max": _check("lineitem", "l_quantity", "max", _bad("l_quantity > 45")),
        "check_accepted_values": _check(
            "events",
            "event_type",
            "accepted_values",
            _bad("event_type NOT IN ('click', 'view', 'purchase')"),
        ),
        "check_accepted_numbers": _check(
            "lineitem", "l_linenumber", "accepted_values", _bad("l_linenumber NOT IN (1, 2, 3, 4)")
        ),
        "check_pattern": _check(
            "part", "p_brand", "pattern", _bad("NOT regexp_matches(p_brand, '^Brand#[0-9]$')")
        ),
        "check_custom": (
            "SELECT '' AS \"column\", 'orders_exist' AS \"check\", COUNT(*) AS bad_rows, "
            "COUNT(*) = 0 AS passed FROM lineitem l "
            "WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)"
        ),
        "check_suite": _check_suite(),
        "check_suite_written": _check_suite(),
        "seed_customer": "SELECT * FROM customer",
        "seed_documents": "SELECT * FROM documents",
        "seed_documents_split": "SELECT * FROM documents",
        "seed_ragged_orders": (
            "SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS status, "
            "CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE '' END AS priority FROM orders"
        ),
        "seed_carriage_returns": (
            "SELECT o_orderkey AS key, 'a' || chr(13) || o_orderstatus AS status, o_orderpriority || chr(13) || chr(13) AS priority, "
            "CASE WHEN o_orderkey % 100 = 1 THEN 'two' || chr(10) || 'lines' ELSE '' END AS note FROM orders"
        ),
        "gate_query": (
            "SELECT COUNT(*) > 0 AS ready FROM events "
            "WHERE event_type = 'purchase' AND ts >= DATE '2024-01-10'"
        ),
        "gate_table": plain_sql(
            f"SELECT COUNT(*) > 0 AS ready FROM ({inputs.EVENTS_T}) "
            "WHERE event_date = DATE '2024-01-15' AND user_key IS NULL"
        ),
        "python_enrich_events": events,
        **journeys.ORACLES,
        **streams.ORACLES,
        **temporal.ORACLES,
        **totals.ORACLES,
    }
