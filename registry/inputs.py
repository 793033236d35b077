"""Target and source rows the registered queries work on.

Each is a query over whole given tables; ``{orders}`` stands for the table.
Sources are the tables' own rows under other keys or dates, so that part of
the keys match, part are new and part vanish at every scale.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_TABLE = re.compile(r"\{(\w+)\}")

ORDERS_T = "SELECT * FROM {orders}"

# Even keys match an order, the upper half of them is new.
ORDERS_S = """
SELECT o_orderkey * 2 AS o_orderkey, o_custkey, 'U' AS o_orderstatus,
       o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
FROM {orders}"""

# Keys scattered over all orders, too many to list.
ORDERS_URGENT = """
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderpriority = '1-URGENT'"""

# Most dates occur among the orders, the last 400 days are new.
ORDERS_LATER = """
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
       o_orderdate + INTERVAL '400' DAY AS o_orderdate, o_orderpriority
FROM {orders}"""

# The run window's orders, as its query would give them.
ORDERS_1998 = """
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
       o_orderdate, o_orderpriority
FROM {orders}
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'"""

# A key of few values, each with a third of the rows, one of them NULL.
ORDERS_STATUS_T = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END
       AS o_orderstatus, o_totalprice
FROM {orders}"""
ORDERS_STATUS_S = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS o_orderstatus,
       o_totalprice + 1 AS o_totalprice
FROM {orders}"""

# A compound key with NULLs.
EVENTS_T = """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_key, event_type,
       CAST(ts AS DATE) AS event_date, event_id, ts, value
FROM {events}"""
EVENTS_S = """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_key, event_type,
       CAST(ts + INTERVAL '3' DAY AS DATE) AS event_date, event_id, ts + INTERVAL '3' DAY AS ts, value
FROM {events}"""

# Two fifths of the target rows have one key; the source has each key once.
EVENTS_HOT_T = """
SELECT CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE event_id END AS group_id,
       event_id, event_type, CAST(NULL AS BIGINT) AS seen
FROM {events}"""
EVENTS_HOT_S = """
SELECT CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE event_id * 2 END AS group_id,
       CAST(MAX(event_id) AS BIGINT) AS event_id, MAX(event_type) AS event_type,
       CAST(COUNT(*) AS BIGINT) AS seen
FROM {events}
GROUP BY 1"""

# Half of the days overlap.
COUNTS_T = """
SELECT CAST(ts - INTERVAL '15' DAY AS DATE) AS event_date, event_type,
       CAST(COUNT(*) AS BIGINT) AS event_count
FROM {events} GROUP BY 1, 2"""
COUNTS_S = """
SELECT CAST(ts AS DATE) AS event_date, event_type, CAST(COUNT(*) AS BIGINT) AS event_count
FROM {events} GROUP BY 1, 2"""

# Open versions of all customers, and closed ones of keys that partly have no
# open version any more. Keys and compared values may be NULL.
DIM_T = """
SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS c_custkey,
       CASE WHEN c_nationkey < 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * c_nationkey AS updated_at,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * c_nationkey AS _valid_from,
       TIMESTAMP '9999-12-31 00:00:00' AS _valid_until, TRUE AS _is_current
FROM {customer}
UNION ALL
SELECT c_custkey * 3, 'OLD', TIMESTAMP '2023-01-01 00:00:00', TIMESTAMP '2023-01-01 00:00:00',
       TIMESTAMP '2024-01-01 00:00:00', FALSE
FROM {customer}"""
DIM_S = """
SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey * 2 END AS c_custkey,
       CASE WHEN c_nationkey > 22 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       TIMESTAMP '2024-01-08 00:00:00' + INTERVAL '1' DAY * c_nationkey AS updated_at
FROM {customer}"""


def spark_sql(template: str, sf_dir: str) -> str:
    """The query over the parquet files; timestamps have no time zone."""
    text = _TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", template)
    return text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")


def rows(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    return spark.sql(spark_sql(template, sf_dir))


def plain_sql(template: str) -> str:
    """The query over tables of the same names."""
    return _TABLE.sub(lambda m: m.group(1), template)
