"""Queries of joins over time, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import asof_join, overlap_join

from .inputs import plain_sql, rows

# Three versions of each customer's segment, the last one open; some start at NULL.
VERSIONS = """
SELECT c_custkey AS user_id, c_mktsegment AS segment,
       CASE WHEN c_nationkey = 3 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * (c_custkey % 100) END AS valid_from,
       TIMESTAMP '2024-01-10 00:00:00' + INTERVAL '1' HOUR * (c_custkey % 100) AS valid_until
FROM {customer}
UNION ALL
SELECT c_custkey, 'SECOND', TIMESTAMP '2024-01-10 00:00:00' + INTERVAL '1' HOUR * (c_custkey % 100),
       TIMESTAMP '2024-01-15 00:00:00' FROM {customer} WHERE c_custkey % 3 <> 0
UNION ALL
SELECT c_custkey, 'THIRD', TIMESTAMP '2024-01-18 00:00:00', TIMESTAMP '9999-12-31 00:00:00'
FROM {customer} WHERE c_custkey % 2 = 0"""
VERSIONED_EVENTS = """
SELECT event_id, user_id % 1000 AS user_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts, value
FROM {events}"""

# Two fifths of the events have one key, and some of its own readings come between them.
HOT_EVENTS = """
SELECT CASE WHEN event_type IN ('click', 'view') THEN 'hot' WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind,
       event_id, ts, value
FROM {events}"""
HOT_READINGS = """
SELECT CASE WHEN event_id % 7 < 4 THEN 'hot' ELSE event_type END AS kind,
       CASE WHEN event_id % 210 = 0 THEN NULL ELSE ts + INTERVAL '30' SECOND END AS read_at,
       event_id AS reading
FROM {events} WHERE event_id % 7 IN (0, 3, 5)"""

# An order's span runs from its date to two days after its last shipping.
ORDER_SPANS = """
SELECT o.o_custkey, o.o_orderkey, o.o_orderdate AS starts,
       MAX(l.l_shipdate) + INTERVAL '2' DAY AS ends
FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, o.o_orderkey, o.o_orderdate"""
# A shipping's span: two weeks from its date, for every hundredth one ten years.
SHIP_SPANS = """
SELECT o.o_custkey, l.l_orderkey AS shipped_order, l.l_linenumber AS line, l.l_partkey AS part, l.l_shipdate AS ships,
       l.l_shipdate + INTERVAL '1' DAY * (CASE WHEN l.l_partkey % 100 = 0 THEN 3650 ELSE 14 END) AS arrives
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"""


def asof_event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the version of its user's segment valid at its time."""
    joined = asof_join(
        rows(spark, sf_dir, VERSIONED_EVENTS), rows(spark, sf_dir, VERSIONS), ["user_id"], "ts", "valid_from", until="valid_until"
    )
    return joined.select("event_id", "user_id", "ts", "segment", "valid_from")


def asof_hot_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last reading of its kind, most of them of one kind."""
    return asof_join(rows(spark, sf_dir, HOT_EVENTS), rows(spark, sf_dir, HOT_READINGS), ["kind"], "ts", "read_at")


def overlap_orders_shippings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often an order's span overlaps shippings of other orders of its customer, and when first."""
    pairs = overlap_join(
        rows(spark, sf_dir, ORDER_SPANS), rows(spark, sf_dir, SHIP_SPANS), ["o_custkey"], ("starts", "ends"), ("ships", "arrives")
    )
    return pairs.filter("shipped_order <> o_orderkey").groupBy("o_custkey", "o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("ships").alias("first_ship"), F.sum("part").alias("parts")
    )


QUERIES = {
    "asof_event_versions": asof_event_versions,
    "asof_hot_readings": asof_hot_readings,
    "overlap_orders_shippings": overlap_orders_shippings,
}

ORACLES = {
    "asof_event_versions": plain_sql(
        f"""WITH e AS ({VERSIONED_EVENTS}), v AS ({VERSIONS})
        SELECT e.event_id, e.user_id, e.ts, v.segment, v.valid_from FROM e
        LEFT JOIN v ON v.user_id = e.user_id AND v.valid_from <= e.ts AND e.ts < v.valid_until"""
    ),
    "asof_hot_readings": plain_sql(
        f"""WITH e AS ({HOT_EVENTS}), r AS (
            SELECT kind, read_at, MAX(reading) AS reading FROM ({HOT_READINGS}) GROUP BY ALL)
        SELECT e.kind, e.event_id, e.ts, e.value, r.read_at, r.reading
        FROM e ASOF LEFT JOIN r ON r.kind = e.kind AND e.ts >= r.read_at"""
    ),
    "overlap_orders_shippings": plain_sql(
        f"""WITH a AS ({ORDER_SPANS}), b AS ({SHIP_SPANS})
        SELECT a.o_custkey, a.o_orderkey, COUNT(*) AS n, MIN(b.ships) AS first_ship, CAST(SUM(b.part) AS BIGINT) AS parts
        FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.starts < b.arrives AND b.ships < a.ends AND a.starts < a.ends AND b.shipped_order <> a.o_orderkey
        GROUP BY a.o_custkey, a.o_orderkey"""
    ),
}
