"""Queries of grouping sets and rollups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright import Measure, TableSpec, cube, rollup, run_rollup

from .inputs import plain_sql, rows
from .tables import fresh, new_store

# Some groups are NULL, which is not a total.
LINES = """
SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag, l_linestatus AS status,
       CAST(YEAR(l_shipdate) AS BIGINT) AS ship_year, CAST(l_quantity AS BIGINT) AS quantity, l_orderkey
FROM {lineitem}"""
LINES_BY = ("flag", "status", "ship_year")
LINES_MEASURES = (
    Measure("n_lines", "count"),
    Measure("quantity", "sum", "quantity"),
    Measure("first_order", "min", "l_orderkey"),
    Measure("last_order", "max", "l_orderkey"),
)

ORDER_FACTS = """
SELECT o_orderpriority AS priority, o_orderstatus AS status, CAST(YEAR(o_orderdate) AS BIGINT) AS order_year, o_custkey
FROM {orders}"""
ORDER_BY = ("priority", "status", "order_year")
ORDER_MEASURES = (Measure("n_orders", "count"), Measure("customers", "max", "o_custkey"))

# Sales per customer and part of the customers' nations; later the orders of one status are gone.
SALES = """
SELECT CAST(c.c_nationkey AS BIGINT) AS nation, c.c_mktsegment AS segment, o.o_custkey AS customer, o.o_orderkey, o.o_orderstatus
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey"""
SALES_LATER = f"SELECT * FROM ({SALES}) WHERE NOT (o_orderstatus = 'P' AND nation < 6)"
SALES_CHANGED = f"SELECT nation, segment, customer FROM ({SALES}) WHERE o_orderstatus = 'P' AND nation < 6"
SALES_BY = ("nation", "segment", "customer")
SALES_MEASURES = (Measure("n_orders", "count"), Measure("last_order", "max", "o_orderkey"))


def rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(rows(spark, sf_dir, LINES), LINES_BY, LINES_MEASURES).drop("node")


def cube_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube(rows(spark, sf_dir, ORDER_FACTS), ORDER_BY, ORDER_MEASURES).drop("node")


def rollup_refreshed_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored rollup after orders went, of which only the groups that contain one are totalled again."""
    store = new_store(spark)
    spec = TableSpec(fresh(store, "sales_totals"))
    run_rollup(store, spec, rows(spark, sf_dir, SALES), SALES_BY, SALES_MEASURES)
    now, changed = rows(spark, sf_dir, SALES_LATER), rows(spark, sf_dir, SALES_CHANGED)
    return run_rollup(store, spec, now, SALES_BY, SALES_MEASURES, changed=changed).drop("node")


QUERIES = {
    "rollup_lineitem": rollup_lineitem,
    "cube_orders": cube_orders,
    "rollup_refreshed_published": rollup_refreshed_published,
}

ORACLES = {
    "rollup_lineitem": plain_sql(
        f"""SELECT flag, status, ship_year, CAST(GROUPING(flag, status, ship_year) AS BIGINT) AS grouping_id, COUNT(*) AS n_lines,
        CAST(SUM(quantity) AS BIGINT) AS quantity, MIN(l_orderkey) AS first_order, MAX(l_orderkey) AS last_order
        FROM ({LINES}) GROUP BY ROLLUP (flag, status, ship_year)"""
    ),
    "cube_orders": plain_sql(
        f"""SELECT priority, status, order_year, CAST(GROUPING(priority, status, order_year) AS BIGINT) AS grouping_id,
        COUNT(*) AS n_orders, MAX(o_custkey) AS customers
        FROM ({ORDER_FACTS}) GROUP BY CUBE (priority, status, order_year)"""
    ),
    "rollup_refreshed_published": plain_sql(
        f"""SELECT nation, segment, customer, CAST(GROUPING(nation, segment, customer) AS BIGINT) AS grouping_id,
        COUNT(*) AS n_orders, MAX(o_orderkey) AS last_order
        FROM ({SALES_LATER}) GROUP BY ROLLUP (nation, segment, customer)"""
    ),
}
