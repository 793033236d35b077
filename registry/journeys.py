"""Queries of funnels and stored sketches, with their SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import Sketch, TableSpec, estimates, funnels, materialize, merge_sketches, sketch

from .inputs import plain_sql, rows
from .tables import fresh, new_store

STEPS = ("event_type = 'view'", "event_type = 'click'", "event_type = 'purchase'")
USER_EVENTS = "SELECT user_id, ts, event_type FROM {events}"
# A third of all events is of one user, a few of none; only the day is known.
HOT_USER_EVENTS = """
SELECT CASE WHEN event_id % 3 = 0 THEN -1 WHEN event_id % 50 = 1 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 70 = 1 THEN NULL ELSE CAST(ts AS DATE) END AS ts, event_type
FROM {events}"""

# Each type's amounts of a day; some users are unknown. Later some days come again with other rows.
AMOUNTS = """
SELECT CAST(ts AS DATE) AS day, event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id * 64 + event_id % 64 END AS visitor, value
FROM {events}"""
AMOUNTS_AGAIN = """
SELECT CAST(ts AS DATE) AS day, event_type, event_id AS visitor, value + 10 AS value
FROM {events} WHERE EXTRACT(DAY FROM ts) IN (3, 17) AND event_id % 2 = 0"""
SKETCHES = (Sketch("visitors", "distinct", "visitor"), Sketch("amounts", "quantiles", "value"))
RANKS = (0.1, 0.5, 0.99)


def funnels_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels(rows(spark, sf_dir, USER_EVENTS), ["user_id"], "ts", STEPS, timedelta(days=2))


def funnels_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels(rows(spark, sf_dir, HOT_USER_EVENTS), ["user_id"], "ts", STEPS, timedelta(days=1), width=timedelta(days=2))


def sketches_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each day and type, of which two days are replaced; what they tell of each type, and whether it is near."""
    store = new_store(spark)
    spec = TableSpec(fresh(store, "daily_sketches"), strategy="delete+insert", incremental_key="day", bootstrap=True)
    first, again = rows(spark, sf_dir, AMOUNTS), rows(spark, sf_dir, AMOUNTS_AGAIN)
    by = ["event_type"]
    materialize(store, spec, sketch(first, ["day", *by], SKETCHES))
    daily = materialize(store, spec, sketch(again, ["day", *by], SKETCHES))
    told = estimates(merge_sketches(daily, by, SKETCHES), by, SKETCHES, RANKS)

    facts = first.join(again.select("day").distinct(), "day", "left_anti").unionByName(again)
    known = facts.join(F.broadcast(told.select("event_type", F.col("amounts").alias("at"))), "event_type")  # a row per type
    ranks = [F.count(F.when(F.col("value") <= F.col("at")[i], 1)).alias(f"rank{i}") for i in range(len(RANKS))]
    exact = known.groupBy(*by).agg(F.count_distinct("visitor").alias("n_visitors"), F.count("value").alias("n_amounts"), *ranks)
    # 4 standard errors, and values that are alike may lie on either side of a rank by one
    close = F.abs(F.col("visitors") - F.col("n_visitors")) <= 4 * SKETCHES[0].error * F.col("n_visitors") + 1
    near = [F.abs(F.col(f"rank{i}") - rank * F.col("n_amounts")) <= SKETCHES[1].error * F.col("n_amounts") + 3 for i, rank in enumerate(RANKS)]
    both = exact.join(F.broadcast(told), "event_type")
    return both.select(
        "event_type", "n_visitors", F.col("amounts_n").alias("n_amounts"), close.alias("visitors_near"), near[0].alias("p10_near"), near[1].alias("p50_near"), near[2].alias("p99_near")
    )


def _funnels_sql(events: str, within: str) -> str:
    return plain_sql(
        f"""WITH e AS (
        SELECT user_id, ts, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS step FROM ({events})
        WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IN ('view', 'click', 'purchase')),
        f AS (SELECT *, SUM(CASE WHEN step = 0 THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, step ROWS UNBOUNDED PRECEDING) AS funnel FROM e),
        b AS (SELECT user_id, funnel, MIN(ts) AS began FROM f WHERE funnel > 0 GROUP BY user_id, funnel),
        c AS (SELECT b.user_id, b.funnel, b.began, MIN(f.ts) AS clicked FROM b LEFT JOIN f ON f.user_id = b.user_id AND f.funnel = b.funnel
            AND f.step = 1 AND f.ts <= b.began + INTERVAL {within} GROUP BY b.user_id, b.funnel, b.began),
        p AS (SELECT c.user_id, c.funnel, c.began, c.clicked, MIN(f.ts) AS bought FROM c LEFT JOIN f ON f.user_id = c.user_id
            AND f.funnel = c.funnel AND f.step = 2 AND f.ts >= c.clicked AND f.ts <= c.began + INTERVAL {within}
            GROUP BY c.user_id, c.funnel, c.began, c.clicked)
        SELECT user_id, began, CAST(CASE WHEN bought IS NOT NULL THEN 3 WHEN clicked IS NOT NULL THEN 2 ELSE 1 END AS INTEGER) AS reached,
        COALESCE(bought, clicked, began) AS ended FROM p"""
    )


QUERIES = {
    "funnels_events": funnels_events,
    "funnels_hot_user": funnels_hot_user,
    "sketches_published": sketches_published,
}

ORACLES = {
    "funnels_events": _funnels_sql(USER_EVENTS, "'2' DAY"),
    "funnels_hot_user": _funnels_sql(HOT_USER_EVENTS, "'1' DAY"),
    "sketches_published": plain_sql(
        f"""SELECT event_type, COUNT(DISTINCT visitor) AS n_visitors, COUNT(value) AS n_amounts, TRUE AS visitors_near,
        TRUE AS p10_near, TRUE AS p50_near, TRUE AS p99_near
        FROM (SELECT * FROM ({AMOUNTS}) WHERE day NOT IN (SELECT day FROM ({AMOUNTS_AGAIN})) UNION ALL SELECT * FROM ({AMOUNTS_AGAIN}))
        GROUP BY event_type"""
    ),
}
