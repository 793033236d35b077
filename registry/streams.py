"""Queries of streams, with their SQL: the given tables, delivered file by file."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import ColumnSpec, TableSpec, TableStore
from tablewright.sources.store import shared_folder
from tablewright.streaming import apply_stream, closed_once, late_rows, version_stream, window_counts

from .inputs import EVENTS_S, EVENTS_T, plain_sql, rows

SCHEMA = "tablewright_streams"
DELIVERIES = 6

# Events come by blocks of six days, every fiftieth two blocks late, every fortieth twice.
DELIVERED = """
SELECT event_id, ts, user_id, event_type, value,
       LEAST(5, CAST(FLOOR((day(ts) - 1) / 6) AS INT) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END) AS delivery
FROM {events}"""
TWICE = f"SELECT * FROM ({DELIVERED}) d UNION ALL SELECT * FROM ({DELIVERED}) d WHERE event_id % 40 = 1"
# New rows dealt to deliveries by their key, so that no key is split.
DELIVERED_NEW = f"""
SELECT user_key, event_type, event_date, event_id, ts, value, CAST(COALESCE(user_key, 7) % 6 AS INT) AS delivery
FROM ({EVENTS_S}) s"""
# Orders as changes of their customers, year by year; every twentieth comes two years late.
CHANGES = """
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderdate AS changed_at,
       LEAST(6, year(o_orderdate) - 1995 + CASE WHEN o_orderkey % 20 = 0 THEN 2 ELSE 0 END) AS delivery
FROM {orders}"""


def delivered(spark: SparkSession, sf_dir: str, template: str, deliveries: int) -> tuple[DataFrame, str]:
    """A stream that reads one delivery per batch, in order, and a new folder for its checkpoint."""
    folder = f"{shared_folder(spark)}/{SCHEMA}-{uuid.uuid4().hex}"
    source = rows(spark, sf_dir, template)
    # the source is read once, by all tasks; a delivery's file reads its own part only
    source.write.partitionBy("delivery").parquet(f"{folder}/dealt")
    dealt = spark.read.parquet(f"{folder}/dealt")
    for number in range(deliveries):  # one file each; their times order the stream
        dealt.filter(F.col("delivery") == number).drop("delivery").coalesce(1).write.mode("append").parquet(f"{folder}/files")
    stream = spark.readStream.schema(source.drop("delivery").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/files")
    return stream, f"{folder}/checkpoint"


def new_table(spark: SparkSession, name: str) -> tuple[TableStore, str]:
    store = TableStore(spark, location=f"{shared_folder(spark)}/{SCHEMA}-{uuid.uuid4().hex}")
    full = f"{SCHEMA}.{name}"
    if store.state(full) is not None:
        store.drop(full)
    return store, full


def column(name: str, type: str, **options) -> ColumnSpec:
    return ColumnSpec(name, type, **options)


def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, checkpoint = delivered(spark, sf_dir, DELIVERED, DELIVERIES)
    store, name = new_table(spark, "appended")
    spec = TableSpec(name, strategy="append", bootstrap=True)
    apply_stream(store, spec, stream, checkpoint).awaitTermination()
    return store.read(name)


def stream_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, of events that come out of order and partly twice."""
    stream, checkpoint = delivered(spark, sf_dir, TWICE, DELIVERIES)
    store, name = new_table(spark, "last_events")
    columns = (
        column("user_id", "bigint", primary_key=True),
        *[column(c, t, update_on_merge=True) for c, t in (("ts", "timestamp_ntz"), ("event_id", "bigint"), ("event_type", "string"))],
    )
    spec = TableSpec(name, columns, strategy="merge", newer_by="ts", by_name=True, bootstrap=True)
    wanted = stream.select("user_id", "ts", "event_id", "event_type")
    apply_stream(store, spec, wanted, checkpoint).awaitTermination()
    return store.read(name)


def stream_anti_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, checkpoint = delivered(spark, sf_dir, DELIVERED_NEW, DELIVERIES)
    store, name = new_table(spark, "landing")
    keys = tuple(column(c, t, primary_key=True) for c, t in (("user_key", "bigint"), ("event_type", "string"), ("event_date", "date")))
    spec = TableSpec(name, keys, strategy="anti_join")
    store.replace(spec, rows(spark, sf_dir, EVENTS_T))
    apply_stream(store, spec, stream, checkpoint).awaitTermination()
    return store.read(name)


WINDOW_COLUMNS = (
    column("window_start", "timestamp", primary_key=True),
    column("window_end", "timestamp", primary_key=True),
    column("event_type", "string", primary_key=True),
    column("n", "bigint", update_on_merge=True),
    column("last_id", "bigint", update_on_merge=True),
)


def windows(kind: str, mode: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    """Counts per window and type, and in a row without a window the number of late rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream, checkpoint = delivered(spark, sf_dir, TWICE, DELIVERIES)
        store, name = new_table(spark, f"{kind}_counts")
        counted = window_counts(
            stream, "ts", ["event_type"], late_by="3 hours", once_by=["event_id"], aggregates={"last_id": F.max("event_id")}, **options
        )
        spec = TableSpec(name, WINDOW_COLUMNS, strategy="merge" if mode == "update" else "append", bootstrap=True)
        running = apply_stream(store, spec, counted, checkpoint, output_mode=mode)
        running.awaitTermination()
        late = sum(late_rows(running).values())
        found = store.read(name).select(
            F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
            "event_type", "n", "last_id",
        )
        return found.union(spark.sql(f"SELECT CAST(NULL AS TIMESTAMP_NTZ), CAST(NULL AS TIMESTAMP_NTZ), 'late', {late}L, CAST(NULL AS BIGINT)"))

    return query


def stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of customers by their orders; closed after 300 days without one."""
    stream, checkpoint = delivered(spark, sf_dir, CHANGES, 7)
    store, name = new_table(spark, "versions")
    changes = version_stream(stream, ["o_custkey"], "changed_at", late_by="30 days", close_after_seconds=300 * 86400)
    columns = (
        column("_valid_from", "timestamp_ntz", primary_key=True), column("o_custkey", "bigint", primary_key=True),
        column("o_orderstatus", "string"), column("o_totalprice", "double"), column("changed_at", "timestamp_ntz"),
        column("_valid_until", "timestamp_ntz", update_on_merge=True), column("_is_current", "boolean", update_on_merge=True),
    )
    spec = TableSpec(name, columns, strategy="merge", by_name=True, bootstrap=True)
    apply_stream(store, spec, changes, checkpoint, output_mode="update", prepare=closed_once(["o_custkey"])).awaitTermination()
    found = store.read(name)
    return found.withColumns({c: F.col(c).cast("string") for c in ("_valid_from", "_valid_until")})


QUERIES = {
    "stream_append_events": stream_append_events,
    "stream_merge_events": stream_merge_events,
    "stream_anti_join_events": stream_anti_join_events,
    "stream_tumbling_counts": windows("tumbling", "update", width="1 hour"),
    "stream_sliding_counts": windows("sliding", "update", width="2 hours", slide="30 minutes"),
    "stream_session_counts": windows("session", "append", gap="10 minutes"),
    "stream_versions": stream_versions,
}


def _in_time(template: str, time: str, delay: str) -> str:
    """Which delivered rows are late: not after the latest time of the deliveries up to two before, less the delay."""
    return plain_sql(
        f"""d AS ({template}),
        tops AS (SELECT delivery, MAX({time}) AS top FROM d GROUP BY delivery),
        marks AS (SELECT a.delivery, date_trunc('millisecond', MAX(b.top)) - INTERVAL {delay} AS mark
                  FROM tops a LEFT JOIN tops b ON b.delivery <= a.delivery - 2 GROUP BY a.delivery),
        final AS (SELECT date_trunc('millisecond', MAX(top)) - INTERVAL {delay} AS mark FROM tops),
        judged AS (SELECT d.*, coalesce(d.{time} <= m.mark, FALSE) AS late FROM d JOIN marks m USING (delivery))"""
    )


_LATE = "SELECT NULL AS window_start, NULL AS window_end, 'late' AS event_type, COUNT(*) AS n, NULL AS last_id FROM judged WHERE late"


def _windows(windowed: str) -> str:
    return f"""WITH {_in_time(TWICE, "ts", "'3' HOUR")}, once AS (SELECT DISTINCT event_id, ts, event_type FROM judged WHERE NOT late),
        {windowed} UNION ALL {_LATE}"""


ORACLES = {
    "stream_append_events": plain_sql("SELECT event_id, ts, user_id, event_type, value FROM {events}"),
    "stream_merge_events": plain_sql(
        "SELECT user_id, MAX(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type "
        "FROM {events} GROUP BY user_id"
    ),
    "stream_anti_join_events": plain_sql(
        f"""WITH t AS ({EVENTS_T}), s AS ({EVENTS_S})
        SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_key IS NOT DISTINCT FROM s.user_key
            AND t.event_type IS NOT DISTINCT FROM s.event_type AND t.event_date IS NOT DISTINCT FROM s.event_date)"""
    ),
    "stream_tumbling_counts": _windows(
        """w AS (SELECT date_trunc('hour', ts) AS window_start, event_type, event_id FROM once)
        SELECT window_start, window_start + INTERVAL '1' HOUR AS window_end, event_type, COUNT(*) AS n, MAX(event_id) AS last_id FROM w GROUP BY ALL"""
    ),
    "stream_sliding_counts": _windows(
        """w AS (SELECT time_bucket(INTERVAL '30' MINUTE, ts) - INTERVAL '30' MINUTE * unnest(range(4)) AS window_start, event_type, event_id FROM once)
        SELECT window_start, window_start + INTERVAL '2' HOUR AS window_end, event_type, COUNT(*) AS n, MAX(event_id) AS last_id FROM w GROUP BY ALL"""
    ),
    "stream_session_counts": _windows(
        """gaps AS (SELECT *, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL '10' MINUTE THEN 0 ELSE 1 END AS opens FROM once),
        numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS session FROM gaps)
        SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL '10' MINUTE AS window_end, event_type, COUNT(*) AS n, MAX(event_id) AS last_id
        FROM numbered GROUP BY event_type, session HAVING MAX(ts) + INTERVAL '10' MINUTE <= (SELECT mark FROM final)"""
    ),
    "stream_versions": f"""WITH {_in_time(CHANGES, "changed_at", "'30' DAY")},
        firsts AS (SELECT * FROM judged WHERE NOT late
            QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, changed_at ORDER BY delivery, o_orderstatus, o_totalprice) = 1),
        -- a change that is no newer than the open version of its customer opens none
        newer AS (SELECT *, MAX(changed_at) OVER (PARTITION BY o_custkey ORDER BY delivery, changed_at
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS had FROM firsts),
        opened AS (SELECT * FROM newer WHERE had IS NULL OR changed_at > had),
        ends AS (SELECT *, changed_at + INTERVAL '300' DAY AS due, LEAD(changed_at) OVER (PARTITION BY o_custkey ORDER BY changed_at) AS next_at FROM opened),
        closed AS (SELECT *, CASE WHEN due < next_at OR next_at IS NULL AND due <= (SELECT mark FROM final) THEN due ELSE next_at END AS until FROM ends)
        SELECT CAST(changed_at AS VARCHAR) AS _valid_from, o_custkey, o_orderstatus, o_totalprice, changed_at,
            CAST(coalesce(until, TIMESTAMP '9999-12-31 00:00:00') AS VARCHAR) AS _valid_until, until IS NULL AS _is_current
        FROM closed""",
}
