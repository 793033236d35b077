"""The registered queries on the Spark side."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import (
    Check,
    ColumnSpec,
    CustomCheck,
    Limits,
    RunWindow,
    TableSpec,
    Watch,
    gate_query,
    gate_table,
    materialize,
    next_state,
    run_checks,
    run_python,
    run_query,
    run_seed,
)

from . import inputs, journeys, streams, temporal, totals
from .inputs import rows, spark_sql
from .tables import SCHEMA, fresh, new_store

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 6, 1)
YEAR_1998 = RunWindow("1998-01-01", "1998-12-31")
MID_JANUARY = RunWindow("2024-01-10", "2024-01-20")
# Forces the form for sources that are too large to broadcast.
LARGE = Limits(broadcast_rows=0)


def column(name: str, type: str | None = None, **options) -> ColumnSpec:
    return ColumnSpec(name, type, **options)


ORDER_COLUMNS = (
    column("o_orderkey", "bigint", primary_key=True),
    column("o_custkey", "bigint"),
    column("o_orderstatus", "string", update_on_merge=True),
    column("o_totalprice", "double", update_on_merge=True),
    column("o_orderdate", "timestamp_ntz"),
    column("o_orderpriority", "string"),
)
EVENT_KEY_COLUMNS = (
    column("user_key", "bigint", primary_key=True),
    column("event_type", "string", primary_key=True),
    column("event_date", "date", primary_key=True),
)
COUNT_COLUMNS = (
    column("event_date", "date", primary_key=True),
    column("event_type", "string", primary_key=True),
    column(
        "event_count", "bigint", update_on_merge=True, checks=(Check("non_negative"),)
    ),
)
DIM_COLUMNS = (
    column("c_custkey", "bigint", primary_key=True),
    column("c_mktsegment", "string"),
)
DIM_DATED_COLUMNS = (*DIM_COLUMNS, column("updated_at", "timestamp_ntz"))


def pair(
    spec: TableSpec, target: str, source: str, window: RunWindow | None = None, **options
) -> Query:
    """The table's next state from its target and source rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return next_state(
            spec,
            rows(spark, sf_dir, target),
            rows(spark, sf_dir, source),
            window=window,
            now=NOW,
            **options,
        )

    return query


def published(
    spec: Callable[[str], TableSpec],
    table: str,
    target: str,
    source: str,
    window: RunWindow | None = None,
    **options,
) -> Query:
    """As ``pair``, with the target published and the change committed to it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = new_store(spark)
        wanted = spec(fresh(store, table))
        store.replace(wanted, rows(spark, sf_dir, target))
        return materialize(
            store, wanted, rows(spark, sf_dir, source), window=window, now=NOW, **options
        )

    return query


def in_text(query: Query) -> Query:
    """Validity timestamps as text: the open end is beyond what pandas can hold."""

    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = query(spark, sf_dir)
        return found.select(
            *[
                F.col(f.name).cast("string").alias(f.name) if "timestamp" in f.dataType.typeName() else f.name
                for f in found.schema
            ]
        )

    return wrapped


def orders_spec(strategy: str, name: str = "orders", **options) -> TableSpec:
    return TableSpec(name, ORDER_COLUMNS, strategy=strategy, **options)


def create_replace_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("daily_event_counts", COUNT_COLUMNS, strategy="create+replace")
    return next_state(spec, None, rows(spark, sf_dir, inputs.COUNTS_S))


def create_replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    spec = TableSpec(fresh(store, "events_by_day"), partition_by="event_date")
    return run_query(store, spec, spark_sql(inputs.EVENTS_T, sf_dir))


def create_replace_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    spec = TableSpec(fresh(store, "orders_by_date"), cluster_by=("o_orderdate", "o_custkey"))
    return run_query(store, spec, spark_sql(inputs.ORDERS_T, sf_dir))


def full_refresh_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_state(
        orders_spec("merge"),
        rows(spark, sf_dir, inputs.ORDERS_T),
        rows(spark, sf_dir, inputs.ORDERS_S),
        full_refresh=True,
    )


def scd2_full_refresh(strategy: str, key: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = TableSpec("customers", DIM_DATED_COLUMNS, strategy=strategy, incremental_key=key)
        source = rows(spark, sf_dir, inputs.DIM_S)
        return next_state(spec, None, source, full_refresh=True, now=NOW)

    return query


def scd2_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh from the open customers, then one run with the new rows."""
    store = new_store(spark)
    spec = TableSpec(
        fresh(store, "customers"),
        DIM_DATED_COLUMNS,
        strategy="scd2_by_column",
        incremental_key="updated_at",
    )
    first = "SELECT c_custkey, c_mktsegment, updated_at FROM (" + inputs.DIM_T + ") WHERE _is_current"
    materialize(store, spec, rows(spark, sf_dir, first), now=NOW, full_refresh=True)
    return materialize(store, spec, rows(spark, sf_dir, inputs.DIM_S), now=NOW)


def query_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM {events} GROUP BY event_type"
    return run_query(new_store(spark), TableSpec("adhoc", kind="none"), spark_sql(text, sf_dir))


def view_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_id, user_id, ts, value FROM {events} WHERE event_type = 'purchase'"
    spec = TableSpec(f"{SCHEMA}.purchases", kind="view")
    return run_query(new_store(spark), spec, spark_sql(text, sf_dir))


def ddl_then_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declare a table twice, which makes it once, then append all events to it."""
    store = new_store(spark)
    name = fresh(store, "declared_events")
    columns = (
        column("id", "bigint", primary_key=True, description="the event's number"),
        column("event_type", "text"),
        column("event_date", "date", description="day of the event, it's local"),
        column("amount", "decimal(12,2)"),
    )
    for _ in range(2):
        run_query(store, TableSpec(name, columns, strategy="ddl", partition_by="event_date"), None)
    text = "SELECT event_id, event_type, CAST(ts AS DATE), CAST(value AS DECIMAL(12,2)) FROM {events}"
    append = TableSpec(name, columns, strategy="append")
    return run_query(store, append, spark_sql(text, sf_dir))


def window_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT o_orderkey, o_orderdate FROM {orders}
        WHERE o_orderdate >= :start_date AND o_orderdate < date_add(:end_date, 1)"""
    spec = TableSpec("orders_in_window", kind="none")
    return run_query(new_store(spark), spec, spark_sql(text, sf_dir), window=YEAR_1998)


def one_check(table: str, name: str, check: Check) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = TableSpec(table, (column(name, checks=(check,)),))
        source = f"SELECT * FROM {{{table}}}" if table != "event_keys" else inputs.EVENTS_T
        return run_checks(rows(spark, sf_dir, source), spec)

    return query


def check_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT COUNT(*) FROM {lineitem} l
        WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_orderkey = l.l_orderkey)"""
    spec = TableSpec(
        "lineitem", custom_checks=(CustomCheck("orders_exist", spark_sql(text, sf_dir)),)
    )
    return run_checks(rows(spark, sf_dir, "SELECT * FROM {lineitem}"), spec)


def _suite(name: str, sf_dir: str) -> TableSpec:
    return TableSpec(
        name,
        (
            column("l_orderkey", checks=(Check("not_null"), Check("unique"), Check("non_negative"))),
            column("l_linenumber", checks=(Check("positive"), Check("unique"))),
            column("l_quantity", checks=(Check("min", 5), Check("max", 45))),
            column("l_tax", checks=(Check("negative"),)),
            column("l_returnflag", checks=(Check("accepted_values", ["A", "R"]),)),
            column("l_linestatus", checks=(Check("pattern", "^[OF]$"),)),
        ),
        custom_checks=(
            CustomCheck("any_rows", spark_sql("SELECT COUNT(*) > 0 FROM {lineitem}", sf_dir), 1),
        ),
    )


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(rows(spark, sf_dir, "SELECT * FROM {lineitem}"), _suite("lineitem", sf_dir))


def check_suite_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the row checks counted while the table is written."""
    store = new_store(spark)
    spec = _suite(fresh(store, "checked_lines"), sf_dir)
    watch = Watch(spec)
    store.replace(spec, rows(spark, sf_dir, "SELECT * FROM {lineitem}"), watch)
    return run_checks(store.read(spec.name), spec, watch.counts)


def _seeded(
    spark: SparkSession, sf_dir: str, table: str, columns: tuple[ColumnSpec, ...], name: str = "", split: int | None = None
) -> DataFrame:
    """Write a whole table as CSV files, then load them as a seed, in splits of ``split`` bytes."""
    store = new_store(spark)
    path = f"{store.location}/csv-{uuid.uuid4().hex}"
    rows(spark, sf_dir, f"SELECT * FROM {{{table}}}").write.options(
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    spec = TableSpec(fresh(store, name or f"seeded_{table}"), columns)
    if split is None:
        return run_seed(store, spec, path)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(split))
    try:
        return run_seed(store, spec, path)
    finally:
        spark.conf.set(setting, before)


def seed_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seeded(
        spark,
        sf_dir,
        "customer",
        (
            column("C_CUSTKEY", "bigint", primary_key=True, checks=(Check("not_null"), Check("unique"))),
            column("c_nationkey", "int"),
            column("c_acctbal", "double"),
            column("c_mktsegment", "varchar(20)"),
        ),
    )


def seed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and line breaks inside their cells."""
    return _seeded(
        spark, sf_dir, "documents", (column("doc_id", "bigint"), column("n_chars", "bigint"))
    )


def seed_documents_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with files of many splits; the table is written before the setting goes back."""
    return _seeded(
        spark,
        sf_dir,
        "documents",
        (column("doc_id", "bigint"), column("n_chars", "bigint")),
        "split_documents",
        split=64 << 10,
    )


def seed_ragged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as lines with too few cells, or one too many, in eight files."""
    store = new_store(spark)
    path = f"{store.location}/ragged-{uuid.uuid4().hex}"
    lines = rows(
        spark,
        sf_dir,
        """
        SELECT o_orderkey % 8 AS file, o_orderkey AS at, CASE o_orderkey % 3
            WHEN 0 THEN CAST(o_orderkey AS STRING)
            WHEN 1 THEN concat_ws(',', o_orderkey, o_orderstatus)
            ELSE concat_ws(',', o_orderkey, o_orderstatus, o_orderpriority, 'surplus') END AS value
        FROM {orders}
        UNION ALL SELECT id, -1, 'key,status,priority' FROM range(8)""",
    )
    sorted_lines = lines.repartition("file").sortWithinPartitions("file", "at")
    sorted_lines.select("file", "value").write.partitionBy("file").text(path)
    spec = TableSpec(fresh(store, "ragged_orders"), (column("key", "bigint"),))
    return run_seed(store, spec, [f"{path}/file={i}" for i in range(8)])


def seed_carriage_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with carriage returns inside cells, half of the lines ended by one as well, a few records over two lines."""
    store = new_store(spark)
    path = f"{store.location}/returns-{uuid.uuid4().hex}"
    lines = rows(
        spark,
        sf_dir,
        r"""
        SELECT o_orderkey % 4 AS file, o_orderkey AS at,
            concat(CAST(o_orderkey AS STRING), ',a', chr(13), o_orderstatus, ',', chr(34), o_orderpriority, chr(13), chr(13), chr(34),
                   CASE WHEN o_orderkey % 100 = 1 THEN concat(',', chr(34), 'two', chr(10), 'lines', chr(34)) ELSE ',' END,
                   CASE WHEN o_orderkey % 2 = 0 THEN chr(13) ELSE '' END) AS value
        FROM {orders}
        UNION ALL SELECT id, -1, 'key,status,priority,note' FROM range(4)""",
    )
    lines.repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    spec = TableSpec(fresh(store, "returned_orders"), (column("key", "bigint"),))
    return run_seed(store, spec, [f"{path}/file={i}" for i in range(4)])


def gate_query_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT COUNT(*) > 0 FROM {events} WHERE event_type = :kind AND ts >= :start_date"
    args = {"kind": "purchase", **MID_JANUARY.params()}
    return gate_query(spark, spark_sql(text, sf_dir), args)


def gate_table_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    name = fresh(store, "gated_events")
    run_query(store, TableSpec(name, partition_by="event_date"), spark_sql(inputs.EVENTS_T, sf_dir))
    return gate_table(spark, name, having="event_date = DATE'2024-01-15' AND user_key IS NULL")


def python_enrich_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    def enrich(session: SparkSession) -> DataFrame:
        events = rows(session, sf_dir, "SELECT * FROM {events}")
        return events.withColumn("is_conversion", F.col("event_type") == F.lit("purchase"))

    store = new_store(spark)
    return run_python(store, TableSpec(fresh(store, "enriched_events")), enrich)


def _anti_join(**options) -> TableSpec:
    return TableSpec("landing", EVENT_KEY_COLUMNS, strategy="anti_join", **options)


def _dim(strategy: str, columns=DIM_DATED_COLUMNS, **options) -> TableSpec:
    return TableSpec("customers", columns, strategy=strategy, **options)


BOUNDED = {"incremental_key": "ts", "time_granularity": "timestamp"}
HOT_COLUMNS = (
    column("group_id", "bigint", primary_key=True),
    column("event_id", "bigint"),
    column("event_type", "string"),
    column("seen", "bigint", update_on_merge=True),
)


def all_queries() -> dict[str, Query]:
    by_date = {"incremental_key": "o_orderdate"}
    in_1998 = {**by_date, "time_granularity": "timestamp"}
    by_day = {"incremental_key": "ts", "time_granularity": "date"}
    merge = orders_spec("merge")
    counts = TableSpec("daily_event_counts", COUNT_COLUMNS, strategy="merge")
    no_update = TableSpec("orders", (column("o_orderkey", primary_key=True), *[
        column(c.name) for c in ORDER_COLUMNS[1:4]
    ]), strategy="merge")
    hot = TableSpec("grouped_events", HOT_COLUMNS, strategy="merge")
    status = TableSpec("orders", strategy="delete+insert", incremental_key="o_orderstatus")
    return {
        "create_replace_daily_counts": create_replace_daily_counts,
        "create_replace_partitioned": create_replace_partitioned,
        "create_replace_clustered": create_replace_clustered,
        "append_orders": pair(orders_spec("append"), inputs.ORDERS_T, inputs.ORDERS_S),
        "truncate_insert_orders": pair(
            orders_spec("truncate+insert"), inputs.ORDERS_T, inputs.ORDERS_S
        ),
        "delete_insert_orders": pair(
            orders_spec("delete+insert", **by_date), inputs.ORDERS_T, inputs.ORDERS_LATER
        ),
        "delete_insert_orders_shuffled": pair(
            orders_spec("delete+insert", **by_date),
            inputs.ORDERS_T,
            inputs.ORDERS_LATER,
            limits=LARGE,
        ),
        "delete_insert_few_keys": pair(status, inputs.ORDERS_STATUS_T, inputs.ORDERS_STATUS_S),
        "delete_insert_few_keys_published": published(
            lambda name: TableSpec(
                name, strategy="delete+insert", incremental_key="o_orderstatus"
            ),
            "orders_by_status",
            inputs.ORDERS_STATUS_T,
            inputs.ORDERS_STATUS_S,
        ),
        "append_orders_published": published(
            lambda name: orders_spec("append", name), "appended_orders", inputs.ORDERS_T, inputs.ORDERS_S
        ),
        "truncate_insert_orders_published": published(
            lambda name: orders_spec("truncate+insert", name), "reloaded_orders", inputs.ORDERS_T, inputs.ORDERS_S
        ),
        "delete_insert_orders_published": published(
            lambda name: orders_spec("delete+insert", name, **by_date),
            "corrected_orders",
            inputs.ORDERS_T,
            inputs.ORDERS_LATER,
        ),
        "merge_orders_published": published(
            lambda name: orders_spec("merge", name), "merged_orders", inputs.ORDERS_T, inputs.ORDERS_S
        ),
        "merge_urgent_orders_published": published(
            lambda name: orders_spec("merge", name, cluster_by="o_orderkey"),
            "urgent_orders",
            inputs.ORDERS_T,
            inputs.ORDERS_URGENT,
        ),
        "delete_insert_urgent_orders_published": published(
            lambda name: orders_spec("delete+insert", name, incremental_key="o_orderkey", cluster_by="o_orderkey"),
            "replaced_urgent_orders",
            inputs.ORDERS_T,
            inputs.ORDERS_URGENT,
        ),
        "merge_orders": pair(merge, inputs.ORDERS_T, inputs.ORDERS_S),
        "merge_orders_shuffled": pair(merge, inputs.ORDERS_T, inputs.ORDERS_S, limits=LARGE),
        "merge_hot_key": pair(hot, inputs.EVENTS_HOT_T, inputs.EVENTS_HOT_S),
        "merge_hot_key_shuffled": pair(
            hot, inputs.EVENTS_HOT_T, inputs.EVENTS_HOT_S, limits=LARGE
        ),
        "merge_insert_only": pair(no_update, inputs.ORDERS_T, inputs.ORDERS_S),
        "merge_daily_counts": pair(counts, inputs.COUNTS_T, inputs.COUNTS_S),
        "merge_daily_counts_published": published(
            lambda name: TableSpec(
                name, COUNT_COLUMNS, strategy="merge", partition_by="event_date"
            ),
            "daily_event_counts",
            inputs.COUNTS_T,
            inputs.COUNTS_S,
        ),
        "time_interval_orders": pair(
            orders_spec("time_interval", **in_1998),
            inputs.ORDERS_T,
            inputs.ORDERS_1998,
            YEAR_1998,
        ),
        "time_interval_orders_published": published(
            lambda name: orders_spec("time_interval", name, **in_1998),
            "orders_in_time",
            inputs.ORDERS_T,
            inputs.ORDERS_1998,
            YEAR_1998,
        ),
        "time_interval_events_by_day": pair(
            TableSpec("events", strategy="time_interval", clip=True, **by_day),
            inputs.EVENTS_T,
            inputs.EVENTS_S,
            MID_JANUARY,
        ),
        "anti_join_events": pair(_anti_join(), inputs.EVENTS_T, inputs.EVENTS_S),
        "anti_join_events_shuffled": pair(
            _anti_join(), inputs.EVENTS_T, inputs.EVENTS_S, limits=LARGE
        ),
        "anti_join_events_bounded": pair(
            _anti_join(**BOUNDED), inputs.EVENTS_T, inputs.EVENTS_S, MID_JANUARY
        ),
        "anti_join_events_published": published(
            lambda name: TableSpec(name, EVENT_KEY_COLUMNS, strategy="anti_join"),
            "landed_events",
            inputs.EVENTS_T,
            inputs.EVENTS_S,
        ),
        "scd2_by_column": in_text(
            pair(_dim("scd2_by_column", DIM_COLUMNS), inputs.DIM_T, inputs.DIM_S)
        ),
        "scd2_by_column_keyed": in_text(
            pair(
                _dim("scd2_by_column", incremental_key="updated_at"), inputs.DIM_T, inputs.DIM_S
            )
        ),
        "scd2_by_column_null_safe": in_text(
            pair(
                _dim("scd2_by_column", DIM_COLUMNS, null_safe=True), inputs.DIM_T, inputs.DIM_S
            )
        ),
        "scd2_by_column_shuffled": in_text(
            pair(_dim("scd2_by_column", DIM_COLUMNS), inputs.DIM_T, inputs.DIM_S, limits=LARGE)
        ),
        "scd2_by_time": in_text(
            pair(_dim("scd2_by_time", incremental_key="updated_at"), inputs.DIM_T, inputs.DIM_S)
        ),
        "scd2_two_runs_published": in_text(scd2_two_runs),
        "scd2_full_refresh_column": in_text(scd2_full_refresh("scd2_by_column", None)),
        "scd2_full_refresh_time": in_text(scd2_full_refresh("scd2_by_time", "updated_at")),
        "full_refresh_merge": full_refresh_merge,
        "query_passthrough": query_passthrough,
        "view_purchases": view_purchases,
        "ddl_then_append": ddl_then_append,
        "window_params": window_params,
        "check_not_null": one_check("event_keys", "user_key", Check("not_null")),
        "check_unique": one_check("lineitem", "l_orderkey", Check("unique")),
        "check_positive": one_check("lineitem", "l_discount", Check("positive")),
        "check_non_negative": one_check("customer", "c_acctbal", Check("non_negative")),
        "check_negative": one_check("customer", "c_acctbal", Check("negative")),
        "check_min": one_check("lineitem", "l_quantity", Check("min", 5)),
        "check_max": one_check("lineitem", "l_quantity", Check("max", 45)),
        "check_accepted_values": one_check(
            "events", "event_type", Check("accepted_values", ["click", "view", "purchase"])
        ),
        "check_accepted_numbers": one_check(
            "lineitem", "l_linenumber", Check("accepted_values", [1, 2, 3, 4])
        ),
        "check_pattern": one_check("part", "p_brand", Check("pattern", r"^Brand#\d$")),
        "check_custom": check_custom,
        "check_suite": check_suite,
        "check_suite_written": check_suite_written,
        "seed_customer": seed_customer,
        "seed_documents": seed_documents,
        "seed_documents_split": seed_documents_split,
        "seed_ragged_orders": seed_ragged_orders,
        "seed_carriage_returns": seed_carriage_returns,
        "gate_query": gate_query_events,
        "gate_table": gate_table_events,
        "python_enrich_events": python_enrich_events,
        **streams.QUERIES,
        **journeys.QUERIES,
        **temporal.QUERIES,
        **totals.QUERIES,
    }
