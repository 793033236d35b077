"""The plans are the ones wanted at scale: pushed filters, few shuffles, no nested loops."""

import pytest

from conftest import SMALL
from registry import inputs
from registry.spark_queries import BOUNDED, COUNT_COLUMNS, DIM_COLUMNS, EVENT_KEY_COLUMNS, NOW, ORDER_COLUMNS
from tablewright import Limits, RunWindow, TableSpec, next_state
from tablewright.plans.match import match_rows
from tablewright.plans.sizing import hot_hashes, measure

LARGE = Limits(broadcast_rows=0, hot_share=0.99)
WINDOW = RunWindow("1998-01-01", "1998-12-31")


def plan(df):
    df._jdf.queryExecution().assertAnalyzed()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    return text


def rows(spark, template):
    return inputs.rows(spark, SMALL, template)


def test_merge_of_large_sides_shuffles_each_once(spark):
    spec = TableSpec("t", ORDER_COLUMNS, strategy="merge")
    got = next_state(spec, rows(spark, inputs.ORDERS_T), rows(spark, inputs.ORDERS_S), limits=LARGE)
    text = plan(got)
    assert text.count("Exchange hashpartitioning") == 2
    assert "FullOuter" in text and "Python" not in text


def test_merge_of_a_small_source_does_not_shuffle_the_target(spark):
    spec = TableSpec("t", ORDER_COLUMNS, strategy="merge")
    got = next_state(spec, rows(spark, inputs.ORDERS_T), rows(spark, inputs.ORDERS_S))
    text = plan(got)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3
    # Full rows of the target are read once, by a scan that no shuffle follows.
    left = text.split("LeftAnti")[0]
    assert "LeftOuter, BuildRight" in left


@pytest.mark.parametrize("strategy", ["scd2_by_column", "scd2_by_time"])
def test_versioned_history_shuffles_each_side_once(spark, strategy):
    key = "updated_at" if strategy == "scd2_by_time" else None
    spec = TableSpec("t", DIM_COLUMNS, strategy=strategy, incremental_key=key)
    got = next_state(spec, rows(spark, inputs.DIM_T), rows(spark, inputs.DIM_S), now=NOW, limits=LARGE)
    text = plan(got)
    assert text.count("Exchange") == 2


def test_anti_join_reads_only_the_targets_keys_in_the_window(spark):
    spec = TableSpec("t", EVENT_KEY_COLUMNS, strategy="anti_join", **BOUNDED)
    window = RunWindow("2024-01-10", "2024-01-20")
    target = spark.read.parquet(f"{SMALL}/events.parquet").selectExpr(
        "user_id AS user_key", "event_type", "CAST(ts AS DATE) AS event_date", "event_id", "ts", "value"
    )
    for limits in (Limits(), LARGE):
        got = next_state(spec, target, rows(spark, inputs.EVENTS_S), window=window, limits=limits)
        text = plan(got)
        scans = [line for line in text.splitlines() if "GreaterThanOrEqual(ts" in line]
        assert len(scans) == 1
        assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in scans[0]


def test_time_interval_is_a_filter_on_the_scan(spark):
    spec = TableSpec(
        "t", strategy="time_interval", incremental_key="o_orderdate", time_granularity="timestamp"
    )
    got = next_state(spec, rows(spark, inputs.ORDERS_T), rows(spark, inputs.ORDERS_1998), window=WINDOW)
    text = plan(got)
    assert "Exchange" not in text
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-01-01" in text


def test_delete_of_few_keys_is_a_filter_on_the_scan(spark):
    spec = TableSpec("t", strategy="delete+insert", incremental_key="o_orderstatus")
    target = spark.read.parquet(f"{SMALL}/orders.parquet")
    got = next_state(spec, target, target.filter("o_orderstatus IN ('F', 'P')"))
    text = plan(got)
    assert "Exchange" not in text and "Join" not in text


def test_delete_of_measured_keys_does_not_shuffle_the_target(spark):
    spec = TableSpec("t", strategy="delete+insert", incremental_key="o_orderdate")
    got = next_state(
        spec,
        rows(spark, inputs.ORDERS_T),
        rows(spark, inputs.ORDERS_LATER),
        limits=Limits(literal_values=10),
    )
    text = plan(got)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_frequent_keys_leave_the_shuffle(spark):
    target = spark.range(3000).selectExpr("if(id < 1000, 7, id) AS k", "id AS v")
    source = spark.range(3000).selectExpr("id AS k", "id AS v")
    limits = Limits(broadcast_rows=0, hot_share=0.1)
    assert len(hot_hashes([target.select("k"), source.select("k")], ["k"], limits)) == 1
    text = plan(match_rows(target, source, ["k"], limits))
    assert "FullOuter" in text and text.count("BroadcastHashJoin") == 2
    assert "isin" not in text.lower() and "xxhash64" in text
    even = spark.range(3000).selectExpr("id AS k", "id AS v")
    assert not hot_hashes([even.select("k"), source.select("k")], ["k"], limits)
    assert "BroadcastHashJoin" not in plan(match_rows(even, source, ["k"], limits))


def test_broadcast_needs_a_measured_size(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) AS s", "array(id) AS a")
    size = measure(df, "id")
    assert (size.rows, size.low, size.high) == (1000, 0, 999)
    assert size.bytes > 124 * 1000
    assert size.fits_broadcast(Limits())
    assert not size.fits_broadcast(Limits(broadcast_rows=999))
    assert not size.fits_broadcast(Limits(broadcast_bytes=100_000))
    assert not measure(df.limit(0)).fits_broadcast(Limits(broadcast_rows=0))


def test_rows_with_null_keys_are_spread(spark):
    """A third of all rows without a key does not end in one task."""
    source = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id) AS k", "'copy' AS w")
    target = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id) AS k", "'copy' AS w")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = match_rows(target, source, ["k"], Limits(broadcast_rows=0, hot_share=0.1))
        sizes = got.groupBy(got["t0"].isNull(), got["s0"].isNull()).count().collect()
        assert sorted(r[2] for r in sizes) == [20000, 20000]
        lone = got.filter("t0 IS NULL AND s0 IS NULL").selectExpr("spark_partition_id() AS p")
        per_task = [r[1] for r in lone.groupBy("p").count().collect()]
        assert sum(per_task) == 20000 and max(per_task) < 10000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_counts_combine_before_the_shuffle(spark):
    got = next_state(TableSpec("t", COUNT_COLUMNS), None, rows(spark, inputs.COUNTS_S))
    assert plan(got).count("partial_count(1)") == 1


def test_values_that_do_not_fit_raise_whatever_the_session_says(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T

    from tablewright.plans.bind import bind

    target = T.StructType([T.StructField("n", T.ByteType())])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [r.n for r in bind(spark.sql("SELECT * FROM VALUES (1), (NULL)"), target).collect()] == [1, None]
        with pytest.raises(PySparkException, match="does not fit"):
            bind(spark.sql("SELECT 300"), target).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_anti_join_prunes_its_target(spark, tmp_path):
    from tablewright import ColumnSpec, TableSpec
    from tablewright.operators.strategies import plan_change

    path = str(tmp_path / "t")
    days = "SELECT date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS d, id AS k FROM range(300)"
    spark.sql(days).write.partitionBy("d").parquet(path)
    target = spark.read.parquet(path).select("d", "k")
    source = spark.sql("SELECT DATE'2024-01-15' AS d, id AS k FROM range(500)")
    columns = (ColumnSpec("d", "date", primary_key=True), ColumnSpec("k", "bigint", primary_key=True))
    for strategy in ("anti_join", "merge"):
        spec = TableSpec("t", columns, strategy=strategy, partition_by="d")
        new = plan_change(spec, target, source).rows
        text = new._jdf.queryExecution().executedPlan().toString()
        assert "2024-01-15" in text[text.index("PartitionFilters") :].split("]")[0]
        assert new.count() == 490


def test_wide_rows_of_frequent_keys_are_not_broadcast_unmeasured(spark):
    target = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS v")
    source = spark.range(500).selectExpr("IF(id = 0, 7, id + 2900) AS k", "repeat('x', 5000) AS wide")
    got = {}
    for most in (64 << 20, 1):
        matched = match_rows(target, source, ["k"], Limits(broadcast_rows=0, hot_share=0.1, broadcast_bytes=most))
        names = [c for c in matched.columns]
        got[most] = sorted(map(str, matched.select(*names).collect()))
    assert got[1] == got[64 << 20] and len(got[1]) > 3000
