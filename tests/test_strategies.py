"""Each strategy against the row-level statements it stands for."""

import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from frames import FORMS, KEYED, collected, duck, keyed_rows, spark_frame
from tablewright import ColumnSpec, Limits, MissingTarget, RunWindow, SpecError, TableSpec
from tablewright.operators.strategies import next_state, plan_change
from tablewright.plans.change import NOTHING

COLUMNS = (
    ColumnSpec("k", "bigint", primary_key=True),
    ColumnSpec("j", "string", primary_key=True),
    ColumnSpec("v", "bigint", update_on_merge=True),
    ColumnSpec("w", "string"),
)
forms = pytest.mark.parametrize("form", FORMS)
seeds = pytest.mark.parametrize("seed", [1, 2])


def pair(seed, unique=False):
    target = keyed_rows(seed, 60)
    source = keyed_rows(seed + 100, 60, unique=unique, keys=20)
    return target, source


@forms
@seeds
def test_merge(spark, form, seed):
    target, source = pair(seed, unique=True)
    expected = duck(
        {"t": (KEYED, target), "s": (KEYED, source)},
        [
            "MERGE INTO t USING s ON t.k = s.k AND t.j = s.j WHEN MATCHED THEN UPDATE SET v = s.v "
            "WHEN NOT MATCHED THEN INSERT (k, j, v, w) VALUES (s.k, s.j, s.v, s.w)"
        ],
    )
    got = next_state(
        TableSpec("t", COLUMNS, strategy="merge"),
        spark_frame(spark, KEYED, target),
        spark_frame(spark, KEYED, source),
        limits=FORMS[form],
    )
    assert collected(got) == expected


@forms
def test_merge_without_updates_only_inserts(spark, form):
    target, source = pair(3)
    expected = duck(
        {"t": (KEYED, target), "s": (KEYED, source)},
        [
            "INSERT INTO t SELECT k, j, v, NULL FROM s "
            "WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k AND t.j = s.j)"
        ],
    )
    columns = (*COLUMNS[:2], ColumnSpec("v", "bigint"))
    change = plan_change(
        TableSpec("t", columns, strategy="merge"),
        spark_frame(spark, KEYED, target),
        spark_frame(spark, KEYED, source),
        limits=FORMS[form],
    )
    assert change.goes is NOTHING
    assert collected(change.apply(spark_frame(spark, KEYED, target))) == expected


@forms
@pytest.mark.parametrize("action", ["count", "collect"])
def test_merge_refuses_two_source_rows_for_a_matched_key(spark, form, action):
    target = [(1, "a", 1, "x"), (2, "a", 2, "x")]
    source = [(1, "a", 3, "y"), (1, "a", 4, "y")]
    got = next_state(
        TableSpec("t", COLUMNS, strategy="merge"),
        spark_frame(spark, KEYED, target),
        spark_frame(spark, KEYED, source),
        limits=FORMS[form],
    )
    with pytest.raises(PySparkException, match="several rows for one matched key"):
        getattr(got, action)()


@forms
def test_merge_inserts_repeated_new_keys(spark, form):
    source = [(9, "a", 3, "y"), (9, "a", 4, "y"), (None, "a", 1, "z"), (None, "a", 1, "z")]
    got = next_state(
        TableSpec("t", COLUMNS, strategy="merge"),
        spark_frame(spark, KEYED, [(1, "a", 1, "x")]),
        spark_frame(spark, KEYED, source),
        limits=FORMS[form],
    )
    assert collected(got) == Counter([(1, "a", 1, "x"), *source])


def test_merge_leaves_undeclared_columns_null_and_binds_by_name(spark):
    target = spark_frame(spark, "extra string, K bigint, v bigint", [("e", 1, 1)])
    source = spark_frame(spark, "v int, k int, more string", [(5, 1, "m"), (6, 2, "m")])
    spec = TableSpec(
        "t",
        (ColumnSpec("k", primary_key=True), ColumnSpec("v", update_on_merge=True)),
        strategy="merge",
    )
    got = next_state(spec, target, source)
    assert got.columns == ["extra", "K", "v"]
    assert collected(got) == Counter([("e", 1, 5), (None, 2, 6)])


def test_merge_limits_itself_to_named_partitions(spark):
    target, source = pair(5, unique=True)
    spec = TableSpec("t", COLUMNS, strategy="merge", partition_by="j")
    t, s = spark_frame(spark, KEYED, target), spark_frame(spark, KEYED, source)
    only_a = s.filter("j = 'a'")
    change = plan_change(spec, t, only_a)
    assert change.goes == "`j` IN ('a')"
    whole = next_state(TableSpec("t", COLUMNS, strategy="merge"), t, only_a)
    assert collected(change.apply(t)) == collected(whole)


def test_changes_reach_only_the_sources_key_range(spark):
    """Target rows outside the range of a source's keys are neither read nor moved."""
    target = [(i, "a", i, "x") for i in range(100)] + [(None, "a", 0, "x")]
    source = [(i, "a", -1, "y") for i in (20, 40, 55)]
    t, s = spark_frame(spark, KEYED, target), spark_frame(spark, KEYED, source)
    for form in FORMS.values():
        change = plan_change(TableSpec("t", COLUMNS, strategy="merge"), t, s, limits=form)
        assert change.goes == "`k` BETWEEN CAST(20 AS bigint) AND CAST(55 AS bigint)"
        assert change.rows.count() == 36
        expected = [(k, j, -1 if k in (20, 40, 55) else v, w) for k, j, v, w in target]
        assert collected(change.apply(t)) == Counter(expected)
    many = Limits(literal_values=0)
    spec = TableSpec("t", strategy="delete+insert", incremental_key="k")
    change = plan_change(spec, t, s, limits=many)
    assert change.goes == "`k` BETWEEN CAST(20 AS bigint) AND CAST(55 AS bigint)"
    kept = [row for row in target if row[0] not in (20, 40, 55)]
    assert collected(change.apply(t)) == Counter(kept + source)


@forms
@seeds
@pytest.mark.parametrize("key", ["k", "j"])
def test_delete_insert(spark, form, seed, key):
    target, source = pair(seed)
    source = [row for row in source if row[0] != 3 and row[1] != "b"]
    expected = duck(
        {"t": (KEYED, target), "s": (KEYED, source)},
        [f"DELETE FROM t WHERE {key} IN (SELECT DISTINCT {key} FROM s)", "INSERT INTO t SELECT * FROM s"],
    )
    change = plan_change(
        TableSpec("t", strategy="delete+insert", incremental_key=key),
        spark_frame(spark, KEYED, target),
        spark_frame(spark, KEYED, source),
        limits=FORMS[form],
    )
    assert ("IN (" in (change.goes or "")) == (form == "small")
    assert collected(change.apply(spark_frame(spark, KEYED, target))) == expected


def test_delete_insert_broadcasts_keys_beyond_the_literal_list(spark):
    target, source = pair(7)
    expected = duck(
        {"t": (KEYED, target), "s": (KEYED, source)},
        ["DELETE FROM t WHERE k IN (SELECT k FROM s)", "INSERT INTO t SELECT * FROM s"],
    )
    got = next_state(
        TableSpec("t", strategy="delete+insert", incremental_key="k"),
        spark_frame(spark, KEYED, target),
        spark_frame(spark, KEYED, source),
        limits=Limits(literal_values=2),
    )
    assert collected(got) == expected


@pytest.mark.parametrize(
    "kind, values",
    [
        ("date", [date(2024, 1, 1), date(1, 1, 1), date(9999, 12, 31)]),
        ("timestamp_ntz", [datetime(2024, 1, 1, 1, 2, 3, 456), datetime(1900, 1, 1)]),
        ("timestamp", [datetime(2024, 3, 31, 2, 30), datetime(2024, 1, 1)]),
        ("string", ["", "it's", "back\\slash", "new\nline", "tab\t", "%_", "ü"]),
        ("boolean", [True, False]),
        ("int", [-2147483648, 2147483647, 0]),
        ("decimal(20,10)", [Decimal("0.0000000001"), Decimal("-1.5"), Decimal("9999999999")]),
        ("double", [0.1, -0.0, 1e300]),
    ],
)
def test_delete_insert_key_types(spark, kind, values):
    """Literal lists name exactly the source's keys."""
    columns = f"key {kind}, n int"
    target = spark_frame(spark, columns, [(v, 1) for v in values] + [(None, 1)])
    for gone in values:
        source = spark_frame(spark, columns, [(gone, 2), (None, 2)])
        spec = TableSpec("t", strategy="delete+insert", incremental_key="key")
        left = collected(next_state(spec, target, source).filter("n = 1").select("key"))
        assert left == Counter([(v,) for v in values if v != gone] + [(None,)])


@pytest.fixture
def tokyo(spark):
    """A session zone other than the machine's."""
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zoned_timestamps_are_instants(spark, tokyo):
    stamps = ["2024-01-01 00:00:00", "2024-01-01 09:00:00", "+12000-06-01 00:00:00"]
    target = spark.createDataFrame([(s, 1) for s in stamps], "at string, n int").selectExpr(
        "CAST(at AS TIMESTAMP) AS at", "n"
    )
    source = target.selectExpr("at", "2 AS n").filter("at <> TIMESTAMP'2024-01-01 09:00:00'")
    spec = TableSpec("t", strategy="delete+insert", incremental_key="at")
    for limits in (Limits(), Limits(literal_values=0)):
        got = next_state(spec, target, source, limits=limits).selectExpr("CAST(at AS STRING)", "n")
        assert collected(got) == Counter([(stamps[0], 2), (stamps[1], 1), (stamps[2], 2)])
    window = TableSpec(
        "t", strategy="time_interval", incremental_key="at", time_granularity="timestamp"
    )
    span = RunWindow("2024-01-01 00:00:00", "2024-01-01 08:59:59")
    got = next_state(window, target, source.limit(0), window=span).selectExpr("CAST(at AS STRING)")
    assert collected(got) == Counter([(stamps[1],), (stamps[2],)])


def test_run_window_parameters_in_the_session_zone(spark, tokyo):
    from tablewright import TableStore, run_query

    query = "SELECT CAST(:start_timestamp AS STRING) AS a, TIMESTAMP_NTZ'2024-01-01 05:00:00' = :start_timestamp AS b"
    window = RunWindow("2024-01-01 05:00:00", "2024-01-02")
    got = run_query(TableStore(spark), TableSpec("q", kind="none"), query, window=window)
    assert tuple(got.first()) == ("2024-01-01 05:00:00", True)


def test_scd2_run_time_in_the_session_zone(spark, tokyo):
    spec = TableSpec("t", (ColumnSpec("k", primary_key=True),), strategy="scd2_by_column")
    got = next_state(spec, None, spark.sql("SELECT 1 AS k"), full_refresh=True, now=datetime(2024, 1, 1))
    got = next_state(spec, got, spark.sql("SELECT 2 AS k"), now=datetime(2024, 2, 1))
    texts = got.selectExpr("k", "CAST(_valid_from AS STRING)", "CAST(_valid_until AS STRING)")
    assert collected(texts) == Counter(
        [
            (1, "2024-01-01 00:00:00", "2024-02-01 00:00:00"),
            (2, "2024-02-01 00:00:00", "9999-12-31 00:00:00"),
        ]
    )


@forms
@seeds
def test_anti_join(spark, form, seed):
    target, source = pair(seed)
    expected = duck(
        {"t": (KEYED, target), "s": (KEYED, source)},
        [
            "INSERT INTO t SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE "
            "t.k IS NOT DISTINCT FROM s.k AND t.j IS NOT DISTINCT FROM s.j)"
        ],
    )
    spec = TableSpec("t", COLUMNS, strategy="anti_join")
    t, s = spark_frame(spark, KEYED, target), spark_frame(spark, KEYED, source)
    once = next_state(spec, t, s, limits=FORMS[form])
    assert collected(once) == expected
    # Running it again adds nothing, NULL keys or not.
    assert collected(next_state(spec, once, s, limits=FORMS[form])) == expected


@forms
def test_anti_join_bounded(spark, form):
    columns = "k bigint, at timestamp_ntz"
    days = [datetime(2024, 1, d) for d in range(1, 11)]
    target = [(d.day, d) for d in days] + [(None, days[4]), (50, None)]
    source = [(d.day, datetime(2024, 2, 1)) for d in days] + [(None, days[0]), (50, days[0])]
    spec = TableSpec(
        "t",
        (ColumnSpec("k", primary_key=True),),
        strategy="anti_join",
        incremental_key="at",
        time_granularity="timestamp",
    )
    got = next_state(
        spec,
        spark_frame(spark, columns, target),
        spark_frame(spark, columns, source),
        window=RunWindow("2024-01-03", "2024-01-05"),
        limits=FORMS[form],
    )
    added = [row for row in source if row[0] not in (3, 4, 5, None)]
    assert collected(got) == Counter(target + added)


def test_time_interval_is_inclusive_and_keeps_null_keys(spark):
    columns = "dt date, n int"
    days = [date(2024, 1, d) for d in range(1, 8)]
    target = [(d, 1) for d in days] + [(None, 1)]
    source = [(days[2], 2), (days[6], 2), (None, 2)]
    spec = TableSpec("t", strategy="time_interval", incremental_key="dt", time_granularity="date")
    window = RunWindow("2024-01-02", "2024-01-04")
    t, s = spark_frame(spark, columns, target), spark_frame(spark, columns, source)
    kept = [(days[0], 1), *[(d, 1) for d in days[4:]], (None, 1)]
    assert collected(next_state(spec, t, s, window=window)) == Counter(kept + source)
    clipped = TableSpec(
        "t", strategy="time_interval", incremental_key="dt", time_granularity="date", clip=True
    )
    assert collected(next_state(clipped, t, s, window=window)) == Counter(kept + source[:1])


def test_time_interval_days_of_a_timestamp_end_at_midnight(spark):
    columns = "at timestamp_ntz, n int"
    target = [(datetime(2024, 1, 2, 10), 1), (datetime(2024, 1, 3), 1)]
    spec = TableSpec("t", strategy="time_interval", incremental_key="at", time_granularity="date")
    t, s = spark_frame(spark, columns, target), spark_frame(spark, columns, [])
    left = next_state(spec, t, s, window=RunWindow("2024-01-01", "2024-01-02"))
    assert collected(left) == Counter(target[1:])
    literal = RunWindow("2024-01-01", "2024-01-02", literal_end=True)
    assert collected(next_state(spec, t, s, window=literal)) == Counter(target)


def test_append_and_truncate_insert_bind_by_position(spark):
    target = spark_frame(spark, "a bigint, b string", [(1, "x")])
    source = spark_frame(spark, "b int, a int", [(7, 8)])
    assert collected(next_state(TableSpec("t", strategy="append"), target, source)) == Counter(
        [(1, "x"), (7, "8")]
    )
    truncated = next_state(TableSpec("t", strategy="truncate+insert"), target, source)
    assert truncated.schema.simpleString() == target.schema.simpleString()
    assert collected(truncated) == Counter([(7, "8")])
    by_name = TableSpec("t", strategy="append", by_name=True)
    assert collected(next_state(by_name, target, source)) == Counter([(1, "x"), (8, "7")])


def test_append_with_repeated_source_names(spark):
    target = spark_frame(spark, "a bigint, b bigint", [(1, 2)])
    source = spark.sql("SELECT 3 AS x, 4 AS x")
    got = next_state(TableSpec("t", strategy="append"), target, source)
    assert collected(got) == Counter([(1, 2), (3, 4)])


def test_store_assignment(spark):
    target = spark_frame(spark, "a bigint", [(1,)])
    append = TableSpec("t", strategy="append")
    with pytest.raises(SpecError, match="columns"):
        next_state(append, target, spark.sql("SELECT 1, 2"))
    with pytest.raises(SpecError, match="cannot store"):
        next_state(append, target, spark.sql("SELECT 'x'"))
    with pytest.raises(PySparkException):
        next_state(append, spark.sql("SELECT 1 AS a"), spark.sql("SELECT 3000000000 AS a")).collect()


def test_full_refresh_replaces(spark):
    source = spark.sql("SELECT 1 AS other")
    spec = TableSpec("t", COLUMNS, strategy="merge")
    target = spark_frame(spark, KEYED, [(1, "a", 1, "x")])
    got = next_state(spec, target, source, full_refresh=True)
    assert got.columns == ["other"] and collected(got) == Counter([(1,)])


def test_missing_target(spark):
    source = spark_frame(spark, KEYED, [(1, "a", 1, "x")])
    with pytest.raises(MissingTarget):
        next_state(TableSpec("t", COLUMNS, strategy="merge"), None, source)
    spec = TableSpec("t", COLUMNS, strategy="merge", bootstrap=True)
    assert next_state(spec, None, source).count() == 1


def test_missing_window(spark):
    frame = spark_frame(spark, "dt date", [])
    spec = TableSpec("t", strategy="time_interval", incremental_key="dt", time_granularity="date")
    with pytest.raises(SpecError, match="window"):
        next_state(spec, frame, frame)


@forms
@pytest.mark.parametrize("strategy", ["merge", "anti_join", "delete+insert"])
@pytest.mark.parametrize("empty", ["target", "source", "both"])
def test_empty_sides(spark, form, strategy, empty):
    some = [(1, "a", 1, "x"), (None, None, None, None)]
    target = [] if empty in ("target", "both") else some
    source = [] if empty in ("source", "both") else some
    spec = TableSpec("t", COLUMNS, strategy=strategy, incremental_key="k", time_granularity="date")
    if strategy == "anti_join":
        spec = TableSpec("t", COLUMNS, strategy=strategy)
    got = next_state(
        spec, spark_frame(spark, KEYED, target), spark_frame(spark, KEYED, source), limits=FORMS[form]
    )
    assert collected(got) == Counter(target + source)


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_idempotent_for_whole_keys(spark, strategy):
    rng = random.Random(4)
    target = [row for row in keyed_rows(8, 40) if None not in row[:2]]
    source = keyed_rows(9, 40, unique=True, nulls=False)
    rng.shuffle(source)
    spec = TableSpec("t", COLUMNS, strategy=strategy, incremental_key="k")
    s = spark_frame(spark, KEYED, source)
    once = next_state(spec, spark_frame(spark, KEYED, target), s)
    assert collected(next_state(spec, once, s)) == collected(once)
