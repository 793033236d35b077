"""Versioned history against one MERGE as row-level engines run it."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from frames import FORMS, collected, duck, spark_frame
from tablewright import ColumnSpec, SpecError, TableSpec
from tablewright.operators.strategies import next_state, plan_change

T_COLUMNS = (
    "k bigint, seg string, upd timestamp_ntz, _valid_from timestamp_ntz, "
    "_valid_until timestamp_ntz, _is_current boolean"
)
S_COLUMNS = "k bigint, seg string, upd timestamp_ntz"
COLUMNS = (
    ColumnSpec("k", "bigint", primary_key=True),
    ColumnSpec("seg", "string"),
    ColumnSpec("upd", "timestamp_ntz"),
)
NOW = datetime(2024, 6, 1, 12)
END = datetime(9999, 12, 31)


def day(n):
    return datetime(2024, 1, n)


def make(seed, count=60):
    """Open, closed and only-closed keys; vanished, new and returning ones; NULLs."""
    rng = random.Random(seed)
    target, source = [], []
    for k in range(count):
        seg = rng.choice([None, "a", "b"])
        if rng.random() < 0.4:
            target.append((k, "old", day(1), datetime(2023, 1, 1), day(1), False))
        if rng.random() < 0.7:
            start = day(rng.randrange(2, 20))
            target.append((k, seg, start, start, END, True))
        if rng.random() < 0.7:
            source.append((k, rng.choice([seg, None, "c"]), rng.choice([None, day(rng.randrange(1, 28))])))
    target += [(None, "n", day(2), day(2), END, True)] * 3 + [(7, "odd", day(1), day(1), END, None)]
    source += [(None, "n", day(5))] * 2 + [(900, "twice", day(3)), (900, "again", day(4))]
    return target, source


def merge_sql(changed, started, ended):
    """The MERGE with a second copy of each source row that opens a version."""
    return f"""
        MERGE INTO t USING (
            SELECT s.*, TRUE AS live FROM s UNION ALL
            SELECT s.*, FALSE FROM s JOIN t ON t.k = s.k WHERE t._is_current AND ({changed})
        ) AS s ON t.k = s.k AND t._is_current AND s.live
        WHEN MATCHED AND ({changed}) THEN UPDATE SET _valid_until = {ended}, _is_current = FALSE
        WHEN NOT MATCHED THEN INSERT (k, seg, upd, _valid_from, _valid_until, _is_current)
            VALUES (s.k, s.seg, s.upd, {started}, TIMESTAMP '9999-12-31', TRUE)
        WHEN NOT MATCHED BY SOURCE AND t._is_current THEN
            UPDATE SET _valid_until = TIMESTAMP '2024-06-01 12:00:00', _is_current = FALSE"""


CASES = {
    "by_column": (
        {"strategy": "scd2_by_column"},
        merge_sql(
            "t.seg != s.seg OR t.upd != s.upd",
            "TIMESTAMP '2024-06-01 12:00:00'",
            "TIMESTAMP '2024-06-01 12:00:00'",
        ),
    ),
    "by_column_keyed": (
        {"strategy": "scd2_by_column", "incremental_key": "upd"},
        merge_sql("t.seg != s.seg OR t.upd != s.upd", "s.upd", "s.upd"),
    ),
    "by_column_null_safe": (
        {"strategy": "scd2_by_column", "incremental_key": "upd", "null_safe": True},
        merge_sql(
            "t.seg IS DISTINCT FROM s.seg OR t.upd IS DISTINCT FROM s.upd", "s.upd", "s.upd"
        ),
    ),
    "by_time": (
        {"strategy": "scd2_by_time", "incremental_key": "upd"},
        merge_sql("t._valid_from < s.upd", "s.upd", "s.upd"),
    ),
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("case", CASES)
def test_against_merge(spark, case, form):
    options, statement = CASES[case]
    target, source = make(len(case))
    expected = duck({"t": (T_COLUMNS, target), "s": (S_COLUMNS, source)}, [statement])
    got = next_state(
        TableSpec("t", COLUMNS, **options),
        spark_frame(spark, T_COLUMNS, target),
        spark_frame(spark, S_COLUMNS, source),
        now=NOW,
        limits=FORMS[form],
    )
    assert collected(got) == expected


def test_keys_are_not_compared_and_keys_alone_never_change(spark):
    spec = TableSpec("t", COLUMNS[:1], strategy="scd2_by_column")
    target = [(1, "a", day(1), day(1), END, True)]
    got = next_state(
        spec, spark_frame(spark, T_COLUMNS, target), spark_frame(spark, S_COLUMNS, [(1, "b", day(9))]), now=NOW
    )
    assert collected(got) == Counter(target)


def test_rerun_adds_no_version(spark):
    target, source = make(4)
    source = [row for row in source if row[0] not in (None, 900)]
    spec = TableSpec("t", COLUMNS, strategy="scd2_by_column", incremental_key="upd", null_safe=True)
    s = spark_frame(spark, S_COLUMNS, source)
    once = next_state(spec, spark_frame(spark, T_COLUMNS, target), s, now=NOW)
    again = next_state(spec, once, s, now=NOW)
    assert collected(again) == collected(once)
    most = once.filter("_is_current AND k IS NOT NULL").groupBy("k").count().agg({"count": "max"})
    assert most.first()[0] == 1


@pytest.mark.parametrize("form", FORMS)
def test_repeated_source_key_of_an_open_version_fails(spark, form):
    target = [(1, "a", day(1), day(1), END, True)]
    got = next_state(
        TableSpec("t", COLUMNS, strategy="scd2_by_column"),
        spark_frame(spark, T_COLUMNS, target),
        spark_frame(spark, S_COLUMNS, [(1, "a", day(1)), (1, "b", day(1))]),
        now=NOW,
        limits=FORMS[form],
    )
    with pytest.raises(PySparkException, match="several rows for one matched key"):
        got.count()


def test_start_column_outside_the_declared_ones(spark):
    """The start of a version may be a query column that the table does not store."""
    columns = "k bigint, seg string, _valid_from timestamp_ntz, _valid_until timestamp_ntz, _is_current boolean"
    target = spark_frame(spark, columns, [(1, "a", day(1), END, True)])
    source = spark_frame(spark, S_COLUMNS, [(1, "b", day(9))])
    spec = TableSpec("t", COLUMNS[:2], strategy="scd2_by_column", incremental_key="upd")
    assert collected(next_state(spec, target, source, now=NOW)) == Counter(
        [(1, "a", day(1), day(9), False), (1, "b", day(9), END, True)]
    )


@pytest.mark.parametrize("strategy", ["scd2_by_column", "scd2_by_time"])
def test_full_refresh_keeps_bookkeeping_columns(spark, strategy):
    source = spark_frame(spark, S_COLUMNS, [(1, "a", day(3)), (None, None, None)])
    spec = TableSpec("t", COLUMNS, strategy=strategy, incremental_key="upd")
    got = next_state(spec, None, source, full_refresh=True)
    assert got.columns == ["_valid_from", "k", "seg", "upd", "_valid_until", "_is_current"]
    assert collected(got) == Counter(
        [(day(3), 1, "a", day(3), END, True), (None, None, None, None, END, True)]
    )
    # The rebuilt table takes the next run, whatever its column order.
    after = next_state(spec, got, spark_frame(spark, S_COLUMNS, [(1, "b", day(8))]), now=NOW)
    assert after.columns == got.columns
    assert collected(after.filter("k = 1")) == Counter(
        [(day(3), 1, "a", day(3), day(8), False), (day(8), 1, "b", day(8), END, True)]
    )


def test_full_refresh_by_column_starts_now(spark):
    spec = TableSpec("t", COLUMNS, strategy="scd2_by_column")
    source = spark_frame(spark, S_COLUMNS, [(1, "a", day(3))])
    row = next_state(spec, None, source, full_refresh=True, now=NOW).first()
    assert (row["_valid_from"], row["_valid_until"]) == (NOW, END)
    with pytest.raises(SpecError, match="now"):
        next_state(spec, None, source, full_refresh=True)


def test_closed_versions_stay_where_they_are(spark):
    target, source = make(6)
    change = plan_change(
        TableSpec("t", COLUMNS, strategy="scd2_by_column"),
        spark_frame(spark, T_COLUMNS, target),
        spark_frame(spark, S_COLUMNS, source),
        now=NOW,
    )
    assert change.goes == "`_is_current`"
    assert not collected(change.rows.filter("seg = 'old' AND NOT _is_current"))
