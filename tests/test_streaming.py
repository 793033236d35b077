"""Streams applied to tables: repeated batches, late rows, state per key."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewright import ColumnSpec, SpecError, TableSpec, materialize, next_state
from tablewright.streaming import LateRows, apply_stream, closed_once, late_rows, version_stream, window_counts
from tablewright.streaming import apply as apply_module

SCHEMA = "k long, v string, t timestamp_ntz"
BASE = datetime(2024, 1, 1)


def at(hours):
    return BASE + timedelta(hours=hours)


@pytest.fixture
def files(spark, tmp_path):
    """A stream that has one batch for each call of ``add``, and its checkpoint folder."""

    class Files:
        checkpoint = str(tmp_path / "checkpoint")
        folder = str(tmp_path / "files")

        def add(self, rows, schema=SCHEMA):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self.folder)

        def stream(self, schema=SCHEMA):
            return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.folder)

    return Files()


def run(store, spec, stream, files, **options):
    query = apply_stream(store, spec, stream, files.checkpoint, **options)
    query.awaitTermination()
    return query


def rows_of(store, name):
    return sorted((tuple(r) for r in store.read(name).collect()), key=str)


def test_a_batch_repeated_after_a_failure_changes_nothing(store, files, monkeypatch):
    """The run fails after the commit, before Spark notes the batch as done."""
    name = f"{store.schema}.t"
    spec = TableSpec(name, strategy="append", bootstrap=True)
    for n in range(3):
        files.add([(n, "a", at(n)), (n, "b", at(n))])
    calls = []

    def fails(store_, spec_, rows, **options):
        done = materialize(store_, spec_, rows, **options)
        calls.append(options["batch"][1])
        if calls == [0, 1]:
            raise RuntimeError("lost after the commit")
        return done

    monkeypatch.setattr(apply_module, "materialize", fails)
    with pytest.raises(Exception, match="lost after the commit"):
        run(store, spec, files.stream(), files)
    assert store.read(name).count() == 4
    run(store, spec, files.stream(), files)
    assert calls == [0, 1, 2]
    assert rows_of(store, name) == sorted([(n, v, at(n)) for n in range(3) for v in "ab"], key=str)
    run(store, spec, files.stream(), files)
    assert calls == [0, 1, 2]


def test_a_batch_that_failed_before_its_commit_is_applied(store, files, monkeypatch):
    name = f"{store.schema}.t"
    spec = TableSpec(name, strategy="append", bootstrap=True)
    files.add([(1, "a", at(1))])
    files.add([(2, "a", at(1))])
    failing = [True]

    def fails(store_, spec_, rows, **options):
        if options["batch"][1] == 1 and failing:
            failing.pop()
            raise RuntimeError("lost before the commit")
        return materialize(store_, spec_, rows, **options)

    monkeypatch.setattr(apply_module, "materialize", fails)
    with pytest.raises(Exception, match="lost before the commit"):
        run(store, spec, files.stream(), files)
    assert [r[0] for r in rows_of(store, name)] == [1]
    run(store, spec, files.stream(), files)
    assert [r[0] for r in rows_of(store, name)] == [1, 2]


def test_two_streams_and_other_runs_change_one_table(store, files, tmp_path, spark):
    name = f"{store.schema}.t"
    spec = TableSpec(name, strategy="append", bootstrap=True)
    files.add([(1, "a", at(1))])
    run(store, spec, files.stream(), files)
    materialize(store, spec, spark.createDataFrame([(2, "a", at(1))], SCHEMA))
    store.compact(name)
    files.checkpoint = str(tmp_path / "other")
    run(store, spec, files.stream(), files)
    assert [r[0] for r in rows_of(store, name)] == [1, 1, 2]
    assert len(store.state(name).batches) == 2


MERGED = (
    ColumnSpec("k", "bigint", primary_key=True),
    ColumnSpec("v", "string", update_on_merge=True),
    ColumnSpec("t", "timestamp_ntz", update_on_merge=True),
)


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_newest_rows_win_in_any_order_of_batches(store, files, order):
    batches = [[(1, "a", at(1)), (1, "b", at(2)), (2, "x", None), (None, "n", at(1))], [(1, "c", at(9)), (2, "y", at(1)), (1, "b", at(2))], [(1, "d", at(5)), (3, "z", at(0)), (2, "w", None)]]
    for n in order:
        files.add(batches[n])
    name = f"{store.schema}.t"
    run(store, TableSpec(name, MERGED, strategy="merge", newer_by="t", bootstrap=True), files.stream(), files)
    assert rows_of(store, name) == sorted([(1, "c", at(9)), (2, "y", at(1)), (3, "z", at(0)), (None, "n", at(1))], key=str)


def test_newer_by_in_memory(spark):
    spec = TableSpec("t", MERGED, strategy="merge", newer_by="t")
    target = spark.createDataFrame([(1, "old", at(5)), (2, "old", None), (4, "kept", at(1))], SCHEMA)
    source = spark.createDataFrame([(1, "late", at(4)), (2, "new", at(0)), (3, "a", at(1)), (3, "b", at(1)), (4, "same", at(1))], SCHEMA)
    got = sorted((r.k, r.v) for r in next_state(spec, target, source).collect())
    assert got == [(1, "old"), (2, "new"), (3, "b"), (4, "same")]
    with pytest.raises(SpecError, match="newer_by"):
        TableSpec("t", MERGED[:1], strategy="merge", newer_by="t")
    with pytest.raises(SpecError, match="newer_by"):
        TableSpec("t", MERGED, strategy="anti_join", newer_by="t")


def test_duplicate_keys_without_newer_by_fail_the_stream(store, files):
    name = f"{store.schema}.t"
    files.add([(1, "a", at(1))])
    files.add([(1, "b", at(1)), (1, "c", at(1))])
    with pytest.raises(Exception, match="several rows"):
        run(store, TableSpec(name, MERGED, strategy="merge", bootstrap=True), files.stream(), files)
    assert rows_of(store, name) == [(1, "a", at(1))]


def test_whole_states_are_no_streams(store, files, spark):
    files.add([(1, "a", at(1))])
    for spec in (
        TableSpec("s.t", strategy="truncate+insert"), TableSpec("s.t", kind="view"), TableSpec("s.t"),
        TableSpec("s.t", MERGED, strategy="scd2_by_time", incremental_key="t"),
        TableSpec("s.t", MERGED, strategy="anti_join", incremental_key="t", time_granularity="date"),
    ):
        with pytest.raises(SpecError, match="stream"):
            apply_stream(store, spec, files.stream(), files.checkpoint)
    with pytest.raises(SpecError, match="streaming"):
        apply_stream(store, TableSpec("s.t", strategy="append"), spark.range(1), files.checkpoint)


def test_late_rows_are_counted_one_by_one(spark, store, files):
    """Rows of one group and window that come late together count each."""
    seen = LateRows()
    spark.streams.addListener(seen)
    try:
        files.add([(1, "a", at(0)), (2, "a", at(0.5)), (2, "a", at(0.5))])
        files.add([(3, "a", at(10)), (4, None, at(10)), (8, "a", None)])
        files.add([(5, "a", at(20)), (1, "a", at(0.75))])
        files.add([(6, "a", at(0.6)), (7, "a", at(0.6)), (9, "b", at(3)), (10, "a", at(12))])
        counted = window_counts(files.stream(), "t", ["v"], late_by="1 hour", once_by=["k"], width="1 hour", aggregates={"most": F.max("k")})
        name = f"{store.schema}.t"
        columns = tuple(ColumnSpec(c, t, primary_key=p, update_on_merge=not p) for c, t, p in (
            ("window_start", "timestamp", True), ("window_end", "timestamp", True), ("v", "string", True), ("n", "bigint", False), ("most", "bigint", False)))
        spec = TableSpec(name, columns, strategy="delete+insert", incremental_key="window_start", bootstrap=True)
        query = run(store, spec, counted, files, output_mode="update")
    finally:
        spark.streams.removeListener(seen)
    # of the fourth batch all behind 9 o'clock are late; of the third nothing is
    assert sum(late_rows(query).values()) == 3
    assert sum(late_rows(query, seen).values()) == 3
    got = [(r[0].hour, r[2], r[3], r[4]) for r in rows_of(store, name)]
    assert (0, "a", 2, 2) in got and (20, "a", 1, 5) in got and (12, "a", 1, 10) in got and (10, None, 1, 4) in got
    assert not any(v == "b" for _, v, *_ in got)


def test_windows_need_one_kind_and_an_identity(files):
    files.add([(1, "a", at(0))])
    for options in ({}, {"width": "1 hour", "gap": "1 hour"}, {"gap": "1 hour", "slide": "1 hour"}):
        with pytest.raises(SpecError, match="width"):
            window_counts(files.stream(), "t", ["v"], late_by="1 hour", once_by=["k"], **options)
    with pytest.raises(SpecError, match="once_by"):
        window_counts(files.stream(), "t", ["v"], late_by="1 hour", once_by=[], width="1 hour")


HISTORY = (
    ColumnSpec("_valid_from", "timestamp_ntz", primary_key=True),
    ColumnSpec("k", "bigint", primary_key=True),
    ColumnSpec("v", "string"),
    ColumnSpec("t", "timestamp_ntz"),
    ColumnSpec("_valid_until", "timestamp_ntz", update_on_merge=True),
    ColumnSpec("_is_current", "boolean", update_on_merge=True),
)


def versions(store, files, **options):
    name = f"{store.schema}.history"
    changes = version_stream(files.stream(), ["k"], "t", late_by="0 seconds", **options)
    spec = TableSpec(name, HISTORY, strategy="merge", by_name=True, bootstrap=True)
    run(store, spec, changes, files, output_mode="update", prepare=closed_once(["k"]))
    return store.read(name)


def in_text(df):
    return sorted(tuple(r) for r in df.select("k", "v", *[F.col(c).cast("string") for c in ("_valid_from", "_valid_until")], "_is_current").collect())


def test_versions_are_those_of_scd2_by_time(spark, store, files):
    """Batches with one row of each key are snapshots, too."""
    spec = TableSpec("c", (ColumnSpec("k", "bigint", primary_key=True), ColumnSpec("v", "string"), ColumnSpec("t", "timestamp_ntz")), strategy="scd2_by_time", incremental_key="t")
    batches = [[(k, f"v{n}", at(10 * n + (k if (k + n) % 3 else -10 * (n > 0)))) for k in range(6)] for n in range(4)]
    target = None
    for batch in batches:
        files.add(batch)
        snapshot = spark.createDataFrame(batch, SCHEMA)
        target = next_state(spec, target, snapshot, full_refresh=target is None, now=at(1000)).checkpoint()
    # changes further back than the watermark are dropped by the stream; here they are no newer in any case
    assert in_text(versions(store, files)) == in_text(target)


def test_silent_keys_are_closed_by_a_timer(store, files):
    hour = 3600
    files.add([(1, "a", at(0)), (2, "a", at(1)), (2, "b", at(3)), (2, "b", at(2)), (2, "z", at(3)), (None, "n", at(1)), (5, "t", None)])
    files.add([(2, "c", at(8))])
    files.add([(3, "a", at(30))])
    files.add([(1, "back", at(31))])
    got = in_text(versions(store, files, close_after_seconds=10 * hour))
    text = lambda h: str(at(h))
    assert got == sorted([
        (1, "a", text(0), text(10), False), (1, "back", text(31), "9999-12-31 00:00:00", True),
        (2, "a", text(1), text(2), False), (2, "b", text(2), text(3), False), (2, "b", text(3), text(8), False), (2, "c", text(8), text(18), False),
        (3, "a", text(30), "9999-12-31 00:00:00", True),
    ])


def test_reserved_names_are_no_changes(files):
    files.add([(1, at(0))], "k long, _valid_from timestamp_ntz")
    with pytest.raises(SpecError, match="reserved"):
        version_stream(files.stream("k long, _valid_from timestamp_ntz"), ["k"], "_valid_from", late_by="1 hour")


def test_state_is_asked_for_by_buckets(store, files, monkeypatch):
    """Many keys, few calls between processes; keys that expire together and apart, and back after a batch."""
    from tablewright.streaming import versions as module

    monkeypatch.setattr(module, "BUCKETS", 2, raising=False)
    files.add([(k, "a", at(k % 7)) for k in range(60)])
    files.add([(k, "b", at(12)) for k in range(0, 60, 3)])
    files.add([(100, "x", at(40))])
    files.add([(1, "c", at(41)), (100, "y", at(42))])
    text = lambda h: str(at(h))
    expected = [(100, "x", text(40), text(42), False), (100, "y", text(42), "9999-12-31 00:00:00", True), (1, "c", text(41), "9999-12-31 00:00:00", True)]
    for k in range(60):
        heard = k % 3 == 0 and 12 <= k % 7 + 10
        expected.append((k, "a", text(k % 7), text(12 if heard else k % 7 + 10), False))
        if k % 3 == 0:
            expected.append((k, "b", text(12), text(22), False))
    name = f"{store.schema}.history"
    changes = version_stream(files.stream(), ["k"], "t", late_by="0 seconds", close_after_seconds=36000)
    query = run(store, TableSpec(name, HISTORY, strategy="merge", by_name=True, bootstrap=True), changes, files, output_mode="update", prepare=closed_once(["k"]))
    assert in_text(store.read(name)) == sorted(expected)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < 20  # of 60 keys


def test_keys_of_other_types_have_a_state_each(spark, store, files):
    schema = "k double, v string, t timestamp_ntz"
    nan = float("nan")
    files.add([(nan, "a", at(0)), (0.0, "a", at(0)), (1.5, "a", at(0))], schema)
    files.add([(nan, "b", at(1)), (0.0, "b", at(2))], schema)
    name = f"{store.schema}.doubles"
    changes = version_stream(files.stream(schema), ["k"], "t", late_by="0 seconds")
    query = apply_stream(store, TableSpec(name, strategy="append", bootstrap=True), changes, files.checkpoint, output_mode="update")
    query.awaitTermination()
    got = sorted((str(r.k), r.v, r["_is_current"]) for r in store.read(name).collect())
    assert got == sorted([("nan", "a", True), ("nan", "a", False), ("nan", "b", True), ("0.0", "a", True), ("0.0", "a", False), ("0.0", "b", True), ("1.5", "a", True)])
