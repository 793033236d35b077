"""Bad-row counts of every check, gates, and their failures."""

from collections import Counter

import pytest

from frames import collected, spark_frame
from tablewright import assets
from tablewright.operators import checks
from tablewright import (
    Check,
    CheckFailed,
    ColumnSpec,
    CustomCheck,
    NotReady,
    SpecError,
    TableSpec,
    gate_query,
    gate_table,
    materialize,
    require_passed,
    require_ready,
    run_checks,
)

NUMBERS = [(v,) for v in (None, None, -2, -1, 0, 0, 0, 1, 5, 9)]


@pytest.mark.parametrize(
    "check, bad",
    [
        (Check("not_null"), 2),
        (Check("unique"), 2),
        (Check("positive"), 5),
        (Check("non_negative"), 2),
        (Check("negative"), 6),
        (Check("min", 0), 2),
        (Check("max", 4.5), 2),
        (Check("accepted_values", [0, 1]), 4),
        (Check("accepted_values", ["0", "1", "x"]), 4),
    ],
)
def test_numbers(spark, check, bad):
    df = spark_frame(spark, "`odd name` int", NUMBERS)
    got = run_checks(df, TableSpec("t", (ColumnSpec("odd name", checks=(check,)),)))
    assert collected(got) == Counter([("odd name", check.kind, bad, bad == 0)])


@pytest.mark.parametrize(
    "pattern, bad",
    [(r"^\d+$", 3), (r"\d", 1), ("it's", 3), ("a|1", 2), ("^$", 3)],
)
def test_patterns_mean_what_was_written(spark, pattern, bad):
    df = spark_frame(spark, "c string", [("12",), ("it's 5",), ("a1",), ("",), (None,)])
    spec = TableSpec("t", (ColumnSpec("c", checks=(Check("pattern", pattern),)),))
    assert run_checks(df, spec).first()["bad_rows"] == bad


def test_values_with_quotes(spark):
    df = spark_frame(spark, "c string", [("it's",), ('"',), (None,)])
    spec = TableSpec("t", (ColumnSpec("c", checks=(Check("accepted_values", ["it's", '"']),)),))
    assert run_checks(df, spec).first()["passed"]


def test_a_suite_takes_one_pass_and_one_shuffle_per_unique_column(spark):
    df = spark_frame(spark, "a int, b string", [(1, "x"), (1, None)])
    spec = TableSpec(
        "t",
        (
            ColumnSpec("a", checks=(Check("unique"), Check("min", 0), Check("max", 9))),
            ColumnSpec("b", checks=(Check("not_null"), Check("pattern", "^x$"))),
        ),
        custom_checks=(CustomCheck("two", "SELECT 2", 2), CustomCheck("none", "SELECT 1 WHERE FALSE")),
    )
    results = run_checks(df, spec)
    assert collected(results) == Counter(
        [
            ("a", "min", 0, True),
            ("a", "max", 0, True),
            ("b", "not_null", 1, False),
            ("b", "pattern", 0, True),
            ("a", "unique", 1, False),
            ("", "two", 2, True),
            ("", "none", None, False),
        ]
    )
    with pytest.raises(CheckFailed, match="b not_null: 1 rows; a unique: 1 rows"):
        require_passed(results)
    plain = TableSpec("t", spec.columns[1:])
    text = run_checks(df, plain)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_empty_frames_pass(spark):
    df = spark_frame(spark, "a int", [])
    spec = TableSpec("t", (ColumnSpec("a", checks=(Check("not_null"), Check("unique"))),))
    assert run_checks(df, spec).filter("passed").count() == 2
    require_passed(run_checks(df, spec))
    with pytest.raises(SpecError, match="no checks"):
        run_checks(df, TableSpec("t"))


def test_checks_run_after_publishing(spark, store):
    name = f"{store.schema}.t"
    spec = TableSpec(name, (ColumnSpec("a", checks=(Check("positive"),)),))
    with pytest.raises(CheckFailed, match="a positive: 1 rows"):
        materialize(store, spec, spark.sql("SELECT 0 AS a"))
    assert store.read(name).count() == 1
    materialize(store, spec, spark.sql("SELECT -1 AS a"), check=False)


@pytest.mark.parametrize(
    "query, ready",
    [
        ("SELECT TRUE", True),
        ("SELECT COUNT(*) > 0 FROM range(3) WHERE id > 5", False),
        ("SELECT 3", True),
        ("SELECT 0", False),
        ("SELECT -1.5", False),
        ("SELECT NULL", False),
        ("SELECT 'true'", True),
        ("SELECT '2'", True),
        ("SELECT 'no idea'", False),
        ("SELECT 1 WHERE FALSE", False),
    ],
)
def test_query_gates(spark, query, ready):
    gate = gate_query(spark, query)
    assert collected(gate) == Counter([(ready,)])
    if ready:
        require_ready(gate)
    else:
        with pytest.raises(NotReady):
            require_ready(gate, "")
    require_ready(gate, "skip")


def test_gate_arguments(spark):
    assert gate_query(spark, "SELECT :n > 1", {"n": 2}).first()["ready"]
    with pytest.raises(SpecError, match="mode"):
        require_ready(gate_query(spark, "SELECT 1"), "wait")


def test_table_gates(spark, store):
    name = f"{store.schema}.t"
    assert not gate_table(spark, name).first()["ready"]
    assert not gate_table(spark, "no_such_schema.t").first()["ready"]
    materialize(store, TableSpec(name), spark.range(5).toDF("id"))
    assert gate_table(spark, name).first()["ready"]
    assert gate_table(spark, name, "id = 4").first()["ready"]
    assert not gate_table(spark, name, "id > 4").first()["ready"]
    for wrong in ("a.b.c", "a..b", ""):
        with pytest.raises(SpecError):
            gate_table(spark, wrong)
    # A name is not a pattern.
    assert not gate_table(spark, f"{store.schema}.t*").first()["ready"]


def test_custom_checks_are_exact(spark):
    from tablewright.operators.checks import custom_check

    df = spark.range(1)
    half = custom_check(df, "half", "SELECT 0.5 AS n").first()
    assert (half["bad_rows"], half["passed"]) == (1, False)
    assert custom_check(df, "yes", "SELECT TRUE AS n", 1).first()["passed"]
    assert not custom_check(df, "none", "SELECT 0 AS n WHERE FALSE").first()["passed"]
    with pytest.raises(Exception, match="more than one row"):
        custom_check(df, "two", "SELECT * FROM VALUES (0), (7)").collect()


WATCHED = (
    ColumnSpec("k", "bigint", checks=(Check("unique"), Check("not_null"), Check("max", 90))),
    ColumnSpec("p", "string", checks=(Check("not_null"),)),
    ColumnSpec("v", "string", checks=(Check("accepted_values", ["a", "b"]), Check("pattern", "^[ab]"))),
)


def watched_rows(spark):
    return spark.range(200).selectExpr(
        "IF(id % 50 = 0, NULL, id % 100) AS k", "IF(id % 40 = 0, '', 'x') AS p", "IF(id % 20 = 0, 'c', 'a') AS v"
    )


@pytest.mark.parametrize("layout", [{}, {"partition_by": "p"}, {"cluster_by": "k"}, {"cluster_by": ("k", "v")}])
@pytest.mark.parametrize("strategy", ["create+replace", "truncate+insert"])
def test_checks_counted_by_the_write_equal_those_of_a_scan(spark, store, monkeypatch, layout, strategy):
    spec = TableSpec(f"{store.schema}.t", WATCHED, strategy=strategy, bootstrap=True, custom_checks=(), **layout)
    seen = []
    monkeypatch.setattr(assets, "require_passed", lambda results: seen.append(results))
    for rows in (watched_rows(spark), watched_rows(spark).limit(0), watched_rows(spark)):
        table = assets.materialize(store, spec, rows)
        scanned = checks.run_checks(table, spec)
        assert sorted(seen[-1].collect()) == sorted(scanned.collect())
        # The table is scanned for `unique` and for what its partition columns may hold otherwise.
        assert scans(seen[-1]) == (2 if "partition_by" in layout else 1) and scans(scanned) == 2


def test_a_failed_watched_check_names_its_rows(spark, store):
    spec = TableSpec(f"{store.schema}.t", WATCHED[2:])
    with pytest.raises(checks.CheckFailed, match="v accepted_values: 10 rows; v pattern: 10 rows"):
        assets.materialize(store, spec, watched_rows(spark))


def test_a_partial_change_is_checked_over_the_whole_table(spark, store):
    spec = TableSpec(f"{store.schema}.t", WATCHED[2:], strategy="append", bootstrap=True)
    assets.materialize(store, spec, watched_rows(spark), check=False)
    with pytest.raises(checks.CheckFailed, match="v accepted_values: 10 rows"):
        assets.materialize(store, spec, watched_rows(spark).filter("v = 'a'"))


def scans(df):
    return df._jdf.queryExecution().analyzed().toString().count("Relation ")
