"""Grouping sets, cubes and rollups, made whole and refreshed, against DuckDB and each other."""

import random
from collections import Counter

import pytest

from frames import collected, duck, spark_frame
from tablewright import Limits, Measure, SpecError, TableSpec, cube, grouping_sets, rollup, run_rollup
from tablewright.operators.rollup import refresh

COLUMNS = "a string, b bigint, c string, v bigint"
BY = ("a", "b", "c")
MEASURES = (Measure("n", "count"), Measure("total", "sum", "v"), Measure("low", "min", "v"), Measure("high", "max", "v"), Measure("known", "count", "v"))
SQL = "SELECT a, b, c, GROUPING(a, b, c) AS g, COUNT(*), CAST(SUM(v) AS BIGINT), MIN(v), MAX(v), COUNT(v) FROM t GROUP BY {}"


def facts(seed, count=300):
    rng = random.Random(seed)
    return [
        (rng.choice([None, "x", "y", "é'\\\""]), rng.choice([None, 1, 2, 3]), rng.choice([None, "p", ""]), rng.choice([None, *range(-5, 20)]))
        for _ in range(count)
    ]


def plain(df):
    return Counter(tuple(r) for r in df.drop("node").collect())


@pytest.mark.parametrize("count", [1, 300])
def test_sets_equal_sql(spark, count):
    rows = facts(1, count)
    frame = spark_frame(spark, COLUMNS, rows)
    for made, sets in (
        (rollup(frame, BY, MEASURES), "ROLLUP (a, b, c)"),
        (cube(frame, BY, MEASURES), "CUBE (a, b, c)"),
        (grouping_sets(frame, BY, MEASURES, [("c",), ("a", "b")]), "GROUPING SETS ((c), (a, b))"),
    ):
        assert plain(made) == duck({"t": (COLUMNS, rows)}, [], SQL.format(sets))
        assert made.count() == made.select("node").distinct().count()


def test_no_facts_no_rows(spark):
    assert rollup(spark_frame(spark, COLUMNS, []), BY, MEASURES).count() == 0


def test_names_and_functions_are_checked(spark):
    with pytest.raises(SpecError):
        Measure("m", "avg", "v")
    with pytest.raises(SpecError):
        rollup(spark_frame(spark, COLUMNS, []), ("a", "b"), (Measure("A", "count"),))
    with pytest.raises(SpecError):
        rollup(spark_frame(spark, COLUMNS, []), (), MEASURES)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, literal_values=0, hot_share=0.99)])
@pytest.mark.parametrize("seed", [2, 3])
def test_refresh_equals_a_new_rollup(spark, limits, seed):
    rng = random.Random(seed)
    old = facts(seed)
    leaves = sorted({r[:3] for r in old}, key=str)
    touched = set(rng.sample(leaves, 4)) | {("new", 9, "z")}
    new = [r for r in old if r[:3] not in touched] + [("new", 9, "z", 4)]
    for leaf in sorted(touched, key=str)[:3]:
        new += [(*leaf, rng.randrange(50)) for _ in range(3)]  # the other leaves are gone
    target = rollup(spark_frame(spark, COLUMNS, old), BY, MEASURES)
    now = spark_frame(spark, COLUMNS, new)
    changed = spark_frame(spark, "a string, b bigint, c string", [*touched, *touched])
    got = refresh(target, now, changed, BY, MEASURES, limits).apply(target)
    assert collected(got) == collected(rollup(now, BY, MEASURES))


def test_everything_gone(spark):
    old = spark_frame(spark, COLUMNS, facts(4, 40))
    target = rollup(old, BY, MEASURES)
    got = refresh(target, old.limit(0), old.select(*BY), BY, MEASURES).apply(target)
    assert got.count() == 0
    assert collected(refresh(target, old, old.select(*BY).limit(0), BY, MEASURES).apply(target)) == collected(target)


def test_a_stored_rollup_writes_the_touched_groups_only(spark, store):
    spec = TableSpec(f"{store.schema}.totals")
    frame = spark.range(20_000).selectExpr("id % 10 AS a", "id % 1000 AS b", "id AS v")
    measures = (Measure("n", "count"), Measure("total", "sum", "v"))
    made = run_rollup(store, spec, frame, ("a", "b"), measures)
    assert made.count() == 1011
    more = frame.union(spark.sql("SELECT 3L, 13L, 5L"))
    got = run_rollup(store, spec, more, ("a", "b"), measures, changed=spark.sql("SELECT 3 AS a, 13 AS b"))
    assert collected(got) == collected(rollup(more, ("a", "b"), measures))
    assert [p.left for p in store.state(spec.name).parts] == [1008, 3]  # a leaf, its group, all
