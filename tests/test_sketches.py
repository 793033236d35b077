"""Stored sketches: merged as if made at once, near the exact numbers, refreshed by group."""

import random

import pytest

from frames import spark_frame
from tablewright import Sketch, SpecError, TableSpec, estimates, materialize, merge_sketches, sketch

COLUMNS = "day bigint, kind string, user bigint, v double"
SKETCHES = (Sketch("users", "distinct", "user"), Sketch("v", "quantiles", "v"))


def facts(seed, count, days=6):
    rng = random.Random(seed)
    return [
        (rng.choice([None, *range(days)]), rng.choice([None, "a", "b"]), rng.choice([None, rng.randint(0, 4000)]), rng.choice([None, float("nan"), rng.gauss(0, 9), rng.gauss(0, 9)]))
        for _ in range(count)
    ]


def near(made, rows, of):
    """Every estimate is within its bound of the exact number."""
    assert {r[0] for r in made} == {of(r) for r in rows}
    for group, users, quantiles, seen in made:
        mine = [r for r in rows if of(r) == group]
        exact = len({r[2] for r in mine if r[2] is not None})
        assert abs(users - exact) <= 4 * SKETCHES[0].error * exact
        values = sorted(r[3] for r in mine if r[3] is not None and r[3] == r[3])
        assert seen == len(values)
        for rank, value in zip((0.0, 0.5, 0.9, 1.0), quantiles, strict=True):
            below, upto = sum(v < value for v in values), sum(v <= value for v in values)
            slack = SKETCHES[1].error * len(values) + 1
            assert below - slack <= rank * len(values) <= upto + slack


def test_merged_sketches_are_near(spark):
    rows = facts(1, 20000)
    daily = sketch(spark_frame(spark, COLUMNS, rows), ["day", "kind"], SKETCHES)
    at = (0, 0.5, 0.9, 1)
    near([tuple(r) for r in estimates(merge_sketches(daily, ["kind"], SKETCHES), ["kind"], SKETCHES, at).collect()], rows, lambda r: r[1])
    near([("all", *r) for r in estimates(merge_sketches(daily, [], SKETCHES), [], SKETCHES, at).collect()], rows, lambda r: "all")


def test_changed_groups_are_sketched_again(spark, store):
    old, new = facts(2, 6000), facts(3, 3000)
    spec = TableSpec(f"{store.schema}.daily", strategy="delete+insert", incremental_key="day", bootstrap=True)
    materialize(store, spec, sketch(spark_frame(spark, COLUMNS, old), ["day", "kind"], SKETCHES))
    later = [r for r in new if r[0] in (1, 4)]
    table = materialize(store, spec, sketch(spark_frame(spark, COLUMNS, later), ["day", "kind"], SKETCHES))
    now = [r for r in old if r[0] not in (1, 4)] + later
    made = estimates(merge_sketches(table, ["day"], SKETCHES), ["day"], SKETCHES, (0, 0.5, 0.9, 1)).collect()
    near([tuple(r) for r in made], now, lambda r: r[0])


def test_groups_that_saw_nothing(spark):
    frame = spark_frame(spark, COLUMNS, [(1, "a", None, None), (1, "b", None, float("nan"))])
    daily = sketch(frame, ["day", "kind"], SKETCHES)
    assert [tuple(r) for r in estimates(merge_sketches(daily, ["day"], SKETCHES), ["day"], SKETCHES).collect()] == [(1, 0, None, 0)]
    none = sketch(frame.limit(0), [], SKETCHES)
    assert [tuple(r) for r in estimates(none, [], SKETCHES).collect()] == [(0, None, 0)]
    assert sketch(frame.limit(0), ["day"], SKETCHES).collect() == []


def test_values_are_told_apart_by_their_text(spark):
    rows = [(1, "a", None, v) for v in (0.0, -0.0, 1.5, float("nan"))]
    of = [Sketch("values", "distinct", "v"), Sketch("kinds", "distinct", "kind"), Sketch("dates", "distinct", "DATE'2024-01-01'")]
    assert [tuple(r) for r in estimates(sketch(spark_frame(spark, COLUMNS, rows), [], of), [], of).collect()] == [(2, 1, 1)]


def test_wrong_calls(spark):
    frame = spark_frame(spark, COLUMNS, [])
    for kind, options in (("median", {}), ("distinct", {"precision": 3}), ("quantiles", {"size": 7})):
        with pytest.raises(SpecError):
            Sketch("s", kind, "v", **options)
    with pytest.raises(SpecError):
        sketch(frame, ["day"], [Sketch("day", "distinct", "v")])
    with pytest.raises(SpecError):
        sketch(frame, ["day"], [Sketch("s", "quantiles", "kind")])
    with pytest.raises(SpecError):
        estimates(sketch(frame, [], SKETCHES), [], SKETCHES, [1.5])
