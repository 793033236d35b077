"""Funnels by the table function, against a plain loop over each key's events."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import spark_frame
from tablewright import SpecError, funnels

STEPS = ("kind = 'view'", "kind = 'click'", "kind = 'buy'")
KINDS = ("view", "click", "buy", "other")


def brute(rows, within):
    by = {}
    for user, at, kind in rows:
        if user is not None and at is not None and kind in KINDS[:3]:
            by.setdefault(user, []).append((at, KINDS.index(kind)))
    found = []
    for user, events in by.items():
        funnel = None
        for at, step in sorted(events):
            if step == 0:
                funnel = [user, at, 1, at]
                found.append(funnel)
            elif funnel and step == funnel[2] and at - funnel[1] <= within:
                funnel[2:] = [step + 1, at]
    return Counter(map(tuple, found))


def events(seed, count, time, hot=0.4):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < hot else rng.choice([None, "a", "b", "c", "é"]), rng.choice([None, *[time(rng) for _ in range(9)]]), rng.choice([*KINDS, None]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("width", [None, 7, 1000])
@pytest.mark.parametrize("within", [0, 7])
def test_whole_numbers(spark, within, width):
    rows = events(1, 3000, lambda rng: rng.randint(-300, 300))
    made = funnels(spark_frame(spark, "user string, at long, kind string", rows), ["user"], "at", STEPS, within, width=width)
    assert made.columns == ["user", "began", "reached", "ended"]
    assert Counter(map(tuple, made.collect())) == brute(rows, within)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_times_keep_their_type(spark, kind):
    if kind == "date":
        rows = events(2, 500, lambda rng: date(1969, 12, 20) + timedelta(days=rng.randint(0, 40)))
    else:
        rows = events(2, 500, lambda rng: datetime(1969, 12, 30) + timedelta(seconds=rng.randint(0, 400000), microseconds=rng.randint(0, 3)))
    frame = spark_frame(spark, f"user string, at {kind}, kind string", rows)
    made = funnels(frame, ["user"], "at", STEPS, timedelta(days=1))
    assert dict(made.dtypes)["began"] == dict(made.dtypes)["ended"] == kind
    assert Counter(map(tuple, made.collect())) == brute(rows, timedelta(days=1))


def test_a_hot_key_is_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [("hot", k, KINDS[k % 3]) for k in range(20000)]
    frame = spark_frame(spark, "user string, at long, kind string", rows)
    try:
        made = funnels(frame, ["user"], "at", STEPS, 10, width=100)
        tasks = [r[1] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(tasks) == len(range(0, 20000, 3))
    assert len(tasks) > 4 and max(tasks) < 0.4 * sum(tasks)


def test_several_keys_and_clashing_names(spark):
    rows = [(1, "x", 1, "view", 0), (1, "x", 2, "click", 0), (1, "y", 3, "buy", 0), (1, None, 4, "view", 0)]
    frame = spark_frame(spark, "key long, bin string, at long, kind string, own int", rows)
    made = funnels(frame, ["key", "bin"], "at", STEPS, 5)
    assert [tuple(r) for r in made.collect()] == [(1, "x", 1, 2, 2)]


def test_no_events(spark):
    assert funnels(spark_frame(spark, "user string, at long, kind string", []), ["user"], "at", STEPS, 5).collect() == []


@pytest.mark.parametrize(
    "changes",
    [{"on": []}, {"on": ["began"]}, {"steps": ["true"]}, {"within": timedelta(1)}, {"within": -1}, {"width": 3}, {"time": "kind"}],
)
def test_wrong_calls(spark, changes):
    frame = spark_frame(spark, "user string, at long, kind string, began string", [])
    call = {"on": ["user"], "time": "at", "steps": STEPS, "within": 5} | changes
    with pytest.raises(SpecError):
        funnels(frame, **call)
