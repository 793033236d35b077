import numpy as np
import pytest
from llm_frames import empty
from pyspark.sql import functions as F

from tablewright.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, every, k=5):
    usable = []
    for i, v in ((r[0], r[1]) for r in rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256.0 * x)) for x in v]))
    out = []
    for q, a in usable:
        if q is not None and q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i is None, i) for i, b in usable if i != q and len(a) == len(b)]
            for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
                out.append((q, rank, i, -s))
    return sorted(out, key=str)


def got(frame, every, **options):
    rows = topk.top_k(frame, F.col("id") % every == 0, **options).collect()
    return sorted(((r.query_id, r["rank"], r.id, r.score) for r in rows), key=str)


def test_ties_and_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 6)).astype(np.float32)
    vectors[100:250] = vectors[100]  # many equal scores
    rows = [(int(k), [float(x) for x in vectors[k]], "x") for k in rng.permutation(400)]
    assert got(spark.createDataFrame(rows, SCHEMA), 20) == brute(rows, 20)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], "x"), (1, [1.0, -2.5], "x"), (2, None, "x"), (3, [float("nan"), 1.0], "x"), (4, [None, 1.0], "x"), (5, [1.0], "x"),
        (6, [0.5, 0.25], "x"), (6, [0.5, 0.25], "x"), (None, [9.0, 9.0], "x"), (7, [0.0, 0.0], "x"), (8, [float("inf"), 0.0], "x"), (10, [2.0], "x"),
    ]
    assert got(spark.createDataFrame(rows, SCHEMA), 10) == brute(rows, 10)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(k, [float(2**21 + k), float(3**12 - 7 * k)], "x") for k in range(30)]
    assert got(spark.createDataFrame(rows, SCHEMA), 10) == brute(rows, 10)
    assert brute(rows, 10)[0][3] > 2**53


def test_too_large_is_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        got(spark.createDataFrame([(0, [3e38], "x"), (1, [1.0], "x")], SCHEMA), 10)


def test_empty_table(spark):
    assert got(empty(spark, SCHEMA), 10) == []


def test_pairs_of_blocks_are_scored_once(spark, monkeypatch):
    """What the rounds need is kept by then: the blocks may go."""
    staged, real = {}, topk.stage

    def stage(df, name):
        staged[name] = real(df, name)
        if name == "topk-state" and "topk-blocks" in staged:
            topk.unstage(staged.pop("topk-blocks"))
        return staged[name]

    monkeypatch.setattr(topk, "stage", stage)
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "GROUPS", 2, raising=False)
    vectors = np.random.default_rng(3).normal(size=(200, 3)).astype(np.float32)
    rows = [(k, [float(x) for x in vectors[k]], "x") for k in range(200)]
    assert got(spark.createDataFrame(rows, SCHEMA), 20) == brute(rows, 20)


@pytest.mark.parametrize("size, kind", [(3, "<i2"), (300, "<i2"), (1 << 20, "<i4"), (1 << 28, "<i8")])
def test_best_of_blocks_with_ties(size, kind):
    rng = np.random.default_rng(size)
    queries, ids = rng.integers(-size, size, (200, 4)), rng.integers(0, 100, 200)
    best = topk._Best(ids.astype("<i8").tobytes(), queries.astype(kind).tobytes(), 4, 2)
    blocks = [(np.sort(rng.integers(0, 3000, 900)), rng.integers(-size, size, (900, 4))) for _ in range(3)]
    for found, block in blocks:
        best.meet(found.astype("<i8").tobytes(), block.astype(kind).tobytes())
    found, block = (np.concatenate(x) for x in zip(*blocks, strict=True))
    for q in range(200):
        wanted = sorted((-int(s), int(i)) for s, i in zip(block @ queries[q], found, strict=True) if i != ids[q])[:2]
        assert [(-int(s), int(i)) for s, i in zip(best.scores[q], best.ids[q], strict=True)] == wanted
