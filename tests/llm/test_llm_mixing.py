import duckdb
import pytest
from compare import spark_rows
from llm_frames import DOC, ROWS, crowded, documents, empty

from tablewright.llm import mixing


def targets(sizes):
    """Targets by source, by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free, left = total - sum(fixed.values()), sum(w for s, w in weight.items() if s not in fixed)
        above = [s for s in names if s not in fixed and free * weight[s] > 3 * sizes[s] * left]
        if not above:
            return {s: fixed.get(s, free * weight[s] / max(left, 1)) for s in names}
        fixed |= {s: 3 * sizes[s] for s in above}


def check(rows, got):
    import re

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r[0] or -1, size(r[1])) for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.copies <= 3 and abs(r.copies - r.rate) < 1 + 1e-9
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_odd_rows(spark):
    docs = crowded(documents(spark)).drop("size", "rate", "copies")
    check(ROWS, mixing.plan(docs).collect())


def test_small_sources_stop_at_three_times(spark):
    rows = [(k, "a b c", "", "aa", 0) for k in range(2)] + [(10 + k, "w " * 50, "", s, 0) for k, s in enumerate("bcdefg")]
    got = mixing.plan(documents(spark, rows)).collect()
    check(rows, got)
    assert {r.copies for r in got if r.source == "aa"} == {3}


def test_rows_are_taken_as_planned(spark):
    docs = crowded(documents(spark))
    planned = mixing.plan(documents(spark)).collect()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in planned)


def test_many_documents_come_near_their_targets(spark):
    rows = [(k, "word " * (1 + k % 40), "", f"s{k % 7}", 0) for k in range(6000)]
    got = mixing.plan(documents(spark, rows)).collect()
    check(rows, got)
    for source in {r.source for r in got}:
        mine = [r for r in got if r.source == source]
        assert sum(r.size * r.copies for r in mine) == pytest.approx(mine[0].target, rel=0.1)


def test_sql_agrees_on_odd_rows(spark):
    import pyarrow as pa

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    duck = duckdb.connect()
    duck.register("documents", pa.table({n: [r[k] for r in ROWS] for k, n in enumerate(names)}))
    planned = mixing.plan(documents(spark)).selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")
    real = sorted((tuple(r) for r in duck.sql(mixing.ORACLE).fetchall()), key=str)
    assert sorted((tuple(r) for r in planned.collect()), key=str) == real
    assert spark_rows(planned)


def test_empty_table_and_no_words(spark):
    assert mixing.plan(empty(spark, DOC)).count() == 0
    assert mixing.mix(empty(spark, DOC)).count() == 0
    got = mixing.plan(documents(spark, [(1, "", "", "a", 0), (2, None, "", None, 0)])).collect()
    assert [(r.size, r.target, r.copies) for r in got] == [(0, 0.0, 0)] * 2
