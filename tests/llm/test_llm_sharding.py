import math
from collections import Counter

from llm_frames import DOC, ROWS, crowded, documents, empty
from pyspark.sql import functions as F

from tablewright.llm import sharding


def exact(got, rows, shards=16):
    places = {}
    for r in got:
        places.setdefault(r.shard, []).append(r.slot)
    sizes = [len(places.get(s, [])) for s in range(shards)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())


def test_odd_rows(spark):
    docs = crowded(documents(spark))
    got = sharding.shard(docs)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    exact(rows, len(ROWS))
    assert sorted(r.doc_id or -1 for r in rows) == sorted(r[0] or -1 for r in ROWS)


def test_many_partitions_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    docs = spark.range(0, 5000, 1, 13).withColumn("x", F.col("id") * 2)
    rows = sharding.shard(docs).collect()
    exact(rows, 5000)
    assert sorted((r.id, r.x) for r in rows) == [(k, 2 * k) for k in range(5000)]
    again = {(r.id, r.shard, r.slot) for r in sharding.shard(docs).collect()}
    assert again == {(r.id, r.shard, r.slot) for r in rows}


def test_matrix_has_its_sums(spark):
    sizes = [5000, 7000, 1, 0, 30_000, 12]
    frame = spark.createDataFrame([(k, n) for k, n in enumerate(sizes) if n], "part int, n long")
    found = {r.part: r.counts for r in sharding.communication_matrix(frame, 16).collect()}
    assert [sum(found.get(k, [])) for k in range(6)] == sizes
    columns = [sum(c) for c in zip(*found.values(), strict=True)]
    assert max(columns) - min(columns) <= 1


def test_draws_follow_the_law(spark):
    g, k, n, rows = 5, 20, 8, 20_000
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(7), "id"), 11) + 0.5) / F.lit(2.0**53)
    drawn = spark.range(rows).select(sharding.hypergeometric(*[F.lit(x).cast("long") for x in (g, k, n)], u).alias("x"))
    seen = Counter(r.x for r in drawn.collect())
    chi = 0.0
    for x in range(g + 1):
        want = rows * math.comb(g, x) * math.comb(k - g, n - x) / math.comb(k, n)
        chi += (seen[x] - want) ** 2 / want
    assert chi < 25  # 5 degrees of freedom


def test_slots_are_uniform(spark):
    rows = sharding.shard(spark.range(0, 16_000, 1, 7), seed=11).collect()
    early = Counter(r.shard for r in rows if r.id < 4000)
    assert all(190 < early[s] < 310 for s in range(16))  # 250 expected, deviation about 13
    mean = sum(r.slot for r in rows if r.id < 4000) / 4000
    assert abs(mean - 499.5) < 25


def test_files_in_order_of_slots(spark, tmp_path):
    sharding.write_shards(sharding.shard(spark.range(1000), shards=3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    exact(back.collect(), 1000, 3)


def test_empty_table(spark):
    assert sharding.shard(empty(spark, DOC)).count() == 0
