"""Exact search for the k largest inner products by distributed histogram selection.

Components become integers, so scores are exact. All vectors are packed into blocks of
bounded size, the queries into blocks of their own; every query block meets every block,
once. A task meets a group of blocks one after the other and keeps each query's k best of
its group: the global k best are among them, as the k-th of all lies no lower than that of
a group. Each round then counts these scores in every query's current interval, in
``BINS`` bins; counts add up to a global histogram per query, whose bin with the k-th
largest score is the next interval, until intervals hold one score. Left are the scores
above the k-th and, of those equal to it, the smallest ids.

Scores are never kept as a whole: a task holds those of ``TILE`` queries and one block,
and sends at most k rows for each query and group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stage, unstage

#: Bins of a histogram, rows of a block and of a query block, queries scored at once.
BINS, BLOCK, QUERY_BLOCK, TILE = 256, 4096, 8192, 128
#: Tasks that score, at most; groups of blocks that a query block meets, at least if there are as many blocks, and blocks of a group.
TASKS, GROUPS, GROUP = 2000, 64, 64
#: Components made integers at once.
AT_ONCE = 1 << 22
#: Stands for a null id inside blocks, behind all others.
NO_ID = np.iinfo(np.int64).max


def integers(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``(id, dim, vec, size)``: floor(scale * x) as packed longs; ``size`` is the largest absolute one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(int(NO_ID)).to_numpy()
            lengths = pc.fill_null(pc.list_value_length(batch.column(1)), -1).to_numpy()
            values = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64)  # null components are NaN
            starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
            for dim in np.unique(lengths[lengths >= 0]).tolist():
                same = np.flatnonzero(lengths == dim)
                for part in np.array_split(same, len(same) * dim // AT_ONCE + 1):
                    x = values[starts[part, None] + np.arange(dim)]
                    finite = np.isfinite(x).all(axis=1)
                    x, ids = np.floor(scale * x[finite]), keys[part[finite]]
                    sizes = np.abs(x).max(axis=1, initial=0.0)
                    if (sizes >= 2.0**61).any():
                        raise ValueError("a component is too large for scores of 64 bits")
                    ends = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(8 * dim))
                    packed = pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(x.astype("<i8").tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(np.full(len(x), dim, np.int32)), packed, pa.array(sizes)],
                        names=["id", "dim", "vec", "size"],
                    )

    return vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).mapInArrow(
        run, "id long, dim int, vec binary, size double"
    )


def _packed(rows: DataFrame, block: int, name: str) -> DataFrame:
    """``(dim, name, ids, vecs)``: blocks of about ``block`` rows of one length of vectors, by id, in the least integers that hold them."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / block).alias("blocks"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        vecs = np.frombuffer(b"".join(frame["vec"]), "<i8")
        for narrow in ("<i2", "<i4"):
            if np.abs(vecs).max(initial=0) <= np.iinfo(narrow).max:
                vecs = vecs.astype(narrow)
                break
        return pd.DataFrame(
            {
                "dim": [frame["dim"].iloc[0]],
                name: [frame[name].iloc[0]],
                "ids": [frame["id"].to_numpy("<i8").tobytes()],
                "vecs": [vecs.tobytes()],
            }
        )

    # few lengths: as many as lengths of vectors, whose sum the table holds
    dealt = rows.join(F.broadcast(sizes), "dim").withColumn(name, F.pmod(F.xxhash64("id", "vec"), "blocks").cast("int"))
    return dealt.select("dim", name, "id", "vec").groupBy("dim", name).applyInPandas(
        pack, f"dim int, {name} int, ids binary, vecs binary"
    )


def _unpacked(ids: bytes, vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, "<i8")
    width = len(vecs) // max(1, len(found) * dim) or 8
    return found, np.frombuffer(vecs, f"<i{width}").reshape(len(found), dim)


def _norm(vecs: np.ndarray) -> float:
    return float(np.sqrt((vecs.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))


class _Best:
    """The ``k`` best (score, id) of each query of a block so far, the highest score and then the smallest id first."""

    def __init__(self, ids: bytes, vecs: bytes, dim: int, k: int) -> None:
        self.query_ids, self.queries = _unpacked(ids, vecs, dim)
        self.dim, self.k, self.norm = dim, k, _norm(self.queries)
        self.none = np.iinfo(np.int64).min  # stands for a place not taken; no score is as low
        self.scores = np.full((len(self.query_ids), k), self.none)
        self.ids = np.full((len(self.query_ids), k), np.iinfo(np.int64).min)

    def meet(self, ids: bytes, vecs: bytes) -> None:
        """Scores all queries against a block; its ids ascend."""
        found, block = _unpacked(ids, vecs, self.dim)
        largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (self.queries, block)]
        most = largest[0] * largest[1] * max(self.dim, 1)
        # sums of products, in any order, stay within the product of the norms
        if self.norm * _norm(block) * (1 + 1e-9) < 2.0**24:
            kind = np.float32
        elif most < 2.0**53:
            kind = np.float64
        elif most < 2.0**61:
            kind = np.int64
        else:
            raise ValueError("scores do not fit 64 bits")
        right = np.ascontiguousarray(block.astype(kind).T)
        first, last = (np.searchsorted(found, self.query_ids, side) for side in ("left", "right"))
        for at in range(0, len(self.query_ids), TILE):
            part = slice(at, at + TILE)
            scores = self.queries[part].astype(kind) @ right
            none = -np.inf if kind is not np.int64 else self.none
            for row in np.flatnonzero(first[part] < last[part]):  # not the query itself
                scores[row, first[at + row] : last[at + row]] = none
            self._take(part, scores, found, none)

    def _take(self, part: slice, scores: np.ndarray, found: np.ndarray, none) -> None:
        kth, kth_id = self.scores[part, -1], self.ids[part, -1]
        low = np.where(kth == self.none, none, kth).astype(scores.dtype)[:, None]
        hits = scores >= low
        many = 16 * self.k * len(scores)
        wide = len(found) // (8 * self.k)
        if wide and np.count_nonzero(hits) > many:  # k of these parts hold a score as high as the k-th of their highest
            highest = scores[:, : wide * 8 * self.k].reshape(len(scores), 8 * self.k, wide).max(axis=2)
            low = np.maximum(low, np.partition(highest, -self.k, axis=1)[:, -self.k, None])
            hits = scores >= low
        if np.count_nonzero(hits) > many:  # the block's own k-th, and the smallest ids of those equal to it
            if len(found) > self.k:
                low = np.maximum(low, np.partition(scores, -self.k, axis=1)[:, -self.k, None])
            same = scores == low
            hits = (scores > low) | same & (same.cumsum(axis=1) <= self.k)
        row, at = np.divmod(np.flatnonzero(hits), len(found))
        score, ids = scores[row, at], found[at]
        taken = score > none
        row, score, ids = row[taken], score[taken].astype(np.int64), ids[taken]
        better = (score > kth[row]) | (ids < kth_id[row])
        row, score, ids = row[better], score[better], ids[better]
        if not len(row):
            return
        changed = np.unique(row)
        row = np.concatenate([np.repeat(changed, self.k), row])
        score = np.concatenate([self.scores[part][changed].ravel(), score])
        ids = np.concatenate([self.ids[part][changed].ravel(), ids])
        order = np.lexsort((ids, ~score, row))  # ~score falls as the score grows, without overflow
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        self.scores[part.start + row[kept], place[kept]] = score[kept]
        self.ids[part.start + row[kept], place[kept]] = ids[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries in their block, their ids, and the ids and scores of what they keep."""
        query, at = np.nonzero(self.scores != self.none)
        return query, self.query_ids[query], self.ids[query, at], self.scores[query, at]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` highest scores of each query, ties to smaller ids.

    ``is_query`` is a condition on ``id``. Vectors that are null or hold null or
    non-finite components take no part; vectors of another length than the query's
    aren't its candidates, nor are rows of its own id. A null id is a candidate,
    behind all others in ties, and never a query. A repeated query row gives its
    result as often.
    """
    rows = stage(integers(vectors, key, vector, scale), "topk-integers").drop("size")
    blocks = stage(_packed(rows, BLOCK, "block"), "topk-blocks")
    asked = rows.where((F.col("id") != F.lit(int(NO_ID))) & is_query)
    queries = stage(_packed(asked, QUERY_BLOCK, "query_block"), "topk-queries")
    unstage(rows)
    groups = F.least("blocks", F.greatest(F.lit(GROUPS), F.ceil(F.col("blocks") / GROUP)))
    of_dim = F.broadcast(blocks.groupBy("dim").agg(F.count("*").alias("blocks")).select("dim", groups.cast("int").alias("groups")))
    met = queries.select("dim", "query_block").join(of_dim, "dim")
    tasks = max(1, min(TASKS, met.agg(F.sum("groups")).first()[0] or 0))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, now = None, None

        def kept() -> pa.RecordBatch:
            query, query_id, found, score = best.rows()
            same = lambda x: pa.array(np.full(len(query), x, np.int32))
            return pa.RecordBatch.from_arrays(
                [same(now[0]), same(now[1]), pa.array(query.astype(np.int32)), pa.array(query_id), pa.array(found), pa.array(score)],
                names=["dim", "query_block", "query", "query_id", "id", "score"],
            )

        for batch in batches:
            for at in range(batch.num_rows):
                dim, query_block, group, block, ids, vecs = (column[at].as_py() for column in batch.columns)
                if block < 0:  # the queries come before the blocks of their group
                    if best:
                        yield kept()
                    best, now = _Best(ids, vecs, dim, k), (dim, query_block, group)
                else:
                    best.meet(ids, vecs)
        if best:
            yield kept()

    to_groups = queries.join(of_dim, "dim").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    pairs = to_groups.select("dim", "query_block", "group", F.lit(-1).alias("block"), "ids", "vecs").unionByName(
        blocks.join(F.broadcast(met), "dim").select("dim", "query_block", F.pmod("block", "groups").alias("group"), "block", "ids", "vecs")
    )
    dealt = pairs.repartition(tasks, "dim", "query_block", "group").sortWithinPartitions("dim", "query_block", "group", "block")
    best = stage(dealt.mapInArrow(meet, "dim int, query_block int, query int, query_id long, id long, score long"), "topk-best")

    of = ["dim", "query_block", "query"]
    # the first interval holds all of a query's scores
    state = stage(
        best.groupBy(*of).agg(F.min("score").alias("low"), (F.max("score") + 1).alias("high")).withColumn("above", F.lit(0).cast("long")), "topk-state"
    )
    width = F.expr(f"(high - low + {BINS - 1}) div {BINS}")
    while (state.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0) > 1:
        inside = best.join(state, of).where("score >= low AND score < high").withColumn("width", width)
        total = inside.groupBy(*of, F.expr("(score - low) div width").alias("bin")).agg(F.count("*").alias("n"))
        higher = F.coalesce(F.sum("n").over(W.partitionBy(*of).orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        reached = total.withColumn("higher", higher).join(state, of).where(F.col("above") + F.col("higher") < k)
        # the last bin that has fewer than k above it; the lowest of all if there are fewer than k scores
        chosen = reached.groupBy(*of).agg(F.min(F.struct("bin", "higher")).alias("b"))
        joined = state.join(chosen, of).withColumn("width", width)
        fresh = joined.select(
            *of,
            (F.col("low") + F.col("b.bin") * F.col("width")).alias("low"),
            F.least("high", F.col("low") + (F.col("b.bin") + 1) * F.col("width")).alias("high"),
            (F.col("above") + F.col("b.higher")).alias("above"),
        )
        after = stage(fresh, "topk-state")
        unstage(state)
        state = after
    found = best.join(state.select(*of, "low"), of).where("score >= low")
    place = F.row_number().over(W.partitionBy(*of).orderBy(F.desc("score"), "id"))
    return (
        found.withColumn("rank", place)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.nullif("id", F.lit(int(NO_ID))).alias("id"), "score")
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
