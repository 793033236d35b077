"""A uniform shuffle into shards of exact sizes.

The rows are where they are: in partitions. How many rows of each partition go to
each shard is drawn first, exactly as a uniform shuffle would deal them: the
matrix of counts follows the multivariate hypergeometric law given the sizes of
partitions and shards. It is drawn by halving: from the counts of a run of
partitions those of its first half, and so on, each level one small join. Then
every partition permutes its rows and cuts them by its counts, the rows move to
their shards, and every shard permutes again: a row's place there is its slot.

Everything is DataFrame functions. Windows run inside a partition or inside a
bucket of a shard, never over a whole shard. The number drawn for each row and
cell comes from hashes, so reruns over the same files agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stage

#: Rows of a shard that one task permutes, about.
BUCKET_ROWS = 50_000
SEED = 20240229



def _let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of named values, each computed once."""
    named = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.element_at(F.transform(F.array(named), body), 1)


def _walk(v: Column, stop: Column) -> Column:
    """Weights of the counts a..b, relative to that of a, summed in ``c``; ``x`` is the count at which the sum passes ``stop``."""
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("c"), v["a"].alias("x"))

    def step(s: Column, i: Column) -> Column:
        ratio = (v["g"] - i) * (v["n"] - i).cast("double") / ((i + 1) * (v["k"] - v["g"] - v["n"] + i + 1).cast("double"))
        return F.struct(
            (s["w"] * ratio).alias("w"), (s["c"] + s["w"]).alias("c"), F.when(s["c"] + s["w"] < stop, i + 1).otherwise(s["x"]).alias("x")
        )

    return F.aggregate(F.sequence(v["a"], v["b"]), start, step)


def hypergeometric(g: Column, k: Column, n: Column, u: Column) -> Column:
    """How many of g marked rows among k are in a random n of them, for u uniform in (0, 1).

    Inverts the law's distribution function within twelve deviations and twelve
    rows of the mean: what lies beyond is less than the last bit of a double.
    """

    def bounds(v: Column) -> Column:
        part = v["g"].cast("double") / F.greatest(v["k"], F.lit(1))
        mean = v["n"] * part
        reach = 12 * F.sqrt(F.greatest(mean * (1 - part) * (v["k"] - v["n"]) / F.greatest(v["k"] - 1, F.lit(1)), F.lit(0.0))) + 12
        low = F.greatest(F.lit(0), v["n"] - (v["k"] - v["g"]), F.floor(mean - reach)).cast("long")
        high = F.least(v["g"], v["n"], F.ceil(mean + reach)).cast("long")
        return _let(search, g=v["g"], k=v["k"], n=v["n"], u=v["u"], a=low, b=high)

    def search(v: Column) -> Column:
        total = _let(lambda x: _walk(v, F.lit(-1.0))["c"] + x["zero"], zero=F.lit(0.0))
        return F.least(_let(lambda x: _walk(v, x["stop"])["x"], stop=v["u"] * total), v["b"])

    return _let(bounds, g=g, k=k, n=n, u=u)


def halve(nodes: DataFrame, sizes: DataFrame, level: int, seed: int) -> DataFrame:
    """``(node, counts)`` of both halves of each node; ``sizes`` has the rows of each half."""
    counts = F.col("counts")

    def step(t: Column, s: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), s), 11)
        drawn = hypergeometric(counts[s], t["pool"], t["rest"], (bits + 0.5) / F.lit(2.0**53))
        return _let(
            lambda v: F.struct(
                (t["rest"] - v["d"]).alias("rest"), (t["pool"] - counts[s]).alias("pool"), F.concat(t["taken"], F.array(v["d"])).alias("taken")
            ),
            d=drawn,
        )

    whole = F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)
    start = F.struct(F.col("first").alias("rest"), whole.alias("pool"), F.array().cast("array<bigint>").alias("taken"))
    taken = F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, step)["taken"]
    ahead = nodes.select((F.col("node") * 2).alias("node"), "counts").join(sizes, "node", "left")
    drawn = ahead.select("node", "counts", F.coalesce("n", F.lit(0)).cast("long").alias("first")).withColumn("taken", taken)
    halves = F.array(
        F.struct(F.col("node").alias("node"), F.col("taken").alias("counts")),
        F.struct((F.col("node") + 1).alias("node"), F.zip_with("counts", "taken", lambda x, y: x - y).alias("counts")),
    )
    return drawn.select(F.explode(halves).alias("h")).select("h.*").where(whole > 0)


def communication_matrix(sizes: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``(part, counts)``: rows of each partition for each shard; ``sizes`` is ``(part, n)``.

    Row sums are the partitions' sizes, column sums differ by at most one.
    """
    whole = sizes.agg(F.sum("n"), F.max("part")).first()
    rows, last = int(whole[0] or 0), int(whole[1] or 0)
    levels = last.bit_length()
    columns = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("long") for s in range(shards)])
    nodes = sizes.sparkSession.range(1 if rows else 0).select(F.col("id").alias("node"), columns.alias("counts"))
    for level in range(levels):
        down = sizes.groupBy(F.expr(f"shiftright(CAST(part AS BIGINT), {levels - level - 1})").alias("node")).agg(F.sum("n").alias("n"))
        nodes = halve(nodes, down, level, seed)
        if level % 5 == 4:
            nodes = stage(nodes, "shard-matrix")
    return nodes.select(F.col("node").alias("part"), "counts")


def shard(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (0 up) and ``slot`` (0 up inside the shard), a uniform shuffle.

    All columns move with their rows, so pass only those needed. Shard sizes differ
    by at most one row. Null values play no part, repeated rows stay apart; columns
    called ``shard`` or ``slot`` are replaced.
    """
    kept = docs.drop("shard", "slot")
    here = stage(
        kept.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "shard-rows"
    )
    sizes = stage(here.groupBy("part").agg(F.count("*").alias("n")), "shard-sizes")
    matrix = stage(communication_matrix(sizes, shards, seed), "shard-matrix")
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    bits = max(0, int(rows // shards // BUCKET_ROWS).bit_length())
    mine: Column = F.row_number().over(W.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), "at"), "at")) - 1
    ends = F.expr("transform(sequence(1, size(counts)), i -> aggregate(slice(counts, 1, i), 0L, (x, y) -> x + y))")
    dealt = (
        here.withColumn("mine", mine)
        .join(matrix.select("part", ends.alias("ends")), "part")
        .select("row", "at", F.expr("size(filter(ends, e -> e <= mine))").alias("shard"))
        .withColumn("order", F.xxhash64(F.lit(seed + 2), "at"))
        .withColumn("bucket", F.expr(f"shiftrightunsigned(`order`, {64 - bits})") if bits else F.lit(0).cast("long"))
    )
    dealt = stage(dealt, "shard-dealt")
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        "shard", "bucket", (F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("order", "at")) - 1
    return (
        dealt.withColumn("place", place)
        .join(before, ["shard", "bucket"])
        .select("row.*", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, the rows of its files in the order of their slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
