"""What the operators share: shared scratch folders, staging, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing, a local session gets a folder of its own; a
    cluster session is refused, as its machines share no temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: its lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the least node that links reach, for every node of ``edges (a, b)``.

    Large-star and small-star rounds: each node's links move to the least node of
    its neighbourhood until nothing changes. Rounds grow with the logarithm of the
    longest chain; every round is one written table, so nothing is gathered.
    """

    def oriented(found: DataFrame) -> DataFrame:
        return found.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).where("a <> b").distinct()

    def least(found: DataFrame) -> DataFrame:
        return found.groupBy("a").agg(F.min("b").alias("low"))

    def state(found: DataFrame) -> tuple:
        row = found.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return tuple(row)

    now = stage(oriented(edges), "components")
    seen = state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        far = (
            both.join(least(both), "a")
            .select("b", F.least("a", "low").alias("low"), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        far = oriented(far)
        near = far.join(least(far), "a")
        moved = near.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            near.select("a", F.col("low").alias("b"))
        )
        after = stage(oriented(moved), "components")
        fresh = state(after)
        unstage(now)
        now = after
        if fresh == seen:
            break
        seen = fresh
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def held_out(key: str, of: int, part: int):
    """Whether a row is in the held-out part: crc32 of its key as text, modulo ``of``. False for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % of == part, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn) -> DataFrame:
    """``(doc_id, text, label)`` of the rows that may be learnt from; null labels are none.

    Of several labels of one document the larger counts. Both sides are filtered
    before they meet; texts are not sorted, and labels are hashed by partition at
    every size.
    """
    known = labels.where(learn & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return docs.select("doc_id", "text").where(learn).join(known.hint("shuffle_hash"), "doc_id")


def bounded_sample(rows: DataFrame, most: int, count: int) -> DataFrame:
    """About ``most`` of ``count`` rows ``(doc_id, text, label)``, chosen by the hash of id and text; all if there are no more.

    Equal rows count once, so a row repeated any number of times is one of the sample
    or none; they are folded in each task before they meet.
    """
    share = min(1.0, most / max(count, 1))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 40)) < int(share * (1 << 40))
    return rows.select("doc_id", "text", "label").where(drawn).distinct()


def logistic(raw, label, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small ridge."""
    import numpy as np

    x = np.stack([np.asarray(raw, float), np.ones(len(raw))], axis=1)
    y = np.asarray(label, float)
    # targets kept off 0 and 1, so that separable data give finite curves
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    y = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    b = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(x.T * w @ x + 1e-6 * np.eye(2), x.T @ (p - y) + 1e-6 * b)
        b -= step / max(1.0, np.abs(step).max() / 5)
    return float(b[0]), float(b[1])
