"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet to the shared folder and reads it again for the next. All but
the last return the columns of ``documents`` as they came, extra ones included.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bpe, crf, mixing, nbsvm, simhash
from tablewright.llm.common import held_out, labelled, stage, table, unstage
from tablewright.llm.queries import THRESHOLD


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality scores below the threshold.

    Learns from the labels of ``docs`` that are not held out; without any, all
    documents stay.
    """
    model = nbsvm.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality", ~held_out("doc_id", 5, 0)))
    return _where(docs, lambda plain, text: nbsvm.score(plain, model, text, "score"), F.col("score") >= THRESHOLD)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity scores the threshold or more.

    Learns from the labels of ``docs`` that are not held out; without toxic ones,
    all documents stay.
    """
    field = crf.fit(labelled(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out("doc_id", 4, 2)))
    return _where(docs, lambda plain, text: crf.score(plain, field, text, "score"), F.col("score") < THRESHOLD)


def _where(docs: DataFrame, scored: Callable[[DataFrame, str], DataFrame], condition: Column) -> DataFrame:
    """The rows of ``docs`` that meet a condition on their score, under plain names meanwhile, so that none can clash."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = scored(plain, f"c{docs.columns.index('text')}").where(condition)
    return kept.select(*plain.columns).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints: that of the least id, null last.

    Of rows of one id the least hash of the text decides, then that of the whole row;
    of rows alike in all that, the first of its file. Survivors are found on narrow
    rows; texts move once, to meet them by file and place.
    """
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:  # not read from files
        docs = stage(docs, "pipeline-rows")
    rows = docs.select(F.struct("*").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    whole = F.xxhash64(*[F.col(f"doc.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    name = F.struct(
        F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("doc_id"), F.xxhash64("doc.text").alias("hash"), whole.alias("whole"), "file", "row"
    )
    groups = simhash.near_duplicates(rows.select(name.alias("name"), F.col("doc.text").alias("text")), key="name")
    first = groups.where(F.col("name") == F.col("component_id")).select("name.file", "name.row")
    return rows.join(first, ["file", "row"], "left_semi").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's rate says; rows repeat."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, tokens, n_tokens, decoded)`` of each row; null texts have no tokens."""
    done = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"), decoded="decoded")
    return done.select("doc_id", "lang", "source", "tokens", F.size("tokens").cast("long").alias("n_tokens"), "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("simhash", one_of_each_group),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL expresses neither the classifiers nor the encoder; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        done = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        if docs is not source:
            unstage(docs)
        docs = done
    return docs
