"""The registered queries: each applies one operator to its whole table.

The operators keep their own results; the columns asked for are derived here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bpe, chat, crf, graph, mixing, nbsvm, pii, sharding, simhash, topk, variants, vbyte, whitening
from tablewright.llm.common import held_out, labelled, table

#: Score from which a document counts as label 1.
THRESHOLD = 0.3


def op1_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_ranked_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = vbyte.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return written.read().select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_shard_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.shard(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.encode(docs, path, decoded="decoded").drop("text")
    return done.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_topk_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out("doc_id", 5, 0)
    model = nbsvm.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality", ~held))
    return _judged(nbsvm.score(docs, model), held)


def op9_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out("doc_id", 4, 2)
    field = crf.fit(labelled(docs, table(spark, sf_dir, "labels"), "toxic", ~held))
    return _judged(crf.score(docs, field), held)


def _judged(scored: DataFrame, held) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op8_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_events(chat.turns_as_events(turns)))


def op10_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("key").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error"
    )


def op12_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["strict"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, F.lit(kind))) for kind in pii.KINDS]
    counts = [(F.size(base) - rest).cast("long").alias(f"n_{kind}") for kind, rest in zip(pii.KINDS, counts, strict=True)]
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_bloom_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.words(table(spark, sf_dir, "documents"), mistype=199))


QUERIES = {
    "op1_pruned_graph": op1_pruned_graph,
    "op2_mix_to_weights": op2_mix_to_weights,
    "op3_ranked_bytes": op3_ranked_bytes,
    "op4_shard_hypergeometric": op4_shard_hypergeometric,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_topk_histograms": op6_topk_histograms,
    "op7_nbsvm_quality": op7_nbsvm_quality,
    "op8_chat_events": op8_chat_events,
    "op9_crf_toxicity": op9_crf_toxicity,
    "op10_simhash_anchors": op10_simhash_anchors,
    "op11_spectrum_whitening": op11_spectrum_whitening,
    "op12_boosted_pii": op12_boosted_pii,
    "op13_bloom_variants": op13_bloom_variants,
}

ORACLES: dict[str, str] = {
    "op2_mix_to_weights": mixing.ORACLE,
    "op6_topk_histograms": topk.ORACLE,
    "op13_bloom_variants": variants.ORACLE,
}
