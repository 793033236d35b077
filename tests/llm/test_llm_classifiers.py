"""Held-out accuracy, and the parts against brute force."""

import itertools
import re

import numpy as np
from pyspark.sql import functions as F
from conftest import MEDIUM
from llm_frames import DOC, ROWS, crowded, documents, empty

from tablewright.llm import crf, nbsvm
from tablewright.llm.common import bounded_sample, held_out, labelled, table
from tablewright.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int, label string"


def accuracy(spark, name, label):
    seen = QUERIES[name](spark, MEDIUM).join(table(spark, MEDIUM, "labels"), "doc_id").where("held_out").toPandas()
    assert ((seen["score"] >= 0) & (seen["score"] <= 1)).all()
    assert (seen["predicted"] == (seen["score"] >= 0.3)).all()
    return float((seen["predicted"] == seen[label]).mean())


def test_quality_on_held_out_rows(spark):
    assert accuracy(spark, "op7_nbsvm_quality", "quality") > 0.95


def test_toxicity_on_held_out_rows(spark):
    assert accuracy(spark, "op9_crf_toxicity", "toxic") > 0.9


def test_queries_give_every_row(spark):
    for name in ("op7_nbsvm_quality", "op9_crf_toxicity"):
        assert QUERIES[name](spark, MEDIUM).count() == table(spark, MEDIUM, "documents").count()


def test_shapes():
    assert nbsvm.shape("Hello") == "Aa" and nbsvm.shape("HELLO!!") == "AA!!" and nbsvm.shape("ÉTÉ,") == "AA,"
    assert nbsvm.shape("abc$$$$$") == "a$$$" and nbsvm.shape("a1b22") == "a0a0"


def test_counts_against_brute_force(spark):
    rows = [(k, text, k % 2) for k, text in enumerate(["a b", "B a a", "", None, "c!! c!!", "a b"])]
    ones, zeros = nbsvm.counts(spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3))
    real = np.zeros((2, nbsvm.PLACES + 1))
    for _, text, label in rows:
        real[0 if label else 1][nbsvm.features(text)] += 1
        real[0 if label else 1][-1] += 1
    assert (ones == real[0]).all() and (zeros == real[1]).all()


def test_descent_reaches_the_best_hinge_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = np.where(x @ [1, -2, 0.5] + 0.3 + rng.normal(size=60) * 0.5 > 0, 1.0, -1.0)
    rows = [(np.arange(3), row) for row in x]

    def loss(w):
        return w @ w / 2 + nbsvm.BOUND * np.maximum(0, 1 - y * (x @ w[:3] + w[3])).sum()

    best = nbsvm.descend(rows, y, 3, passes=500)
    for _ in range(300):
        assert loss(best) <= loss(best + rng.normal(size=4) * 0.1) + 1e-3


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(4)
    sizes = [1, 4, 7, 1, 3]
    scores, start, moves = rng.normal(size=16) * 2, rng.normal(size=2), rng.normal(size=(2, 2))
    first = np.zeros(16, bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    want = []
    for a, n in zip(np.cumsum([0, *sizes[:-1]]), sizes, strict=True):
        total, one = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            w = np.exp(start[tags[0]] + sum(scores[a + k] * t for k, t in enumerate(tags)) + sum(moves[s, t] for s, t in itertools.pairwise(tags)))
            total += w
            one += w * np.array(tags)
        want.append(one / total)
    assert np.allclose(crf.marginals(scores, first, start, moves), np.concatenate(want))


def test_marginals_of_long_chains_do_not_depend_on_neighbours():
    rng = np.random.default_rng(5)
    scores, start, moves = rng.normal(size=1000) * 3, rng.normal(size=2), rng.normal(size=(2, 2))
    first = np.zeros(1000, bool)
    first[[0, 130, 131, 700]] = True
    whole = crf.marginals(scores, first, start, moves)
    for a, b in ((0, 130), (130, 131), (131, 700), (700, 1000)):
        assert np.allclose(whole[a:b], crf.marginals(scores[a:b], first[a:b], start, moves))


def trained(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "theta"]
    rows = []
    for k in range(400):
        text = [str(rng.choice(words)) for _ in range(30)]
        if k % 4 == 0:
            text[rng.integers(30)] = "Rotten" if k % 8 else "vile"
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    return crf.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))


def test_offsets_of_offending_words(spark):
    field = trained(spark)
    text = "Alpha, VILE rotten! beta 😀 rotten"
    seen = crf.score(documents(spark, [(1, text, "", "", 0), (2, "alpha beta", "", "", 0), (3, None, "", "", 0)]), field).collect()
    by = {r.doc_id: r for r in seen}
    assert [text[s.start : s.end] for s in by[1].spans] == ["VILE rotten", "rotten"]
    assert by[1].score > 0.9 and by[2].score < 0.1 and by[3].score < 0.1 and by[3].spans == []


def test_odd_rows(spark):
    model = nbsvm.fit(spark.createDataFrame([(1, "good words here", 1), (2, "BAD!!", 0), (3, None, 1), (4, "", 0)], "doc_id long, text string, label int"))
    docs = crowded(documents(spark))
    got = nbsvm.score(docs, model)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(ROWS)
    got = crf.score(docs, trained(spark))
    assert got.count() == len(ROWS) and all(0 <= r.score <= 1 for r in got.collect())


def test_no_labels_of_one_kind(spark):
    assert nbsvm.fit(empty(spark, "doc_id long, text string, label int")).score(nbsvm.features("x")) == 0.5
    only = nbsvm.fit(spark.createDataFrame([(1, "x", 1)], "doc_id long, text string, label int"))
    assert only.score(nbsvm.features("y")) == 1.0
    field = crf.fit(empty(spark, "doc_id long, text string, label int"))
    assert crf.score(documents(spark), field).where("score > 0.01").count() == 0
    assert nbsvm.score(empty(spark, DOC), only).count() == 0 and crf.score(empty(spark, DOC), field).count() == 0


def test_labels_that_count(spark):
    import zlib

    docs = documents(spark)
    labels = spark.createDataFrame([(1, 0, 1, ""), (1, 1, 0, ""), (2, None, 1, ""), (3, 1, 1, ""), (None, 1, 1, ""), (99, 1, 1, "")], LABELS)
    got = sorted((r.doc_id, r.label) for r in labelled(docs, labels, "quality", ~held_out("doc_id", 5, 0)).collect())
    assert got == [(k, 1) for k in (1, 3) if zlib.crc32(str(k).encode()) % 5]
    assert re.fullmatch("doc_id|text|label", "label")


def test_samples_are_bounded_and_hold_a_rare_label(spark):
    """One id holds a third of the rows, and one row in 10,000 has the rare label."""
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 10_000 == 1, F.concat(F.lit("vile broken text "), "id")).when(F.col("id") % 3 == 0, "all the same").otherwise(F.concat(F.lit("fine words "), "id")).alias("text"),
        (F.col("id") % 10_000 == 1).cast("int").alias("label"),
    )
    for most in (500, 2000):
        assert bounded_sample(docs, most, 30_000).count() < 1.2 * most
    model = nbsvm.fit(docs, sample=500)
    scores = [model.score(nbsvm.features(t)) for t in ("vile broken text 9", "fine words 8")]
    assert scores[0] > 10 * scores[1] and scores[1] < 0.01


def test_all_of_a_long_word_counts():
    """Texts without spaces: what stands behind the first letters has features, too."""
    head, tails = "字" * 300, ("詞" * 40 + "好", "詞" * 40 + "x1!")
    first, second = (set(nbsvm.features(head + t).tolist()) for t in tails)
    assert first != second and first & second
    assert len(nbsvm.features("".join(chr(0x4E00 + k) for k in range(2000)))) > 20
