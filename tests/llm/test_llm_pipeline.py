"""Each stage against a brute-force version on its own input."""

import corpus_pipeline
import public_tokenizers
from conftest import SMALL
from llm_frames import DOC, ROWS, documents, empty
from test_llm_simhash import brute as groups
from tokenizers import Tokenizer

from tablewright.llm import crf, mixing, nbsvm
from tablewright.llm.common import held_out, labelled, stage, table


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_stages_on_the_small_tables(spark):
    docs = table(spark, SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "toxicity", "simhash", "mixing", "bpe"]

    labels = table(spark, SMALL, "labels")
    model = nbsvm.fit(labelled(docs, labels, "quality", ~held_out("doc_id", 5, 0)))
    good = stage(steps["quality"](spark, docs, SMALL), "t")
    assert rows(good) == sorted((tuple(r) for r in docs.collect() if model.score(nbsvm.features(r.text)) >= 0.3), key=str)

    field = crf.fit(labelled(good, labels, "toxic", ~held_out("doc_id", 4, 2)))
    clean = stage(steps["toxicity"](spark, good, SMALL), "t")
    scores = {r.doc_id: r.score for r in crf.score(good, field).collect()}
    assert rows(clean) == sorted((tuple(r) for r in good.collect() if scores[r.doc_id] < 0.3), key=str)
    assert good.count() > clean.count() or all(s < 0.3 for s in scores.values())

    single = stage(steps["simhash"](spark, clean, SMALL), "t")
    kept = {x[2] for x in groups([tuple(r) for r in clean.collect()])}
    assert rows(single) == sorted((tuple(r) for r in clean.collect() if r.doc_id in kept), key=str)

    mixed = stage(steps["mixing"](spark, single, SMALL), "t")
    copies = {r.doc_id: r.copies for r in mixing.plan(single).collect()}
    assert rows(mixed) == sorted((tuple(r) for r in single.collect() for _ in range(copies[r.doc_id])), key=str)

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    done = steps["bpe"](spark, mixed, SMALL).collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(done) == mixed.count()
    for r in done:
        assert r.tokens == tool.encode(texts[r.doc_id], add_special_tokens=False).ids and r.decoded == texts[r.doc_id]
    assert len(corpus_pipeline.run(spark, SMALL).collect()) == len(done)


def crowded_rows(spark):
    """The odd rows with columns of all names that stages use inside."""
    from pyspark.sql import functions as F

    names = ("evidence", "spans", "score", "file", "row", "doc", "name", "c1", "__score", "__of", "__draw", "__doc", "__copy", "size", "fp")
    return documents(spark).select("*", *[F.concat(F.lit(name), F.coalesce("doc_id", F.lit(-1))).alias(name) for name in names])


def test_rows_come_out_as_they_went_in(spark, tmp_path):
    path = str(tmp_path / "labels.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 0, 1), (8, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(path)
    docs = crowded_rows(spark)
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, str(tmp_path)), "t")
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in docs.collect()}, name
        docs = after


def test_survivor_of_rows_of_one_id_and_text_is_defined(spark):
    """Which row stays does not hang on the order of rows."""
    rows = [(k % 50, "the same words stand here and there", "en", f"s{k}", k) for k in range(100)]
    first = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), SMALL).collect()
    again = corpus_pipeline.one_of_each_group(spark, documents(spark, rows[::-1]).repartition(7), SMALL).collect()
    assert first == again and len(first) == 1 and first[0].doc_id == 0
    alike = corpus_pipeline.one_of_each_group(spark, documents(spark, rows[:1] * 9), SMALL).collect()
    assert [tuple(r) for r in alike] == rows[:1]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "labels.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(path)
    for docs in (documents(spark), empty(spark, DOC)):
        before = docs.count()
        for name, step in corpus_pipeline.STAGES[:-1]:
            docs = stage(step(spark, docs, str(tmp_path)), "t")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            if name in ("quality", "toxicity"):
                assert docs.count() == before  # no labels, so nothing is rejected
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert last.count() == docs.count()


def test_one_row_of_each_group(spark):
    got = corpus_pipeline.one_of_each_group(spark, documents(spark), SMALL).collect()
    real = groups(ROWS)
    assert len(got) == len({x[2] for x in real if x[2] is not None}) + len({x[1] for x in real if x[2] is None})
    assert {r.doc_id for r in got if r.doc_id is not None} == {x[2] for x in real if x[2] is not None}
