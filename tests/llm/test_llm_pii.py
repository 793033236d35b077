import random
import re

import numpy as np
import pytest
from llm_frames import crowded, documents, empty
from pyspark.sql import functions as F

from tablewright.llm import pii

#: The patterns as the contract words them.
PLAIN = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+",
    3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            passes = {
                0: True,
                1: kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                2: 14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0,
                3: 10 <= len(digits) <= 15,
            }[kind]
            if passes:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["ab.@-", "a_@.%b ", "0129.", "01 -.", "+1 ().-23", "1234567890 -+().@a.", "é@a.0٣ +1-"])
def test_strict_is_the_plain_patterns(alphabet):
    draw = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 60)))
        assert pii.strict(text) == plain(text), text


def test_strict_on_cards_and_others():
    texts = ["4111 1111 1111 1111, 4111-1111-1111-1112 +1 (555) 123-4567. a.b@c.d_e@f.g 1.2.3.4.5.6.7.8 256.1.1.1 00001.02.3.255", "x@a@b.c", "a@b.c@d.e", "+" * 9]
    for text in texts:
        assert pii.strict(text) == plain(text)
    assert len(pii.strict(texts[0])) == 7


@pytest.mark.parametrize("part", ["w", "9", "1.", "a@", "+1 ", "@", "1 2", "a:", "x at y dot ", ": :", "(", "é"])
def test_long_texts_take_linear_time(part):
    text = part * (400_000 // len(part))
    pii.strict(text)
    sum(1 for _ in zip(pii.candidates(text), range(200_000)))


def corpus(count=3000):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9)))
    number = lambda n: "".join(draw.choices("0123456789", k=n))

    def card():
        while not pii.luhn(c := number(16)):
            pass
        return c

    def phone():
        return f"1 ({number(3)}) 555-{number(4)}"

    rows = []
    for k in range(count):
        made = [word() for _ in range(20)]
        made[7] = [lambda: f"{word()}.{number(2)}@mail{number(1)}.example.com", card, lambda: "+" + phone(), lambda: ".".join(str(draw.randint(1, 255)) for _ in range(4)),
                   lambda: number(16), lambda: f'token = "{word()}{number(9)}{word()}"', lambda: f"order {number(4)}-{number(4)}", lambda: f"v{number(1)}.{number(3)}.999.{number(4)}", word][k % 9]()
        rows.append((k, " ".join(made), "en", "a", 1))
    return rows, phone, card, word


@pytest.fixture(scope="module")
def learnt(spark):
    rows, *make = corpus()
    docs = documents(spark, rows).repartition(6)
    return docs, rows, pii.fit(docs), make


def spans(frame):
    return {r.key: [(s.start, s.kind, s.end, s.strict) for s in r.spans] for r in frame.collect()}


def test_strict_spans_stay_and_clean_texts_stay_clean(learnt):
    docs, rows, model, _ = learnt
    got = spans(pii.find(docs, model))
    for key, text, *_ in rows:
        assert [(s, pii.KINDS.index(k), e) for s, k, e, own in got[key] if own] == plain(text)
    clean = [key for key, text, *_ in rows if not plain(text)]
    assert sum(bool(got[key]) for key in clean) <= len(clean) / 100


def test_adds_the_same_data_written_otherwise(spark, learnt):
    _, _, model, (phone, _, word) = learnt
    assert 3 in model.judges
    rows = [(k, f"{word()} {word()} {(p := phone())} {word()} {word()}", "en", "a", 1) for k in range(60)]
    assert not any(plain(text) for _, text, *_ in rows)
    got = pii.find(documents(spark, rows), model, redacted=True)
    assert sum(bool(s) for s in spans(got).values()) >= 50
    for row in got.collect():
        for s in row.spans:
            assert not s.strict and model.judges[pii.KINDS.index(s.kind)].threshold <= s.probability <= 1
            assert f"[{s.kind.upper()}]" in row.redacted
    whole = [s for (_, text, *_), r in zip(rows, sorted(got.collect(), key=lambda r: r.key), strict=True) for s in r.spans if len(re.sub("[^0-9]", "", text[s.start : s.end])) == 11]
    assert len(whole) >= 50


def test_the_sample_is_bounded_and_reruns_agree(spark, learnt):
    docs, _, model, _ = learnt
    again = pii.fit(docs.repartition(3))
    assert {k: (j.threshold, j.slope) for k, j in again.judges.items()} == {k: (j.threshold, j.slope) for k, j in model.judges.items()}
    hot = docs.unionByName(docs.where("doc_id < 90").crossJoin(spark.range(50)).drop("id"))
    assert {k: j.threshold for k, j in pii.fit(hot, documents=10**6).judges.items()}.keys() == model.judges.keys()
    assert pii.fit(docs, most=10).judges == {}


def test_odd_rows(spark, learnt):
    model = learnt[2]
    docs = crowded(documents(spark)).unionByName(documents(spark, [(20, "a@b.c " * 3000, "x", None, 1)]), allowMissingColumns=True)
    got = pii.find(docs, model, redacted=True)
    assert got.columns == ["key", "spans", "redacted"]
    assert got.count() == docs.count()
    by = {r.key: r for r in got.collect()}
    assert by[4].spans == [] and by[4].redacted == "" and by[3].redacted == ""
    assert len(by[20].spans) == 3000 and by[20].redacted == "[EMAIL] " * 3000


def test_empty_table(spark):
    docs = empty(spark, "doc_id long, text string")
    assert pii.find(docs, pii.fit(docs)).collect() == []


def test_boosting_learns_what_one_split_cannot():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = pii.boosted(x[:2000], y[:2000])
    assert ((trees.raw(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_overlapping_spans_are_redacted_once():
    assert pii._redacted("abcdefgh", [(1, 0, 4), (2, 3, 6), (7, 1, 8)]) == "a[EMAIL]g[IP]"


def test_offsets_are_code_points(spark):
    docs = documents(spark, [(1, "😀é x@y.zz", "x", "y", 1)])
    row = pii.find(docs, pii.Model()).select("key", F.inline("spans")).first()
    assert (row.start, row.end, row.kind) == (3, 9, "email")
