import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_frames import crowded, documents, empty

from tablewright.llm import variants

ROW = "word string, n long"


def brute_words(rows, mistype=None, shortest=6, rarest=5):
    seen = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if mistype and h % mistype == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            seen[word] += len(word) >= shortest
    return {w: n for w, n in seen.items() if n >= rarest}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, share=5):
    best = {}
    for a in words:
        around = [(-words[b], b) for b in words if near(a, b)]
        best[a] = (len(around), min(around) if around and -min(around)[0] >= share * words[a] else None)
    out = set()
    for a, (n_near, top) in best.items():
        root = a
        while best[root][1]:
            root = best[root][1][1]
        out.add((a, top[1] if top else None, root, words[a], n_near, -top[0] if top else None))
    return out


def got(frame):
    rows = variants.variants(frame).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def vocabulary(seed, letters="abcé", sizes=(6, 9), count=400):
    rng = np.random.default_rng(seed)
    found = {"".join(rng.choice(list(letters), rng.integers(*sizes))): int(rng.choice([5, 6, 30, 200, 9000])) for _ in range(count)}
    return found | {"a" * 6: 7, "a" * 7: 40, "a" * 8: 300, "ÿ" * 40: 5, "ÿ" * 41: 25}


@pytest.mark.parametrize("seed", [1, 2])
def test_forms_and_roots(spark, seed):
    words = vocabulary(seed)
    want = brute(words)
    assert got(spark.createDataFrame(sorted(words.items()), ROW).repartition(5)) == want
    assert any(f and r != f for _, f, r, *_ in want)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(variants, "MOST_BYTES", 64)
    monkeypatch.setattr(variants, "AT_ONCE", 50)
    monkeypatch.setattr(variants, "PROBES", 5000)
    words = vocabulary(3)
    assert got(spark.createDataFrame(sorted(words.items()), ROW)) == brute(words)


def test_filters_pass_few_edits_that_are_no_words(spark):
    rng = np.random.default_rng(7)
    words = sorted({"".join(rng.choice(list("abcdefghij"), 9)) for _ in range(3000)})
    known = variants.filters(spark.createDataFrame([(w, 5) for w in words], ROW))
    letters = np.frombuffer("".join(words).encode(), np.uint8).reshape(-1, 9)
    passed = {(row, edit.decode()) for row, edit in variants._edits(letters, known)}
    true = {(k, w) for k, w in passed if w in set(words)}
    assert true == {(k, b) for k, a in enumerate(words) for i in range(9) for c in "abcdefghij" if c > a[i] and (b := a[:i] + c + a[i + 1 :]) in set(words)}
    assert len(passed - true) < 3000 * 9 * 5 / 100


@pytest.mark.parametrize("mistype", [None, 3])
def test_words_of_odd_rows(spark, mistype):
    rows = [
        (1, "Straße Café naïveté ÀÉÎÕÜ× word-word WORDS Wordss don't été", "x", "y", 1), (None, "wörter wörter WÖRTER", None, None, None),
        (2, None, "x", "y", 1), (3, "", "x", "y", 1), (4, "Ångström " * 50 + "q" * 20_000, "x", "y", 1), (4, "Ångström " * 50, "x", "y", 1), (-5, "ВодаŁódź naïveté", "x", "y", 1),
    ]
    made = variants.words(crowded(documents(spark, rows)), rarest=1, mistype=mistype)
    assert {r.word: r.n for r in made.collect()} == brute_words(rows, mistype, rarest=1)


def test_one_word_of_a_third_of_all_rows(spark):
    rows = [(k, "common " * 30 + f"comm{'aeiou'[k % 5]}n rarely{'xyz'[k % 3]}", "x", "y", 1) for k in range(300)]
    docs = documents(spark, rows)
    words = brute_words(rows, 199)
    assert got(variants.words(docs, mistype=199)) == brute(words)


def test_no_rows(spark):
    assert got(variants.words(empty(spark, "doc_id long, text string"))) == set()
    assert got(spark.createDataFrame([("single", 9)], ROW)) == {("single", None, "single", 9, 0, None)}
