"""Against the tokenizers library."""

import random

import public_tokenizers
import pytest
from llm_frames import DOC, ROWS, crowded, documents, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


@pytest.mark.parametrize("alphabet", ["ab", "aeionrst ", "abc ABC\n\t'", "éèàü aß€😀", "0123 <|>!?", "the intion "])
def test_same_ids_as_the_library(library, codec, alphabet):
    rnd = random.Random(alphabet)
    for _ in range(200):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_white_space_and_category(library, codec):
    for code in [*range(0x3000), 0x1F600, 0x10FFFF]:
        text = f"a {chr(code)} b{chr(code)}1"
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(code)


def test_long_words(library, codec):
    for text in ("a" * 5000, "word" * 3000, " " * 4000, "x<|endoftext|>y <|endoftext|>"):
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_decoding_ids_that_are_no_text(library, codec):
    for ids in ([128, 200], [94, 50256, 220], [447, 247], []):
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_is_the_merges(codec):
    """Each gadget against rewriting the sequence rank by rank, on a small vocabulary."""
    labels = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab", 5: b"ba", 6: b"abba"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (1, 0, 5), (3, 5, 6)]
    automaton = bpe.Automaton(labels, merges)
    for n in range(1, 12):
        for code in range(1 << n):
            ids = [code >> k & 1 for k in range(n)]
            word = bytes(b"ab"[x] for x in ids)
            for a, b, c in merges:
                k, out = 0, []
                while k < len(ids):
                    if ids[k : k + 2] == [a, b]:
                        out.append(c)
                        k += 2
                    else:
                        out.append(ids[k])
                        k += 1
                ids = out
            assert list(automaton.encode(word)) == ids, word


def test_refuses_merges_out_of_order():
    with pytest.raises(ValueError):
        bpe.Automaton({0: b"a", 1: b"b", 2: b"ab", 3: b"aba"}, [(2, 0, 3), (0, 1, 2)])


def test_rows_stay_one_to_one(spark, library):
    done = bpe.encode(crowded(documents(spark)), PATH, decoded="decoded")
    assert sorted(done.columns) == sorted(crowded(documents(spark)).columns)
    got = sorted((r.doc_id or -1, r.tokens, r.decoded) for r in done.collect())
    real = sorted((r[0] or -1, library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in ROWS)
    assert got == real
    again = bpe.decode(done.select("tokens", "doc_id"), PATH, into="back")
    assert sorted(r.back for r in again.collect()) == sorted(r[1] or "" for r in ROWS)


def test_empty_table_and_null_ids(spark):
    assert bpe.encode(empty(spark, DOC), PATH).count() == 0
    nulls = spark.range(1).select(F.lit(None).cast("array<int>").alias("tokens"))
    assert bpe.decode(nulls, PATH).first().decoded == ""
