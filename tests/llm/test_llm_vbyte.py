import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_frames import DOC, ROWS, crowded, documents, empty
from tokenizers import Tokenizer

from tablewright.llm import vbyte

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def brute(library, rows):
    """(doc_id, start, n_tokens, crc32) in order of keys, null first."""
    done = [(r[0], np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")) for r in rows]
    done.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].astype("<u2").tobytes()))
    start, out = 0, []
    for key, ids in done:
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def rows_of(written):
    return [(r.key, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in written.read().collect()]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_ranks_come_back(n):
    rng = np.random.default_rng(n)
    ranks = np.concatenate([rng.integers(0, 1 << bits, n) for bits in (7, 9, 17, 32)]).astype(np.uint32)
    control, data = vbyte.encode_ranks(ranks)
    assert len(control) == len(ranks) // 4
    assert (vbyte.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks)) == ranks).all()


@pytest.mark.parametrize("alphabet", ["ab' s\n", "It's don't WE'LL'd., \t", "éè́àü aß€😀  \x85\x1c", "ABC019 <|>!?.,", "ΣσΑς İi̇ \x0b\x0c.", "ȩ́ a.,"])
def test_words_have_the_ids_of_whole_texts(library, alphabet):
    tool, rnd = vbyte._Encoder(PATH), random.Random(alphabet)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)] + ["A<|endoftext|>b <|ENDOFTEXT|>."]
    ids, counts = tool.encode(texts)
    for text, end, n in zip(texts, np.cumsum(counts), counts, strict=True):
        assert ids[end - n : end].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_files_against_brute_force(spark, library):
    written = vbyte.write(crowded(documents(spark)).repartition(3), PATH)
    assert rows_of(written) == brute(library, ROWS)
    assert written.ids[0] == 1 or len(written.ids) > 1
    counts = [library.encode(r[1] or "", add_special_tokens=False).ids.count(int(written.ids[0])) for r in ROWS]
    assert sum(counts) >= max(sum(library.encode(r[1] or "", add_special_tokens=False).ids.count(7) for r in ROWS), 1)


def test_frames_split_between_documents(spark, library, monkeypatch):
    rows = [(k, "some words " * (k % 7) + str(k), "", "", 0) for k in range(300)]
    monkeypatch.setattr(vbyte, "FRAME_DOCS", 16)
    assert rows_of(vbyte.write(documents(spark, rows), PATH)) == brute(library, rows)


def test_empty_table(spark):
    written = vbyte.write(empty(spark, DOC), PATH)
    assert written.files == [] and written.read().count() == 0
