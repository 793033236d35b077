"""Token ids in files of byte-aligned variable length, with separate control bytes.

Ids are replaced by their rank in frequency over the whole corpus, so common ids
take one byte. A frame of a file holds, after its head, the document ids, the
lengths of documents, two control bits per token (bytes of its rank less one, four
tokens to a byte) and then the bytes of the ranks. It is decoded without a loop
over tokens: control bytes index a table of byte lengths, their running sum gives
the places, and ranks index the table of ids.

Documents are encoded once by the tokenizers library and staged as raw ids; ranks
come from counts over all of them (as many rows as the vocabulary has ids). Files
are written in ascending order of keys, one or more frames each, under names of
their own attempt: a task that runs twice leaves a file that no manifest names.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import new_folder, stage, unstage

#: Format of a frame's head: magic, documents, tokens, data bytes.
HEAD = "<4sQQQ"
MAGIC = b"TWV1"
#: Tokens and documents of a frame, about; a longer document has a frame of its own.
FRAME_TOKENS, FRAME_DOCS = 1 << 20, 4096
#: Words whose ids a Python worker keeps; it starts anew beyond.
KEPT_WORDS = 1_000_000
#: Letters of the texts that are encoded together, about; a longer text is alone.
LETTERS = 8 << 20

#: By control byte: bytes of each of its four ranks.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
#: By length: the bits of four bytes that belong to the rank.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(codes)] = codes
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of control and data bytes."""
    lengths = LENGTHS[control].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    ranks = padded[starts].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        ranks |= padded[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks & MASKS[lengths]


#: Of Latin-1, the ASCII signs but the apostrophe, which begins endings, and all else that is no letter, number or space.
SIGNS = "!-&(-/:-@\\[-`{-~"
OTHERS = "\x00-\x08\x0e-\x1f'\x7f-\x84\x86-\x9f¡-©«-±´¶-¸»¿×÷"
#: A whole run of such signs: a piece of its own for the tokenizer, whatever stands around.
SIGN_RUN = re.compile(f"[{SIGNS}](?<![{SIGNS}{OTHERS}][{SIGNS}])[{SIGNS}]*+(?![{OTHERS}])")


class _Encoder:
    """A tokenizer of the library, with the ids of common words kept as raw bytes.

    ASCII white space parts words for it whatever stands around, so a text's ids
    are those of its words in order. It lowers letters and parts runs of signs from
    letters and numbers. In texts of Latin-1 letters, whose lowering is plain and which
    are composed already, both are done before texts are split, so that one word serves
    all its forms. In others, words that differ in letters' case or in a full stop or
    comma behind them are encoded once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_padding()
        self.tool.no_truncation()
        self.words: dict[bytes, bytes] = {}
        self.code = "H" if self.tool.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.layout = "<u2" if self.code == "H" else "<u4"
        vocabulary = self.tool.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[bytes]) -> None:
        """Words as they stand in any text."""
        known, cores = self.words, {}
        for word in words:
            core = word if b"<" in word else word.lower()  # special tokens keep their case
            tail = b""
            if core[-1:] in (b".", b",") and _ends_in_letter(core[:-1].decode()):
                core, tail = core[:-1], core[-1:]
            cores[word] = core, tail
        raw = self._ids(list({x for pair in cores.values() for x in pair if x not in known}))
        for word, (core, tail) in cores.items():
            known[word] = (raw.get(core) or known.get(core, b"")) + ((raw.get(tail) or known.get(tail, b"")) if tail else b"")

    def _ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Raw ids of each word."""
        raw, letters, alone = {}, [], []
        for word in words:
            plain = word.decode()
            (letters if plain.isalpha() else alone).append((word, plain))
        # words of letters are one piece each, whose last token alone ends a word: many of them make one text
        groups = [letters[k : k + 200] for k in range(0, len(letters), 200)]
        joined = self.tool.encode_batch_fast([" ".join([plain for _, plain in group]) for group in groups], add_special_tokens=False)
        for group, found in zip(groups, joined, strict=True):
            ids = np.array(found.ids, self.layout)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
            if len(ends) != len(group):
                alone += group
                continue
            ids = ids.tobytes()
            raw.update(zip([word for word, _ in group], [ids[a:b] for a, b in zip([0, *ends], ends)]))
        found = self.tool.encode_batch_fast([plain for _, plain in alone], add_special_tokens=False)
        return raw | {word: array(self.code, x.ids).tobytes() for (word, _), x in zip(alone, found, strict=True)}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, of 16 bits if the vocabulary allows, and how many each text has.

        Words are numbered first, so that each distinct one is looked up once for all texts.
        """
        known = self.words
        if len(known) > KEPT_WORDS:
            known.clear()
        plainly = [_parts_plainly(text) for text in texts]
        parted = [SIGN_RUN.sub(r" \g<0> ", text.lower()) if plain else text for text, plain in zip(texts, plainly, strict=True)]
        split = pc.ascii_split_whitespace(pa.array(parted, pa.large_string()))
        numbered = split.flatten().dictionary_encode()
        distinct = _values(numbered.dictionary)
        raw = list(map(known.get, distinct))
        new = [word for word, ids in zip(distinct, raw, strict=True) if ids is None]
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            if all(plainly):
                known.update(self._ids(part))
            else:
                self._learn(part)
        if new:
            raw = [known[word] for word in distinct]
        ids = np.frombuffer(b"".join(raw), self.layout)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // ids.itemsize
        begins = np.cumsum(sizes) - sizes
        at = numbered.indices.to_numpy()
        each = sizes[at]
        ends = np.cumsum(each)
        found = ids[np.repeat(begins[at] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        words = np.diff(split.offsets.to_numpy())
        upto = np.concatenate([[0], ends])[np.cumsum(words)]
        return found, np.diff(upto, prepend=0)


def _values(strings: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of large strings without nulls."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(at, at[1:])]


def _parts_plainly(text: str) -> bool:
    """Whether it has Latin-1 letters only, and nothing that could be a special token."""
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _ends_in_letter(word: str) -> bool:
    """Whether it does so in the form that the tokenizer sees: composed, in lower case."""
    return unicodedata.normalize("NFC", word[-1:]).lower()[-1:].isalpha()


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def id_type(path: str) -> str:
    """How raw ids of a tokenizer file are laid out."""
    return _encoder(path).layout


def token_ids(docs: DataFrame, path: str, key: str, text: str, end: int) -> DataFrame:
    """``(key, ids)``: raw ids of each document, ``end`` appended."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    last = np.array(end, id_type(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _encoder(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            upto = np.cumsum([len(x) for x in texts], dtype=np.int64)
            start = 0
            while start < len(texts):
                before = upto[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(upto, before + LETTERS, side="right")))
                ids, counts = tool.encode(texts[start:stop])
                ends = np.cumsum(counts)
                raw = np.insert(ids, ends, last)
                places = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * raw.itemsize
                found = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), found.cast(pa.binary())], names=["key", "ids"])
                start = stop

    return source.mapInArrow(run, f"key {kind}, ids binary")


def frequencies(encoded: DataFrame, layout: str = "<u4") -> DataFrame:
    """``(id, n)`` over all documents, counted in each task before they meet."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for frame in frames:
            for start in range(0, len(frame), 1000):
                found = np.bincount(np.frombuffer(b"".join(frame["ids"][start : start + 1000]), layout))
                if len(found) > len(total):
                    found[: len(total)] += total
                    total = found
                else:
                    total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pd.DataFrame({"id": ids, "n": total[ids]})

    return encoded.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


class Written:
    """What was written: the folder, its files in order, ids by rank."""

    def __init__(self, spark: SparkSession, folder: str, key_type: str, files: list, ids: np.ndarray):
        self.spark, self.folder, self.key_type, self.files, self.ids = spark, folder, key_type, files, ids
        counts = [f["tokens"] for f in files]
        self.starts = [0, *np.cumsum(counts).tolist()][: len(files)]

    def read(self) -> DataFrame:
        """``(key, start, n_tokens, ids)`` of each document, decoded from the files.

        ``ids`` are little-endian unsigned 32-bit integers; one task per file, one
        frame in memory at a time.
        """
        names, starts, folder, by_rank = [f["file"] for f in self.files], self.starts, self.folder, self.ids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    start = starts[k]
                    for keys, lengths, ranks in _frames(folder, names[k]):
                        ids = by_rank[ranks].astype("<u4")
                        ends = np.cumsum(lengths)
                        raw = [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(start + ends - lengths), pa.array(lengths), pa.array(raw, pa.binary())],
                            names=["key", "start", "n_tokens", "ids"],
                        )
                        start += int(ends[-1])

        n = len(names)
        files = self.spark.range(0, n, 1, max(n, 1))
        return files.mapInArrow(run, f"key {self.key_type}, start long, n_tokens long, ids binary")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _frames(folder: str, name: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    store, base = _open(folder)
    with store.open_input_stream(f"{base}/{name}") as file:
        while head := file.read(struct.calcsize(HEAD)):
            magic, docs, tokens, data = struct.unpack(HEAD, head)
            if magic != MAGIC:
                raise ValueError(f"{folder}/{name} is not a file of token ids")
            keys = np.frombuffer(file.read(8 * docs), "<i8")
            null = np.frombuffer(file.read(docs), np.uint8).astype(bool)
            lengths = np.frombuffer(file.read(8 * docs), "<i8")
            control = np.frombuffer(file.read(-(-tokens // 4)), np.uint8)
            ranks = decode_ranks(control, np.frombuffer(file.read(data), np.uint8), tokens)
            yield pa.array(keys, mask=null), lengths, ranks


def write(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 1, folder: str | None = None
) -> Written:
    """Encode whole texts with the tokenizer file ``path`` and write them in order of ``key``.

    ``key`` is an integer column; null keys come first, and rows of equal keys in
    the order of their ids. A null text counts as empty: it has the end id only. An
    empty table gives no files. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    kind = docs.schema[key].dataType.simpleString()
    encoded = stage(token_ids(docs, path, key, text, end).select(F.col("key").cast("long").alias("key"), "ids"), "token-ids")
    layout = id_type(path)
    ranked = frequencies(encoded, layout).orderBy(F.desc("n"), "id").toPandas()  # as many rows as the vocabulary has ids
    by_rank = ranked["id"].to_numpy(np.uint32)
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = _open(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.twv"
        rows = tokens = 0
        file = None
        for keys, lengths, ranks in _framed(batches, rank_of, layout):
            if file is None:
                store.create_dir(base)
                file = store.open_output_stream(f"{base}/{name}")
            control, data = encode_ranks(ranks)
            values = keys.fill_null(0).to_numpy(zero_copy_only=False)
            null = keys.is_null().to_numpy(zero_copy_only=False)
            file.write(struct.pack(HEAD, MAGIC, len(keys), len(ranks), len(data)))
            for piece in (values.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), lengths.astype("<i8").tobytes(), control, data):
                file.write(piece)
            rows, tokens = rows + len(keys), tokens + len(ranks)
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [rows], "tokens": [tokens]})

    ordered = encoded.repartitionByRange(F.asc_nulls_first("key"), F.xxhash64("ids")).sortWithinPartitions(
        F.asc_nulls_first("key"), "ids"
    )
    manifest = ordered.mapInArrow(run, "part long, file string, docs long, tokens long")
    files = sorted(manifest.collect(), key=lambda row: row["part"])  # one row per file
    unstage(encoded)
    return Written(spark, folder, kind, [row.asDict() for row in files], by_rank)


def _framed(
    batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, layout: str
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys, lengths and ranks of the frames of a partition."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(layout).itemsize
        start = 0
        while start < batch.num_rows:
            sums = np.cumsum(sizes[start : start + FRAME_DOCS])
            n = max(1, int(np.searchsorted(sums, FRAME_TOKENS, side="right")))
            part = batch.slice(start, n)
            ids = np.frombuffer(b"".join(x.as_buffer() for x in part.column(1)), layout)
            yield part.column(0), sizes[start : start + n], rank_of[ids]
            start += n
