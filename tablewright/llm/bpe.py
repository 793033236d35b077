"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts as one state with an arc for each byte and
accepts any byte sequence; each merge ``a b -> c`` then changes it by one gadget,
in rank order:

1. every state with an arc ``a`` to a state that has an arc ``b`` gets an arc
   ``c``, which leads to a state copied from the one that ``b`` leads to;
2. the state that ``a`` leads to loses its arc ``b``.

In the end it accepts exactly the token sequences that the merges produce. As the
state depends only on the last token, a state carries that token's id. Copies are
kept as references to what they copy and when ("row" of a state, "column" of an
arc), removals with their time: 50,000 merges fill a few lists instead of a table
of 2.5 billion arcs. An arc is looked up by following the copies back in time;
arcs met are kept in a transition table.

A prefix of a word has one accepted sequence only, so a word is encoded by
following the longest arcs first and never trying a position twice. Decoding
emits the arcs' labels.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the pattern by which the vocabulary's pre-tokenizer splits text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words and arcs that a Python worker keeps at most; it starts anew beyond.
KEPT_WORDS = 300_000
KEPT_ARCS = 1_000_000
#: Bytes of the longest word that is kept.
LONGEST_KEPT = 64

_AGES = 1 << 62


class Automaton:
    """Merges compiled gadget by gadget; ``labels[state]`` is the token of a state's arcs in."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.size = max(labels) + 1
        self.labels = [labels.get(i, b"") for i in range(self.size)]
        self.ids = {label: i for i, label in labels.items()}
        made = {c for _, _, c in merges}
        self.row, self.row_at = [-1] * self.size, [-1] * self.size
        self.column, self.column_at = [-1] * self.size, [-1] * self.size
        self.cut: dict[int, int] = {}
        self.known: dict[int, bool] = {}
        ready = {i for i in labels if i not in made}
        if any(len(labels[i]) != 1 for i in ready) or len(made) != len(merges):
            raise ValueError("every token must be a byte or the result of one merge")
        for rank, (a, b, c) in enumerate(merges):
            if a not in ready or b not in ready or labels[a] + labels[b] != labels[c]:
                raise ValueError(f"merge {rank} uses a token that no earlier merge makes")
            self._gadget(2 * rank, a, b, c)
            ready.add(c)
        self.longest = max(map(len, self.ids))

    def _gadget(self, at: int, a: int, b: int, c: int) -> None:
        if not self._arc(a, b, at):
            del self.ids[self.labels[c]]  # earlier merges always part a from b
            return
        self.row[c], self.row_at[c] = b, at
        self.cut[a * self.size + b] = at + 1
        self.column[c], self.column_at[c] = a, at + 2

    def _arc(self, state: int, token: int, at: int = _AGES) -> bool:
        """Whether ``state`` has an arc ``token`` at a time."""
        while True:
            if self.cut.get(state * self.size + token, _AGES) < at:
                return False
            by_row, by_column = self.row_at[state], self.column_at[token]
            if by_row < 0 and by_column < 0:
                return True
            if by_row > by_column:
                state, at = self.row[state], by_row
            else:
                token, at = self.column[token], by_column

    def step(self, state: int, token: int) -> bool:
        key = state * self.size + token
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KEPT_ARCS:
                self.known.clear()
            found = self.known[key] = self._arc(state, token)
        return found

    def encode(self, word: bytes) -> tuple[int, ...]:
        """The one accepted sequence of a word's bytes."""
        ids, step, longest, n = self.ids, self.step, self.longest, len(word)
        path: list[int] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, end = 0, min(n, longest)
        while at < n:
            while end > at:
                token = ids.get(word[at:end])
                if token is not None and end not in dead and (not path or step(path[-1], token)):
                    break
                end -= 1
            if end > at:
                path.append(token)
                starts.append(at)
                at, end = end, min(n, end + longest)
            elif path:
                dead.add(at)
                path.pop()
                at, end = starts.pop(), at - 1
            else:
                raise ValueError(f"byte {word[:1]!r} is not in the vocabulary")
        return tuple(path)


class Codec:
    """A tokenizer file's automaton with its added tokens and its way of splitting text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (
            model["type"] != "BPE"
            or spec["normalizer"] is not None
            or pre["type"] != "ByteLevel"
            or pre["add_prefix_space"]
            or not pre["use_regex"]
            or any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix"))
        ):
            raise ValueError("only plain byte-level BPE files are supported")
        byte_of = _byte_of()
        labels = {i: bytes(byte_of[x] for x in token) for token, i in model["vocab"].items()}
        ids = {label: i for i, label in labels.items()}
        merges = []
        for pair in model["merges"]:
            a, b = (ids[bytes(byte_of[x] for x in y)] for y in (pair.split(" ") if isinstance(pair, str) else pair))
            merges.append((a, b, ids[labels[a] + labels[b]]))
        self.automaton = Automaton(labels, merges)
        self.added = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token {token['content']} strips its surroundings")
            self.added[token["content"]] = token["id"]
        self.labels = dict(enumerate(self.automaton.labels))
        self.labels |= {i: content.encode() for content, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.pieces = regex.compile(PIECES)
        self.words = _Words(self.automaton)

    def encode(self, text: str) -> list[int]:
        parts = self.special.split(text) if self.special else [text]
        ids: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.added[part])
            elif part:
                ids.extend(chain.from_iterable(map(self.words.__getitem__, self.pieces.findall(part))))
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class _Words(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, piece: str) -> tuple[int, ...]:
        word = piece.encode()
        ids = self.automaton.encode(word)
        if len(word) <= LONGEST_KEPT:
            self[piece] = ids
        return ids


def _byte_of() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, the other way round."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if chr(b) not in found]
    return found | {chr(256 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "tokens", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of the whole ``text`` in ``into`` (array of int).

    A null text counts as empty and has no ids. Columns called ``into`` or
    ``decoded`` are replaced, all others stay; rows stay one to one, repeated ones
    too. ``decoded`` names a column for the text decoded from these ids.
    """
    kept = docs.drop(into, *([decoded] if decoded else []))
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        schema = schema.add(decoded, T.StringType(), False)
    at = docs.columns.index(text)
    source = docs.select(*kept.columns, docs[docs.columns[at]].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for part in _cut(batch):
                texts = part.column(part.num_columns - 1)
                lists = [tool.encode(x.as_py() or "") for x in texts]
                arrays = [*part.columns[:-1], _lists(lists)]
                names = [*part.schema.names[:-1], into]
                if decoded:
                    arrays.append(pa.array([tool.decode(x) for x in lists], pa.string()))
                    names.append(decoded)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of their ids in ``into``; null ids give an empty text."""
    kept = docs.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            ids = batch.column(batch.schema.names.index(tokens))
            texts = pa.array([tool.decode(x.as_py() or ()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Slices whose ids fit the memory of a worker."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _lists(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), type=kind)
