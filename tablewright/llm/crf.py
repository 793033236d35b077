"""Toxicity: a linear-chain conditional random field over tokens.

Token labels come from the documents' labels: a word is offending if nearly all
labelled documents that use it are toxic and it stands in many different contexts
there (copies of one toxic text give its words one context each). These counts
cover all rows that may be learnt from. Windows around labelled tokens of a
bounded sample, and windows of clean documents, train the field: two tags, weights of words and of transitions,
by sign-based gradient steps on the exact likelihood. Words of few windows share one weight,
which also stands for words never seen.

Forward-backward gives each token of every whole text the probability of its tag.
The chain of a batch is cut in blocks whose transfer matrices are multiplied
first, so a text of any length takes a fixed number of array steps. A document's
score is a logistic curve of its evidence, the sum of its tokens' squared
probabilities (so the small doubts of a long text don't add up); the offending offsets are runs of tokens that are more likely offending than not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import bounded_sample, logistic, stage, unstage

TOKEN = re.compile(r"[^\W_]+")
#: A word is offending if this share of its documents is toxic, if so many of 64 context bits are set, and
#: if that many toxic documents use it that chance gives less than ``CHANCE`` such words in all.
SHARE, CONTEXTS, CHANCE = 0.9, 6, 0.01
#: Windows in which a word must occur to have a weight of its own.
OWN_WEIGHT = 5
#: Labelled documents of either label whose windows train the field, and that fit the curve, at most (about).
SAMPLE, CURVE = 3_000, 20_000
#: Tokens on either side of a labelled token; windows of one document.
SIDE, WINDOWS = 10, 3
#: Gradient steps, weight of the ridge.
STEPS, RIDGE = 60, 0.1
#: Tokens of a block of the chain; tokens worked on at once.
BLOCK, AT_ONCE = 64, 1 << 20
KEPT_WORDS = 500_000


def key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.lower()) >> 1


# --- token labels ---------------------------------------------------------------


def offending_words(rows: DataFrame, base: float) -> set[int]:
    """Keys of the words that mark toxic documents, from all rows ``(text, label)``; ``base`` is the toxic share."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic: dict[str, list[int]] = {}
        clean: dict[str, int] = {}

        def out() -> Iterator[pd.DataFrame]:
            if toxic:
                yield pd.DataFrame({"word": [key(w) for w in toxic], "toxic": [x[0] for x in toxic.values()], "clean": 0, "seen": np.array([x[1] for x in toxic.values()], np.uint64).view(np.int64)})
            if clean:
                yield pd.DataFrame({"word": [key(w) for w in clean], "toxic": 0, "clean": list(clean.values()), "seen": 0})
            toxic.clear()
            clean.clear()

        for frame in frames:
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = TOKEN.findall((text or "").lower())
                if not label:
                    for word in set(words):
                        clean[word] = clean.get(word, 0) + 1
                else:
                    before = dict(zip(words, ["", *words], strict=False))
                    for word, last in before.items():
                        mine = toxic.setdefault(word, [0, 0])
                        mine[0] += 1
                        mine[1] |= 1 << (xxhash.xxh32_intdigest(last) & 63)
                if len(clean) + len(toxic) > KEPT_WORDS:
                    yield from out()
        yield from out()

    partial = rows.select("text", "label").mapInPandas(run, "word long, toxic long, clean long, seen long")
    total = stage(
        partial.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("seen").alias("seen")), "crf-words"
    )
    least = np.log(max(total.count(), 1) / CHANCE) / -np.log(min(max(base, 1e-9), 0.999))
    found = total.where(
        (F.col("toxic") >= float(least)) & (F.col("toxic") >= SHARE * (F.col("toxic") + F.col("clean"))) & (F.bit_count("seen") >= CONTEXTS)
    )
    # words of many contexts in toxic documents and next to none in others: a part of the vocabulary
    return {row["word"] for row in found.select("word").collect()}


def windows(rows: DataFrame, lexicon: set[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys of words, tags) of training windows of a bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            places, tags = [], []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = TOKEN.findall(text or "")
                if not words:
                    continue
                keys = np.array([key(w) for w in words], np.int64)
                marked = np.isin(keys, list(known)) if label else np.zeros(len(keys), bool)
                centres = np.flatnonzero(marked)[:: max(1, int(marked.sum()) // WINDOWS)][:WINDOWS] if marked.any() else []
                if not label:
                    centres = np.linspace(0, len(words) - 1, WINDOWS + 2).astype(int)[1:-1]
                for c in centres:
                    part = slice(max(0, c - SIDE), c + SIDE + 1)
                    places.append(keys[part].astype("<i8").tobytes())
                    tags.append(marked[part].astype(np.uint8).tobytes())
            yield pd.DataFrame({"words": places, "tags": tags})

    got = rows.select("text", "label").mapInPandas(run, "words binary, tags binary").collect()
    return [(np.frombuffer(p, "<i8"), np.frombuffer(t, np.uint8).astype(np.int64)) for p, t in sorted(map(tuple, got))]


# --- the field ------------------------------------------------------------------


@dataclass
class Field:
    """``words`` weigh a word under the offending tag against the clean one, ``rest`` all words without a weight
    of their own; ``moves[i, j]`` weighs tag i before j."""

    words: dict[int, float]
    rest: float
    start: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def curve(self, evidence: np.ndarray) -> np.ndarray:
        raw = self.slope * np.log1p(evidence * 10) + self.offset
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def marginals(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the offending tag at every token of many chains laid end to end.

    ``scores`` weigh the offending tag, ``first`` marks where a chain begins. A
    chain's first matrix has equal rows, so nothing passes from the chain before.
    """
    n = len(scores)
    if not n:
        return np.zeros(0)
    blocks = -(-n // BLOCK)
    odds = np.ones(blocks * BLOCK)
    odds[:n] = np.exp(np.clip(scores, -30, 30))
    begins = np.ones(blocks * BLOCK, bool)
    begins[:n] = first
    s, m = np.exp(start), np.exp(moves)
    step = np.where(begins[:, None, None], s[None, None, :], m[None])  # [token, from, to]
    step[:, :, 1] *= odds[:, None]
    step /= step.max(axis=(1, 2))[:, None, None]
    step = step.reshape(blocks, BLOCK, 2, 2)
    product = step[:, 0].copy()
    for k in range(1, BLOCK):
        product = product @ step[:, k]
        product /= product.max(axis=(1, 2))[:, None, None]
    ahead, behind = np.ones((blocks, 2)), np.ones((blocks, 2))
    a, b = np.ones(2), np.ones(2)
    for k in range(blocks):
        ahead[k] = a
        a = a @ product[k]
        a /= a.sum()
    for k in range(blocks - 1, -1, -1):
        behind[k] = b
        b = product[k] @ b
        b /= b.sum()
    forward = np.empty((blocks, BLOCK, 2))
    for k in range(BLOCK):
        ahead = np.einsum("bi,bij->bj", ahead, step[:, k])
        ahead /= ahead.sum(axis=1, keepdims=True)
        forward[:, k] = ahead
    for k in range(BLOCK - 1, -1, -1):
        forward[:, k] *= behind
        behind = np.einsum("bij,bj->bi", step[:, k], behind)
        behind /= behind.sum(axis=1, keepdims=True)
    both = forward.reshape(-1, 2)[:n]
    return both[:, 1] / both.sum(axis=1)


def train(data: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """A field that makes the tags of the windows likely: full gradients, steps by place."""
    field = Field({}, 0.0, np.zeros(2), np.zeros((2, 2)))
    if not any(tags.any() for _, tags in data):
        field.rest = -30.0
        return field
    sizes = [len(tags) for _, tags in data]
    tags = np.concatenate([t for _, t in data])
    first = np.zeros(len(tags), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    every, at, often = np.unique(np.concatenate([p for p, _ in data]), return_inverse=True, return_counts=True)
    own = often >= OWN_WEIGHT
    used = every[own]
    at = np.where(own, np.cumsum(own) - 1, len(used))[at]  # the last weight is that of the rest
    weights, seen = np.zeros(len(used) + 1), np.bincount(at, tags, len(used) + 1)
    pairs = ~first[1:]
    real = np.zeros((2, 2))
    np.add.at(real, (tags[:-1][pairs], tags[1:][pairs]), 1)
    real_start = np.bincount(tags[first], minlength=2)
    values = (weights, field.start, field.moves)
    sizes_of = [np.full(v.shape, 0.5) for v in values]
    last = [np.zeros(v.shape) for v in values]
    for _ in range(STEPS):
        p = marginals(weights[at], first, field.start, field.moves)
        both = _pairs(weights[at], p, first, field)
        expected = np.array([[x[pairs].sum() for x in row] for row in both])
        start = np.array([(1 - p[first]).sum(), p[first].sum()])
        model = (np.bincount(at, p, len(weights)), start, expected)
        for k, (value, of_data, of_model) in enumerate(zip(values, (seen, real_start, real), model, strict=True)):
            gradient = of_data - of_model - RIDGE * value
            # a place's step grows while its gradient keeps the sign and shrinks when it turns
            turned = gradient * last[k]
            sizes_of[k] = np.clip(sizes_of[k] * np.where(turned > 0, 1.2, np.where(turned < 0, 0.5, 1.0)), 1e-6, 2.0)
            last[k] = np.where(turned < 0, 0.0, gradient)
            value += np.sign(last[k]) * sizes_of[k]
    field.words, field.rest = dict(zip(used.tolist(), weights.tolist(), strict=False)), float(weights[-1])
    return field


def _pairs(scores: np.ndarray, p: np.ndarray, first: np.ndarray, field: Field) -> list[list[np.ndarray]]:
    """Probabilities of the tags of neighbours, from those of single tokens.

    In a chain of two tags, what follows a tag is a mixture whose weights solve the
    two marginals and the odds ratio of the four cells, which the field gives.
    """
    a, b = p[:-1], p[1:]  # of the offending tag before and after
    m = np.exp(field.moves)
    ratio = m[0, 0] * m[1, 1] / (m[0, 1] * m[1, 0])
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        root = np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0))
        both = np.minimum((s - root) / (2 * (ratio - 1)), np.minimum(a, b))
    return [[1 - a - b + both, b - both], [a - both, both]]


# --- texts ----------------------------------------------------------------------


class _Tagger:
    def __init__(self, field: Field):
        self.field = field
        self.known = _Scores(field)

    def tag(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Tokens and probabilities of each text."""
        held, size = [], 0
        for text in texts:
            held.append(TOKEN.findall(text or ""))
            size += len(held[-1])
            if size >= AT_ONCE:
                yield from self._tag(held)
                held, size = [], 0
        yield from self._tag(held)

    def _tag(self, held: list[list[str]]) -> Iterator[tuple[list[str], np.ndarray]]:
        sizes = [len(words) for words in held]
        find = self.known.__getitem__
        scores = np.fromiter((find(w) for words in held for w in words), float, sum(sizes))
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        starts = np.cumsum([0, *sizes])
        first = np.zeros(len(scores), bool)
        first[starts[:-1][starts[:-1] < len(scores)]] = True
        p = marginals(scores, first, self.field.start, self.field.moves)
        for words, a, b in zip(held, starts[:-1], starts[1:], strict=True):
            yield words, p[a:b]


class _Scores(dict):
    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        found = self.field.words.get(key(word), self.field.rest)
        if len(word) <= 64:
            self[word] = found
        return found


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Code point offsets of runs of tokens that are offending with at least this probability."""
    found: list[dict] = []
    last = None
    for k, match in enumerate(TOKEN.finditer(text)):
        if p[k] >= least:
            if last == k - 1 and found:
                found[-1]["end"] = match.end()
            else:
                found.append({"start": match.start(), "end": match.end()})
            last = k
    return found


def tagged(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``evidence``, the sum of squared probabilities, and ``spans``.

    A null text counts as empty: no token, no span. Rows stay one to one; columns
    of these names are replaced.
    """
    kept = docs.drop("evidence", "spans")
    places = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*kept.schema.fields, T.StructField("evidence", T.DoubleType()), T.StructField("spans", places)])
    shared = docs.sparkSession.sparkContext.broadcast(field)  # words of the sample's windows
    at = kept.columns.index(text)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(shared.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sums, where = [], []
            for value, (_, p) in zip(texts, tagger.tag(texts), strict=True):
                sums.append(float(p @ p))
                where.append(spans(value, p) if len(p) and p.max() >= 0.5 else [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.float64()), pa.array(where, kind)], names=[*batch.schema.names, "evidence", "spans"]
            )

    return kept.mapInArrow(run, schema)


def fit(rows: DataFrame, sample: int = SAMPLE, curve: int = CURVE) -> Field:
    """A field from ``(doc_id, text, label)``: token labels from all rows, weights and curve from samples.

    Without toxic rows every score is next to 0.
    """
    rows = stage(rows.select("doc_id", "text", "label"), "crf-labelled")
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if not sizes.get(1):
        field = train([])
        field.offset = -12.0
        return field
    chosen = [bounded_sample(rows.where(F.col("label") == label), sample, sizes.get(label, 0)) for label in (0, 1)]
    field = train(windows(chosen[0].unionByName(chosen[1]), offending_words(rows, sizes[1] / sum(sizes.values()))))
    seen = tagged(bounded_sample(rows, curve, sum(sizes.values())), field).select("evidence", "label").toPandas()
    unstage(rows)
    if seen["label"].nunique() < 2:
        field.slope, field.offset = 3.0, -6.0
        return field
    field.slope, field.offset = logistic(np.log1p(seen["evidence"] * 10), seen["label"])
    return field


def score(docs: DataFrame, field: Field, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with ``evidence``, ``spans`` and the score of each whole text in ``into``, in 0 to 1."""
    raw = F.lit(field.slope) * F.log1p(F.col("evidence") * 10) + F.lit(field.offset)
    return tagged(docs, field, text).withColumn(into, 1 / (1 + F.exp(-F.least(F.greatest(raw, F.lit(-500.0)), F.lit(500.0)))))
