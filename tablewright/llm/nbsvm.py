"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: words, shapes of words (letters by case,
digits, punctuation as it is) and pairs of shapes, each marked if it repeats the
word, hashed to a fixed number of places. The class log-count ratios come from
all labelled rows that may be learnt from, counted where they are; they scale the
indicators. On the scaled, normalised rows of a bounded sample a linear
hinge-loss model is fitted by dual coordinate descent, and a logistic curve turns
its margins, taken out of fold, into scores. Every whole text is scored.
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

from tablewright.llm.common import bounded_sample, logistic

#: Places of words, of shapes and of pairs of shapes.
WORDS, SHAPES, PAIRS = 1 << 16, 1 << 12, 1 << 15
PLACES = WORDS + SHAPES + PAIRS
#: Labelled rows on which the linear model is fitted, at most (about).
SAMPLE = 10_000
#: Smoothing of counts, bound of the dual variables, passes over the sample.
SMOOTHING, BOUND, PASSES = 1.0, 1.0, 12
#: Words that a Python worker keeps; it starts anew beyond.
KEPT_WORDS = 500_000
#: Letters of a word; longer ones are cut into pieces, of which each counts as a word.
LONGEST = 64

_LETTERS, _DIGITS, _MARKS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"([\W_])\1{2,}")


def _case(letters: re.Match) -> str:
    run = letters[0]
    if run.isupper():
        return "A" if len(run) == 1 else "AA"
    return "Aa" if run[0].isupper() else "a"


def shape(word: str) -> str:
    """Letters by case, digits as 0, of other characters at most three alike in a row."""
    word = _DIGITS.sub("0", _LETTERS.sub(_case, word))
    return _MARKS.sub(r"\1\1\1", word)


class _Words(dict):
    """word -> its place and the code of its shape, in one integer."""

    def __missing__(self, word: str) -> int:
        place = xxhash.xxh32_intdigest(word.lower()) % WORDS
        code = self[word] = place << 32 | xxhash.xxh32_intdigest(shape(word))
        return code


_words = _Words()


def features(text: str | None) -> np.ndarray:
    """Places of the n-grams that a text has, ascending; none for an empty text."""
    if len(_words) > KEPT_WORDS:
        _words.clear()
    words = (text or "").split()
    if max(map(len, words), default=0) > LONGEST:
        words = [word[k : k + LONGEST] for word in words for k in range(0, len(word), LONGEST)]
    codes = np.fromiter(map(_words.__getitem__, words), np.int64, len(words))
    shapes = codes & 0xFFFFFFFF
    same = codes[1:] == codes[:-1]
    pairs = (shapes[1:] * 31 + shapes[:-1] * 1_000_003) * 2 + same
    pairs = (pairs ^ pairs >> 17) % PAIRS
    return np.unique(np.concatenate([codes >> 32, WORDS + shapes % SHAPES, WORDS + SHAPES + pairs]))


@dataclass
class Model:
    """``weights`` of the places already hold the ratios; ``squares`` are the ratios squared, for the norm."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    offset: float
    prior: float | None = None

    def score(self, places: np.ndarray) -> float:
        if self.prior is not None:
            return self.prior
        norm = np.sqrt(self.squares[places].sum()) or 1.0
        margin = self.weights[places].sum() / norm + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Labelled texts with each n-gram and, last, all of them; of label 1 and of label 0."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((2, PLACES + 1), np.int64)
        for frame in frames:
            for text, label in zip(frame["text"], frame["label"], strict=True):
                mine = found[0 if label else 1]
                mine[features(text)] += 1
                mine[-1] += 1
        at = np.flatnonzero(found.any(axis=0))
        yield pd.DataFrame({"place": at, "ones": found[0, at], "zeros": found[1, at]})

    partial = rows.select("text", "label").mapInPandas(run, "place int, ones long, zeros long")
    # one row per place at most, however many documents there are
    total = partial.groupBy("place").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toPandas()
    ones, zeros = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    ones[total["place"]], zeros[total["place"]] = total["ones"], total["zeros"]
    return ones, zeros


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, width: int, passes: int = PASSES, seed: int = 1) -> np.ndarray:
    """Weights of a linear hinge-loss model, last the constant, by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    weights, duals = np.zeros(width + 1), np.zeros(len(rows))
    squares = np.array([(values**2).sum() + 1.0 for _, values in rows])
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, values = rows[i]
            y = labels[i]
            gradient = y * (weights[at] @ values + weights[-1]) - 1
            fresh = min(max(duals[i] - gradient / squares[i], 0.0), BOUND)
            if fresh != duals[i]:
                step = (fresh - duals[i]) * y
                weights[at] += step * values
                weights[-1] += step
                duals[i] = fresh
    return weights


def fit(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``(doc_id, text, label)``; ratios from all rows, weights from about ``sample`` different ones of them.

    Without rows of both labels the model gives every text the share of ones, or
    0.5 if there are no rows.
    """
    ones, zeros = counts(rows)
    if not ones[-1] or not zeros[-1]:
        prior = float(ones[-1] / (ones[-1] + zeros[-1])) if ones[-1] + zeros[-1] else 0.5
        return Model(np.zeros(1), np.zeros(1), 1.0, 0.0, prior)
    p, q = ones[:-1] + SMOOTHING, zeros[:-1] + SMOOTHING
    ratios = np.log(p / p.sum()) - np.log(q / q.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_py()).astype("<u4").tobytes() for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["places", "label"])

    sizes = [float(zeros[-1]), float(ones[-1])]
    # A rare label has a tenth of the sample, or all its rows; the curve takes that back.
    wanted = [max(sample * size / sum(sizes), min(size, sample / 10)) for size in sizes]
    parts = [bounded_sample(rows.where(F.col("label") == label), wanted[label], sizes[label]) for label in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select("text", "label")
    got = sorted(map(tuple, chosen.mapInArrow(run, "places binary, label int").collect()))
    scaled = []
    for places, _ in got:
        at = np.frombuffer(places, "<u4").astype(np.int64)
        values = ratios[at]
        scaled.append((at, values / (np.linalg.norm(values) or 1.0)))
    labels = np.array([1.0 if label else -1.0 for _, label in got])
    margins = np.zeros(len(scaled))
    fold = np.random.default_rng(0).integers(0, 2, len(scaled))
    for part in (0, 1):
        mine = np.flatnonzero(fold != part)
        if len(set(labels[mine])) < 2:
            mine = np.arange(len(scaled))
        weights = descend([scaled[i] for i in mine], labels[mine], PLACES)
        for i in np.flatnonzero(fold == part):
            margins[i] = weights[scaled[i][0]] @ scaled[i][1] + weights[-1]
    weights = descend(scaled, labels, PLACES)
    slope, offset = logistic(margins, labels > 0)
    drawn = [(labels < 0).sum(), (labels > 0).sum()]
    offset += float(np.log(sizes[1] / drawn[1]) - np.log(sizes[0] / drawn[0]))
    return Model(np.append(weights[:-1] * ratios, weights[-1]), ratios**2, slope, offset)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``into``, in 0 to 1.

    A null text counts as empty; an empty text gets the score of no features. Rows
    stay one to one; a column called ``into`` is replaced.
    """
    kept = docs.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many weights as places
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for batch in batches:
            found = [use.score(features(x.as_py())) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, schema)
