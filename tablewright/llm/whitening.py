"""Whitening of vectors, its components found by spectrum slicing.

Components become integers, ``floor(256 * c)``, so that sums are exact. Each distinct
vector counts once; these vectors are written once and read for their sums, for
their covariance (centred before it is multiplied) and for the check of the result.

The driver holds the covariance only, which has the size of a vector squared. The
LDLᵀ factors of the covariance less a shift tell, by their signs, how many eigenvalues
lie below the shift. Bisection by such counts isolates each leading eigenvalue;
Rayleigh quotient iteration from inside its interval converges to it cubically; the
counts just below and above what was found certify its number. Eigenvalues that
counts cannot part are found together, as one subspace.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import importable, stage

#: Partial matrices are added in so many lanes first, so that no group holds those of all tasks.
LANES = 64
#: An eigenvalue below this share of the trace, for each dimension, is rounding.
ROUNDING = 4 * np.finfo(np.float64).eps


def negative_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are below 0: the inertia of its LDLᵀ factors.

    Pivots of one or two rows are chosen so that factors stay bounded; a pivot of
    two rows has one eigenvalue of each sign.
    """
    a = np.array(matrix, np.float64)
    size, k, below = len(a), 0, 0
    bound = (1 + np.sqrt(17)) / 8
    while k < size:
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        if most == 0:
            below += a[k, k] < 0
            k += 1
            continue
        wide = False
        if abs(a[k, k]) < bound * most:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0
            if abs(a[k, k]) * others.max() < bound * most**2:
                wide = abs(a[r, r]) < bound * others.max()
                to = k + 1 if wide else k
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if wide:
            pivot, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            below += 1
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
            k += 2
        else:
            rest = a[k + 1 :, k].copy()
            below += a[k, k] < 0
            a[k + 1 :, k + 1 :] -= np.outer(rest / a[k, k], rest)
            k += 1
    return int(below)


def _solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The solution, also next to an eigenvalue, where its length is of no account."""
    tiny = np.finfo(np.float64).eps * max(1e-300, np.abs(matrix).max())
    for nudge in (0.0, tiny, 16 * tiny):
        try:
            found = np.linalg.solve(matrix + nudge * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    return right


def _unit(x: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """``x`` of length 1, at right angles to the columns of ``apart``."""
    for _ in range(2):
        x = x - apart @ (apart.T @ x)
    return x / max(float(np.linalg.norm(x)), 1e-300)


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, of a covariance and their unit vectors as columns.

    Fewer, if the rest is zero but for rounding. Vectors have their largest entry above 0.
    """
    size = len(matrix)
    trace = float(np.trace(matrix)) if size else 0.0
    least = ROUNDING * size * trace
    if trace <= 0:
        return np.zeros(0), np.zeros((size, 0))
    norm = float(np.abs(matrix).sum(axis=1).max())
    eye, finest = np.eye(size), 4 * np.finfo(np.float64).eps * norm
    counted: dict[float, int] = {}

    def above(shift: float) -> int:
        """Eigenvalues from ``shift`` on."""
        if shift not in counted:
            counted[shift] = size - negative_pivots(matrix - shift * eye)
        return counted[shift]

    random = np.random.default_rng(0)
    values: list[float] = []
    vectors = np.zeros((size, 0))
    while len(values) < min(most, size):
        number = len(values) + 1
        # numbers of eigenvalues from the ends on: at the low end `number` or more, at the high end fewer
        low, high = least, norm * (1 + 1e-12) + finest
        if above(low) < number:
            break
        for shift, count in counted.items():
            low, high = (max(low, shift), high) if count >= number else (low, min(high, shift))
        found = None
        while found is None:
            if above(low) - above(high) == 1 and high - low < 0.1 * high:
                found = _by_quotients(matrix, low, high, vectors, random)
            if found is None and high - low <= finest * 4:
                break
            if found is None:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
        if found is not None and above(found[0] + 64 * finest) < number <= above(found[0] - 64 * finest):
            block = found[1][:, None]
        else:  # counts cannot part them: the whole subspace of this place
            low, high = low - 64 * finest, high + 64 * finest
            block = random.normal(size=(size, max(1, above(low) - len(values))))
            for _ in range(4):
                block = _solved(matrix - (low + high) / 2 * eye, block)
                block -= vectors @ (vectors.T @ block)
                block = np.linalg.qr(block)[0]
            turned = np.linalg.eigh(block.T @ matrix @ block)[1]
            block = (block @ turned)[:, ::-1]
        for column in block.T[: most - len(values)]:
            column = _unit(column, vectors)
            values.append(float(column @ matrix @ column))
            vectors = np.column_stack([vectors, column * np.sign(column[np.abs(column).argmax()])])
    return np.array(values), vectors


def _by_quotients(
    matrix: np.ndarray, low: float, high: float, apart: np.ndarray, random: np.random.Generator
) -> tuple[float, np.ndarray] | None:
    """The only eigenvalue of an interval with its vector; ``None`` if the iteration left the interval."""
    size, eye = len(matrix), np.eye(len(matrix))
    x = _unit(random.normal(size=size), apart)
    for _ in range(3):  # the eigenvalue inside is the nearest to the middle
        x = _unit(_solved(matrix - (low + high) / 2 * eye, x), apart)
    best = np.inf
    for _ in range(40):
        value = float(x @ matrix @ x)
        if not low <= value <= high:
            return None
        off = float(np.linalg.norm(matrix @ x - value * x))
        if off >= best / 2:
            break
        best = off
        x = _unit(_solved(matrix - value * eye, x), apart)
    value = float(x @ matrix @ x)
    near = float(np.linalg.norm(matrix @ x - value * x)) <= 1e3 * np.finfo(np.float64).eps * np.abs(matrix).sum(axis=1).max()
    return (value, x) if near and low <= value <= high else None


@dataclass
class Model:
    """What whitens vectors of one length: their number and sums, eigenvalues, unit vectors, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: whole parts as integers, so that one rounding is left."""
        return _centred(x, self.n, self.sums)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of ``(n * x - S) ** 2``, exact."""
        width = max([1, *(abs(s) for s in self.sums)]) + self.n * int(np.abs(x.astype(np.float64)).max(initial=0) + 1)
        if width**2 * max(1, x.shape[1]) < 2**62:
            far = ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
            return pa.array(far, pa.int64()).cast(pa.decimal128(38, 0), safe=False)
        sums = np.array(self.sums, object)
        return pa.array([Decimal(int(v)) for v in ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)], pa.decimal128(38, 0))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole = [s // n for s in sums]
    part = np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)], np.float64)
    if max([0, *(abs(w) for w in whole)]) < 2**62 and np.abs(x.astype(np.float64)).max(initial=0) < 2.0**62:
        return (x - np.array(whole, np.int64)).astype(np.float64) - part
    return (x.astype(object) - np.array(whole, object)).astype(np.float64) - part


def usable(column: pa.Array, scale: float = 256.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: numbers of the rows that take part, and their integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))[:-1]]).astype(np.int64)
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.nonzero(lengths == length)[0]
        values = flat[starts[rows][:, None] + np.arange(length)]
        fit = np.isfinite(values).all(axis=1)
        whole = np.floor(scale * values[fit])
        if np.abs(whole).max(initial=0) >= 2.0**63:
            raise ValueError("a component does not fit 64 bits")
        yield rows[fit], whole.astype(np.int64)


def _lists(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Packed vectors by their length."""
    for batch in frames:
        found = batch.column(0).to_pylist()
        lengths = np.array([len(v) // 8 for v in found])
        for length in np.unique(lengths):
            rows = [v for v, n in zip(found, lengths, strict=True) if n == length]
            yield int(length), np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), length)


def fit_list(vectors: DataFrame, vector: str, scale: float = 256.0) -> DataFrame:
    """``(vec)``: each distinct vector of integers once, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in usable(batch.column(0), scale):
                packed = [row.astype("<i8").tobytes() for row in x]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["vec"])

    return vectors.select(F.col(vector).cast("array<double>").alias("vec")).mapInArrow(run, "vec binary").distinct()


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length, the number of vectors and the exact sums of their dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for length, x in _lists(batches):
            safe = np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0**62
            total = (x if safe else x.astype(object)).sum(axis=0) if length else np.zeros(0, object)
            n, sums = found.setdefault(length, [0, [0] * length])
            found[length] = [n + len(x), [s + int(t) for s, t in zip(sums, total, strict=True)]]
        for length, (n, sums) in found.items():
            at = [-1, *range(length)]  # -1 is the row of the number
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))],
                names=["length", "at", "total"],
            )

    added = rows.mapInArrow(run, "length int, at int, total decimal(38,0)").groupBy("length", "at").agg(F.sum("total").alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    by = {(row["length"], row["at"]): int(row["total"]) for row in added.collect()}
    for length in sorted({length for length, _ in by}):
        out[length] = by[length, -1], [by[length, at] for at in range(length)]
    return out


def _covariances(rows: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length the covariance, by the number of vectors; partial matrices are added line by line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for length, x in _lists(batches):
            far = _centred(x, *sums[length])
            found[length] = found.get(length, 0.0) + far.T @ far
        task = TaskContext.get().partitionId()
        for length, total in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([task % LANES] * length, pa.int32()),
                    pa.array([task] * length, pa.int32()), pa.array([line.astype("<f8").tobytes() for line in total], pa.binary()),
                ],
                names=["length", "line", "lane", "task", "total"],
            )

    schema = "length int, line int, lane int, task int, total binary"

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task", kind="stable")  # one order of adding, one rounding
        total = np.sum([np.frombuffer(t, "<f8") for t in frame["total"]], axis=0)
        return frame.iloc[:1].assign(total=[total.astype("<f8").tobytes()])

    lanes = rows.mapInArrow(run, schema).groupBy("length", "line", "lane").applyInPandas(add, schema)
    lines = lanes.groupBy("length", "line").applyInPandas(add, schema).collect()
    out = {}
    for length, (n, _) in sums.items():
        own = sorted((row["line"], row["total"]) for row in lines if row["length"] == length)
        matrix = np.array([np.frombuffer(total, "<f8") for _, total in own]).reshape(length, length) / n
        out[length] = (matrix + matrix.T) / 2
    return out


def _identity_error(rows: DataFrame, models: dict[int, Model], length: int) -> float:
    """The largest absolute entry of the covariance of whitened vectors, less the identity."""
    model = models[length]
    width = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, x in _lists(batches):
            if found == length:
                white = model.whitened(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in white.T], names=[f"w{k}" for k in range(width)])

    white = rows.mapInArrow(run, ", ".join(f"w{k} double" for k in range(width)))
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    seen = white.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(seen[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 4, scale: float = 256.0) -> dict[int, Model]:
    """A model for each length of vectors; components whose eigenvalue is only rounding are left out."""
    importable(vectors.sparkSession)
    rows = stage(fit_list(vectors, vector, scale), "whitening-list")
    sums = _sums(rows)
    models = {}
    for length, matrix in _covariances(rows, sums).items():
        values, found = leading(matrix, components)
        models[length] = Model(*sums[length], values, found, float(np.trace(matrix)))
        if len(values):
            models[length].identity_error = _identity_error(rows, models, length)
    return models


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4, scale: float = 256.0) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)`` of each vector and component.

    Vectors that are null or hold null or non-finite entries have no rows. Each length
    of vectors is a space of its own. A null key stays null, a repeated row gives its
    rows as often; other columns take no part. Components whose eigenvalue is zero but
    for rounding do not exist: one vector alone, equal vectors, vectors without entries
    and an empty table give no rows. A component of 2^55 or more is refused.
    ``deviation`` is a decimal of 38 digits.
    """
    models = fit(vectors, vector, components, scale)
    source = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vec"))
    schema = T.StructType([source.schema["key"]])
    for name, kind in (("component", "int"), ("n", "bigint"), ("deviation", "decimal(38,0)"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema.add(name, T._parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in usable(batch.column(1), scale):
                model = models.get(x.shape[1])
                width = len(model.values) if model else 0
                if not width or not len(rows):
                    continue
                each = pa.array(np.repeat(rows, width))
                share = model.values / model.trace
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(each),
                        pa.array(np.tile(np.arange(1, width + 1), len(rows)), pa.int32()),
                        pa.array(np.full(len(each), model.n), pa.int64()),
                        model.deviation(x).take(pa.array(np.repeat(np.arange(len(rows)), width))),
                        pa.array(model.whitened(x).ravel(), pa.float64()),
                        pa.array(np.tile(share, len(rows)), pa.float64()),
                        pa.array(np.full(len(each), model.identity_error), pa.float64()),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
