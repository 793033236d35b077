"""Distinct counts and quantiles that are stored as sketches and merged later.

``sketch`` makes a row per group, whose binary columns hold a HyperLogLog sketch of
distinct values or a KLL sketch of quantiles each. Such a table is kept like any other: groups
that changed are sketched again and replaced by ``delete+insert`` or ``time_interval``.
``merge_sketches`` unites the rows of finer groups, ``estimates`` reads numbers from them.

A sketch has a bounded size, whatever it has seen: about 2 ** ``precision`` bytes for distinct
values, some tens of ``size`` values for quantiles. Sketches are made map-side and merged, so a
hot group moves as one sketch per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote
from ..spec import SpecError

DISTINCT, QUANTILES = "distinct", "quantiles"


@dataclass(frozen=True)
class Sketch:
    """A column of sketches of an expression; NULL and NaN are not seen.

    ``distinct`` tells values apart by their text. Its estimates have a relative standard error
    of ``error`` (1.04 / sqrt(2 ** precision)). ``quantiles`` needs numbers and keeps them as
    doubles; a quantile's true rank is within ``error`` (2.3 / size ** 0.9) of the one asked,
    in 99 of 100 cases.
    """

    name: str
    kind: str
    of: str
    precision: int = 14
    size: int = 800

    def __post_init__(self) -> None:
        if self.kind not in (DISTINCT, QUANTILES):
            raise SpecError(f"a sketch is of {DISTINCT} values or of {QUANTILES}, not {self.kind}")
        if not 4 <= self.precision <= 21 or not 8 <= self.size <= 65535:
            raise SpecError("precision is 4 to 21, size 8 to 65535")

    @property
    def error(self) -> float:
        return 1.04 / sqrt(1 << self.precision) if self.kind == DISTINCT else 2.3 / self.size**0.9

    def made(self, facts: DataFrame) -> Column:
        dtype = facts.select(F.expr(self.of)).schema[0].dataType
        value = F.expr(self.of)
        if self.kind == DISTINCT:
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                value = F.nanvl(value, F.lit(None)) + F.lit(0).cast(dtype)  # one zero
            return F.hll_sketch_agg(value.cast("string"), self.precision).alias(self.name)
        if not isinstance(dtype, T.NumericType):
            raise SpecError(f"quantiles need numbers: {self.of} is {dtype.simpleString()}")
        return F.kll_sketch_agg_double(value.cast("double"), self.size).alias(self.name)

    def merged(self) -> Column:
        column = F.col(quote(self.name))
        return (F.hll_union_agg(column) if self.kind == DISTINCT else F.kll_merge_agg_double(column, self.size)).alias(self.name)


def _checked(by: Sequence[str], sketches: Sequence[Sketch], more: Sequence[str] = ()) -> None:
    names = [*by, *(s.name for s in sketches), *more]
    if not sketches or len({name.lower() for name in names}) < len(names):
        raise SpecError(f"sketches are needed, and all columns with names of their own: {', '.join(names)}")


def _by(names: Sequence[str]) -> list[Column]:
    return [F.col(quote(c)) for c in names]


def sketch(facts: DataFrame, by: Sequence[str], sketches: Sequence[Sketch]) -> DataFrame:
    """A row of sketches per group of ``by``, NULL being a group; without ``by`` one row."""
    _checked(by, sketches)
    return facts.groupBy(*_by(by)).agg(*[s.made(facts) for s in sketches])


def merge_sketches(stored: DataFrame, by: Sequence[str], sketches: Sequence[Sketch]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones; as if made of all their facts."""
    _checked(by, sketches)
    return stored.groupBy(*_by(by)).agg(*[s.merged() for s in sketches])


def estimates(stored: DataFrame, by: Sequence[str], sketches: Sequence[Sketch], at: Sequence[float] = (0.5,)) -> DataFrame:
    """The columns ``by``, and the numbers that their rows' sketches tell.

    ``<name>`` is a distinct count, of quantiles ``<name>`` is an array, one for each rank ``at``,
    and ``<name>_n`` the number of values seen; NULL where none was.
    """
    counts = [f"{s.name}_n" for s in sketches if s.kind == QUANTILES]
    _checked(by, sketches, counts)
    if not all(0 <= rank <= 1 for rank in at) or (counts and not at):
        raise SpecError("ranks are from 0 to 1")
    columns: list[Column] = []
    for s in sketches:
        column = F.col(quote(s.name))
        if s.kind == DISTINCT:
            columns.append(F.hll_sketch_estimate(column).alias(s.name))
            continue
        seen = F.kll_sketch_get_n_double(column)
        ranks = F.array(*[F.lit(float(rank)) for rank in at])
        columns.append(F.when(seen > 0, F.kll_sketch_get_quantile_double(column, ranks)).alias(s.name))
        columns.append(seen.alias(f"{s.name}_n"))
    return stored.select(*_by(by), *columns)
