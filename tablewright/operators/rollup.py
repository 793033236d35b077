"""Totals over a hierarchy of groups, made whole or kept up to date.

A rollup table has a row per group of each level, from the leaves to the grand total:

* the grouping columns, NULL above their level;
* ``grouping_id``, whose bits tell the columns that are totalled (the first column has
  the highest bit), so a NULL group differs from a total;
* ``node``, text that names the row: the key by which rows are replaced;
* the measures, which merge: a level is totalled from the level below it.

Facts are read once, for the leaves; the levels above are totalled from these. A
refresh reads the facts of the changed leaves only, and of the stored rows only the
children of groups that contain one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import quote
from ..plans.change import NOTHING, Change
from ..plans.sizing import Limits, measure
from ..spec import SpecError
from .strategies import replace_keys

NODE, LEVEL = "node", "grouping_id"
_OVER = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}  # how totals of each merge


@dataclass(frozen=True)
class Measure:
    """A column of totals: ``count``, ``sum``, ``min`` or ``max`` of an expression.

    Rows are counted where the expression is not NULL, all by ``"1"``. Sums of floating
    point numbers depend on the order of rows; decimals do not.
    """

    name: str
    function: str
    of: str = "1"

    def __post_init__(self) -> None:
        if self.function not in _OVER:
            raise SpecError(f"{self.function} does not merge; use one of {', '.join(_OVER)}")

    def first(self) -> Column:
        function = F.count if self.function == "count" else _OVER[self.function]
        return function(F.expr(self.of)).alias(self.name)

    def merged(self, dtype: str) -> Column:
        return _OVER[self.function](F.col(quote(self.name))).cast(dtype).alias(self.name)


def _checked(by: Sequence[str], measures: Sequence[Measure]) -> None:
    names = [*by, *(m.name for m in measures), NODE, LEVEL]
    if not by or len({name.lower() for name in names}) < len(names):
        raise SpecError(f"a rollup needs grouping columns, and all its columns names of their own: {', '.join(names)}")


def _leaves(facts: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return facts.groupBy(*[F.col(quote(c)) for c in by]).agg(*[m.first() for m in measures])


def _node(by: Sequence[str]) -> Column:
    """Names a row: the totalled columns by the level, the others by their values, which JSON quotes."""
    values = F.to_json(F.struct(*[F.col(quote(c)).cast("string").alias(f"g{i}") for i, c in enumerate(by)]))
    return F.concat(F.col(LEVEL).cast("string"), F.lit(":"), values)


def _shaped(rows: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    named = rows.withColumn(NODE, _node(by))
    return named.select(*[quote(c) for c in by], LEVEL, NODE, *[quote(m.name) for m in measures])


def grouping_sets(
    facts: DataFrame, by: Sequence[str], measures: Sequence[Measure], sets: Sequence[Sequence[str]]
) -> DataFrame:
    """The totals of each set of grouping columns; a set may be empty. No facts, no rows."""
    _checked(by, measures)
    leaves = _leaves(facts, by, measures)
    types = {f.name: f.dataType.simpleString() for f in leaves.schema}
    wanted = [[F.col(quote(c)) for c in names] for names in sets]
    totals = leaves.groupingSets(wanted, *[F.col(quote(c)) for c in by]).agg(
        F.grouping_id().cast("long").alias(LEVEL), *[m.merged(types[m.name]) for m in measures]
    )
    return _shaped(totals, by, measures)


def rollup(facts: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The totals of every prefix of ``by``, from all columns to none."""
    return grouping_sets(facts, by, measures, [by[:k] for k in range(len(by), -1, -1)])


def cube(facts: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The totals of every subset of ``by``."""
    sets = [[c for i, c in enumerate(by) if mask >> i & 1] for mask in range(1 << len(by))]
    return grouping_sets(facts, by, measures, sets)


def refresh(
    target: DataFrame,
    facts: DataFrame,
    changed: DataFrame,
    by: Sequence[str],
    measures: Sequence[Measure],
    limits: Limits = Limits(),
    stage: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Change:
    """How a rollup of ``facts`` as they are now differs from the stored ``target``.

    ``changed`` names the leaf groups, by the columns ``by``, whose facts changed, came or
    went since. Groups without facts are dropped. Each level's new rows are put through
    ``stage``, as the next level and the result read them.
    """
    _checked(by, measures)
    types = {f.name: f.dataType.simpleString() for f in target.schema}
    changed = stage(changed.select(*[F.col(quote(c)).cast(types[c]).alias(c) for c in by]).distinct())
    size = measure(changed)
    if not size.rows:
        return Change(NOTHING, target.limit(0))
    small = size.fits_broadcast(limits)

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if small else rows  # prefixes of ``changed``: no more rows, no wider

    def of(rows: DataFrame, prefixes: DataFrame, names: Sequence[str], how: str) -> DataFrame:
        """The rows that belong, or do not, to a group of the prefixes, NULL being a value."""
        if not names:
            return rows if how == "left_semi" else rows.limit(0)
        plain = prefixes.select(*[F.col(quote(c)).alias(f"__p{i}") for i, c in enumerate(names)])
        same = reduce(Column.__and__, [F.col(quote(c)).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(names)])
        return rows.join(side(plain), same, how)

    def level(k: int) -> int:
        return (1 << (len(by) - k)) - 1

    gone, new = [], []
    below = None
    for k in range(len(by), -1, -1):
        names = list(by[:k])
        touched = changed.select(*[quote(c) for c in names]).distinct() if names else changed.limit(1).select()
        if k == len(by):
            rows = _leaves(of(facts, changed, by, "left_semi"), by, measures)
            rows = rows.select(*[F.col(quote(f)).cast(types[f]).alias(f) for f in (*by, *(m.name for m in measures))])
        else:
            children = of(target.filter(F.col(LEVEL) == level(k + 1)), touched, names, "left_semi")
            others = of(children, changed.select(*[quote(c) for c in by[: k + 1]]).distinct(), by[: k + 1], "left_anti")
            parts = others.select(*below.columns).union(below)
            upper = [F.lit(None).cast(types[c]).alias(c) if c not in names else F.col(quote(c)) for c in by]
            # Grouped by a constant, too: no child, no total.
            rows = parts.groupBy(F.lit(k).alias("__k"), *[F.col(quote(c)) for c in names]).agg(*[m.merged(types[m.name]) for m in measures])
            rows = rows.select(*upper, *[quote(m.name) for m in measures])
        below = stage(rows)
        new.append(_shaped(below.withColumn(LEVEL, F.lit(level(k)).cast("long")), by, measures))
        left = [F.lit(None).cast(types[c]).alias(c) for c in by[k:]]
        gone.append(touched.select("*", *left, F.lit(level(k)).cast("long").alias(LEVEL)).select(_node(by).alias(NODE)))
    rows = reduce(DataFrame.union, new).select(*[quote(c) for c in target.columns])
    return replace_keys(target, reduce(DataFrame.union, gone), rows, (), limits)
