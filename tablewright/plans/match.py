"""Match target rows with source rows on a business key.

``match_rows`` is the full outer join that upserts and versioned dimensions
are built on. Its result has the target's columns as ``t0, t1, …``, the
source's as ``s0, s1, …`` and the markers ``in_target`` and ``in_source``.
Keys compare with ``=``, so a NULL key matches nothing.

Three forms give the same rows:

* the source is small: it is broadcast and the target is not shuffled;
* otherwise both sides are shuffled once, rows with a NULL key being spread
  over all partitions since they match nothing;
* keys that hold a large share of the rows are taken out of the shuffle and
  joined with the other side's rows for these few keys, folded to one per key.

A source with several rows for one matched key is an error, raised from a
filter so that no projection can drop it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import Limits, Size, hot_hashes, key_hash, measure
from ..functions.types import quote

_SPREAD = 1024
# Parts of the target rows of a frequent key whose source row is too wide to broadcast.
_SALTS = 32


def any_null(keys: Sequence[str]) -> Column:
    null = F.lit(False)
    for key in keys:
        null = null | F.col(quote(key)).isNull()
    return null


class _Sides:
    """Both inputs with generated column names, so no two names collide."""

    def __init__(self, target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
        self.t_cols = [f"t{i}" for i in range(len(target.columns))]
        self.s_cols = [f"s{i}" for i in range(len(source.columns))]
        self.t_keys = [f"t{target.columns.index(key)}" for key in keys]
        self.s_keys = [f"s{source.columns.index(key)}" for key in keys]
        self.k_cols = [f"k{i}" for i in range(len(keys))]
        self.target = target.toDF(*self.t_cols)
        self.source = source.toDF(*self.s_cols)

    def key_frame(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(key).alias(k) for key, k in zip(keys, self.k_cols)])

    def on_keys(self, left: Sequence[str], right: Sequence[str]) -> Column:
        return _all([F.col(a) == F.col(b) for a, b in zip(left, right)])

    def output(self, df: DataFrame) -> DataFrame:
        """All columns and both markers; a side that is absent is NULL."""
        types = {**_types(self.target), **_types(self.source)}
        cols = [
            F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
            for c in [*self.t_cols, *self.s_cols]
        ]
        marks = [
            (F.col(m).isNotNull() if m in df.columns else F.lit(False)).alias(m)
            for m in ("in_target", "in_source")
        ]
        return df.select(*cols, *marks)


def _types(df: DataFrame) -> dict:
    return {field.name: field.dataType for field in df.schema}


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def _guarded(df: DataFrame) -> DataFrame:
    """Fail when a matched key has more than one source row."""
    twice = F.col("in_target").isNotNull() & F.col("in_source").isNotNull() & (F.col("copies") > 1)
    message = F.lit("the source has several rows for one matched key")
    return df.filter(F.when(twice, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def match_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    limits: Limits = Limits(),
    size: Size | None = None,
) -> DataFrame:
    """Full outer match of ``target`` and ``source``, whose ``keys`` have equal types.

    ``size`` is the source's, where it was measured already.
    """
    sides = _Sides(target, source, keys)
    if (size or measure(source)).fits_broadcast(limits):
        return _small_source(sides)
    hot = hot_hashes(
        [
            frame.filter(~any_null(keys)).select(*[F.col(quote(key)) for key in keys])
            for frame in (target, source)
        ],
        keys,
        limits,
    )
    if not hot:
        return _shuffled(sides)
    t_hot = key_hash(sides.t_keys).isin(hot) & ~any_null(sides.t_keys)
    s_hot = key_hash(sides.s_keys).isin(hot) & ~any_null(sides.s_keys)
    cold = _shuffled(sides, ~t_hot, ~s_hot)
    return cold.unionByName(_few_keys(sides, t_hot, s_hot, limits))


def _small_source(sides: _Sides) -> DataFrame:
    """The source was measured to fit: only its keys' matches leave the target scan."""
    per_key = Window.partitionBy(*sides.s_keys)
    source = sides.source.withColumn("copies", F.count(F.lit(1)).over(per_key)).withColumn(
        "in_source", F.lit(True)
    )
    target = sides.target.withColumn("in_target", F.lit(True))
    updated = target.join(
        F.broadcast(source), sides.on_keys(sides.t_keys, sides.s_keys), "left_outer"
    )
    return sides.output(_guarded(updated)).unionByName(
        sides.output(
            unmatched_small(
                sides.source.withColumn("in_source", F.lit(True)),
                sides.s_keys,
                sides.target,
                sides.t_keys,
            )
        )
    )


def _shuffled(sides: _Sides, t_part: Column | None = None, s_part: Column | None = None) -> DataFrame:
    """One shuffle of each side; the copies of a key are counted in the same partitioning."""
    target = sides.target if t_part is None else sides.target.filter(t_part)
    source = sides.source if s_part is None else sides.source.filter(s_part)
    target = target.withColumn("in_target", F.lit(True)).withColumn(
        "t_spread", _null_spread(sides.t_keys, sides.t_cols)
    )
    source = source.withColumn("in_source", F.lit(True)).withColumn(
        "s_spread", _null_spread(sides.s_keys, sides.s_cols)
    )
    per_key = Window.partitionBy(*sides.s_keys, "s_spread")
    source = source.withColumn("copies", F.count(F.lit(1)).over(per_key))
    on = sides.on_keys([*sides.t_keys, "t_spread"], [*sides.s_keys, "s_spread"])
    return sides.output(_guarded(target.join(source, on, "full_outer")))


def _null_spread(keys: Sequence[str], cols: Sequence[str]) -> Column:
    """0 for whole keys; many values for NULL keys, which would all hash alike.

    The input partition's number tells copies of one row apart and, unlike a
    random number, is the same when a lost task runs again.
    """
    spread = F.spark_partition_id().cast("long") * _SPREAD + F.pmod(
        F.xxhash64(*[F.col(c) for c in cols]), F.lit(_SPREAD)
    )
    return F.when(any_null(keys), spread + 1).otherwise(F.lit(0).cast("long"))


def _few_keys(sides: _Sides, t_hot: Column, s_hot: Column, limits: Limits) -> DataFrame:
    """Join for a bounded set of frequent keys: each side is folded to one row per key.

    The folded source rows are broadcast if their bytes were counted to fit.
    Else the target's rows of a key are spread, and the key's one row repeated.
    """
    target = sides.target.filter(t_hot)
    source = sides.source.filter(s_hot)
    others = [c for c in sides.s_cols if c not in sides.s_keys]
    folded = source.groupBy(*sides.s_keys).agg(
        F.count(F.lit(1)).alias("copies"),
        F.first(F.struct(F.lit(True).alias("in_source"), *others)).alias("rest"),
    )
    folded = folded.select(*sides.s_keys, "copies", "rest.*")
    marked = target.withColumn("in_target", F.lit(True))
    if measure(folded).bytes <= limits.broadcast_bytes:
        updated = marked.join(
            F.broadcast(folded), sides.on_keys(sides.t_keys, sides.s_keys), "left_outer"
        )
    else:
        salts = F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))
        marked = marked.withColumn(
            "t_spread", F.pmod(F.xxhash64(*[F.col(c) for c in sides.t_cols]), F.lit(_SALTS)).cast("long")
        )
        repeated = folded.withColumn("s_spread", F.explode(salts))
        on = sides.on_keys([*sides.t_keys, "t_spread"], [*sides.s_keys, "s_spread"])
        updated = marked.join(repeated, on, "left_outer")
    known = sides.key_frame(target, sides.t_keys).distinct()
    added = source.withColumn("in_source", F.lit(True)).join(
        F.broadcast(known), sides.on_keys(sides.s_keys, sides.k_cols), "left_anti"
    )
    return sides.output(_guarded(updated)).unionByName(sides.output(added))


def unmatched(
    rows: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    null_safe: bool,
    limits: Limits = Limits(),
    known_is_smaller: bool = False,
    size: Size | None = None,
) -> DataFrame:
    """Rows whose key does not occur in ``known``, of which only the keys are read.

    The side that is expected to be smaller is measured (``size`` if its keys
    were already) and, if it fits, broadcast; otherwise both sides are
    shuffled, apart from frequent keys.
    """
    k_cols = [f"k{i}" for i in range(len(keys))]
    known = known.select(*[F.col(quote(key)).alias(k) for key, k in zip(keys, k_cols)])
    r_keys = [f"r{rows.columns.index(key)}" for key in keys]
    names = rows.columns
    rows = rows.toDF(*[f"r{i}" for i in range(len(names))])
    row_keys = rows.select(*[F.col(r).alias(k) for r, k in zip(r_keys, k_cols)])
    on = _same(r_keys, k_cols, null_safe)
    if known_is_smaller:
        if (size or measure(known)).fits_broadcast(limits):
            return rows.join(F.broadcast(known), on, "left_anti").toDF(*names)
    elif (size or measure(row_keys)).fits_broadcast(limits):
        return unmatched_small(rows, r_keys, known, k_cols, null_safe).toDF(*names)

    lone = None
    if not null_safe:
        # NULL keys match nothing, so these rows need no shuffle.
        lone = rows.filter(any_null(r_keys))
        rows = rows.filter(~any_null(r_keys))
        known = known.filter(~any_null(k_cols))
        row_keys = row_keys.filter(~any_null(k_cols))
    hot = hot_hashes([row_keys, known], k_cols, limits)
    if hot:
        r_hot, k_hot = key_hash(r_keys).isin(hot), key_hash(k_cols).isin(hot)
        few = known.filter(k_hot).distinct()
        left = rows.filter(~r_hot).join(known.filter(~k_hot), on, "left_anti")
        left = left.union(rows.filter(r_hot).join(F.broadcast(few), on, "left_anti"))
    else:
        left = rows.join(known, on, "left_anti")
    if lone is not None:
        left = left.union(lone)
    return left.toDF(*names)


def unmatched_small(
    rows: DataFrame,
    s_keys: Sequence[str],
    known: DataFrame,
    t_keys: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """As ``unmatched`` for a source measured to fit a broadcast.

    The target scan keeps only keys the source has, which are no more than the
    source's own, and these are what the source is compared with.
    """
    names = [f"m{i}" for i in range(len(s_keys))]
    wanted = rows.select(*[F.col(k).alias(n) for k, n in zip(s_keys, names)]).distinct()
    found = known.select(*t_keys).join(
        F.broadcast(wanted), _same(t_keys, names, null_safe), "left_semi"
    )
    return rows.join(F.broadcast(found.distinct()), _same(s_keys, t_keys, null_safe), "left_anti")


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    if null_safe:
        return _all([F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])
    return _all([F.col(a) == F.col(b) for a, b in zip(left, right)])
