"""Column quality checks: how many rows break each rule.

A table's checks share one aggregation pass, save ``unique``, which needs one
shuffle of per-key counts for each column. A table that is written whole has its
row checks counted by the write itself (``Watch``). NULLs pass every check but
``not_null``. A check passes when no row breaks it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote
from ..spec import Check, SpecError, TableSpec


class CheckFailed(AssertionError):
    """At least one check found bad rows."""


def bad_row(column: str, check: Check) -> Column:
    """True for the rows that break ``check``."""
    value = F.col(quote(column))
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "positive":
        return value <= 0
    if check.kind == "non_negative":
        return value < 0
    if check.kind == "negative":
        return value >= 0
    if check.kind == "min":
        return value < F.lit(check.value)
    if check.kind == "max":
        return value > F.lit(check.value)
    if check.kind == "accepted_values":
        return ~value.cast("string").isin([str(v) for v in check.value])
    if check.kind == "pattern":
        return ~value.rlike(check.value)
    raise SpecError(f"{check.kind} is not a row check")


def repeated(df: DataFrame, column: str) -> DataFrame:
    """One row ``bad_rows``: values of the column beyond the first of each kind."""
    value = F.col(quote(column)).alias("value")
    per_value = df.select(value).filter(F.col("value").isNotNull()).groupBy("value").count()
    return per_value.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("bad_rows"))


class Watch:
    """Counts a table's row checks while its rows are written, without another pass over them.

    ``apart`` names columns that the table may hold otherwise than the rows do, as the
    partition columns, whose empty strings are stored as NULL; theirs are not counted.
    """

    def __init__(self, spec: TableSpec, apart: Sequence[str] = ()) -> None:
        left = {name.lower() for name in apart}
        self._checks = [
            (i, c.name, check)
            for i, (c, check) in enumerate((c, check) for c in spec.columns for check in c.checks)
            if check.kind != "unique" and c.name.lower() not in left
        ]
        self._seen: Observation | None = None

    def __call__(self, rows: DataFrame) -> DataFrame:
        """``rows`` as they are. To be written next: the counts are of the write's last stage, whose tasks count once."""
        if not self._checks:
            return rows
        self._seen = Observation()
        return rows.observe(
            self._seen, *[F.count_if(bad_row(name, check)).alias(f"c{i}") for i, name, check in self._checks]
        )

    @property
    def counts(self) -> dict[int, int]:
        """Bad rows by the number of the check, once the rows were written."""
        if self._seen is None:
            return {}
        seen = self._seen.get
        return {i: seen[f"c{i}"] for i, _, _ in self._checks}


def run_checks(df: DataFrame, spec: TableSpec, counted: Mapping[int, int] | None = None) -> DataFrame:
    """All checks of a table as rows ``(column, check, bad_rows, passed)``.

    ``counted`` has the bad rows of those that were counted already, as ``Watch.counts``.
    """
    wanted = [(c.name, check) for c in spec.columns for check in c.checks]
    known = [(*wanted[i], bad) for i, bad in (counted or {}).items()]
    rows_checks = [
        (name, check)
        for i, (name, check) in enumerate(wanted)
        if check.kind != "unique" and i not in (counted or {})
    ]
    frames = []
    if known:
        listed = [(name, check.kind, bad) for name, check, bad in known]
        frames.append(df.sparkSession.createDataFrame(listed, "column string, check string, bad_rows long"))
    if rows_checks:
        counts = [
            F.struct(
                F.lit(name).alias("column"),
                F.lit(check.kind).alias("check"),
                F.count_if(bad_row(name, check)).alias("bad_rows"),
            )
            for name, check in rows_checks
        ]
        frames.append(df.agg(F.array(*counts).alias("counts")).select(F.inline("counts")))
    for name, check in wanted:
        if check.kind == "unique":
            frames.append(
                repeated(df, name).select(
                    F.lit(name).alias("column"), F.lit(check.kind).alias("check"), "bad_rows"
                )
            )
    frames = [f.withColumn("passed", F.col("bad_rows") == 0) for f in frames]
    frames += [custom_check(df, check.name, check.query, check.expected) for check in spec.custom_checks]
    if not frames:
        raise SpecError(f"{spec.name} declares no checks")
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result


def custom_check(df: DataFrame, name: str, query: str, expected: int = 0) -> DataFrame:
    """A query's single value, which must equal ``expected`` exactly; no row fails, several raise.

    ``bad_rows`` is the value, rounded away from zero if it is not whole.
    """
    found = df.sparkSession.sql(query)
    kind = found.schema[0].dataType
    value = F.first(F.col(quote(found.columns[0])))
    if isinstance(kind, T.BooleanType):
        value = value.cast("int")
    elif not isinstance(kind, T.NumericType):
        value = value.try_cast("decimal(38,10)")
    several = F.raise_error(F.lit(f"the query of check {name} gives more than one row"))
    one = found.limit(2).agg(F.count(F.lit(1)).alias("n"), value.alias("value"))
    one = one.filter(F.when(F.col("n") > 1, several.cast("boolean")).otherwise(F.lit(True)))
    whole = F.when(F.col("value") < 0, F.floor("value")).otherwise(F.ceil("value"))
    return one.select(
        F.lit("").alias("column"),
        F.lit(name).alias("check"),
        whole.cast("long").alias("bad_rows"),
        F.coalesce(F.col("value") == F.lit(expected), F.lit(False)).alias("passed"),
    )


def require_passed(results: DataFrame) -> None:
    """Raise with every failed check and its count; one row per declared check is read."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        texts = [f"{r['column']} {r['check']}: {r['bad_rows']} rows".strip() for r in failed]
        raise CheckFailed("; ".join(texts))
