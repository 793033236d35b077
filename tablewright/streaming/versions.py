"""Versioned history from an ordered stream of changes, one state per bucket of keys.

What ``scd2_by_time`` makes of whole snapshots, for streams of changes: each change
newer than the open version closes it and opens the next. A key that is not heard of
for a while is closed by a timer, as there is no snapshot that it could be missing from.

State is asked for and handed over by calls between processes, so keys share it by
buckets: a batch reads and writes a bucket's state once, and its one timer is due when
the first of its keys is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.types import quote
from ..spec import IS_CURRENT, OPEN_END, RESERVED, VALID_FROM, VALID_UNTIL, SpecError
from .rocks import needs_rocks


#: Buckets that keys share the state of.
BUCKETS = 2048
# Key types whose values are equal in Python when they are in Spark; keys of others have a state each.
_PLAIN = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampNTZType())


class _Versions(StatefulProcessor):
    """State of a bucket: of each key its open version's values, when it began, when the key was last heard of; the next timer."""

    def __init__(self, keys: T.StructType, values: T.StructType, silence: int | None, shared: bool) -> None:
        self.keys, self.values, self.silence, self.shared = keys, values, silence, shared
        self.names = [*keys.names, *values.names, "began", "ended", "current"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        open = T.StructType([*self.keys, *self.values, T.StructField("__from", T.LongType()), T.StructField("__seen", T.LongType())])
        self.handle = handle
        self.open = handle.getValueState("open", T.StructType([T.StructField("keys", T.ArrayType(open)), T.StructField("timer", T.LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known, timer = self._known(key)
        changes: dict[tuple, list] = {}
        for r in rows:
            changes.setdefault(self._same(key, r), []).append((r["__at"], tuple(r[name] for name in self.values.names)))
        for one, found in changes.items():
            now = yield from self._changed(one, known.get(one), found)
            known[one] = now
        self._keep(known, timer)

    def _changed(self, key: tuple, now: tuple | None, changes: list) -> Iterator[Row]:
        """The versions that changes of a key close and open; returns its state."""
        began = None
        width = len(self.values)
        # at one time the least values come first, and the rest of that time is not newer
        for at, values in sorted(changes, key=lambda c: (c[0], [(v is not None, v) for v in c[1]])):
            if now is not None and self.silence is not None and at > now[-1] + self.silence:
                # silent for too long, though its timer comes after the rows of this batch
                yield self._row(key, now[:width], now[width], now[-1] + self.silence, False)
                now = None
            if now is not None and now[width] < at:
                yield self._row(key, now[:width], now[width], at, False)
            if now is None or now[width] < at:
                now, began = (*values, at, at), at
            now = (*now[:-1], max(now[-1], at))
        if began is not None:
            yield self._row(key, now[:width], now[width], None, True)
        return now

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        known, timer = self._known(key)
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        for one in [k for k, now in known.items() if self._due(now[-1]) <= passed]:
            now = known.pop(one)
            yield self._row(one, now[:-2], now[-2], now[-1] + self.silence, False)
        # Spark lets go of the timer that is due
        self._keep(known, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)

    def _same(self, key: tuple, row: Row) -> tuple:
        return tuple(row[name] for name in self.keys.names) if self.shared else tuple(key)

    def _known(self, key: tuple) -> tuple[dict[tuple, tuple], int | None]:
        """The states of a bucket's keys and its timer."""
        found = self.open.get()
        if found is None:
            return {}, None
        width = len(self.keys)
        return {tuple(x[:width]) if self.shared else tuple(key): tuple(x[width:]) for x in found[0]}, found[1]

    def _keep(self, known: dict[tuple, tuple], timer: int | None) -> None:
        due = min((self._due(now[-1]) for now in known.values()), default=None) if self.silence is not None else None
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if known:
            self.open.update(([(*one, *now) for one, now in known.items()], due))
        else:
            self.open.clear()

    def close(self) -> None:
        pass

    def _due(self, seen: int) -> int:
        """Timers have milliseconds; a started one counts whole."""
        return -(-(seen + self.silence) // 1000)

    def _row(self, key: Any, values: tuple, began: int, ended: int | None, current: bool) -> Row:
        return Row(*self.names)(*key, *values, began, ended, current)


def version_stream(
    changes: DataFrame, keys: Sequence[str], changed_at: str, *, late_by: str, close_after_seconds: float | None = None
) -> DataFrame:
    """The versions that a stream of changes opens and closes, to be merged by key and ``_valid_from``.

    ``changes`` has the keys, the values and ``changed_at``, a timestamp. The result
    has them and ``_valid_from``, ``_valid_until`` and ``_is_current`` as
    ``scd2_by_time`` gives them, in output mode ``update``: a row when a version
    opens, and the same version again when it is closed. A key without a change for
    ``close_after_seconds`` of event time is closed at the end of that time, once the
    watermark has passed it; a later change opens a new version.

    Changes of a key are put in order within a batch; one that is not newer than the
    open version changes nothing, but shows that the key is there. Of changes of one
    key and time those with the least values count. Changes further back than
    ``late_by`` are dropped and counted by ``late_rows``. Changes without a time, or
    with a NULL key, are no versions. A task holds the changes of one batch and the open
    versions of one of ``BUCKETS`` buckets of keys; keys of other types than whole
    numbers, texts, booleans, dates and timestamps without a zone are no buckets, but
    each by itself.
    """
    clash = [c for c in changes.columns if c.lower() in RESERVED]
    if clash:
        raise SpecError(f"column name {clash[0]} is reserved for validity tracking")
    kind = changes.schema[changed_at].dataType
    values = [c for c in changes.columns if c not in keys]
    fields = T.StructType([T.StructField(f"c{i}", changes.schema[c].dataType) for i, c in enumerate(values)])
    at = F.col(quote(changed_at))
    known = changes.filter(at.isNotNull())
    for key in keys:
        known = known.filter(F.col(quote(key)).isNotNull())
    rows = known.withColumn("__time", at.cast("timestamp")).withWatermark("__time", late_by)
    rows = rows.select(
        *[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate(keys)], F.unix_micros("__time").alias("__at"), "__time",
        *[F.col(quote(c)).alias(f"c{i}") for i, c in enumerate(values)],
    )
    named = T.StructType([T.StructField(f"k{i}", changes.schema[k].dataType) for i, k in enumerate(keys)])
    out = T.StructType([*named, *fields, T.StructField("began", T.LongType()), T.StructField("ended", T.LongType()), T.StructField("current", T.BooleanType())])
    silence = None if close_after_seconds is None else int(close_after_seconds * 1_000_000)
    needs_rocks(changes.sparkSession)
    shared = all(k.dataType in _PLAIN for k in named)
    of = list(named.names)
    if shared:
        rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*of), F.lit(BUCKETS)).cast("int"))
        of = ["__bucket"]
    made = rows.groupBy(*of).transformWithState(_Versions(named, fields, silence, shared), out, "Update", "EventTime")
    stamp = lambda c: F.timestamp_micros(c).cast(kind)
    found = {k: F.col(f"k{i}") for i, k in enumerate(keys)} | {c: F.col(f"c{i}") for i, c in enumerate(values)}
    end = F.lit(OPEN_END.isoformat(sep=" ")).cast(kind)
    return made.select(
        stamp("began").alias(VALID_FROM), *[found[c].alias(c) for c in changes.columns],
        F.coalesce(stamp("ended"), end).alias(VALID_UNTIL), F.col("current").alias(IS_CURRENT),
    )


def closed_once(keys: Sequence[str]):
    """For ``apply_stream(prepare=…)``: of a version opened and closed in one batch, the closed row only."""

    def prepare(rows: DataFrame) -> DataFrame:
        ended = F.struct(VALID_UNTIL, F.struct(*[F.col(quote(c)).alias(f"c{i}") for i, c in enumerate(rows.columns)]).alias("row"))
        folded = rows.groupBy(*[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate([*keys, VALID_FROM])]).agg(F.min(ended).alias("first"))
        return folded.select(*[F.col(f"first.row.c{i}").alias(c) for i, c in enumerate(rows.columns)])

    return prepare
