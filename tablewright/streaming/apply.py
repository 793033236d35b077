"""Apply a stream to a published table, each batch once.

A micro-batch is written to the shared folder first and then changes the table as
any other rows do, by the table's strategy. Its number is published in the same
catalog statement as its rows. If a run fails after that, but before Spark has noted
the batch as done, Spark gives the batch again; it is then in the table already and
changes nothing. If it fails before, nothing was published.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .. import spec as names
from ..assets import materialize
from ..plans.sizing import Limits
from ..sources.store import TableStore
from ..spec import SpecError, TableSpec

# Strategies whose source is what is new; the others' source is a whole state or window.
STREAMED = (names.APPEND, names.MERGE, names.ANTI_JOIN, names.DELETE_INSERT)


def apply_stream(
    store: TableStore,
    spec: TableSpec,
    stream: DataFrame,
    checkpoint: str,
    *,
    output_mode: str = "append",
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    limits: Limits = Limits(),
    check: bool = True,
) -> StreamingQuery:
    """Start a streaming query that changes the table of ``spec`` by each batch of ``stream``.

    ``append``, ``merge``, ``anti_join`` and ``delete+insert`` take part: of a batch of
    a merge each key may have one row, or any number with ``newer_by``, by which rows
    that come late do not undo newer ones either. ``prepare`` works on a batch before
    it is applied. The default ``trigger`` takes all there is and ends.

    The ``checkpoint`` folder is what makes a stream the same one: under a new folder
    all of the source is new. Checks run after a batch is published, as with any run.
    """
    if spec.kind != "table" or spec.strategy not in STREAMED or spec.needs_window:
        raise SpecError(f"a stream can be applied by {', '.join(STREAMED)} without a run window, not {spec.strategy or spec.kind}")
    if not stream.isStreaming:
        raise SpecError("apply_stream needs a streaming DataFrame; materialize takes others")
    known: list[str] = []

    def change(rows: DataFrame, number: int) -> None:
        if not known:
            known.append(stream_id(store, checkpoint))
        batch = (known[0], number)
        if store.has_batch(spec.name, batch):
            return
        # Streams plan without adaptive execution; the stored copy is planned in the store's own session.
        copy = store.stage(prepare(rows) if prepare else rows)
        try:
            materialize(store, spec, copy, limits=limits, check=check, batch=batch, stored=True)
        finally:
            store.unstage(copy)

    writer = stream.writeStream.foreachBatch(change).outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_id(store: TableStore, checkpoint: str) -> str:
    """The identity that Spark gave the stream of a checkpoint folder; it is there before the first batch."""
    text = store.spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]
