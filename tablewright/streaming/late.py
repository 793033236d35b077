"""Rows that came behind the watermark: Spark drops them, here they are counted."""

from __future__ import annotations

import threading
from typing import Any

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Counts the late rows of all queries of a session: ``spark.streams.addListener(LateRows())``.

    Needed for queries of many batches, of which Spark itself keeps the last hundred only.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._counts: dict[str, dict[int, int]] = {}

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        with self._lock:
            self._counts.setdefault(str(progress.id), {})[progress.batchId] = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def batches(self, query: StreamingQuery) -> dict[int, int]:
        with self._lock:
            return dict(self._counts.get(str(query.id), {}))


def late_rows(query: StreamingQuery, listener: LateRows | None = None) -> dict[int, int]:
    """Late rows by batch, of the batches that the listener saw and those Spark still knows."""
    found = listener.batches(query) if listener else {}
    for progress in query.recentProgress:
        # a batch without rows reports what an earlier one dropped anew in some releases
        dropped = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        found[progress["batchId"]] = max(found.get(progress["batchId"], 0), dropped)
    return found
