"""OBS-1 for streams: what every micro-batch held, observed while it is written.

``observe`` adds named counts to a stream; they are computed within the batch's own
job.  ``BatchMetrics`` is a query listener that keeps them by query and batch, so a
live query is watched without a second read of its source or sink.
"""

from __future__ import annotations

import threading
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

NAME = "dealspark_batch"


def observe(stream: DataFrame, ts: str = "priceUpdateDate") -> DataFrame:
    """``stream`` with the number of rows and the span of ``ts`` of every batch observed."""
    return stream.observe(NAME, F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


class BatchMetrics(StreamingQueryListener):
    """Metrics of observed batches: ``held[query id][batch id]``; a replayed batch replaces its entry.

    Entries are one small row per batch; ``take`` hands out a query's and drops them."""

    def __init__(self) -> None:
        self.held: dict[str, dict[int, Any]] = {}
        self._over: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _ended(self, run: str) -> threading.Event:
        with self._lock:
            return self._over.setdefault(run, threading.Event())

    def onQueryStarted(self, event: Any) -> None:
        """Nothing to keep."""

    def onQueryIdle(self, event: Any) -> None:
        """Nothing to keep."""

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(NAME)
        if found is not None:
            with self._lock:
                self.held.setdefault(str(progress.id), {})[progress.batchId] = found

    def onQueryTerminated(self, event: Any) -> None:
        self._ended(str(event.runId)).set()

    def take(self, query: StreamingQuery, timeout: float = 60.0) -> dict[int, Any]:
        """Metrics by batch of a query that has ended, once all its events have come."""
        if not self._ended(str(query.runId)).wait(timeout):
            raise TimeoutError("the end of the query was not reported")
        with self._lock:
            self._over.pop(str(query.runId), None)
            return self.held.pop(str(query.id), {})
