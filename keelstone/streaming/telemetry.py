"""Counts of what a batch or a stream has seen, as observed metrics of the query itself: no extra pass."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and an observation that holds n_rows, first and last time once they have been written."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.min("occurred_at").alias("first"), F.max("occurred_at").alias("last")), seen


class Progress(StreamingQueryListener):
    """Keeps the last `most` progress reports and counts those that had to go."""

    def __init__(self, most: int = 100):
        self.reports: deque = deque(maxlen=most)
        self.dropped, self.failed = 0, []

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.dropped += len(self.reports) == self.reports.maxlen
        self.reports.append({"batch": event.progress.batchId, "rows": event.progress.numInputRows, "ms": event.progress.batchDuration})

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            self.failed.append(event.exception)
