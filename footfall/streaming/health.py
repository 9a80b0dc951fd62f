"""Alerts on a running stream."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

# Rows waiting per trigger that count as a backlog (feed, rows).
FEED_BACKLOG = 8_000
ROW_BACKLOG = 4_000


# Alerts that the listener holds; the log has all.
KEPT_ALERTS = 1_000


class HealthListener(StreamingQueryListener):
    """Collects an alert for every trigger that takes in or writes more than its limit, that
    reads faster than it can process, or in which rows come too late for their window (counted in ``late_rows``)."""

    def __init__(self, feed_limit: int = FEED_BACKLOG, row_limit: int = ROW_BACKLOG) -> None:
        self.feed_limit, self.row_limit = feed_limit, row_limit
        self.alerts: list[str] = []
        self.triggers = 0
        self.late_rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.triggers += 1
        taken, written = progress.numInputRows, progress.sink.numOutputRows
        if taken > self.feed_limit:
            self._alert(f"batch {progress.batchId}: {taken} events in one trigger")
        if written > self.row_limit:
            self._alert(f"batch {progress.batchId}: {written} rows in one trigger")
        if progress.inputRowsPerSecond > progress.processedRowsPerSecond > 0:
            self._alert(f"batch {progress.batchId}: falling behind the feed")

        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if late:
            self.late_rows += late
            self._alert(f"batch {progress.batchId}: {late} rows behind the watermark")

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._alert(f"stream ended: {event.exception}")

    def _alert(self, text: str) -> None:
        log.warning(text)
        self.alerts.append(text)
        del self.alerts[:-KEPT_ALERTS]
