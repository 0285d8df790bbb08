"""Progress lines of streams: a listener says them as the stream goes on, from what its batches left."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import Row
from pyspark.sql.streaming import StreamingQueryListener

from shelfmark.plans.report import ProgressLog

log = logging.getLogger("shelfmark")


class StreamLog(StreamingQueryListener):
    """Lines of one query. Batches leave their outcomes with add(); lines come once Spark tells that a batch is through, and with the
    query's end. target: pages that the stream is known to bring, or 0."""

    def __init__(self, target: int = 0, clock: Callable[[], float] = time.monotonic):
        self.progress, self.clock, self.began = ProgressLog(target, clock), clock, clock()
        self.query, self.left, self.ended = None, {}, threading.Event()
        self.failed = 0

    def add(self, batch: int, rows: list[Row]) -> None:
        self.left[batch] = rows

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def _own(self, event_id) -> bool:
        return self.query is None or str(event_id) == self.query

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if self._own(event.progress.id):
            for number in sorted(n for n in self.left if n <= event.progress.batchId):
                self._say(self.left.pop(number))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self._own(event.id):
            for number in sorted(self.left):
                self._say(self.left.pop(number))
            p = self.progress
            log.info("stream ended after %.0f s: %d pages, %d failed, %d cards", self.clock() - self.began, p.pages, self.failed, p.cards)
            if event.exception:
                log.warning("stream failed: %s", event.exception.splitlines()[0])
            self.ended.set()

    def _say(self, rows: list[Row]) -> None:
        self.failed += sum(r["error"] is not None for r in rows)
        self.progress.add(rows)
