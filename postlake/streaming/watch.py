"""What running streams report: rows by query, and which have ended how."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Watch(StreamingQueryListener):
    """Counts the rows that each named query of a session has taken in, while attached.

    Counts are those observed as `rows` where a query observes them, else what its sources gave. Reports arrive some time after
    what they tell of; `settle` waits for those of ended queries.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: Counter[str] = Counter()
        self.batches: Counter[str] = Counter()
        self.failures: dict[str, str] = {}
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> "Watch":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = [m["rows"] for m in progress.observedMetrics.values() if "rows" in m.asDict()]
        with self._changed:
            self.rows[progress.name] += sum(observed) if observed else progress.numInputRows
            self.batches[progress.name] += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            if event.exception:
                self.failures[self._names.get(str(event.runId), str(event.id))] = event.exception
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def settle(self, queries: list[StreamingQuery], seconds: float = 60) -> None:
        """Wait for the last reports of queries that have ended. Those of one query come in order."""
        wanted = {str(query.runId) for query in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: wanted <= self._ended, seconds):
                raise TimeoutError("no report of the end of a stream")
