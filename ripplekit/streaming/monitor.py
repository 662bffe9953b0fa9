"""K5: a monitor of running streaming queries.

The queries report named metrics per micro-batch (``DataFrame.observe``); the
monitor is a ``StreamingQueryListener`` that adds them up per query as they
arrive.  It holds one number per metric and depends neither on how many
progress reports Spark keeps nor on who started the query.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class UpdateMonitor(StreamingQueryListener):
    """Totals of observed metrics: ``{metric: {column: total}}`` per query id
    (which a query keeps when it restarts from its checkpoint)."""

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._totals: dict[str, dict[str, dict[str, int]]] = {}
        self._last: dict[str, int] = {}      # micro-batch that was counted last
        self._ended: set[str] = set()        # runs

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.add(str(p.id), p.batchId, {name: row.asDict() for name, row in p.observedMetrics.items()})

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def add(self, query: str, batch: int, metrics: dict[str, dict[str, int]]) -> None:
        """Count a micro-batch, once."""
        with self._changed:
            if not metrics or batch <= self._last.get(query, -1):
                return
            self._last[query] = batch
            totals = self._totals.setdefault(query, defaultdict(lambda: defaultdict(int)))
            for name, columns in metrics.items():
                for column, n in columns.items():
                    totals[name][column] += n or 0

    def wait(self, run: str, seconds: float = 60) -> None:
        """Wait until all reports of a run that has ended are in."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(run) in self._ended, seconds):
                raise TimeoutError(f"no end of run {run} was reported in {seconds} s")

    def totals(self, query: str) -> dict[str, dict[str, int]]:
        with self._changed:
            return {name: dict(columns) for name, columns in self._totals.get(str(query), {}).items()}


class monitored:
    """``with monitored(spark) as monitor:`` registers a monitor meanwhile."""

    def __init__(self, spark: SparkSession):
        self.spark, self.monitor = spark, UpdateMonitor()

    def __enter__(self) -> UpdateMonitor:
        self.spark.streams.addListener(self.monitor)
        return self.monitor

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self.monitor)
