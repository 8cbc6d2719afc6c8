"""Live rates: the progress reports of streaming queries as rows of the metric table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from changeflow.operators import metrics as M

#: Batches whose reports are held until they are taken; the oldest go first.
HELD = 100_000


def report_rows(progress) -> list[tuple]:
    """One report, with the run as `op`: the time of the trigger and the rows read. Spark counts a row as often
    as the batch reads it, so the number of messages comes from the stream (`metrics.live_rates`)."""
    p, run = progress, str(progress.runId)
    values = {M.BATCH_MS: p.durationMs.get("triggerExecution", 0), M.ROWS_READ: p.numInputRows}
    return [(metric, None, run, float(v), p.batchId, p.timestamp) for metric, v in values.items()]


class ProgressLog(StreamingQueryListener):
    """Collects the reports of batches that took rows; restarts are further runs. Add it to a session with
    `spark.streams.addListener`. It only keeps what Spark tells it: rows are made by whoever asks."""

    def __init__(self):
        self._held: dict[tuple[str, int], list[tuple]] = {}
        self._runs: set[str] = set()
        self._lock = threading.Lock()

    def add(self, progress) -> None:
        """A report; the same one twice counts once."""
        with self._lock:
            self._runs.add(str(progress.runId))
            if progress.numInputRows:
                self._held[str(progress.runId), progress.batchId] = report_rows(progress)
            while len(self._held) > HELD:
                self._held.pop(next(iter(self._held)))

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def restarts(self) -> int:
        return max(0, len(self._runs) - 1)

    def rows(self, spark: SparkSession) -> DataFrame:
        """What has been collected, as rows of the metric table with their batch."""
        with self._lock:
            held = [r for rows in self._held.values() for r in rows]
        schema = "metric string, table_name string, op string, value double, batch_id bigint, at string"
        found = spark.createDataFrame(held, schema)
        return found.withColumn("at", found["at"].cast("timestamp_ntz"))
