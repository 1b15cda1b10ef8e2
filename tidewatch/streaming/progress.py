"""Progress of streaming queries as a table: what came in, what the watermark dropped, what the state holds."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, name string, batch_id long, started_at string, input_rows long, dropped_late_rows long, "
    "state_rows long, state_bytes long, batch_ms long, watermark string"
)
ENDED = "query_id string, run_id string, ended_at double, error string"


class ProgressLog(StreamingQueryListener):
    """Takes one row per micro-batch of every query of the session from ``attach`` to ``detach``.

    The listener only notes the rows, in the driver; ``flush`` appends them to a table below ``path``. Between two flushes there is a row per
    micro-batch, so calling it now and then, as ``supervise`` does, keeps them few.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._ended: dict[str, tuple] = {}
        self._lock = threading.Lock()

    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        row = (
            str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, sum(max(0, s.numInputRows) for s in p.sources),
            sum(s.numRowsDroppedByWatermark for s in states), sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states),
            p.durationMs.get("triggerExecution"), p.eventTime.get("watermark"),
        )
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)] = (str(event.id), str(event.runId), time.time(), event.exception)

    def wait_for(self, run_id: str, seconds: float = 30) -> bool:
        """Events arrive behind the query; wait until the end of this run has."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self._lock:
                if str(run_id) in self._ended:
                    return True
            time.sleep(0.05)
        return False

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def failures(self) -> list[tuple[str, str]]:
        """(query id, error) of the runs that failed."""
        with self._lock:
            return [(query, error) for query, _, _, error in self._ended.values() if error]

    def frame(self) -> DataFrame:
        """All rows so far; a micro-batch that was run again has a row per run."""
        self.flush()
        try:
            return self.spark.read.schema(PROGRESS).parquet(self.path)
        except Exception as missing:  # nothing ran yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], PROGRESS)
