"""K4, K5 and the listener behind S8: how much comes in, how fast it is handled."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.logs import idle_row, log_load, progress_frame, progress_rows


def volume(spark: SparkSession, progress: Iterable) -> DataFrame:
    """K4: rows in per micro-batch."""
    return progress_frame(spark, progress).select("query_id", "batch_id", "ts", "n_in", "n_late")


def volume_by_window(
    df: DataFrame, width: str, event_time: str = "ts", delay: str = "1 hour"
) -> DataFrame:
    """K4: rows per event-time window; counted before they are shuffled.

    Rows later than ``delay`` are dropped by the watermark and show up as
    ``n_late`` in the load log.
    """
    stamped = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    counted = (
        stamped.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, width).alias("w"))
        .agg(F.count("*").alias("n"))
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"
    )


def performance(spark: SparkSession, progress: Iterable) -> DataFrame:
    """K5: rates and times per micro-batch."""
    return progress_frame(spark, progress).select(
        "query_id", "batch_id", "ts", "in_rate", "out_rate", "trigger_ms", "add_batch_ms"
    )


class LoadLog(StreamingQueryListener):
    """The load of streams, kept as a table by day.

    Register it with ``spark.streams.addListener``. With a ``name`` it logs the query
    of that name only and takes itself off when that query ends; without one it logs
    all queries of the session.

    A stream that has nothing to do makes no batches, only idle triggers, which Spark
    reports every ``spark.sql.streaming.noDataProgressEventInterval`` (ten seconds by
    default). Each becomes a row of its own, so that an idle cluster is seen.

    Rows are appended once ``flush_every`` of them are held and the last append is
    ``flush_seconds`` past: a day has at most 86,400 / ``flush_seconds`` files, besides
    one when a query ends. `compact_load` makes one of them later.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        flush_every: int = 1,
        name: str | None = None,
        flush_seconds: float = 0.0,
    ):
        self._spark = spark
        self._path = path
        self._writer = uuid.uuid4().hex
        self._flush_every = flush_every
        self._flush_seconds = flush_seconds
        self._flushed = -math.inf
        self._name = name
        self._last: dict[str, int] = {}
        self._held: list[dict] = []
        self.idle_triggers = 0
        self.closed = False

    def wait(self, until: Callable[[], bool], seconds: float) -> None:
        """Reports arrive after what they report: wait for one that tells ``until``."""
        end = time.monotonic() + seconds
        while not until():
            if time.monotonic() > end:
                raise TimeoutError(f"no such report within {seconds} s")
            time.sleep(0.05)

    def onQueryStarted(self, event) -> None:
        if self._name is None or event.name == self._name:
            self._last.setdefault(str(event.id), -1)

    def onQueryIdle(self, event) -> None:
        query = str(event.id)
        if query in self._last:
            self.idle_triggers += 1
            self._hold(idle_row(query, self._last[query], event.timestamp))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._name is not None and progress.name != self._name:
            return
        self._last[str(progress.id)] = int(progress.batchId)
        self._hold(*progress_rows([progress]))

    def onQueryTerminated(self, event) -> None:
        if self._last.pop(str(event.id), None) is not None:
            self._flush()
            self.closed = True
            if self._name is not None:
                self._spark.streams.removeListener(self)

    def _hold(self, *rows: dict) -> None:
        self._held += rows
        due = time.monotonic() - self._flushed >= self._flush_seconds
        if due and len(self._held) >= self._flush_every:
            self._flush()

    def _flush(self) -> None:
        held, self._held = self._held, []
        if held:
            self._flushed = time.monotonic()
            log_load(self._spark, held, self._path, self._writer)
