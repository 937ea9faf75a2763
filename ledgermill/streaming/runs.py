"""Streams that log their runs: a start row, counters while they run, and how they ended.

Counters come from ``observe`` on the stream and on what is written, so nothing is
counted by a scan of its own. A run that fails is closed as FAILED with its error, and
its high-water mark stays where it was: the next run takes the same rows again.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgermill.operators.runlog import end_run, start_run
from ledgermill.session import path_exists

OBSERVED = "run"
# Longest wait for the last event of a query that has ended.
EVENT_SECONDS = 60
ERROR_CHARACTERS = 500


class RunCounters(StreamingQueryListener):
    """Rows that the queries of a session read, by run, and whether a run has ended."""

    def __init__(self) -> None:
        self.extracted: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if seen is not None:
            run = str(event.progress.runId)
            self.extracted[run] = self.extracted.get(run, 0) + seen["rows_extracted"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def _end(self, run) -> threading.Event:
        return self.ended.setdefault(str(run), threading.Event())

    def rows_of(self, run) -> int:
        """Rows of a run that has ended; waits for its last event."""
        self._end(run).wait(EVENT_SECONDS)
        return self.extracted.get(str(run), 0)


def written(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write ``rows`` and return how many they were, counted by the write itself."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows_loaded")))
    return seen.get["rows_loaded"]


def run_logged(
    stream: DataFrame,
    write: Callable[[DataFrame, int], int],
    checkpoint: str,
    log_path: str,
    workflow: str,
    advance: Callable[[], None] | None = None,
) -> str:
    """Run ``write(batch, epoch)`` over everything that is there and log the run.

    ``write`` returns the rows it loaded. ``advance`` moves the high-water mark and is
    called after a run without a failure only. Returns the run's batch id; a failure is
    in the log and is not raised.
    """
    spark = stream.sparkSession
    batch_id = start_run(spark, log_path, workflow)
    counters, loaded, errors, run = RunCounters(), [], [], None

    def counted(batch: DataFrame, epoch: int) -> None:
        # One evaluation, so that the stream's rows are counted once.
        batch.persist()
        try:
            loaded.append(write(batch, epoch))
        except Exception as failure:
            # The query's own error wraps this one in the traces of both sides.
            errors.append(f"{type(failure).__name__}: {failure}")
            raise
        finally:
            batch.unpersist()

    spark.streams.addListener(counters)
    try:
        query = (
            stream.observe(OBSERVED, F.count(F.lit(1)).alias("rows_extracted"))
            .writeStream.foreachBatch(counted)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run = query.runId
        query.awaitTermination()
        if advance is not None:
            advance()
    except StreamingQueryException as failure:
        errors.append(str(failure))
    finally:
        extracted = counters.rows_of(run) if run else 0
        spark.streams.removeListener(counters)
    error = errors[0][:ERROR_CHARACTERS] if errors else None
    status = "SUCCESS" if error is None else "FAILED"
    end_run(
        spark, log_path, batch_id, workflow, status, extracted, sum(loaded),
        extracted - sum(loaded), error,
    )
    return batch_id


MARK = "mark BIGINT, marked_at TIMESTAMP"


def advance_mark(spark: SparkSession, path: str, newest: DataFrame) -> None:
    """Append a mark: the one value of ``newest``; none leaves the log as it is."""
    row = newest.select(
        F.col(newest.columns[0]).cast("bigint").alias("mark"),
        F.current_timestamp().alias("marked_at"),
    )
    row.filter("mark IS NOT NULL").write.mode("append").parquet(path)


def current_mark(spark: SparkSession, path: str) -> int | None:
    """The highest mark, or none before the first run that succeeded."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(MARK).parquet(path).agg(F.max("mark")).first()[0]
