"""Incremental jobs as streams: drop folder, late mail, queue drain and actions.

Every sink writes the folder of its own micro-batch, so a batch that is retried
after a failure replaces its rows instead of adding them twice. The checkpoint
moves on only after the sink has finished. What a sink knows from earlier batches
is kept in bucketed logs, of which a batch reads the buckets of its own keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.functions.crypto import Secret
from ledgermill.operators.buckets import EPOCH, SLOT, BucketedLog
from ledgermill.operators.checklist import valid_answers
from ledgermill.operators.keys import first_per_key
from ledgermill.operators.merge import (
    CURRENT_POLICY,
    KEY,
    MergePolicy,
    has_key,
    incoming_documents,
    latest_documents,
    merge_changes,
    quarantined,
)
from ledgermill.operators.review import valid_review_actions
from ledgermill.schemas import CORE_DOCUMENTS
from ledgermill.session import path_exists
from ledgermill.sources.files import BINARY_FILE, described, with_hashes
from ledgermill.sources.queue import unprocessed


def run_available(
    stream: DataFrame, write: Callable, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Run ``write(batch, epoch)`` over everything that is there, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _epoch_path(path: str, epoch: int) -> str:
    return f"{path}/{EPOCH}={epoch}"


def read_epochs(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of all finished micro-batches, or of those before one; empty at first."""
    full = f"{schema}, {EPOCH} INT"
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).parquet(path)
    return rows if before is None else rows.filter(F.col(EPOCH) < before)


def staged_files(spark: SparkSession, folder: str) -> DataFrame:
    """New files of a supported type dropped into a folder, listed and not yet read."""
    files = spark.readStream.format("binaryFile").schema(BINARY_FILE).load(folder)
    return described(files)


STAGED_FILE = (
    "path STRING, file_name STRING, file_ext STRING, file_size_bytes BIGINT, "
    "modified_at TIMESTAMP, file_hash STRING"
)


def ingest_files(spark: SparkSession, folder: str, landing: str, checkpoint: str) -> StreamingQuery:
    """Land files whose content is not landed yet."""

    def land(batch: DataFrame, epoch: int) -> None:
        log = BucketedLog(batch.sparkSession, landing, STAGED_FILE, ["file_hash"])
        hashed = with_hashes(batch)
        once = first_per_key(hashed, ["file_hash"], [F.col("file_name"), F.col("path")])
        # Hashed once: the slots are looked up before the rows are written.
        once.persist()
        log.write(log.unknown(once, before=epoch), epoch)
        once.unpersist()

    return run_available(staged_files(spark, folder), land, checkpoint)


def ingest_rows(
    stream: DataFrame,
    landing: str,
    checkpoint: str,
    keys: Sequence[str],
    schema: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Land streamed rows whose key is not landed yet, one per key."""

    def land(batch: DataFrame, epoch: int) -> None:
        log = BucketedLog(batch.sparkSession, landing, schema, keys)
        rows = transform(batch)
        # A full order, so that a retried batch keeps the same row.
        once = first_per_key(rows, list(keys), [F.col(c).asc() for c in rows.columns])
        log.write(log.unknown(once, before=epoch), epoch)

    return run_available(stream, land, checkpoint)


def dedupe_late(
    stream: DataFrame, keys: Sequence[str], event_time: str = "received_at", lateness: str = "3 days"
) -> DataFrame:
    """Drop repeated keys; state is kept only as long as rows may arrive late."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


def drain_queue(
    landing: DataFrame,
    core_path: str,
    checkpoint: str,
    fy_periods: DataFrame,
    categories: DataFrame,
    policy: MergePolicy = CURRENT_POLICY,
    now: Column | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Merge streamed landing rows into core, kept as a log of changed rows.

    Rows the merge cannot take are written with their reasons before the changes of
    their batch, below ``rejects_path`` (default: ``<core_path>-rejects``).
    """
    rejects = rejects_path or f"{core_path}-rejects"

    def merge(batch: DataFrame, epoch: int) -> None:
        log = core_log(batch.sparkSession, core_path)
        quarantined(batch).write.mode("overwrite").parquet(_epoch_path(rejects, epoch))
        incoming = incoming_documents(batch, fy_periods, categories).withColumn(SLOT, log.slot())
        # Parsed once: changes and marks are both made from it.
        incoming.persist()
        touched = log.slots_of(has_key(unprocessed(batch)))
        core = latest_documents(log.read(touched, before=epoch), EPOCH, (SLOT, *KEY))
        last_id = _last_id(batch.sparkSession, core_path, epoch)
        changes = merge_changes(
            core, incoming, policy, now, F.lit(last_id).cast("bigint"), (SLOT, *KEY)
        )
        log.write(changes, epoch)
        marks_log(batch.sparkSession, core_path).write(incoming.select(*KEY), epoch)
        incoming.unpersist()
        _keep_last_id(log, core_path, epoch, last_id)

    return run_available(landing, merge, checkpoint)


def core_log(spark: SparkSession, core_path: str) -> BucketedLog:
    """Changed documents, bucketed on the key."""
    return BucketedLog(spark, core_path, CORE_DOCUMENTS, KEY)


def marks_log(spark: SparkSession, core_path: str) -> BucketedLog:
    """Keys that the drains of a core have taken from the queue."""
    return BucketedLog(spark, f"{core_path}-marks", "source_type STRING, source_id STRING", KEY)


LAST_ID = "last_id BIGINT"


def _last_id(spark: SparkSession, core_path: str, epoch: int) -> int:
    """Highest document id given before an epoch: one row, left by the epoch before."""
    ids = f"{core_path}-ids"
    before = _epoch_path(ids, epoch - 1)
    if path_exists(spark, before):
        return spark.read.schema(LAST_ID).parquet(before).first()[0]
    found = read_epochs(spark, ids, LAST_ID, before=epoch).agg(F.max("last_id")).first()[0]
    return found or 0


def _keep_last_id(log: BucketedLog, core_path: str, epoch: int, last_id: int) -> None:
    written = log.read().filter(F.col(EPOCH) == epoch)
    highest = F.greatest(F.coalesce(F.max("doc_id"), F.lit(0)), F.lit(last_id))
    written.agg(highest.cast("bigint").alias("last_id")).write.mode("overwrite").parquet(
        _epoch_path(f"{core_path}-ids", epoch)
    )


def read_core(spark: SparkSession, core_path: str) -> DataFrame:
    """Current core documents from the change log, which is not shuffled for it."""
    rows = core_log(spark, core_path).read()
    return latest_documents(rows, EPOCH, (SLOT, *KEY)).drop(SLOT)


REJECT = "landing_id BIGINT, reasons ARRAY<STRING>"


def read_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Rows of all batches that could not be merged, with their reasons."""
    return read_epochs(spark, rejects_path, REJECT).drop(EPOCH)


def compact_core(spark: SparkSession, core_path: str, target: str) -> None:
    """Start a new change log at ``target`` from the current documents.

    Readers of the old log are not disturbed; the next drain is given the new
    path and the old checkpoint, so its epochs follow the base.
    """
    log = core_log(spark, target)
    log.write(read_core(spark, core_path), -1)
    _keep_last_id(log, target, -1, 0)
    marks = marks_log(spark, core_path).read().select(*KEY).distinct()
    marks_log(spark, target).write(marks, -1)


DECISION = "doc_id BIGINT, action STRING, action_ts TIMESTAMP, token STRING"


def log_decisions(actions: DataFrame, path: str, checkpoint: str, secret: Secret) -> StreamingQuery:
    """Keep the first valid review action per document; later ones are replays."""

    def keep(batch: DataFrame, epoch: int) -> None:
        log = BucketedLog(batch.sparkSession, path, DECISION, ["doc_id"])
        valid = valid_review_actions(batch, secret)
        first = first_per_key(valid, ["doc_id"], [F.col("action_ts"), F.col("action")])
        log.write(log.unknown(first, before=epoch), epoch)

    return run_available(actions, keep, checkpoint)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    return read_epochs(spark, path, DECISION).drop(EPOCH)


ANSWER = "group_code STRING, fy_year INT, answer STRING, action_ts TIMESTAMP"


def keep_answers(answers: DataFrame, path: str, checkpoint: str, secret: Secret) -> StreamingQuery:
    """Keep the last valid answer by event time of every group and year.

    The state is one row per group and year, whatever the number of answers, so it needs
    no watermark: an answer that arrives late loses to a newer one however late it is,
    and a replay changes nothing. Equal times go to the larger answer.
    """
    last = F.max(F.struct("action_ts", "answer")).alias("last")
    state = valid_answers(answers, secret).groupBy("group_code", "fy_year").agg(last)

    def keep(batch: DataFrame, epoch: int) -> None:
        log = BucketedLog(batch.sparkSession, path, ANSWER, ["group_code", "fy_year"], 8)
        rows = batch.select(
            "group_code", F.col("fy_year").cast("int").alias("fy_year"), "last.answer", "last.action_ts"
        )
        log.write(rows, epoch)

    return run_available(state, keep, checkpoint, "update")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The last answer of every group and year, in the shape ``apply_answers`` takes."""
    log = BucketedLog(spark, path, ANSWER, ["group_code", "fy_year"], 8)
    newest = first_per_key(log.read(), [SLOT, "group_code", "fy_year"], [F.col(EPOCH).desc()])
    return newest.drop(SLOT, EPOCH)
