"""Run log: append-only start and end rows; the state of a run is its newest row."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schemas import RUN_LOG


def _append(spark: SparkSession, path: str, **fields) -> None:
    names = [field.split(" ")[0] for field in RUN_LOG.split(", ")]
    kinds = dict(field.split(" ") for field in RUN_LOG.split(", "))
    row = spark.range(1).select(
        *[
            (
                F.current_timestamp() if name == "logged_at" else F.lit(fields.get(name))
            ).cast(kinds[name]).alias(name)
            for name in names
        ]
    )
    row.write.mode("append").parquet(path)


def start_run(spark: SparkSession, path: str, workflow: str, script: str | None = None) -> str:
    """Log a start row and return the new batch id."""
    batch_id = uuid.uuid4().hex
    _append(
        spark, path, batch_id=batch_id, workflow_nme=workflow, script_nme=script,
        status="STARTED", rows_extracted=0, rows_loaded=0, rows_skipped=0,
    )
    return batch_id


def end_run(
    spark: SparkSession, path: str, batch_id: str, workflow: str, status: str,
    extracted: int = 0, loaded: int = 0, skipped: int = 0, error: str | None = None,
) -> None:
    """Log how a run ended. Every started run is closed, failed ones included."""
    _append(
        spark, path, batch_id=batch_id, workflow_nme=workflow, status=status,
        rows_extracted=extracted, rows_loaded=loaded, rows_skipped=skipped, error_msg=error,
    )


def runs(log: DataFrame) -> DataFrame:
    """One row per run: start, end and the counts of its closing row.

    Of several closing rows the newest gives status, counts and error alike; a run
    without one is STARTED and has the counts of its start row. A missing or negative
    count is 0.
    """
    closed = F.col("status") != "STARTED"
    counts = [
        F.greatest(F.col(c), F.lit(0)).alias(c)
        for c in ("rows_extracted", "rows_loaded", "rows_skipped")
    ]
    state = F.struct("status", *counts, "error_msg")
    newest = F.max_by(state, F.struct(closed, "logged_at", "status"))
    return (
        log.groupBy("batch_id", "workflow_nme")
        .agg(
            newest.alias("_last"),
            F.min(F.when(~closed, F.col("logged_at"))).alias("started_at"),
            F.max(F.when(closed, F.col("logged_at"))).alias("completed_at"),
        )
        .select("batch_id", "workflow_nme", "_last.*", "started_at", "completed_at")
    )


def latest_run(log: DataFrame, workflow: str) -> DataFrame:
    """Newest run of a workflow with its duration in whole seconds."""
    return (
        runs(log.filter(F.col("workflow_nme") == workflow))
        .orderBy(F.col("started_at").desc_nulls_last())
        .limit(1)
        .withColumn(
            "duration_secs",
            F.round((F.unix_micros("completed_at") - F.unix_micros("started_at")) / 1e6).cast("int"),
        )
    )


def run_totals(items: DataFrame, exit_code: Column) -> DataFrame:
    """Totals over per-item results; an item without an exit code counts as loaded."""
    good = F.coalesce(exit_code == 0, F.lit(True))
    return items.agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        F.count_if(good).alias("rows_loaded"),
        F.count_if(~good).alias("rows_skipped"),
    )
