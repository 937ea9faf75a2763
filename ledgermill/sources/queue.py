"""Scans over the landing queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unprocessed(landing: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Rows still to be merged, of one batch when it is given."""
    rows = landing.filter(~F.col("is_processed"))
    return rows if batch_id is None else rows.filter(F.col("batch_id") == batch_id)


def unclassified(landing: DataFrame) -> DataFrame:
    """Unprocessed rows whose JSON has no ``classification`` key."""
    keys = F.coalesce(F.json_object_keys("raw_json"), F.array().cast("array<string>"))
    return unprocessed(landing).filter(~F.array_contains(keys, "classification"))


def landed_hashes(landing: DataFrame) -> DataFrame:
    """First landing row per file hash; pre-aggregated, so copies cost nothing.

    A queue that keeps ``file_hash`` as a column of its own is not parsed.
    """
    stored = "file_hash" in landing.columns
    file_hash = F.col("file_hash") if stored else F.get_json_object("raw_json", "$.file_hash")
    return (
        landing.groupBy(file_hash.alias("file_hash"))
        .agg(F.min("landing_id").alias("landing_id"))
        .filter(F.col("file_hash").isNotNull())
    )


def find_by_hash(landing: DataFrame, hashes: DataFrame) -> DataFrame:
    """``hashes(file_hash)`` with the first landing row of each, NULL when unknown."""
    return hashes.join(landed_hashes(landing), "file_hash", "left")
