"""Tables that are replaced as a whole: write a new version, then point to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import path_exists


class SnapshotTable:
    """Parquet versions below ``root`` and a small log naming the current one.

    Readers keep the version they started with. A failed write leaves the log
    as it was, so a repeated run starts from the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def _log(self) -> DataFrame:
        return self.spark.read.schema("version STRING, written_at TIMESTAMP").parquet(
            f"{self.root}/log"
        )

    def current(self) -> str | None:
        """Newest complete version."""
        if not path_exists(self.spark, f"{self.root}/log"):
            return None
        row = self._log().orderBy(F.col("written_at").desc()).first()
        return row.version if row else None

    def has(self, version: str) -> bool:
        if not path_exists(self.spark, f"{self.root}/log"):
            return False
        return self._log().filter(F.col("version") == version).limit(1).count() > 0

    def read(self) -> DataFrame:
        version = self.current()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{version}")

    def write(self, df: DataFrame, version: str, partition_by: Sequence[str] = ()) -> None:
        """Write and switch; a version that is already complete is not redone."""
        if self.has(version):
            return
        out = df.write.mode("overwrite")
        if partition_by:
            # Group rows by folder, so that one task does not open every folder;
            # rebalancing splits the folders that are too large for one task.
            grouped = df.hint("rebalance", *partition_by)
            out = grouped.write.mode("overwrite").partitionBy(*partition_by)
        out.parquet(f"{self.root}/data/{version}")
        entry = self.spark.range(1).select(
            F.lit(version).alias("version"), F.current_timestamp().alias("written_at")
        )
        entry.write.mode("append").parquet(f"{self.root}/log")
