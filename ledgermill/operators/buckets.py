"""Logs of rows in bucketed tables, so that a batch reads the buckets of its own keys only.

A log is a Spark table with one partition per epoch and a fixed number of buckets on
the slot of a row's key. A batch collects its slots, one small number per bucket at
most, and filters the log by them: Spark then opens the files of those buckets and no
others. Windows per key, and joins with another log or with a batch on slot and key,
need no shuffle of the log.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import path_exists

SLOT, EPOCH = "key_slot", "epoch"
BUCKETS = 64

# The slot is one of the join keys; it suffices that both sides are dealt by it.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
REPLACE_EPOCH = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


@contextmanager
def scoped(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the plans that are run inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class BucketedLog:
    """Rows of ``schema`` at ``path``, bucketed on the slot of ``keys``.

    The number of buckets holds for the life of the log. A table that the catalog does
    not know, as after a restart with a catalog in memory, is attached to its files.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        keys: Sequence[str],
        buckets: int = BUCKETS,
    ):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.name = "log_" + hashlib.md5(path.encode()).hexdigest()
        fields = [f for f in T.StructType.fromDDL(schema) if f.name != SLOT]
        self.columns = [f.name for f in fields]
        ddl = T.StructType(fields).toDDL()
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        if not spark.catalog.tableExists(self.name):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({ddl}, {SLOT} INT, {EPOCH} INT) "
                f"USING parquet PARTITIONED BY ({EPOCH}) "
                f"CLUSTERED BY ({SLOT}) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
            if path_exists(spark, path):
                spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def slot(self) -> Column:
        """Slot of a row's key; null keys have one as well."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def slots_of(self, rows: DataFrame) -> list[int]:
        """Slots that the keys of ``rows`` touch: at most one number per bucket."""
        return sorted(r[0] for r in rows.select(self.slot().alias(SLOT)).distinct().collect())

    def read(self, slots: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """Rows with their slot and epoch, of the given slots and of earlier epochs."""
        self.spark.catalog.refreshTable(self.name)
        rows = self.spark.table(self.name)
        if before is not None:
            rows = rows.filter(F.col(EPOCH) < before)
        return rows if slots is None else rows.filter(F.col(SLOT).isin(list(slots)))

    def write(self, rows: DataFrame, epoch: int) -> None:
        """The rows of an epoch; those of an earlier attempt are replaced.

        The rows may be made from earlier epochs of the same log: Spark writes beside the
        table and moves what it wrote when all of it is there.
        """
        dealt = rows.select(*self.columns).withColumn(SLOT, self.slot()).hint("rebalance", SLOT)
        view = f"rows_{uuid.uuid4().hex}"
        session = dealt.sparkSession
        dealt.createOrReplaceTempView(view)
        try:
            with scoped(session, CO_LOCATED | REPLACE_EPOCH):
                session.sql(
                    f"INSERT OVERWRITE TABLE {self.name} "
                    f"SELECT *, CAST({epoch} AS INT) AS {EPOCH} FROM {view}"
                )
        finally:
            session.catalog.dropTempView(view)

    def unknown(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Rows whose key an earlier epoch does not hold; only their buckets are read."""
        known = self.read(self.slots_of(rows), before).select(SLOT, *self.keys)
        slotted = rows.withColumn(SLOT, self.slot())
        return slotted.join(known, [SLOT, *self.keys], "left_anti").select(*rows.columns)

    def rows_without(self, other: BucketedLog) -> DataFrame:
        """Rows of this log whose key ``other`` does not hold; neither log is shuffled."""
        self.check_same_layout(other)
        on = [SLOT, *self.keys]
        return self.read().join(other.read().select(*on), on, "left_anti")

    def rows_marked(self, other: BucketedLog, out: str) -> DataFrame:
        """Rows of this log with ``out``: whether ``other`` holds their key, once or more."""
        self.check_same_layout(other)
        on = [SLOT, *self.keys]
        marks = other.read().select(*on).distinct().withColumn(out, F.lit(True))
        joined = self.read().join(marks, on, "left")
        return joined.withColumn(out, F.coalesce(out, F.lit(False)))

    def check_same_layout(self, other: BucketedLog) -> None:
        if (self.keys, self.buckets) != (other.keys, other.buckets):
            raise ValueError("the logs must be bucketed on the same keys alike")
