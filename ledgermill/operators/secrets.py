"""Secrets as one-row tables that are read at run time.

A literal in a plan is readable in ``explain`` and in event logs. Signing pads and keys
are therefore columns of a table with one row, which a plan names by its path only; the
folder's own permissions decide who reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from ledgermill.functions.crypto import Pads, hmac_pads

SECRET = "inner BINARY, outer BINARY, key BINARY"


def keep_secret(spark: SparkSession, path: str, secret: str) -> None:
    """Write the secret and its signing pads as the one row of a table at ``path``."""
    inner, outer = hmac_pads(secret)
    row = (bytes.fromhex(inner), bytes.fromhex(outer), secret.encode("utf-8"))
    spark.createDataFrame([row], SECRET).coalesce(1).write.mode("overwrite").parquet(path)


def _kept(spark: SparkSession, path: str, column: str) -> Column:
    return spark.read.schema(SECRET).parquet(path).select(column).scalar()


def signing_pads(spark: SparkSession, path: str) -> Pads:
    """What signatures are made with, in place of the secret itself."""
    return Pads(_kept(spark, path, "inner"), _kept(spark, path, "outer"))


def encryption_key(spark: SparkSession, path: str) -> Column:
    """The secret as an encryption key."""
    return _kept(spark, path, "key")
