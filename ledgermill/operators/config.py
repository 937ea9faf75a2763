"""Encrypted configuration values per package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.crypto import decrypt, encrypt

KEY_SETTING = "spark.ledgermill.config.key"


def config_key(spark: SparkSession) -> str:
    """Key from the Spark configuration; it never lies in the data."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"set {KEY_SETTING} to a 16, 24 or 32 byte key")
    return key


def seal(rows: DataFrame, key: str | Column) -> DataFrame:
    """``(package_nme, var_nme, value)`` to stored rows with an encrypted value."""
    return rows.select("package_nme", "var_nme", encrypt(F.col("value"), key).alias("var_val"))


def config_vars(stored: DataFrame, package: str, key: str | Column) -> DataFrame:
    """Every variable of a package in clear text."""
    return stored.filter(F.col("package_nme") == package).select(
        "var_nme", decrypt(F.col("var_val"), key).alias("var_val")
    )


def upsert_vars(stored: DataFrame, rows: DataFrame, key: str | Column) -> DataFrame:
    """Stored rows with the given values added or replaced."""
    new = seal(rows, key)
    kept = stored.join(new, ["package_nme", "var_nme"], "left_anti")
    return kept.select("package_nme", "var_nme", "var_val").unionByName(new)


def stored_mark(messages: DataFrame, package: str, name: str) -> DataFrame:
    """Newest message time of a run as a variable row; nothing when there is none."""
    newest = messages.agg(F.max(F.col("internalDate").try_cast("bigint")).alias("ms"))
    return newest.filter(F.col("ms") > 0).select(
        F.lit(package).alias("package_nme"),
        F.lit(name).alias("var_nme"),
        F.col("ms").cast("string").alias("value"),
    )
