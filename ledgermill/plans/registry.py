"""Register of named queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import pin_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result with engine-neutral types for comparison with another engine.

    Whole numbers become BIGINT, decimals DOUBLE, dates and times ISO text. The
    library itself keeps DECIMAL, DATE and TIMESTAMP.
    """

    def neutral(field: T.StructField):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[neutral(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its DuckDB twin, left out where none exists."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(pin_settings(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
