"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import pin_settings, scratch_dir

WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch: texts may be long, so a batch must not hold many.
ARROW_ROWS = "512"

MIN_PARTS_KEY = "spark.sql.files.minPartitionNum"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the library plus small Arrow batches."""
    pin_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The lineage ends at the written table, so a lost executor costs a read and
    not a second run of what made it; the reader also knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def fresh(columns: list[str], name: str) -> str:
    """``name``, or ``name`` with underscores, that no column has yet in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a scan: the place of the row in it.

    A second scan may be split in another way, so the result must be read once
    only; what needs the numbers again takes :func:`numbered_copy`.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered_scan(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of files, the same at every read in this session; nothing is copied.

    ``df`` must be the direct read of files. Spark splits them by their bytes and the
    least number of parts, which it takes from the cores at hand unless it is set.
    """
    spark = df.sparkSession
    if spark.conf.get(MIN_PARTS_KEY, None) is None:
        spark.conf.set(MIN_PARTS_KEY, str(spark.sparkContext.defaultParallelism))
    return with_row_id(df, name)


def numbered_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` with row numbers, written once, so that every later read has the same numbers."""
    return stored(with_row_id(df, name), "numbered")


def numbered_rows(df: DataFrame, name: str, scanned: bool) -> DataFrame:
    """Row numbers for rows that are read more than once: a copy, or places in a file scan."""
    return numbered_scan(df, name) if scanned else numbered_copy(df, name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def word_count(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(digest: Column, modulus: int) -> Column:
    return F.pmod(digest, F.lit(modulus))


def levels_for(count: int) -> int:
    """Halvings until one is left of ``count``."""
    return max(0, math.ceil(math.log2(count))) if count > 1 else 0


@functools.cache
def ascii_space() -> str:
    return " \t\n\x0b\x0c\r"
