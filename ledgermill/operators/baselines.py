"""Spending baselines that grow by months: quantile sketches, merged when they are read.

A month of a category is one sketch of its amounts, a few kilobytes whatever the number
of transactions. A new month is sketched from its own rows and written beside the others;
a baseline merges the sketches of the months before. Up to ``K`` amounts a sketch is
exact, beyond it the rank of a quantile is off by a share of about ``RANK_ERROR``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.calendar import month_start
from ledgermill.operators.buckets import REPLACE_EPOCH, scoped

K = 1024
# Two-sided error of ranks at 99 % confidence for K, as the sketch's authors state it.
RANK_ERROR = 0.0036
MONTHS = 12
LEAST_AMOUNTS = 5
# Our own threshold: quartile distances beyond the quartiles that make an outlier.
SPREADS = 1.5

SKETCHES = "category_id INT, month_start DATE, amounts BIGINT, sketch BINARY"


def _cents() -> Column:
    return (F.abs("amount") * 100).cast("bigint")


def month_sketches(txns: DataFrame, k: int = K) -> DataFrame:
    """One sketch of the absolute amounts, in cents, per category and month.

    Sketches are built on the map side and merged, so a category that holds most rows
    sends one sketch per task and month. Rows without a category or amount are left out.
    """
    return (
        txns.filter("category_id IS NOT NULL AND amount IS NOT NULL")
        .groupBy(
            F.col("category_id").cast("int").alias("category_id"),
            month_start(F.col("txn_date")).cast("date").alias("month_start"),
        )
        .agg(
            F.count(F.lit(1)).alias("amounts"),
            F.kll_sketch_agg_bigint(_cents(), F.lit(k)).alias("sketch"),
        )
    )


def write_months(sketches: DataFrame, path: str) -> None:
    """Store sketches by month; months that are there already are replaced, others stay."""
    with scoped(sketches.sparkSession, REPLACE_EPOCH):
        sketches.hint("rebalance", "month_start").write.mode("overwrite").partitionBy(
            "month_start"
        ).parquet(path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def month_baselines(sketches: DataFrame, months: int = MONTHS) -> DataFrame:
    """Median and quartiles of the ``months`` months before each month, per category.

    A sketch is handed to the months it counts for, so there is no join by range; what
    is merged is one sketch per category and month.
    """
    given = sketches.select(
        "category_id",
        "amounts",
        "sketch",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.lit(months)), lambda i: F.add_months("month_start", i)
            )
        ).alias("month_start"),
    )
    merged = given.groupBy("category_id", "month_start").agg(
        F.sum("amounts").alias("amounts"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )

    def quantile(rank: float) -> Column:
        return (F.kll_sketch_get_quantile_bigint("sketch", F.lit(rank)) / 100).cast("decimal(18,2)")

    return merged.select(
        "category_id",
        "month_start",
        "amounts",
        quantile(0.25).alias("low_quartile"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("high_quartile"),
    )


def median_outliers(
    txns: DataFrame,
    baselines: DataFrame,
    spreads: float = SPREADS,
    least_amounts: int = LEAST_AMOUNTS,
) -> DataFrame:
    """Transactions far above what their category spent in the months before.

    Far is more than ``spreads`` quartile distances above the upper quartile. A month
    with fewer than ``least_amounts`` amounts before it has no baseline.
    """
    known = baselines.filter(F.col("amounts") >= least_amounts)
    limit = F.col("high_quartile") + F.lit(str(spreads)).cast("decimal(4,2)") * (
        F.col("high_quartile") - F.col("low_quartile")
    )
    dated = txns.withColumn("month_start", month_start(F.col("txn_date")).cast("date"))
    joined = dated.join(known, ["category_id", "month_start"])
    return joined.withColumn("limit", limit).filter(F.abs("amount") > F.col("limit"))
