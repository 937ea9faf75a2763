"""Helpers for keyed work: one row per key, and surrogate keys without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import scratch_dir


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    ``row_number() = 1`` lets Spark place a group limit before the shuffle, so
    a key that holds a third of all rows sends one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def with_surrogate_key(
    df: DataFrame, keys: Sequence[Column], after: Column, out: str, digits: int = 3
) -> DataFrame:
    """Unique ids above ``after``, stable for the same rows.

    Rows (unique on ``keys``) are spread over ``16 ** digits`` buckets of their
    key digest and numbered inside the bucket; bucket ``b`` uses the ids
    ``b, b + n, b + 2n ...``. No task sees more than its bucket and no running
    total over all rows is needed. Gaps are allowed, as with a sequence.
    """
    buckets = 16**digits
    digest = F.md5(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    number = F.conv(F.substring("_digest", 1, digits), 16, 10).cast("bigint")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest"))
    return (
        df.withColumn("_digest", digest)
        .withColumn("_bucket", number)
        .withColumn(out, after + (rank - 1) * F.lit(buckets) + F.col("_bucket") + 1)
        .drop("_digest", "_bucket")
    )


def sorted_places(df: DataFrame, groups: Sequence[Column], order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with ``out``: the place of each row in its group, from 1, by ``order``.

    For groups that are few and large, or for one group of all rows. Rows are dealt by
    ranges of group and order, so a group spreads over many tasks; a task numbers its
    rows of a group, and the rows of the group in the ranges before, one count per range
    and group, are added. The sorted rows are written once, as a second sort may cut its
    ranges elsewhere. ``order`` should tell rows apart; equal rows may split anyhow.
    """
    spark = df.sparkSession
    names = [f"_group_{i}" for i in range(len(groups))]
    keyed = df.withColumns(dict(zip(names, groups, strict=True)))
    dealt = keyed.repartitionByRange(*[F.col(n) for n in names], *order)
    ranged = dealt.sortWithinPartitions(*[F.col(n) for n in names], *order).withColumn(
        "_at", F.monotonically_increasing_id()
    )
    path = scratch_dir(spark, "sorted")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn(
        "_range", F.shiftright("_at", 33)
    )
    inside = ["_range", *names]
    counts = rows.groupBy(*inside).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row per range and group that meet; a range holds neighbours in the order.
    earlier = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_range").alias("_of_range"),
        *[F.col(n).alias(f"_of{n}") for n in names],
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("_range") == F.col("_of_range")
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_of{name}"))
    place = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return rows.join(offsets, same).select(*df.columns, place.alias(out))
