"""Financial-year and calendar expressions (year runs 1 July to 30 June)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fy_of(day: Column) -> Column:
    """Financial year of a date, named by the calendar year it ends in."""
    return F.year(F.add_months(day, 6))


def fy_start(fy_year: Column) -> Column:
    return F.make_date(fy_year.cast("int") - 1, F.lit(7), F.lit(1))


def fy_end(fy_year: Column) -> Column:
    return F.make_date(fy_year.cast("int"), F.lit(6), F.lit(30))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def fy_folder(fy_year: Column) -> Column:
    """2025 -> ``2024-2025``."""
    year = fy_year.cast("int")
    return F.concat_ws("-", (year - 1).cast("string"), year.cast("string"))


def days_since_fy_start(as_of: Column, fy_year: Column) -> Column:
    return F.date_diff(as_of, fy_start(fy_year))


def epoch_ms(moment: Column) -> Column:
    """Whole milliseconds since 1970, rounded half away from zero."""
    micros = F.unix_micros(moment).cast("decimal(20,0)")
    return F.round(micros / 1000).cast("bigint")


def fy_calendar(fy_periods: DataFrame) -> DataFrame:
    """One row per calendar day covered by a period: ``(fy_day, fy_of_day)``.

    Expanding the handful of periods to days turns the "start <= d <= end"
    lookup into an equi-join on the day. The size is bounded by the calendar
    (366 rows per year), not by the data. Overlapping periods resolve to the
    smallest year so the lookup stays deterministic.
    """
    days = fy_periods.select(
        F.explode(F.sequence("start_date", "end_date")).alias("fy_day"), "fy_year"
    )
    return days.groupBy("fy_day").agg(F.min("fy_year").alias("fy_of_day"))


def with_fy_period(df: DataFrame, day: Column, fy_periods: DataFrame, out: str) -> DataFrame:
    """Add the period that contains ``day``; NULL outside every period."""
    calendar = fy_calendar(fy_periods).withColumnRenamed("fy_of_day", out)
    return (
        df.withColumn("_fy_day", day)
        .join(calendar, F.col("_fy_day") == F.col("fy_day"), "left")
        .drop("_fy_day", "fy_day")
    )


def high_water_mark(
    rows: DataFrame,
    overlap_days: int = 3,
    source_type: str = "GMAIL",
    floor: str = "2022-07-01",
) -> DataFrame:
    """Epoch ms to resume a mail scan from: newest row less an overlap, else a floor."""
    newest = F.max("received_at") - F.make_dt_interval(days=F.lit(overlap_days))
    start = F.to_timestamp(F.lit(f"{floor} 00:00:00"))
    return rows.filter(F.col("source_type") == source_type).agg(
        epoch_ms(F.coalesce(newest, start)).alias("watermark_ms")
    )


def high_water_mark_previous_fy(
    rows: DataFrame, today: Column, source_type: str = "GMAIL"
) -> DataFrame:
    """Older rule: newest row without overlap, else the start of the previous year.

    ``before_date`` is the upper bound of the scan: today or the end of the
    running financial year, whichever is earlier.
    """
    running = fy_of(today)
    start = F.to_timestamp(fy_start(running - 1))
    return rows.filter(F.col("source_type") == source_type).agg(
        epoch_ms(F.coalesce(F.max("received_at"), start)).alias("watermark_ms"),
        F.max(F.least(today, fy_end(running))).alias("before_date"),
    ).withColumn("before_date", F.coalesce("before_date", F.least(today, fy_end(running))))


def newest_mark(rows: DataFrame, value: str) -> DataFrame:
    """Highest value seen in a run (file time, ``landing_id``, message time)."""
    return rows.agg(F.max(value).alias("mark"))
