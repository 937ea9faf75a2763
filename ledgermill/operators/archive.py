"""Where a classified document is filed: year, category path, name and collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions import values
from ledgermill.functions.calendar import fy_folder, fy_of
from ledgermill.functions.text import filed_name
from ledgermill.operators.merge import FOLDER_THRESHOLD

# Years a classifier may plausibly name.
MIN_FILING_FY, MAX_FILING_FY = 2020, 2035


def filing_fy(raw_year: Column, today: Column) -> Column:
    """The classifier's year when plausible, else the year running today."""
    year = values.safe_int(raw_year)
    return F.when(year.between(MIN_FILING_FY, MAX_FILING_FY), year).otherwise(fy_of(today))


def filing_fy_folder(year: Column, fy_periods: DataFrame) -> Column:
    """Drop-folder form: the classifier's year, else the period flagged current."""
    current = fy_periods.filter("is_current").agg(F.max(F.year("end_date"))).scalar()
    return F.coalesce(F.nullif(year, F.lit(0)), current)


def category_path(
    category: Column, block: str = seeds.DOCUMENT_PATHS, default: str = seeds.DOCUMENT_DEFAULT_PATH
) -> Column:
    """Sub-path of a category; unknown names go to the default path."""
    pairs = [F.lit(x) for item in seeds.path_map(block).items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(default))


def folder_path(
    category: Column,
    confidence: Column,
    threshold: float = FOLDER_THRESHOLD,
    block: str = seeds.FOLDER_PATHS,
) -> Column:
    """Drop-folder path: an unsure file goes to "other" whatever its category."""
    return F.when(
        confidence < threshold, F.lit(seeds.FOLDER_DEFAULT_PATH)
    ).otherwise(category_path(category, block, seeds.FOLDER_DEFAULT_PATH))


def folder_status(confidence: Column, threshold: float = FOLDER_THRESHOLD) -> Column:
    return F.when(confidence < threshold, "NEEDS_REVIEW").otherwise("PENDING")


def destination(fy_year: Column, path: Column, supplier: Column, file_name: Column) -> Column:
    return F.concat_ws("/", fy_folder(fy_year), path, filed_name(supplier, file_name))


def _suffixed(path: Column, suffix: Column) -> Column:
    """``a/b.pdf`` -> ``a/b_<suffix>.pdf``; a name without a dot gets it at the end."""
    extension = F.regexp_extract(path, r"(\.[^./]*)$", 1)
    stem = F.substring(path, F.lit(1), F.length(path) - F.length(extension))
    return F.concat(stem, F.lit("_"), suffix, extension)


def _claim(docs: DataFrame, path: str, taken: DataFrame | None, won: str) -> DataFrame:
    """Flag the one row per path that may use it (smallest id, path not taken).

    The winner is found with a partial aggregate and joined back on the id,
    which is unique, so a path wanted by a third of all files is no hot key.
    """
    winners = docs.filter(F.col(path).isNotNull()).groupBy(path).agg(F.min("doc_id").alias("_winner"))
    if taken is not None:
        winners = winners.join(taken.select(F.col("path").alias(path)).distinct(), path, "left_anti")
    return (
        docs.join(winners.select("_winner"), F.col("doc_id") == F.col("_winner"), "left")
        .withColumn(won, F.col("_winner").isNotNull())
        .drop("_winner")
    )


def archive_index(docs: DataFrame, filed_at: Column, taken: DataFrame | None = None) -> DataFrame:
    """Final path per document: ``docs(doc_id, path)`` to ``(doc_id, path, final_path, collided)``.

    The first file keeps its name. A collision gets a time stamp, and where
    even that is taken the document id as well, so final paths are unique.
    """
    first = _claim(docs.select("doc_id", "path"), "path", taken, "_plain")
    stamped = first.withColumn(
        "_stamped",
        F.when(
            ~F.col("_plain"), _suffixed(F.col("path"), F.date_format(filed_at, "yyyyMMdd_HHmmss"))
        ),
    )
    second = _claim(stamped, "_stamped", taken, "_dated")
    unique = _suffixed(F.col("_stamped"), F.col("doc_id").cast("string"))
    return second.select(
        "doc_id",
        "path",
        F.when(F.col("_plain"), F.col("path"))
        .when(F.col("_dated"), F.col("_stamped"))
        .otherwise(unique)
        .alias("final_path"),
        (~F.col("_plain")).alias("collided"),
    )


def write_archive_index(index: DataFrame, path: str) -> None:
    """Index laid out by financial-year folder and category path.

    Rebalancing groups the rows per folder and splits a folder that holds too
    many of them over several tasks.
    """
    parts = F.split("final_path", "/")
    rows = index.withColumn("fy_dir", F.element_at(parts, 1)).withColumn(
        "category_path", F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "-")
    )
    (
        rows.hint("rebalance", "fy_dir", "category_path")
        .write.mode("append")
        .partitionBy("fy_dir", "category_path")
        .parquet(path)
    )
