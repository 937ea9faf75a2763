"""Data-quality checks: rules in, one row per violation out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas


@dataclass(frozen=True)
class RowRule:
    """Broken when ``test`` is true for a row; NULL counts as kept."""

    name: str
    test: Column


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null:{column}", F.col(column).isNull())


def one_of(column: str, allowed: Sequence[str]) -> RowRule:
    return RowRule(f"one_of:{column}", ~F.col(column).isin(*allowed))


def in_range(column: str, low, high) -> RowRule:
    return RowRule(f"range:{column}", ~F.col(column).between(low, high))


def at_least(column: str, low) -> RowRule:
    return RowRule(f"range:{column}", F.col(column) < low)


def max_length(column: str, limit: int) -> RowRule:
    return RowRule(f"length:{column}", F.length(column) > limit)


def holds(name: str, condition: Column) -> RowRule:
    """Cross-column rule: broken when ``condition`` is false."""
    return RowRule(f"rule:{name}", ~condition)


def row_violations(df: DataFrame, key: str, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules in one pass over the table."""
    broken = [F.when(F.coalesce(r.test, F.lit(False)), F.lit(r.name)) for r in rules]
    names = F.filter(F.array(*broken), lambda n: n.isNotNull())
    return df.select(
        F.explode(names).alias("rule"), F.col(key).cast("string").alias("row_key")
    )


def unique_violations(
    df: DataFrame, name: str, columns: Sequence[Column], where: Column | None = None
) -> DataFrame:
    """Keys that occur more than once; NULL in a key never conflicts."""
    rows = df if where is None else df.filter(where)
    keys = [f"_key_{i}" for i in range(len(columns))]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    # Grouped on the columns; joined only for the report, where texts may look alike.
    return (
        rows.filter(complete)
        .groupBy(*[c.alias(k) for c, k in zip(columns, keys, strict=True)])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select(
            F.lit(f"unique:{name}").alias("rule"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("row_key"),
        )
    )


def foreign_key_violations(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Distinct values without a parent row; the distinct runs before the join."""
    values = df.select(F.col(column).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    return values.join(
        parent.select(F.col(parent_column).alias("_v")).distinct(), "_v", "left_anti"
    ).select(F.lit(f"foreign_key:{column}").alias("rule"), F.col("_v").cast("string").alias("row_key"))


def check(parts: Sequence[DataFrame]) -> DataFrame:
    """All violations as one frame ``(rule, row_key)``."""
    return reduce(DataFrame.unionByName, parts)


def document_rules() -> list[RowRule]:
    """Row rules of core documents."""
    return [
        not_null("source_type"),
        not_null("source_id"),
        not_null("review_status"),
        one_of("source_type", schemas.SOURCE_TYPES),
        one_of("review_status", schemas.REVIEW_STATUSES),
        in_range("confidence_score", 0, 1),
        max_length("source_id", 500),
        max_length("subject", 1000),
        max_length("file_name", 500),
        max_length("content_preview", 500),
    ]


def transaction_rules() -> list[RowRule]:
    return [
        not_null("account_id"),
        not_null("txn_date"),
        not_null("amount"),
        not_null("dedup_hash"),
        max_length("description_raw", 1000),
    ]


def budget_rules() -> list[RowRule]:
    return [in_range("month_num", 1, 12), at_least("budget_amount", 0)]


def provider_rules() -> list[RowRule]:
    split = F.col("debit_col").isNotNull() & F.col("credit_col").isNotNull()
    return [holds("amount_columns", F.col("amount_col").isNotNull() | split)]


def checklist_item_rules() -> list[RowRule]:
    return [
        one_of("item_type", ("DOCUMENT", "RESPONSE")),
        holds(
            "document_has_category",
            (F.col("item_type") != "DOCUMENT") | F.col("category_id").isNotNull(),
        ),
        holds(
            "response_has_format",
            (F.col("item_type") != "RESPONSE") | F.col("response_format").isNotNull(),
        ),
    ]


def fy_rules() -> list[RowRule]:
    return [holds("end_after_start", F.col("end_date") > F.col("start_date"))]


def response_rules() -> list[RowRule]:
    return [
        one_of("is_applicable", ("YES", "NO", "UNKNOWN")),
        one_of("source", ("EMAIL", "DBEAVER", "SYSTEM")),
    ]


def account_rules() -> list[RowRule]:
    return [one_of("account_type", schemas.ACCOUNT_TYPES)]


def run_rules() -> list[RowRule]:
    return [one_of("status", schemas.RUN_STATUSES)]


def seed_if_absent(table: DataFrame, seeds: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Table plus the seed rows whose key it lacks (NULL key parts count as empty)."""
    names = [f"_k{i}" for i in range(len(keys))]

    def keyed(df: DataFrame) -> DataFrame:
        columns = [F.col(k) if isinstance(k, str) else k for k in keys]
        return df.withColumns(
            {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(names, columns)}
        )

    fresh = keyed(seeds).join(keyed(table).select(*names), names, "left_anti").drop(*names)
    return table.unionByName(fresh.select(*table.columns))
