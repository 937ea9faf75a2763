"""Dashboard cards and the yearly report, on top of the mart views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Categories the investment page shows besides the income group.
INVESTMENT_CATEGORIES = (
    "Share Sale / CGT Event",
    "Dividend Statement",
    "Property Depreciation Schedule",
)


def home_cards(core: DataFrame, fy_year: int) -> DataFrame:
    """Waiting documents, and confirmed amount and count of a year, in one scan."""
    confirmed = (F.col("review_status") == "CONFIRMED") & (F.col("fy_year") == fy_year)
    return core.agg(
        F.count_if(F.col("review_status") == "NEEDS_REVIEW").alias("awaiting_review"),
        F.sum(F.when(confirmed, F.col("total_amount"))).alias("confirmed_total"),
        F.count_if(confirmed).alias("confirmed_records"),
    )


def records_by_status(core: DataFrame) -> DataFrame:
    return core.groupBy("review_status").agg(F.count(F.lit(1)).alias("records"))


def fy_pack(core: DataFrame) -> DataFrame:
    """Per year: confirmed total, count, categories covered and change on the year before."""
    per_category = (
        core.filter((F.col("review_status") == "CONFIRMED") & F.col("fy_year").isNotNull())
        .groupBy("fy_year", "tax_category_id")
        .agg(F.sum("total_amount").alias("_amount"), F.count(F.lit(1)).alias("_n"))
    )
    per_year = per_category.groupBy("fy_year").agg(
        F.sum("_amount").alias("total_amount"),
        F.sum("_n").alias("record_count"),
        F.count("tax_category_id").alias("categories_covered"),
    )
    # One row per year is left, so the unpartitioned window stays tiny.
    by_year = Window.orderBy("fy_year")
    before = F.lag("total_amount").over(by_year)
    return per_year.withColumn("previous_total", before).withColumn(
        "yoy_change", F.col("total_amount") - F.col("previous_total")
    )


def fy_pack_categories(summary: DataFrame, fy_year: int) -> DataFrame:
    """Category, count and amount of one year of the tax summary."""
    return summary.filter(F.col("fy_year") == fy_year).select(
        "tax_category", "document_count", "total_deductible_amt"
    )


def investment_documents(documents: DataFrame, fy_year: int | None = None) -> DataFrame:
    """Documents of the income group or of the named categories."""
    kept = documents.filter(
        (F.col("tax_category_group") == "Income")
        | F.col("tax_category").isin(*INVESTMENT_CATEGORIES)
    )
    return kept if fy_year is None else kept.filter(F.col("fy_year") == fy_year)


def tax_report(summary: DataFrame, documents: DataFrame, wfh: DataFrame, fy_year: int) -> DataFrame:
    """Report rows ``(section, sort_key, label, document_count, amount)`` of a year.

    Sections: deductions by category, income summary, inventory by status and
    the work-from-home amounts. All are grouped results.
    """
    year = documents.filter(F.col("fy_year") == fy_year)
    money = "decimal(38,2)"

    def rows(df: DataFrame, section: str, label: Column, n: Column, amount: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), label.cast("string").alias("label"),
            n.cast("bigint").alias("document_count"), amount.cast(money).alias("amount"),
        )

    none = F.lit(None)
    deductions = rows(
        summary.filter(F.col("fy_year") == fy_year), "1 deductions", F.col("tax_category"),
        F.col("document_count"), F.col("total_deductible_amt"),
    )
    income = rows(
        year.filter(F.col("tax_category_group") == "Income").groupBy("tax_category").agg(
            F.count(F.lit(1)).alias("n")
        ),
        "2 income", F.col("tax_category"), F.col("n"), none,
    )
    inventory = rows(
        year.groupBy("review_status").agg(F.count(F.lit(1)).alias("n")),
        "3 inventory", F.col("review_status"), F.col("n"), none,
    )
    home = wfh.filter(F.col("fy_year") == fy_year)
    fixed = rows(home, "4 work from home", F.lit("fixed rate"), none, F.col("fixed_rate_amount"))
    actual = rows(home, "4 work from home", F.lit("actual cost"), none, F.col("actual_cost_amount"))
    return (
        deductions.unionByName(income).unionByName(inventory).unionByName(fixed)
        .unionByName(actual)
    )


def report_markdown(report: DataFrame) -> DataFrame:
    """The report as Markdown table lines, one text row each."""
    line = F.format_string(
        "| %s | %s | %s | %s |",
        "section",
        "label",
        F.coalesce(F.col("document_count").cast("string"), F.lit("")),
        F.coalesce(F.col("amount").cast("string"), F.lit("")),
    )
    return report.orderBy("section", "label").select(line.alias("value"))


def write_tax_report(report: DataFrame, path: str) -> None:
    """JSON rows and a Markdown table below ``path``."""
    report.write.mode("overwrite").json(f"{path}/json")
    report_markdown(report).write.mode("overwrite").text(f"{path}/markdown")
