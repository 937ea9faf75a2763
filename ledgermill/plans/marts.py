"""Mart views as DataFrame functions.

Facts are grouped on their own ids before any dimension is joined: the partial
aggregate takes the weight out of hot accounts and categories, and the joins
that follow see one row per group.

Views that return single documents or transactions are unordered unless asked with
``ordered=True``: a total order costs a second pass over the scan and a shuffle of
every row, and belongs to the sink that shows the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.calendar import fy_of, month_label, month_start
from ledgermill.schemas import LINE_ITEMS
from ledgermill.seeds import UTILITY_CATEGORIES

# Statuses that count in the tax summary and in the checklist.
SUMMARY_STATUSES = ("PENDING", "CONFIRMED")
CHECKLIST_STATUSES = ("CONFIRMED", "AUTO_CONFIRMED")


def _labels(fy_periods: DataFrame) -> DataFrame:
    return fy_periods.select(F.col("fy_year").alias("_fy"), "fy_label")


def _tax_names(categories: DataFrame, *extra: str) -> DataFrame:
    return categories.select(
        F.col("category_id").alias("_cat"),
        F.col("category_nme").alias("tax_category"),
        F.col("category_grp").alias("tax_category_group"),
        *extra,
    )


def vw_tax_documents(
    core: DataFrame, fy_periods: DataFrame, categories: DataFrame, include_rejected: bool = True
) -> DataFrame:
    """Documents with year label and category; optionally without rejected ones."""
    docs = core if include_rejected else core.filter(
        ~F.col("review_status").eqNullSafe("AUTO_REJECTED")
    )
    return (
        docs.withColumnRenamed("fy_year", "_doc_fy")
        .join(_labels(fy_periods), F.col("_doc_fy") == F.col("_fy"), "left")
        .join(
            _tax_names(categories, "ato_reference"),
            F.col("tax_category_id") == F.col("_cat"),
            "left",
        )
        .select(
            "doc_id", "source_type", "subject", "sender_email", "received_at", "fy_label",
            F.col("_fy").alias("fy_year"), "tax_category", "tax_category_group", "ato_reference",
            "is_deductible", "deductible_amount", "confidence_score", "review_status",
            "reviewer_notes", "file_name", "file_ext", "content_preview", "created_at",
            "updated_at",
        )
    )


def vw_tax_summary(
    core: DataFrame,
    fy_periods: DataFrame,
    categories: DataFrame,
    statuses: tuple[str, ...] = SUMMARY_STATUSES,
) -> DataFrame:
    """Deductible documents by year and category, newest year first."""
    totals = (
        core.filter(F.col("is_deductible") & F.col("review_status").isin(*statuses))
        .groupBy("fy_year", "tax_category_id")
        .agg(
            F.count("doc_id").alias("document_count"),
            F.sum("deductible_amount").alias("total_deductible_amt"),
            F.min("received_at").alias("earliest_doc"),
            F.max("received_at").alias("latest_doc"),
        )
    )
    return (
        totals.join(_labels(fy_periods), F.col("fy_year") == F.col("_fy"))
        .join(
            _tax_names(categories, "ato_reference", "sort_order"),
            F.col("tax_category_id") == F.col("_cat"),
        )
        .select(
            "fy_label", "fy_year", "tax_category_group", "tax_category", "ato_reference",
            "sort_order", "document_count", "total_deductible_amt", "earliest_doc", "latest_doc",
        )
        .orderBy(F.col("fy_year").desc(), "sort_order")
    )


def _spending_names(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("category_id").alias("_cat"), "category_nme", "subcategory_nme", "is_income",
        "is_deductible",
    )


def vw_monthly_spending(
    txns: DataFrame, accounts: DataFrame, categories: DataFrame, budgets: DataFrame
) -> DataFrame:
    """Spend per account, month and category with the month's budget."""
    per_month = txns.groupBy(
        "account_id", "category_id", month_start(F.col("txn_date")).alias("month_start")
    ).agg(F.sum("amount").alias("_amount"), F.count(F.lit(1)).alias("_count"))
    targets = budgets.select(
        F.col("category_id").alias("_bcat"), F.col("fy_year").alias("_bfy"),
        F.col("month_num").alias("_bmonth"), "budget_amount",
    )
    on_budget = (
        (F.col("category_id") == F.col("_bcat"))
        & (F.col("_fy") == F.col("_bfy"))
        & (F.col("txn_month") == F.col("_bmonth"))
    )
    keys = (
        "account_id", "account_nme", "provider", "month_start", "month_label", "txn_year",
        "txn_month", "category_nme", "subcategory_nme", "is_income", "is_deductible",
        "budget_amount",
    )
    return (
        per_month.withColumn("month_label", month_label(F.col("month_start")))
        .withColumn("txn_year", F.year("month_start"))
        .withColumn("txn_month", F.month("month_start"))
        .withColumn("_fy", fy_of(F.col("month_start")))
        .join(accounts.select("account_id", "account_nme", "provider"), "account_id")
        .join(_spending_names(categories), F.col("category_id") == F.col("_cat"), "left")
        .join(targets, on_budget, "left")
        .groupBy(*keys)
        .agg(F.sum("_amount").alias("total_amount"), F.sum("_count").alias("txn_count"))
        .orderBy(F.col("month_start").desc(), F.col("category_nme").asc_nulls_last())
    )


def vw_spending_by_category(txns: DataFrame, categories: DataFrame) -> DataFrame:
    """All-time totals per category, largest turnover first."""
    per_id = txns.groupBy("category_id").agg(
        F.count(F.lit(1)).alias("_count"),
        F.sum("amount").alias("_amount"),
        F.sum(F.abs("amount")).alias("_turnover"),
        F.min("txn_date").alias("_first"),
        F.max("txn_date").alias("_last"),
    )
    total, count = F.sum("_amount"), F.sum("_count")
    return (
        per_id.join(_spending_names(categories), F.col("category_id") == F.col("_cat"), "left")
        .groupBy("category_nme", "subcategory_nme", "is_income", "is_deductible")
        .agg(
            count.alias("txn_count"),
            total.alias("total_amount"),
            (total.cast("double") / count).alias("avg_amount"),
            F.min("_first").alias("first_txn_date"),
            F.max("_last").alias("last_txn_date"),
            F.sum("_turnover").alias("_turnover"),
        )
        .orderBy(F.col("_turnover").desc())
        .drop("_turnover")
    )


def _income_and_spend(txns: DataFrame, categories: DataFrame, period: Column, *extra: Column) -> DataFrame:
    """Income and spend per period. Uncategorised rows count as neither."""
    names = ["_income_sum", "_spend_sum"] + [f"_extra{i}" for i in range(len(extra))]
    per_id = txns.groupBy(period.alias("period"), "category_id").agg(
        F.sum("amount").alias(names[0]),
        F.sum(F.abs("amount")).alias(names[1]),
        *[F.sum(e).alias(n) for e, n in zip(extra, names[2:])],
    )
    zero = F.lit(0).cast("decimal(12,2)")
    return (
        per_id.join(_spending_names(categories), F.col("category_id") == F.col("_cat"), "left")
        .groupBy("period")
        .agg(
            F.sum(F.when(F.col("is_income"), F.col("_income_sum")).otherwise(zero)).alias("total_income"),
            F.sum(F.when(~F.col("is_income"), F.col("_spend_sum")).otherwise(zero)).alias("total_spend"),
            *[F.sum(n).alias(n) for n in names[2:]],
        )
    )


def vw_savings_rate(txns: DataFrame, categories: DataFrame) -> DataFrame:
    """Monthly income, spend, net and savings rate; no rate without income."""
    totals = _income_and_spend(txns, categories, month_start(F.col("txn_date")))
    net = F.col("total_income") - F.col("total_spend")
    rate = F.when(
        F.col("total_income") > 0, F.round(F.try_divide(net, F.col("total_income")) * 100, 1)
    )
    return totals.select(
        month_label(F.col("period")).alias("month_label"),
        F.col("period").alias("month_start"),
        F.round("total_income", 2).alias("total_income"),
        F.round("total_spend", 2).alias("total_spend"),
        F.round(net, 2).alias("net_savings"),
        rate.alias("savings_rate_pct"),
    ).orderBy(F.col("month_start").desc())


def vw_anomalies(
    txns: DataFrame, accounts: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """Flagged transactions with labels, newest first."""
    rows = (
        txns.filter("is_anomaly")
        .join(accounts.select("account_id", "account_nme", "provider"), "account_id")
        .join(
            categories.select(F.col("category_id").alias("_cat"), "category_nme", "subcategory_nme"),
            F.col("category_id") == F.col("_cat"),
            "left",
        )
        .select(
            "txn_id", "account_id", "account_nme", "provider", "txn_date", "amount",
            "description_clean", "description_raw", "category_nme", "subcategory_nme",
            "anomaly_reason", "review_status", "created_at",
        )
    )
    return rows.orderBy(F.col("txn_date").desc()) if ordered else rows


def vw_fy_cashflow(txns: DataFrame, categories: DataFrame, fy_periods: DataFrame) -> DataFrame:
    """Income, spend and deductibles per financial year."""
    deductible = F.when(F.col("is_deductible"), F.col("deductible_amount")).otherwise(
        F.lit(0).cast("decimal(10,2)")
    )
    totals = _income_and_spend(txns, categories, fy_of(F.col("txn_date")), deductible)
    return (
        totals.withColumnRenamed("period", "fy_year")
        .join(_labels(fy_periods), F.col("fy_year") == F.col("_fy"), "left")
        .select(
            "fy_year", "fy_label", "total_income", "total_spend",
            F.col("_extra0").alias("total_deductible"),
        )
        .orderBy(F.col("fy_year").desc())
    )


def vw_checklist_completeness(
    items: DataFrame,
    responses: DataFrame,
    categories: DataFrame,
    core: DataFrame,
    statuses: tuple[str, ...] = CHECKLIST_STATUSES,
) -> DataFrame:
    """Status of every active item per answered year, with its document count."""
    counts = (
        core.filter(F.col("review_status").isin(*statuses))
        .groupBy(F.col("tax_category_id").alias("_dc_cat"), F.col("fy_year").alias("_dc_fy"))
        .agg(F.count(F.lit(1)).alias("_docs"))
    )
    names = categories.select(
        F.col("category_id").alias("_cat"), "category_nme", "category_grp", "is_deductible"
    )
    answers = responses.select(
        F.col("item_id").alias("_item"), "fy_year", "is_applicable", "response_value",
        "responded_at",
    )
    is_document = F.col("item_type") == "DOCUMENT"
    required = F.col("always_required") | F.coalesce(
        F.col("is_applicable") == "YES", F.lit(False)
    )
    status = (
        F.when(F.col("item_type") == "RESPONSE", "N/A")
        .when(required & (F.col("doc_count") > 0), "SATISFIED")
        .when(required, "MISSING")
        .when(F.col("is_applicable") == "NO", "NOT_APPLICABLE")
        .otherwise("UNKNOWN")
    )
    return (
        items.filter("active")
        .join(answers, F.col("item_id") == F.col("_item"), "left")
        .join(names, F.col("category_id") == F.col("_cat"), "left")
        .join(
            counts,
            (F.col("category_id") == F.col("_dc_cat")) & (F.col("fy_year") == F.col("_dc_fy")),
            "left",
        )
        .withColumn("doc_count", F.coalesce("_docs", F.lit(0)))
        .select(
            "item_id", "section", "item_name", "description", "item_type", "always_required",
            "applicability_group", "applicability_question", "category_nme", "category_grp",
            "is_deductible", "fy_year", "is_applicable", "response_value", "responded_at",
            "doc_count", status.alias("status"), (is_document & required).alias("in_scope"),
        )
    )


def _utility_documents(core: DataFrame, fy_periods: DataFrame, categories: DataFrame) -> DataFrame:
    """Documents of the utility categories; the filter sits on the small side."""
    kept = categories.filter(F.col("category_nme").isin(*UTILITY_CATEGORIES)).select(
        F.col("category_id").alias("_cat"), "category_nme"
    )
    return (
        core.withColumnRenamed("fy_year", "_doc_fy")
        .join(kept, F.col("tax_category_id") == F.col("_cat"))
        .join(_labels(fy_periods), F.col("_doc_fy") == F.col("_fy"), "left")
        .withColumn("fy_year", F.col("_fy"))
    )


_BILL_ORDER = ("billing_start", "supplier_name")


def vw_utility_bills(
    core: DataFrame, fy_periods: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """Bills of the utility categories by billing start, missing ones last."""
    rows = (
        _utility_documents(core, fy_periods, categories)
        .select(
            "doc_id", "source_id", "subject", "supplier_name", "account_ref", "supply_address",
            "billing_start", "billing_end", "document_date", "total_amount", "gst_amount",
            "line_items", "category_nme", "fy_label", "fy_year", "review_status", "filed_path",
            "confidence_score", "created_at",
        )
    )
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in _BILL_ORDER]) if ordered else rows


def line_items_from_json(json: Column) -> Column:
    """JSON text to the item array; anything that is not an array counts as empty."""
    is_array = F.coalesce(F.ltrim(json).startswith("["), F.lit(False))
    return F.coalesce(
        F.when(is_array, F.from_json(json, LINE_ITEMS)), F.array().cast(LINE_ITEMS)
    )


def vw_utility_line_items(
    core: DataFrame, fy_periods: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """One row per charge line, numbered from 1, with typed numbers."""

    def number(field: str) -> Column:
        return F.nullif(F.col(f"item.{field}"), F.lit("")).try_cast("decimal(18,4)")

    docs = _utility_documents(core, fy_periods, categories)
    rows = (
        docs.select(
            "doc_id", "supplier_name", "account_ref", "supply_address", "billing_start",
            "billing_end", "fy_label", "fy_year", "category_nme", "review_status", "created_at",
            F.posexplode("line_items").alias("_pos", "item"),
        )
        .select(
            "doc_id", "supplier_name", "account_ref", "supply_address", "billing_start",
            "billing_end", "fy_label", "fy_year", "category_nme",
            (F.col("_pos") + 1).alias("line_num"),
            F.col("item.description").alias("description"),
            F.col("item.period").alias("period"),
            number("quantity").alias("quantity"),
            F.col("item.unit").alias("unit"),
            number("rate").alias("rate"),
            number("amount").alias("amount"),
            "review_status", "created_at",
        )
    )
    order = [F.col(c).asc_nulls_last() for c in _BILL_ORDER]
    return rows.orderBy(*order, "doc_id", "line_num") if ordered else rows


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views under the mart names, for SQL users.

    ``tables`` holds ``documents, transactions, accounts, categories, budgets,
    fy_periods, tax_categories, items, responses``.
    """
    t = tables
    views = {
        "vw_tax_documents": vw_tax_documents(t["documents"], t["fy_periods"], t["tax_categories"]),
        "vw_tax_summary": vw_tax_summary(t["documents"], t["fy_periods"], t["tax_categories"]),
        "vw_monthly_spending": vw_monthly_spending(
            t["transactions"], t["accounts"], t["categories"], t["budgets"]
        ),
        "vw_spending_by_category": vw_spending_by_category(t["transactions"], t["categories"]),
        "vw_savings_rate": vw_savings_rate(t["transactions"], t["categories"]),
        "vw_anomalies": vw_anomalies(t["transactions"], t["accounts"], t["categories"]),
        "vw_fy_cashflow": vw_fy_cashflow(t["transactions"], t["categories"], t["fy_periods"]),
        "vw_checklist_completeness": vw_checklist_completeness(
            t["items"], t["responses"], t["tax_categories"], t["documents"]
        ),
        "vw_utility_bills": vw_utility_bills(t["documents"], t["fy_periods"], t["tax_categories"]),
        "vw_utility_line_items": vw_utility_line_items(
            t["documents"], t["fy_periods"], t["tax_categories"]
        ),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
