"""Checklist answers, the questionnaire and completeness percentages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.calendar import days_since_fy_start
from ledgermill.functions.crypto import Secret, checklist_token
from ledgermill.operators.keys import first_per_key
from ledgermill.seeds import SECTION_ORDER

# Deduction per hour worked at home, in dollars, and months per year.
WFH_RATE, MONTHS = "0.70", 12
# Checklist items the work-from-home deduction reads.
WFH_ITEMS = {
    "hours": 110,
    "internet_cost": 111,
    "internet_pct": 112,
    "mobile_cost": 113,
    "mobile_pct": 114,
}


def valid_answers(answers: DataFrame, secret: Secret) -> DataFrame:
    """YES / NO answers with the right token over ``group|year|answer``."""
    expected = checklist_token(
        F.col("group_code"), F.col("fy_year"), F.col("answer"), secret
    )
    return answers.filter(F.col("answer").isin("YES", "NO") & (F.col("token") == expected))


def apply_answers(
    responses: DataFrame, items: DataFrame, answers: DataFrame, secret: Secret
) -> DataFrame:
    """Answer a group for a year; re-answering is allowed, the last answer counts.

    One answer covers every document item of the group. Missing response rows
    are added, so years that were never seeded can be answered too.
    """
    last = first_per_key(
        valid_answers(answers, secret),
        ["group_code", "fy_year"],
        [F.col("action_ts").desc(), F.col("answer").desc()],
    )
    return apply_last_answers(responses, items, last)


def apply_last_answers(responses: DataFrame, items: DataFrame, last: DataFrame) -> DataFrame:
    """Answer groups for years; ``last`` has one valid answer per group and year."""
    documents = items.filter(F.col("item_type") == "DOCUMENT").select(
        "item_id", F.col("applicability_group").alias("group_code")
    )
    new = last.join(documents, "group_code").select(
        "item_id",
        F.col("fy_year").cast("smallint").alias("fy_year"),
        F.col("answer").alias("_answer"),
        F.col("action_ts").alias("_ts"),
    )
    joined = responses.join(new, ["item_id", "fy_year"], "full_outer")
    answered = F.col("_answer").isNotNull()
    return joined.select(
        "item_id",
        "fy_year",
        F.coalesce("_answer", "is_applicable").alias("is_applicable"),
        "response_value",
        F.when(answered, F.col("_ts")).otherwise(F.col("responded_at")).alias("responded_at"),
        F.when(answered, "EMAIL").otherwise(F.col("source")).alias("source"),
    )


def questionnaire(items: DataFrame, responses: DataFrame, fy_year: int) -> DataFrame:
    """One row per question with the group's answer (the largest text, as stored)."""
    asked = items.filter(
        (F.col("item_type") == "DOCUMENT")
        & ~F.col("always_required")
        & F.col("applicability_group").isNotNull()
        & F.col("active")
    )
    year = responses.filter(F.col("fy_year") == fy_year).select("item_id", "is_applicable")
    return (
        asked.join(year, "item_id")
        .groupBy(F.col("applicability_group").alias("group_code"), "applicability_question", "section")
        .agg(
            F.min("sort_order").alias("sort_order"),
            F.max("is_applicable").alias("current_response"),
        )
        .orderBy("sort_order")
    )


def section_place(section: Column) -> Column:
    """Place of a section in the questionnaire; unlisted sections go last."""
    place = F.array_position(F.array(*[F.lit(s) for s in SECTION_ORDER]), section)
    return F.when(place > 0, place).otherwise(len(SECTION_ORDER) + 1)


def questionnaire_progress(questions: DataFrame) -> DataFrame:
    """Answered, total and rounded percentage, per section and overall."""
    answered = F.count_if(F.col("current_response") != "UNKNOWN")
    total = F.count(F.lit(1))
    return (
        questions.rollup("section")
        .agg(answered.alias("answered"), total.alias("total"))
        .select(
            F.coalesce("section", F.lit("ALL")).alias("section"),
            "answered",
            "total",
            F.round(F.try_divide(F.col("answered") * 100, F.col("total"))).cast("int").alias("pct"),
        )
        .orderBy(section_place(F.col("section")))
    )


def percent_complete(completeness: DataFrame, by: tuple[str, ...] = ("section",)) -> DataFrame:
    """Satisfied share of the items in scope, per section and overall, with a colour.

    Unanswered items are out of scope, so they do not enter the denominator.
    """
    scope = completeness.filter((F.col("item_type") == "DOCUMENT") & F.col("in_scope"))
    satisfied = F.count_if(F.col("status") == "SATISFIED")
    pct = F.round(F.col("satisfied") * 100 / F.col("applicable"), 1)
    return (
        scope.rollup(*by)
        .agg(satisfied.alias("satisfied"), F.count(F.lit(1)).alias("applicable"))
        .withColumn("pct_complete", pct)
        .withColumn(
            "colour",
            F.when(F.col("pct_complete") < 50, "red")
            .when(F.col("pct_complete") < 80, "amber")
            .otherwise("green"),
        )
        .withColumn(by[-1], F.coalesce(by[-1], F.lit("ALL")))
    )


def outstanding_items(completeness: DataFrame, as_of: Column) -> DataFrame:
    """Items in scope that are missing, with days since the year began."""
    return completeness.filter(F.col("in_scope") & (F.col("status") == "MISSING")).select(
        "item_id",
        "item_name",
        "section",
        "fy_year",
        days_since_fy_start(as_of, F.col("fy_year")).alias("days_since_fy_start"),
    )


def response_values(completeness: DataFrame) -> DataFrame:
    return completeness.filter(
        (F.col("item_type") == "RESPONSE") & F.col("response_value").isNotNull()
    ).select("item_id", "item_name", "fy_year", "response_value")


def wfh_deduction(responses: DataFrame) -> DataFrame:
    """Work-from-home deduction per year: fixed hourly rate and actual cost."""
    wanted = responses.filter(F.col("item_id").isin(*WFH_ITEMS.values()))
    value = F.coalesce(F.col("response_value").try_cast("decimal(12,2)"), F.lit(0))
    by_item = wanted.groupBy("fy_year").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("item_id") == item, value)), F.lit(0))
            .cast("decimal(12,2)")
            .alias(name)
            for name, item in WFH_ITEMS.items()
        ]
    )

    def yearly(cost: str, pct: str) -> Column:
        return F.col(cost) * MONTHS * F.col(pct) / 100

    return by_item.select(
        "fy_year",
        "hours",
        F.round(F.col("hours") * F.lit(WFH_RATE).cast("decimal(4,2)"), 2).alias("fixed_rate_amount"),
        F.round(
            yearly("internet_cost", "internet_pct") + yearly("mobile_cost", "mobile_pct"), 2
        ).alias("actual_cost_amount"),
    )
