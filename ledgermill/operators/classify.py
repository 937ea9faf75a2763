"""Rule jobs that classify documents and transactions, and what surrounds them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import seeds
from ledgermill.functions import text as text_fn
from ledgermill.functions import values
from ledgermill.functions.calendar import fy_of
from ledgermill.operators.merge import MERGE_THRESHOLD
from ledgermill.schemas import CLASSIFICATION

# Confidence given when nothing could be classified.
DOCUMENT_DEFAULT_CONFIDENCE, FOLDER_DEFAULT_CONFIDENCE = "0.1", "0.0"
# How many reviewed examples are quoted.
BALANCED_EXAMPLES, RECENT_EXAMPLES, RECLASSIFY_EXAMPLES, MIN_RECENT_EXAMPLES = 8, 10, 5, 3

# Our own rules: words that speak for a category.
CATEGORY_WORDS: dict[str, tuple[str, ...]] = {
    "Payment Summary / Group Certificate": ("payslip", "group certificate", "payment summary"),
    "Bank Interest Statement": ("interest earned", "savings account"),
    "Dividend Statement": ("dividend", "franking"),
    "Share Sale / CGT Event": ("contract note", "capital gain", "share sale"),
    "Work From Home — Internet": ("nbn", "internet", "broadband"),
    "Work From Home — Electricity/Gas": ("kwh", "electricity", "gas usage", "supply charge"),
    "Work From Home — Insurance": ("home insurance", "contents insurance"),
    "Technology Equipment": ("laptop", "monitor", "keyboard", "hard drive"),
    "Software & Subscriptions": ("software", "licence", "subscription"),
    "Professional Development": ("course", "conference", "certification"),
    "Professional Memberships": ("membership", "member fee"),
    "Income Protection Insurance": ("income protection",),
    "Rental Income Statement": ("rental", "tenant"),
    "Property Depreciation Schedule": ("depreciation", "quantity surveyor"),
    "ATO Notice / Assessment": ("notice of assessment", "taxation office"),
    "HECS/HELP Statement": ("hecs", "study loan"),
    "Superannuation Statement": ("superannuation", "super fund"),
    "Super Contribution Notice": ("contribution notice", "notice of intent"),
    "Private Health Insurance Statement": ("health insurance", "hospital cover"),
    "Invoice / Receipt — Other": ("invoice", "receipt"),
}

# Our own rules: words of purchases that are private, whatever they cost.
PRIVATE_WORDS = (
    "restaurant", "cafe", "groceries", "supermarket", "streaming", "cinema", "clothing",
    "holiday", "gym", "flowers", "gift", "concert", "gaming", "promotion",
)


def _alternation(words: Sequence[str]) -> str:
    """Whole words, whatever the alphabet; longer phrases are tried first."""
    ordered = sorted({w.lower() for w in words}, key=lambda w: (-len(w), w))
    body = "|".join(re.escape(w).replace(r"\ ", " ") for w in ordered)
    # The first-letter test comes first: it rules out most places cheaply.
    first = "".join(sorted({re.escape(w[0]) for w in ordered}))
    return rf"(?=[{first}])(?<![\p{{L}}\p{{N}}])({body})(?![\p{{L}}\p{{N}}])"


def words_found(lower: Column, words: Sequence[str]) -> Column:
    """Every whole-word hit in a lower-case text, in one scan."""
    return F.regexp_extract_all(lower, F.lit(_alternation(words)), F.lit(1))


def hits_of(found: Column, words: Sequence[str]) -> Column:
    lowered = [w.lower() for w in words]
    return F.size(F.filter(found, lambda n: n.isin(*lowered)))


def best_category(found: Column, rules: dict[str, tuple[str, ...]]) -> Column:
    """Category with most hits, the earlier rule on a tie: ``struct<hits, place, category>``.

    Works on the short list of words found, not on the text. NULL without hits.
    """
    scores = F.array(
        *[
            F.struct(
                hits_of(found, words).alias("hits"),
                F.lit(-place).alias("place"),
                F.lit(category).alias("category"),
            )
            for place, (category, words) in enumerate(rules.items())
        ]
    )
    return F.array_max(F.filter(scores, lambda s: s["hits"] > 0))


def confidence_of(hits: Column) -> Column:
    """Our scale: 0.5 for one hit, 0.1 more for each further one, at most 0.95."""
    steps = F.least(F.coalesce(hits, F.lit(0)) + 4, F.lit(9))
    return F.when(F.coalesce(hits, F.lit(0)) > 0, F.least(steps * F.lit(0.1), F.lit(0.95)))


def default_classification(confidence: str, category: str, summary: str) -> Column:
    """Classification of a document without text, or after a failure."""
    given = {
        "is_tax_relevant": None,
        "category": category,
        "is_deductible": "false",
        "confidence": confidence,
        "document_type": "Unknown",
        "summary": summary,
    }
    shape = T.StructType.fromDDL(f"c {CLASSIFICATION}")["c"].dataType
    none = F.array()
    return F.struct(
        *[
            (none if isinstance(f.dataType, T.ArrayType) else F.lit(given.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in shape.fields
        ]
    )


def document_default(summary: str = "No text could be extracted from this document.") -> Column:
    return default_classification(DOCUMENT_DEFAULT_CONFIDENCE, seeds.DEFAULT_CATEGORY, summary)


def folder_default(summary: str = "Classification failed.") -> Column:
    return default_classification(
        FOLDER_DEFAULT_CONFIDENCE, seeds.FOLDER_DEFAULT_CATEGORY, summary
    )


def extract_amount(text: Column) -> Column:
    """Amount after the word "total", else the first dollar amount."""
    total = F.regexp_extract(text, r"(?i)total[^\n$]*\$\s*([0-9][0-9,]*\.[0-9]{2})", 1)
    first = F.regexp_extract(text, r"\$\s*([0-9][0-9,]*\.[0-9]{2})", 1)
    found = F.coalesce(F.nullif(total, F.lit("")), F.nullif(first, F.lit("")))
    # Most texts hold no dollar sign and need no expression.
    return F.when(text.contains("$"), values.money(found))


def extract_date(text: Column) -> Column:
    """First valid ISO date, else the first valid ``dd/mm/yyyy``; one scan for both."""
    pattern = r"([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
    parsed = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)),
        lambda d: F.struct(
            values.safe_to_date(d).alias("iso"),
            values.statement_date(d, "%d/%m/%Y").alias("local"),
        ),
    )
    return F.element_at(
        F.transform(
            F.array(parsed),
            lambda p: F.coalesce(
                F.try_element_at(F.filter(p["iso"], lambda d: d.isNotNull()), F.lit(1)),
                F.try_element_at(F.filter(p["local"], lambda d: d.isNotNull()), F.lit(1)),
            ),
        ),
        1,
    )


def extract_abn(text: Column) -> Column:
    digits = F.regexp_extract(text, r"(?i)ABN[: ]*((?:[0-9] ?){11})", 1)
    return F.nullif(F.replace(digits, F.lit(" "), F.lit("")), F.lit(""))


def extract_account(text: Column) -> Column:
    pattern = r"(?i)(?:account|policy|NMI)(?: number| no\.?)?[: ]+([A-Z0-9-]{4,})"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def extract_supplier(text: Column) -> Column:
    """First line of the document that is not blank."""
    return F.nullif(F.trim(F.regexp_extract(text, r"^\s*([^\n]+)", 1)), F.lit(""))


# Our own words for kinds of documents, the more telling ones first.
DOCUMENT_TYPES = (
    "tax invoice", "contract note", "notice of assessment", "payment summary", "payslip",
    "receipt", "statement", "invoice", "certificate", "notice", "schedule",
)
_DAY = r"([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"


def extract_type(lower: Column) -> Column:
    """The first word for a kind of document in a lower-case text, in title case."""
    body = "|".join(DOCUMENT_TYPES)
    found = F.regexp_extract(lower, rf"\b({body})\b", 1)
    # Plain searches keep the expression away from texts without any of the words.
    some = F.lit(False)
    for word in {w.rsplit(" ")[-1] for w in DOCUMENT_TYPES}:
        some = some | lower.contains(word)
    return F.when(some, F.nullif(F.initcap(found), F.lit("")))


def extract_period(text: Column, lower: Column) -> Column:
    """``struct<first, last>``: the days of a billing period, null where they are no days."""
    pattern = rf"(?i)\b(?:billing|service|supply) period[: ]+{_DAY}\s*(?:-|–|to)\s*{_DAY}"

    def day(group: int) -> Column:
        said = F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
        return F.coalesce(values.safe_to_date(said), values.statement_date(said, "%d/%m/%Y"))

    return F.when(
        lower.contains(" period"), F.struct(day(1).alias("first"), day(2).alias("last"))
    )


def extract_address(text: Column, lower: Column) -> Column:
    """The rest of the line behind "supply address"."""
    said = F.trim(F.regexp_extract(text, r"(?i)\bsupply address[: ]+([^\r\n]+)", 1))
    return F.when(lower.contains("supply address"), F.nullif(said, F.lit("")))


def summary_of(category: Column, supplier: Column, amount: Column) -> Column:
    """One line: the category, who from and how much, as far as they are known."""
    return F.concat(
        category,
        F.coalesce(F.concat(F.lit(" from "), supplier), F.lit("")),
        F.coalesce(F.concat(F.lit(", $"), amount), F.lit("")),
    )


def classify_documents(
    docs: DataFrame,
    text: str,
    rules: dict[str, tuple[str, ...]] | None = None,
    private_words: Sequence[str] = PRIVATE_WORDS,
) -> DataFrame:
    """Add ``classification``: category, relevance and details by rule.

    One projection over the whole text; no rule table is joined. A document
    without text takes the default, as does one no rule speaks for.
    """
    rules = rules or CATEGORY_WORDS
    body = F.col(text)
    deductible = {
        name
        for _, name, _, _, flag, _, _ in seeds.rows_of(seeds.TAX_CATEGORIES)
        if flag == "true"
    }
    # Everything that reads the text is computed once, in its own projection.
    words = [w for rule in rules.values() for w in rule]
    lower = F.col("_lower")
    read = docs.withColumn("_lower", F.lower(body)).withColumns(
        {
            "_words": words_found(lower, [*words, *private_words]),
            "_amount": extract_amount(body).cast("string"),
            "_date": extract_date(body),
            "_items": text_fn.bill_lines(body),
            "_period": extract_period(body, lower),
            "_supplier": extract_supplier(body),
        }
    )
    read = read.withColumn("_best", best_category(F.col("_words"), rules)).withColumn(
        "_private", hits_of(F.col("_words"), private_words)
    )
    hits = F.coalesce(F.col("_best.hits"), F.lit(0))
    category = F.coalesce("_best.category", F.lit(seeds.DEFAULT_CATEGORY))
    confidence = F.coalesce(
        confidence_of(hits).cast("decimal(4,3)").cast("string"),
        F.lit(DOCUMENT_DEFAULT_CONFIDENCE),
    )
    found = F.struct(
        ((hits > 0) & (hits >= F.col("_private"))).cast("string").alias("is_tax_relevant"),
        category.alias("category"),
        fy_of(F.col("_date")).cast("string").alias("fy_year"),
        category.isin(*sorted(deductible)).cast("string").alias("is_deductible"),
        F.col("_amount").alias("deductible_amount"),
        F.col("_amount").alias("total_amount"),
        confidence.alias("confidence"),
        extract_type(lower).alias("document_type"),
        F.col("_date").cast("string").alias("document_date"),
        summary_of(category, F.col("_supplier"), F.col("_amount")).alias("summary"),
        F.col("_period.first").cast("string").alias("billing_period_start"),
        F.col("_period.last").cast("string").alias("billing_period_end"),
        F.col("_supplier").alias("supplier_name"),
        extract_address(body, lower).alias("supply_address"),
        extract_account(body).alias("account_reference"),
        F.transform(
            "_items",
            lambda i: F.struct(
                i["description"].alias("description"),
                i["period"].alias("period"),
                i["quantity"].cast("string").alias("quantity"),
                i["unit"].alias("unit"),
                i["rate"].cast("string").alias("rate"),
                i["amount"].cast("string").alias("amount"),
            ),
        ).alias("line_items"),
    )
    empty = body.isNull() | (body == "")
    return read.withColumn(
        "classification",
        F.when(empty, document_default().cast(CLASSIFICATION)).otherwise(
            found.cast(CLASSIFICATION)
        ),
    ).drop("_words", "_best", "_private", "_amount", "_date", "_items", "_period", "_supplier", "_lower")


def parse_response(
    response: Column,
    vocabulary: Sequence[str] | None = None,
    default: Column | None = None,
) -> Column:
    """A scorer's text answer as a classification struct.

    Code fences are dropped. Text that is no JSON object, or has a confidence
    that is no number, takes the default. An unknown category becomes the
    default category and a missing confidence 0.
    """
    vocabulary = vocabulary or tuple(seeds.path_map(seeds.FOLDER_PATHS))
    default = folder_default() if default is None else default
    bare = F.trim(F.regexp_replace(response, r"```(?:json)?\s*", ""))
    bare = F.trim(F.rtrim(bare, F.lit("`")))
    raw = F.from_json(bare, CLASSIFICATION)
    keys = F.json_object_keys(bare)
    given = F.array_contains(F.coalesce(keys, F.array().cast("array<string>")), "confidence")
    number = raw["confidence"].try_cast("double")
    readable = bare.startswith("{") & F.try_parse_json(bare).isNotNull() & (
        number.isNotNull() | ~given
    )
    known = F.coalesce(raw["category"].isin(*vocabulary), F.lit(False))
    flag = F.coalesce(raw["is_deductible"].try_cast("boolean"), F.lit(False))
    clean = (
        raw.withField(
            "category",
            F.when(known, raw["category"]).otherwise(F.lit(seeds.FOLDER_DEFAULT_CATEGORY)),
        )
        .withField("is_deductible", flag.cast("string"))
        .withField("confidence", F.coalesce(raw["confidence"], F.lit("0.0")))
    )
    return F.when(F.coalesce(readable, F.lit(False)), clean).otherwise(
        default.cast(CLASSIFICATION)
    )


# --- reviewed examples -------------------------------------------------------


def few_shot_balanced(
    core: DataFrame, categories: DataFrame, n: int = BALANCED_EXAMPLES
) -> DataFrame:
    """Top ``n`` confirmed and top ``n`` rejected rows: noted first, newest first.

    Each half is a top-n, so only ``n`` rows per task leave the scan.
    """
    names = categories.select(
        F.col("category_id").alias("tax_category_id"), F.col("category_nme").alias("category")
    )

    def half(status: str) -> DataFrame:
        return (
            core.filter((F.col("review_status") == status) & F.col("subject").isNotNull())
            .orderBy(
                F.col("reviewer_notes").isNotNull().desc(),
                F.col("reviewed_at").desc_nulls_last(),
                F.col("doc_id").asc(),
            )
            .limit(n)
        )

    picked = half("CONFIRMED").unionByName(half("REJECTED"))
    return picked.join(names, "tax_category_id", "left").select(
        "doc_id", "subject", "supplier_name", "category", "review_status", "reviewer_notes",
        "reviewed_at",
    )


def few_shot_recent(
    core: DataFrame, categories: DataFrame, n: int = RECENT_EXAMPLES
) -> DataFrame:
    """The ``n`` reviewed rows with a known category that changed last."""
    names = categories.select(F.col("category_id").alias("tax_category_id"), "category_nme")
    return (
        core.filter(F.col("review_status").isin("CONFIRMED", "REJECTED"))
        .select("doc_id", "subject", "file_name", "tax_category_id", "is_deductible",
                "review_status", "updated_at")
        .join(names, "tax_category_id")
        .orderBy(F.col("updated_at").desc_nulls_last(), F.col("doc_id").asc())
        .limit(n)
        .drop("tax_category_id")
    )


# Wording of the example block.
BLOCK_TITLE = "Past decisions by a human reviewer — use these to calibrate your classification:"
BLOCK_HEADS = {
    "CONFIRMED": "CONFIRMED (is_tax_relevant=true):",
    "REJECTED": "REJECTED (is_tax_relevant=false):",
}
RECENT_TITLE = "Here are recent examples of correctly classified documents:"


def _labelled(label: str, value: str) -> Column:
    filled = F.col(value).isNotNull() & (F.col(value) != "")
    return F.when(filled, F.concat(F.lit(f"{label}: "), F.col(value)))


def few_shot_block(examples: DataFrame) -> DataFrame:
    """One row ``block``: the examples as text lines, empty text without examples.

    The input is the bounded output of ``few_shot_balanced``.
    """
    category = F.when(F.col("review_status") == "CONFIRMED", _labelled("Category", "category"))
    line = F.concat(
        F.lit("  - "),
        F.concat_ws(
            " | ",
            _labelled("Supplier", "supplier_name"),
            _labelled("Subject", "subject"),
            category,
            _labelled("Note", "reviewer_notes"),
        ),
    )
    order = F.struct(
        F.col("reviewer_notes").isNull().alias("plain"),
        F.coalesce(-F.unix_micros("reviewed_at"), F.lit(2**62)).alias("age"),
        "doc_id",
        line.alias("line"),
    )

    def section(status: str) -> Column:
        mine = F.array_sort(F.collect_list(F.when(F.col("review_status") == status, order)))
        lines = F.transform(mine, lambda e: e["line"])
        body = F.concat(F.lit(BLOCK_HEADS[status] + "\n"), F.array_join(lines, "\n"), F.lit("\n\n"))
        return F.when(F.size(mine) > 0, body).otherwise("")

    return examples.agg(
        F.count(F.lit(1)).alias("n"),
        section("CONFIRMED").alias("c"),
        section("REJECTED").alias("r"),
    ).select(
        F.when(F.col("n") == 0, "")
        .otherwise(F.concat(F.lit(BLOCK_TITLE + "\n\n"), F.col("c"), F.col("r")))
        .alias("block")
    )


def few_shot_recent_block(examples: DataFrame) -> DataFrame:
    """Other form, used only from three examples on."""
    label = F.coalesce(F.nullif("subject", F.lit("")), F.nullif("file_name", F.lit("")), F.lit("unknown"))
    flag = F.coalesce(F.initcap(F.col("is_deductible").cast("string")), F.lit("None"))
    line = F.format_string('- "%s" → %s (is_deductible: %s)', label, F.col("category_nme"), flag)
    order = F.struct(
        F.coalesce(-F.unix_micros("updated_at"), F.lit(2**62)).alias("age"),
        "doc_id",
        line.alias("line"),
    )
    lines = F.transform(F.array_sort(F.collect_list(order)), lambda e: e["line"])
    text = F.concat(F.lit(RECENT_TITLE + "\n"), F.array_join(lines, "\n"), F.lit("\n\n"))
    return examples.agg(
        F.when(F.count(F.lit(1)) >= MIN_RECENT_EXAMPLES, text).otherwise("").alias("block")
    )


def prompts(docs: DataFrame, text: str, block: DataFrame) -> DataFrame:
    """Add ``prompt`` for a downstream scorer: task, examples, names and the text.

    The text is whole; a scorer with a limit is given parts of it by the caller.
    """
    names = "\n".join(seeds.path_map(seeds.DOCUMENT_PATHS))
    task = (
        "Classify the Australian tax document below and answer with one JSON object "
        "that has the fields category, fy_year, is_deductible, deductible_amount, confidence, "
        "document_date, supplier_name, account_reference and line_items.\n\n"
    )
    examples = block.select("block").scalar()
    return docs.withColumn(
        "prompt",
        F.concat(
            F.lit(task),
            examples,
            F.lit("Document text:\n"),
            F.coalesce(F.col(text), F.lit("")),
            F.lit("\n\nCategories:\n" + names),
        ),
    )


# --- second looks and transactions ------------------------------------------


def reclassify_low(
    rows: DataFrame, confidence: Column, again: Column, threshold: float = MERGE_THRESHOLD
) -> DataFrame:
    """Replace ``classification`` with ``again`` where confidence is low."""
    low = F.coalesce(confidence, F.lit(0)) < threshold
    return rows.withColumn(
        "classification", F.when(low, again).otherwise(F.col("classification"))
    ).withColumn("reclassified", low)


def bill_details(core: DataFrame, threshold: float = MERGE_THRESHOLD) -> DataFrame:
    """One row per bill with its items, extraction confidence and review flag."""
    return core.filter(F.size("line_items") > 0).select(
        "doc_id",
        F.coalesce("supplier_name", F.lit("unknown")).alias("provider_nme"),
        F.col("account_ref").alias("account_number"),
        F.col("billing_start").alias("billing_period_start"),
        F.col("billing_end").alias("billing_period_end"),
        "total_amount",
        "line_items",
        F.lit("rules").alias("extracted_by"),
        F.col("confidence_score").alias("extraction_confidence"),
        (F.col("confidence_score") < threshold).alias("needs_review"),
    )


@dataclass(frozen=True)
class MerchantRule:
    """Pass-one rule: a pattern on the clean description, first match wins."""

    pattern: str
    category_id: int
    subcategory: str | None = None
    is_deductible: bool = False


def classify_transactions(
    txns: DataFrame, rules: Sequence[MerchantRule], second_pass: Column | None = None
) -> DataFrame:
    """Set category fields in two passes.

    Pass one tries the merchant rules in order. ``second_pass`` is a struct
    column ``(category_id, subcategory, is_deductible, confidence_score)`` for
    the remainder, for instance a scorer's answer joined in beforehand.
    """
    shape = "struct<category_id:int,subcategory:string,is_deductible:boolean,confidence_score:decimal(4,3)>"

    def outcome(rule: MerchantRule) -> Column:
        return F.struct(
            F.lit(rule.category_id).alias("category_id"),
            F.lit(rule.subcategory).cast("string").alias("subcategory"),
            F.lit(rule.is_deductible).alias("is_deductible"),
            F.lit("1.000").cast("decimal(4,3)").alias("confidence_score"),
        ).cast(shape)

    description = F.col("description_clean")
    first = F.coalesce(
        *[F.when(description.rlike(f"(?i){r.pattern}"), outcome(r)) for r in rules],
        F.lit(None).cast(shape),
    )
    rest = F.lit(None).cast(shape) if second_pass is None else second_pass.cast(shape)
    return (
        txns.withColumn("_rule", first)
        .withColumn("_found", F.coalesce("_rule", rest))
        .withColumn(
            "classified_by",
            F.when(F.col("_rule").isNotNull(), "rule").when(F.col("_found").isNotNull(), "model"),
        )
        .withColumn("category_id", F.col("_found.category_id"))
        .withColumn("subcategory", F.col("_found.subcategory"))
        .withColumn("is_deductible", F.coalesce("_found.is_deductible", F.lit(False)))
        .withColumn("confidence_score", F.col("_found.confidence_score"))
        .drop("_rule", "_found")
    )
