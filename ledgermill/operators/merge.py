"""Landing to core: pick, type, resolve and merge documents under status rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import values
from ledgermill.functions.calendar import with_fy_period
from ledgermill.operators.keys import first_per_key, with_surrogate_key
from ledgermill.schemas import CLASSIFICATION, LINE_ITEMS, REVIEWED
from ledgermill.sources.queue import unprocessed

# Status thresholds of the merge and of the drop-folder scan.
MERGE_THRESHOLD = 0.75
FOLDER_THRESHOLD = 0.6
# Recorded as the model where documents are classified by this library's rules.
CLASSIFIER = "rules"

KEY = ("source_type", "source_id")

# What an update does to a column that is not listed: the old value stays.
REPLACE, KEEP_IF_NULL, REPLACE_IF_FILLED = "replace", "keep_if_null", "replace_if_filled"

FULL_RULES = {
    **dict.fromkeys(
        (
            "subject",
            "sender_email",
            "received_at",
            "file_name",
            "file_ext",
            "file_size_bytes",
            "is_deductible",
            "deductible_amount",
            "confidence_score",
            "classification_model",
            "batch_id",
        ),
        REPLACE,
    ),
    **dict.fromkeys(
        (
            "content_preview",
            "fy_year",
            "tax_category_id",
            "supplier_name",
            "account_ref",
            "supply_address",
            "document_date",
            "billing_start",
            "billing_end",
            "total_amount",
            "gst_amount",
            "filed_path",
        ),
        KEEP_IF_NULL,
    ),
    "line_items": REPLACE_IF_FILLED,
}

METADATA_RULES = {
    **dict.fromkeys(
        (
            "subject",
            "sender_email",
            "received_at",
            "file_name",
            "file_ext",
            "file_size_bytes",
            "batch_id",
        ),
        REPLACE,
    ),
    "content_preview": KEEP_IF_NULL,
}


@dataclass(frozen=True)
class MergePolicy:
    """Which existing rows may change, and how."""

    rules: dict[str, str]
    frozen_statuses: tuple[str, ...] = REVIEWED
    only_status: str | None = None
    restatus: bool = False

    def may_update(self, status: Column) -> Column:
        if self.only_status is not None:
            return status == self.only_status
        return ~status.isin(*self.frozen_statuses)


CURRENT_POLICY = MergePolicy(FULL_RULES)
RESTATUS_POLICY = MergePolicy(FULL_RULES, restatus=True)
FIRST_POLICY = MergePolicy(METADATA_RULES, only_status="PENDING")


def has_key(landing: DataFrame) -> DataFrame:
    return landing.filter(F.col("source_type").isNotNull() & F.col("source_id").isNotNull())


def primary_documents(queue: DataFrame) -> DataFrame:
    """One row per message: the largest file, then the smallest file name."""
    return first_per_key(
        has_key(queue),
        KEY,
        [
            F.coalesce("file_size_bytes", F.lit(0)).desc(),
            F.coalesce("file_name", F.lit("")).asc(),
            F.col("landing_id").asc(),
        ],
    )


def review_status(confidence: Column, threshold: float = MERGE_THRESHOLD) -> Column:
    sure = F.coalesce(confidence, F.lit(0)) >= F.lit(str(threshold)).cast("decimal(4,3)")
    return F.when(sure, "AUTO_CONFIRMED").otherwise("NEEDS_REVIEW")


def review_status_by_relevance(
    relevant: Column, confidence: Column, threshold: float = MERGE_THRESHOLD
) -> Column:
    """Full rule: an irrelevant document is rejected, whatever its confidence."""
    return F.when(~F.coalesce(relevant, F.lit(True)), "AUTO_REJECTED").otherwise(
        review_status(confidence, threshold)
    )


def parse_classification(landing: DataFrame) -> DataFrame:
    """Replace ``raw_json`` by the few fields the merge reads, as ``_raw``.

    This runs before any shuffle: the JSON holds the full text of a document,
    which must not travel, and behind the shuffle a later filter cannot pull
    the parser down and run it once per field.
    """
    wanted = f"filed_path STRING, classification {CLASSIFICATION}"
    return landing.withColumn("_raw", F.from_json("raw_json", wanted)).drop("raw_json")


def unpack_classification(rows: DataFrame, total_from: str = "deductible_amount") -> DataFrame:
    """Typed classification fields and the ``cast_errors`` found, from parsed rows.

    ``total_from`` names the JSON field the total is read from: by default the
    deductible amount, or ``total_amount`` for the drop-folder form.
    """

    def raw(name: str) -> Column:
        return F.col(f"_raw.classification.{name}")

    amount = values.safe_decimal(raw("deductible_amount"), 10, 2)
    total = values.safe_decimal(raw(total_from), 12, 2)
    confidence = raw("confidence").try_cast("decimal(4,3)")
    flag = raw("is_deductible").try_cast("boolean")
    year = values.safe_int(raw("fy_year"))

    def unreadable(text: Column, value: Column, blank_allowed: bool) -> Column:
        given = text.isNotNull() & (text != "") if blank_allowed else text.isNotNull()
        return given & value.isNull()

    problems = {
        "fy_year": unreadable(raw("fy_year"), year, True),
        "deductible_amount": unreadable(raw("deductible_amount"), amount, True),
        total_from: unreadable(raw(total_from), total, True),
        "is_deductible": unreadable(raw("is_deductible"), flag, False),
        "confidence": unreadable(raw("confidence"), confidence, False)
        | ~F.coalesce(confidence, F.lit(0)).between(0, 1),
    }
    errors = F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in problems.items()]),
        lambda e: e.isNotNull(),
    )
    return rows.withColumns(
        {
            "cls_category": raw("category"),
            "cls_fy_year": year,
            "is_tax_relevant": values.safe_boolean(raw("is_tax_relevant")),
            "is_deductible": F.coalesce(flag, F.lit(False)),
            "deductible_amount": amount,
            "confidence_score": F.coalesce(confidence, F.lit(0).cast("decimal(4,3)")),
            "supplier_name": values.blank_to_null(raw("supplier_name")),
            "account_ref": values.blank_to_null(raw("account_reference")),
            "supply_address": values.blank_to_null(raw("supply_address")),
            "document_date": values.safe_to_date(raw("document_date")),
            "billing_start": values.safe_to_date(raw("billing_period_start")),
            "billing_end": values.safe_to_date(raw("billing_period_end")),
            "total_amount": total,
            "gst_amount": F.lit(None).cast("decimal(12,2)"),
            "filed_path": values.blank_to_null(F.col("_raw.filed_path")),
            "line_items": F.coalesce(raw("line_items"), F.array().cast(LINE_ITEMS)),
            "cast_errors": errors,
        }
    ).drop("_raw")


def resolve_fy(rows: DataFrame, fy_periods: DataFrame) -> DataFrame:
    """Add ``fy_year``: the classifier's year if seeded, else the received date's."""
    known = fy_periods.select(F.col("fy_year").alias("_known_fy"))
    return (
        with_fy_period(rows, F.to_date("received_at"), fy_periods, "_received_fy")
        .join(known, F.col("cls_fy_year") == F.col("_known_fy"), "left")
        .withColumn("fy_year", F.coalesce("_known_fy", "_received_fy"))
        .drop("_known_fy", "_received_fy")
    )


def with_category_id(
    rows: DataFrame,
    name: str,
    categories: DataFrame,
    out: str = "tax_category_id",
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Add the id of a category name, NULL when the name is not seeded.

    ``aliases(alias, category_nme)`` optionally maps the folder vocabulary.
    """
    lookup = categories.groupBy(F.col("category_nme").alias("_name")).agg(
        F.min("category_id").alias(out)
    )
    wanted = F.col(name)
    if aliases is not None:
        renamed = aliases.select(
            F.col("alias").alias("_alias"), F.col("category_nme").alias("_renamed")
        )
        rows = rows.join(renamed, F.col(name) == F.col("_alias"), "left").drop("_alias")
        wanted = F.coalesce("_renamed", F.col(name))
    joined = rows.withColumn("_wanted", wanted).join(
        lookup, F.col("_wanted") == F.col("_name"), "left"
    )
    return joined.drop("_wanted", "_name", "_renamed")


def _unreadable(queue: DataFrame, total_from: str) -> DataFrame:
    """Primary documents whose classification cannot be typed."""
    return unpack_classification(
        primary_documents(parse_classification(queue)), total_from
    ).filter(F.size("cast_errors") > 0)


def quarantined(
    landing: DataFrame, batch_id: int | None = None, total_from: str = "deductible_amount"
) -> DataFrame:
    """Unprocessed rows the merge cannot take, with the reasons.

    ``total_from`` must be that of :func:`incoming_documents`.
    """
    queue = unprocessed(landing, batch_id)
    no_key = queue.filter(F.col("source_type").isNull() | F.col("source_id").isNull()).select(
        "landing_id", F.array(F.lit("key")).alias("reasons")
    )
    bad = _unreadable(queue, total_from).select(
        "landing_id", F.col("cast_errors").alias("reasons")
    )
    return no_key.unionByName(bad)


def incoming_documents(
    landing: DataFrame,
    fy_periods: DataFrame,
    categories: DataFrame,
    batch_id: int | None = None,
    *,
    total_from: str = "deductible_amount",
    threshold: float = MERGE_THRESHOLD,
    by_relevance: bool = False,
    aliases: DataFrame | None = None,
    classifier: str = CLASSIFIER,
) -> DataFrame:
    """Core-shaped rows for every readable primary document of the queue."""
    queue = parse_classification(unprocessed(landing, batch_id))
    rows = unpack_classification(primary_documents(queue), total_from).filter(
        F.size("cast_errors") == 0
    )
    rows = with_category_id(
        resolve_fy(rows, fy_periods), "cls_category", categories, aliases=aliases
    )
    status = (
        review_status_by_relevance(F.col("is_tax_relevant"), F.col("confidence_score"), threshold)
        if by_relevance
        else review_status(F.col("confidence_score"), threshold)
    )
    return (
        rows.withColumn("review_status", status)
        .withColumn("classification_model", F.lit(classifier))
        .drop("cast_errors", "cls_category", "cls_fy_year", "is_tax_relevant", "landing_id",
              "loaded_at", "is_processed")
    )


def incoming_metadata(
    landing: DataFrame, fy_periods: DataFrame, batch_id: int | None = None
) -> DataFrame:
    """First form of the merge input: metadata only, everything PENDING."""
    rows = primary_documents(unprocessed(landing, batch_id).drop("raw_json"))
    rows = with_fy_period(rows, F.to_date("received_at"), fy_periods, "fy_year")
    return rows.withColumn("review_status", F.lit("PENDING")).drop(
        "landing_id", "loaded_at", "is_processed"
    )


def merge_documents(
    core: DataFrame,
    incoming: DataFrame,
    policy: MergePolicy = CURRENT_POLICY,
    now: Column | None = None,
) -> DataFrame:
    """Next state of core: a full outer merge on the key, with ``merge_outcome``.

    Both sides are unique on the key, so no key is hot. Outcomes: ``inserted``,
    ``updated``, ``protected`` (reviewed, left alone) and ``untouched``.
    """
    return _merge(core, incoming, policy, now, "full_outer")


def merge_changes(
    core: DataFrame,
    incoming: DataFrame,
    policy: MergePolicy = CURRENT_POLICY,
    now: Column | None = None,
    last_id: Column | None = None,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """Only the rows a merge inserts or updates.

    Core is joined from the incoming side, so a small batch against a large
    core costs one scan of core and writes nothing that did not change. With
    ``last_id``, the highest id given so far, core may be the part of it that
    holds the incoming keys. ``keys`` may name further columns that follow from
    the key, such as its slot.
    """
    rows = _merge(core, incoming, policy, now, "right", last_id, keys)
    return rows.filter(F.col("merge_outcome").isin("inserted", "updated"))


def latest_documents(changes: DataFrame, version: str, keys: Sequence[str] = KEY) -> DataFrame:
    """Current documents from a log of changed rows: the newest version per key."""
    return first_per_key(changes, keys, [F.col(version).desc()]).drop(version)


def _merge(
    core: DataFrame,
    incoming: DataFrame,
    policy: MergePolicy,
    now: Column | None,
    how: str,
    last_id: Column | None = None,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    if last_id is None:
        last_id = F.coalesce(core.agg(F.max("doc_id")).scalar(), F.lit(0).cast("bigint"))
    incoming = with_surrogate_key(incoming, [F.col(k) for k in KEY], last_id, "_new_id")
    new = incoming.select(*[F.col(c).alias(f"n_{c}") for c in incoming.columns])
    old = core.select(*[F.col(c).alias(f"o_{c}") for c in core.columns])

    on = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys]
    joined = old.join(new, on, how)
    is_new, is_old = F.col("n__new_id").isNotNull(), F.col("o_doc_id").isNotNull()
    insert = is_new & ~is_old
    update = is_new & is_old & policy.may_update(F.col("o_review_status"))

    def merged(column: str, kind: str) -> Column:
        before = F.col(f"o_{column}")
        if column == "doc_id":
            return F.coalesce(before, F.col("n__new_id"))
        if column in keys:
            return F.coalesce(before, F.col(f"n_{column}"))
        if column == "created_at":
            return F.when(insert, now).otherwise(before)
        if column == "updated_at":
            return F.when(insert | update, now).otherwise(before)
        if column not in incoming.columns:
            return before
        after = F.col(f"n_{column}").cast(kind)
        rule = policy.rules.get(column)
        if column == "review_status" and policy.restatus:
            rule = REPLACE
        if rule == REPLACE:
            changed = after
        elif rule == KEEP_IF_NULL:
            changed = F.coalesce(after, before)
        elif rule == REPLACE_IF_FILLED:
            changed = F.when(F.size(after) > 0, after).otherwise(before)
        else:
            changed = before
        return F.when(insert, after).when(update, changed).otherwise(before)

    outcome = (
        F.when(insert, "inserted")
        .when(update, "updated")
        .when(is_new, "protected")
        .otherwise("untouched")
    )
    kinds = dict(core.dtypes)
    return joined.select(
        *[merged(c, kinds[c]).alias(c) for c in core.columns], outcome.alias("merge_outcome")
    )


def merge_counts(merged: DataFrame, rejected: DataFrame) -> DataFrame:
    """Merged and skipped rows of a run, with the quarantine counted as skipped."""
    outcome = F.col("merge_outcome")
    done = merged.agg(
        F.count_if(outcome.isin("inserted", "updated")).alias("merged"),
        F.count_if(outcome == "protected").alias("protected"),
    )
    return done.withColumn("quarantined", rejected.agg(F.count("*")).scalar())


def processed_keys(
    landing: DataFrame, batch_id: int | None = None, total_from: str = "deductible_amount"
) -> DataFrame:
    """Keys that a run merged: entries for a log of marks.

    Keys whose document the quarantine holds are left out, so that a corrected
    classification is merged by a later run.
    """
    queue = unprocessed(landing, batch_id)
    rejected = _unreadable(queue, total_from).select(*KEY)
    return has_key(queue).select(*KEY).distinct().join(rejected, list(KEY), "left_anti")


def mark_processed(
    landing: DataFrame, batch_id: int | None = None, total_from: str = "deductible_amount"
) -> DataFrame:
    """Set the flag on every row, of any batch, whose key the run merged.

    Keys whose document the quarantine holds stay unmarked, so that a corrected
    classification is merged by a later run. Both key sides are unique; the
    quarantine is small, and a hot key of a batch is split by the skew join.
    """
    queue = unprocessed(landing, batch_id)
    rejected = _unreadable(queue, total_from).select(*KEY)
    keyed = F.col("source_type").isNotNull() & F.col("source_id").isNotNull()
    if batch_id is None:
        done = rejected.withColumn("_done", F.lit(False))
    else:
        merged = has_key(queue).select(*KEY).distinct().join(rejected, list(KEY), "left_anti")
        done = merged.withColumn("_done", F.lit(True))
    return (
        landing.join(done, list(KEY), "left")
        .withColumn(
            "is_processed",
            F.col("is_processed") | (keyed & F.coalesce("_done", F.lit(batch_id is None))),
        )
        .select(*landing.columns)
    )
