"""Review queries, the digest and human actions on core documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.crypto import Secret, review_token
from ledgermill.functions.values import exact_mean
from ledgermill.operators.keys import first_per_key
from ledgermill.schemas import REVIEWED

# Labels for missing values and the confidence bands.
NO_CATEGORY, NO_SUPPLIER, NO_VALUE = "— uncategorised —", "— unknown —", "—"
CONFIDENCE_BANDS = (
    ("0.90", "0.90–1.00 (very high)"),
    ("0.75", "0.75–0.89 (high)"),
    ("0.50", "0.50–0.74 (medium)"),
    ("0.25", "0.25–0.49 (low)"),
)
LOWEST_BAND = "0.00–0.24 (very low)"

# Notes and confidence floors of the bulk actions.
MIN_CATEGORY_CONFIDENCE, MIN_FY_CONFIDENCE = "0.85", "0.90"


def _statuses() -> Column:
    """Distinct statuses as sorted text; at most six values per group."""
    return F.array_join(F.array_sort(F.collect_set("review_status")), ", ").alias("statuses")


def _with_category(core: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select(F.col("category_id").alias("tax_category_id"), "category_nme")
    return core.join(names, "tax_category_id", "left")


def status_summary(core: DataFrame) -> DataFrame:
    return (
        core.groupBy("review_status")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            exact_mean(F.col("confidence_score"), 3).alias("avg_confidence"),
            F.sum("total_amount").alias("total_amount_sum"),
        )
        .orderBy("review_status")
    )


def category_matrix(core: DataFrame, categories: DataFrame) -> DataFrame:
    """Counts per category and status, grouped by id before the names are joined."""
    per_id = core.groupBy("tax_category_id", "review_status").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("confidence_score").alias("_sum"),
        F.count("confidence_score").alias("_n"),
    )
    return (
        _with_category(per_id, categories)
        .groupBy(F.coalesce("category_nme", F.lit(NO_CATEGORY)).alias("category"), "review_status")
        .agg(
            F.sum("cnt").alias("cnt"),
            F.round(F.try_divide(F.sum("_sum"), F.sum("_n")), 3).alias("avg_confidence"),
        )
        .orderBy("category", "review_status")
    )


_LIST_COLUMNS = (
    "fy_year", "supplier_name", "total_amount", "document_date", "subject", "sender_email",
)


def _status_list(core: DataFrame, categories: DataFrame, status: str) -> DataFrame:
    rows = _with_category(core.filter(F.col("review_status") == status), categories)
    return rows.select(
        "doc_id",
        F.round("confidence_score", 3).alias("confidence"),
        F.coalesce("category_nme", F.lit(NO_VALUE)).alias("category"),
        *_LIST_COLUMNS,
        "reviewer_notes",
    )


def needs_review_list(
    core: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """Least certain first, then the newest document."""
    rows = _status_list(core, categories, "NEEDS_REVIEW")
    order = [F.col("confidence").asc_nulls_last(), F.col("document_date").desc_nulls_first()]
    return rows.orderBy(*order) if ordered else rows


def auto_confirmed_list(
    core: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """Spot-check list: least certain first, then the newest document."""
    rows = _status_list(core, categories, "AUTO_CONFIRMED").drop("reviewer_notes")
    order = [F.col("confidence").asc_nulls_last(), F.col("document_date").desc_nulls_first()]
    return rows.orderBy(*order) if ordered else rows


def auto_rejected_list(
    core: DataFrame, categories: DataFrame, ordered: bool = False
) -> DataFrame:
    """Rejected by the classifier: most certain first, then the newest document."""
    rows = _status_list(core, categories, "AUTO_REJECTED").drop("reviewer_notes")
    order = [F.col("confidence").desc_nulls_first(), F.col("document_date").desc_nulls_first()]
    return rows.orderBy(*order) if ordered else rows


def confidence_band(confidence: Column) -> Column:
    """Five bands, closed below; NULL falls into the lowest."""
    band = F.when(F.lit(False), "")
    for floor, label in CONFIDENCE_BANDS:
        band = band.when(confidence >= F.lit(floor).cast("decimal(4,3)"), label)
    return band.otherwise(LOWEST_BAND)


def confidence_bands(core: DataFrame) -> DataFrame:
    return (
        core.groupBy(confidence_band(F.col("confidence_score")).alias("confidence_band"))
        .agg(F.count(F.lit(1)).alias("cnt"), _statuses())
        .orderBy(F.col("confidence_band").desc())
    )


def supplier_profile(
    core: DataFrame, categories: DataFrame, supplier: str | None = None
) -> DataFrame:
    """Counts, confidence, dates, amount and statuses per supplier and category.

    Asking for one supplier filters before the grouping; the result is the same.
    """
    name = F.coalesce("supplier_name", F.lit(NO_SUPPLIER))
    rows = core if supplier is None else core.filter(name == supplier)
    return (
        _with_category(rows, categories)
        .groupBy(name.alias("supplier"), F.coalesce("category_nme", F.lit(NO_VALUE)).alias("category"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            exact_mean(F.col("confidence_score"), 3).alias("avg_confidence"),
            F.min("document_date").alias("earliest"),
            F.max("document_date").alias("latest"),
            F.sum("total_amount").alias("total_amount"),
            _statuses(),
        )
        .orderBy(F.col("record_count").desc(), "supplier", "category")
    )


def supplier_rows(core: DataFrame, supplier: str) -> DataFrame:
    return core.filter(F.col("supplier_name") == supplier).orderBy(
        F.col("received_at").asc_nulls_last()
    )


def fy_coverage(core: DataFrame) -> DataFrame:
    return (
        core.groupBy("fy_year")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            exact_mean(F.col("confidence_score"), 3).alias("avg_confidence"),
            F.sum("total_amount").alias("total_amount"),
            _statuses(),
        )
        .orderBy(F.col("fy_year").desc_nulls_first())
    )


def duplicate_candidates(core: DataFrame, ids_per_row: int = 1000) -> DataFrame:
    """Groups of equal supplier, date and amount with their ids.

    A large group continues over several rows: ``part`` is the id range, so a
    row lists at most ``ids_per_row`` ids however many copies there are.
    ``copies`` counts the whole group.
    """
    key = ["supplier_name", "document_date", "total_amount"]
    complete = core.select(*key, "doc_id")
    for column in key:
        complete = complete.filter(F.col(column).isNotNull())
    # The groups come first: most documents have no copy and go no further than
    # the join, whose group side is unique and far smaller.
    copies = complete.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    ids = F.array_sort(F.collect_list("doc_id")).cast("array<string>")
    return (
        complete.join(copies, key)
        .groupBy(*key, "copies", F.floor(F.col("doc_id") / ids_per_row).alias("part"))
        .agg(F.array_join(ids, ", ").alias("doc_ids"))
        .orderBy(F.col("copies").desc(), *key, "part")
    )


def record_lookup(core: DataFrame, categories: DataFrame, doc_id: int) -> DataFrame:
    return _with_category(core.filter(F.col("doc_id") == doc_id), categories)


def status_counts(core: DataFrame) -> DataFrame:
    """Automatic statuses and the total in one row."""
    status = F.col("review_status")
    return core.agg(
        F.count_if(status == "AUTO_CONFIRMED").alias("auto_confirmed"),
        F.count_if(status == "NEEDS_REVIEW").alias("needs_review"),
        F.count_if(status == "AUTO_REJECTED").alias("auto_rejected"),
        F.count(F.lit(1)).alias("total"),
    )


def status_verify(core: DataFrame) -> DataFrame:
    return (
        core.groupBy("review_status")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy("review_status")
    )


def digest_rows(core: DataFrame, categories: DataFrame) -> DataFrame:
    """Rows of the review digest with labels for what is missing."""
    rows = _with_category(core.filter(F.col("review_status") == "NEEDS_REVIEW"), categories)
    fy = F.concat(F.lit("FY"), F.col("fy_year").cast("string"))
    return rows.select(
        "doc_id",
        F.coalesce("supplier_name", F.lit(NO_SUPPLIER)).alias("supplier_name"),
        "subject",
        F.coalesce("category_nme", F.lit(NO_CATEGORY)).alias("category"),
        F.round("confidence_score", 2).alias("confidence"),
        "total_amount",
        "document_date",
        F.coalesce(fy, F.lit(NO_VALUE)).alias("fy_label"),
        "confidence_score",
    ).orderBy(F.col("confidence_score").asc_nulls_last(), F.col("document_date").desc_nulls_first()).drop("confidence_score")


def digest_summary(core: DataFrame) -> DataFrame:
    """Count of waiting documents and whether the queue is clear."""
    waiting = F.count_if(F.col("review_status") == "NEEDS_REVIEW")
    return core.agg(waiting.alias("waiting"), (waiting == 0).alias("all_clear"))


def signed_links(digest: DataFrame, secret: Secret) -> DataFrame:
    """Add a confirm and a reject token per row."""
    return digest.withColumn(
        "confirm_token", review_token(F.col("doc_id"), F.lit("confirm"), secret)
    ).withColumn("reject_token", review_token(F.col("doc_id"), F.lit("reject"), secret))


# --- actions -----------------------------------------------------------------


@dataclass(frozen=True)
class BulkAction:
    """One statement of a review script, applied in the order given.

    ``kind`` is one of ``accept, reject`` (by ``doc_id``), ``accept_supplier,
    reject_supplier, accept_category, accept_fy, rescue, recategorise, note``.
    """

    kind: str
    doc_id: int | None = None
    supplier: str | None = None
    category: str | None = None
    fy_year: int | None = None
    note: str | None = None


ACTION_KINDS = (
    "accept", "reject", "accept_supplier", "reject_supplier", "accept_category", "accept_fy",
    "rescue", "recategorise", "note",
)
BULK_ACTION = (
    "step BIGINT, kind STRING, doc_id BIGINT, supplier STRING, category STRING, fy_year INT, "
    "note STRING"
)


def bulk_action_rows(spark: SparkSession, actions: Sequence[BulkAction]) -> DataFrame:
    """A review script as a table, numbered in the order given."""
    for action in actions:
        if action.kind not in ACTION_KINDS:
            raise ValueError(f"unknown action {action.kind}")
    rows = [
        (i, a.kind, a.doc_id, a.supplier, a.category, a.fy_year, a.note)
        for i, a in enumerate(actions)
    ]
    return spark.createDataFrame(rows, BULK_ACTION)


def _after(state: Column, action: Column, floors: dict[str, Column], now: Column) -> Column:
    """A document's state after one action that may concern it."""
    status, kind = state["status"], action["kind"]
    supplier_hit = kind.isin("accept_supplier", "reject_supplier") & (
        status.isin("NEEDS_REVIEW", "AUTO_CONFIRMED")
        | ((kind == "reject_supplier") & (status == "AUTO_REJECTED"))
    )
    category_hit = (
        (kind == "accept_category")
        & (state["category"] == action["category_id"])
        & (status == "AUTO_CONFIRMED")
        & floors["accept_category"]
    )
    fy_hit = (kind == "accept_fy") & (status == "AUTO_CONFIRMED") & floors["accept_fy"]
    rescued = (kind == "rescue") & (status == "AUTO_REJECTED")
    hit = F.coalesce(
        kind.isin("accept", "reject") | supplier_hit | category_hit | fy_hit | rescued,
        F.lit(False),
    )
    target = F.when(kind.isin("reject", "reject_supplier"), "REJECTED").otherwise("CONFIRMED")
    changes = F.coalesce(hit & (status != target), F.lit(False))
    return F.struct(
        F.when(hit, target).otherwise(status).alias("status"),
        F.when(hit | (kind == "note"), action["note"]).otherwise(state["note"]).alias("note"),
        F.when(kind == "recategorise", action["category_id"])
        .otherwise(state["category"])
        .alias("category"),
        F.when(changes, now).otherwise(state["reviewed_at"]).alias("reviewed_at"),
        F.when(hit, now).otherwise(state["updated_at"]).alias("updated_at"),
    )


def apply_bulk_actions(
    core: DataFrame,
    actions: Sequence[BulkAction] | DataFrame,
    categories: DataFrame,
    now: Column,
) -> DataFrame:
    """Apply a review script: one join per way of naming documents, then one pass per document.

    Every statement sees a document as the one before left it. An unknown category
    name matches no row, and a document recategorised to one has no category. The
    script is written by people: what names one document, supplier, year or category
    is kept as one list.
    """
    if not isinstance(actions, DataFrame):
        actions = bulk_action_rows(core.sparkSession, actions)
    names = categories.groupBy(F.col("category_nme").alias("category")).agg(
        F.min("category_id").alias("category_id")
    )
    steps = actions.join(names, "category", "left")
    steps = steps.withColumn("category_id", F.col("category_id").cast("int"))
    entry = F.struct("step", "kind", "note", "category_id")
    # A document moved to a category meets the statements on that category as well.
    accepts = steps.filter("kind = 'accept_category'")
    moved = steps.filter("kind = 'recategorise'").select("doc_id", "category_id")
    steps = steps.unionByName(
        accepts.drop("doc_id").join(moved, "category_id").select(*steps.columns)
    )

    def listed(named: Column, key: Column, name: str) -> DataFrame:
        chosen = steps.filter(named & key.isNotNull())
        return chosen.groupBy(key.alias(f"_{name}")).agg(
            F.collect_list(entry).alias(f"_by_{name}")
        )

    kind = F.col("kind")
    single = kind.isin("accept", "reject", "rescue", "recategorise", "note", "accept_category")
    by_doc = listed(single, F.col("doc_id"), "doc")
    by_supplier = listed(
        kind.isin("accept_supplier", "reject_supplier"), F.lower("supplier"), "supplier"
    )
    by_year = listed(kind == "accept_fy", F.col("fy_year"), "year")
    by_category = listed(kind == "accept_category", F.col("category_id"), "category")
    rows = (
        core.join(by_doc, F.col("doc_id") == F.col("_doc"), "left")
        .join(by_supplier, F.lower("supplier_name") == F.col("_supplier"), "left")
        .join(by_year, F.col("fy_year") == F.col("_year"), "left")
        .join(by_category, F.col("tax_category_id") == F.col("_category"), "left")
    )
    none = F.array().cast("array<struct<step:bigint,kind:string,note:string,category_id:int>>")
    lists = ("_by_doc", "_by_supplier", "_by_year", "_by_category")
    script = F.array_sort(
        F.array_distinct(F.concat(*[F.coalesce(F.col(c), none) for c in lists]))
    )
    confidence = F.col("confidence_score")
    floors = {
        kind: confidence >= F.lit(floor).cast("decimal(4,3)")
        for kind, floor in (
            ("accept_category", MIN_CATEGORY_CONFIDENCE),
            ("accept_fy", MIN_FY_CONFIDENCE),
        )
    }
    types = {f.name: f.dataType for f in core.schema.fields}
    fields = {
        "review_status": "status",
        "reviewer_notes": "note",
        "tax_category_id": "category",
        "reviewed_at": "reviewed_at",
        "updated_at": "updated_at",
    }
    kinds = ", ".join(
        f"{f}: {'int' if f == 'category' else types[c].simpleString()}" for c, f in fields.items()
    )
    start = F.struct(*[F.col(c).alias(f) for c, f in fields.items()]).cast(f"struct<{kinds}>")
    state = F.aggregate(
        script, start, lambda s, x: _after(s, x, floors, now).cast(f"struct<{kinds}>")
    )
    done = rows.withColumn("_state", state)
    return done.select(
        *[
            F.col(f"_state.{fields[c]}").cast(types[c]).alias(c) if c in fields else F.col(c)
            for c in core.columns
        ]
    )


# Notes of the signed review actions.
CONFIRM_NOTE, REJECT_NOTE = "Confirmed via email review bot", "Rejected via email review bot"


def valid_review_actions(actions: DataFrame, secret: Secret) -> DataFrame:
    """Actions that are exactly confirm or reject and carry the right token."""
    expected = review_token(F.col("doc_id"), F.col("action"), secret)
    return actions.filter(F.col("action").isin("confirm", "reject") & (F.col("token") == expected))


def apply_signed_actions(
    core: DataFrame, actions: DataFrame, secret: Secret, now: Column | None = None
) -> DataFrame:
    """Apply ``actions(action_ts, doc_id, action, token)``; the first valid one counts.

    A reviewed document does not change again, so replays are no-ops and only
    one action per document has to reach the join.
    """
    now = F.col("_ts") if now is None else now
    first = first_per_key(
        valid_review_actions(actions, secret), ["doc_id"], [F.col("action_ts"), F.col("action")]
    ).select("doc_id", F.col("action").alias("_action"), F.col("action_ts").alias("_ts"))
    rows = core.join(first, "doc_id", "left")
    hit = F.col("_action").isNotNull() & ~F.col("review_status").isin(*REVIEWED)
    status = F.when(F.col("_action") == "confirm", "CONFIRMED").otherwise("REJECTED")
    note = F.when(F.col("_action") == "confirm", CONFIRM_NOTE).otherwise(REJECT_NOTE)
    return rows.withColumn("_hit", hit).select(
        *[
            F.when(F.col("_hit"), status).otherwise(F.col(c)).alias(c) if c == "review_status"
            else F.when(F.col("_hit"), F.coalesce(F.col(c), note)).otherwise(F.col(c)).alias(c)
            if c == "reviewer_notes"
            else F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c)
            if c in ("reviewed_at", "updated_at")
            else F.col(c)
            for c in core.columns
        ]
    )
