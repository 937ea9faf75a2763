"""Review, action, checklist-answer and quality queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions import crypto
from ledgermill.functions.calendar import epoch_ms
from ledgermill.operators import checklist, config, health, quality, review, runlog
from ledgermill.plans import frames
from ledgermill.plans.frames import SAMPLE_SECRET, sample_key, sample_pads, with_frames
from ledgermill.plans.queries_mart import ITEMS_SQL, RESPONSES_SQL, _responses
from ledgermill.plans.registry import query

_INNER, _OUTER = crypto.hmac_pads(SAMPLE_SECRET)


def _hmac_sql(message: str) -> str:
    inner = f"sha256(unhex('{_INNER}' || hex(encode({message}))))"
    return f"sha256(unhex('{_OUTER}' || {inner}))"


def _mean3(column: str) -> str:
    """Exact mean of a three-digit decimal, rounded half up, in whole numbers."""
    total = f"CAST(sum({column}) * 1000 AS BIGINT)"
    return f"((2 * {total} + count({column})) // (2 * count({column}))) / 1000.0"


_STATUSES = "string_agg(DISTINCT review_status, ', ' ORDER BY review_status)"
_CATS_JOIN = "LEFT JOIN tax_cats c ON c.category_id = d.tax_category_id"


def _core(spark, sf):
    return frames.core_documents(spark, sf)


def _cats(spark):
    return seeds.tax_categories(spark)


@query(
    "status_summary",
    with_frames("docs")
    + f"""SELECT review_status, count(*) AS record_count, {_mean3('confidence_score')} AS avg_confidence,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount_sum FROM docs GROUP BY 1""",
)
def status_summary(spark, sf):
    return review.status_summary(_core(spark, sf))


@query(
    "category_matrix",
    with_frames("docs", "tax_cats")
    + f"""SELECT coalesce(c.category_nme, '— uncategorised —') AS category, d.review_status, count(*) AS cnt,
  {_mean3('d.confidence_score')} AS avg_confidence FROM docs d {_CATS_JOIN} GROUP BY 1, 2""",
)
def category_matrix(spark, sf):
    return review.category_matrix(_core(spark, sf), _cats(spark))


_LIST = """SELECT d.doc_id, CAST(d.confidence_score AS DOUBLE) AS confidence,
  coalesce(c.category_nme, '—') AS category, CAST(d.fy_year AS BIGINT) AS fy_year, d.supplier_name,
  CAST(d.total_amount AS DOUBLE) AS total_amount, CAST(d.document_date AS VARCHAR) AS document_date,
  d.subject, d.sender_email{notes} FROM docs d """ + _CATS_JOIN + " WHERE d.review_status = '{status}'"


@query(
    "review_queue",
    with_frames("docs", "tax_cats")
    + _LIST.format(notes=", d.reviewer_notes", status="NEEDS_REVIEW"),
)
def review_queue(spark, sf):
    return review.needs_review_list(_core(spark, sf), _cats(spark))


@query(
    "auto_confirmed_list",
    with_frames("docs", "tax_cats") + _LIST.format(notes="", status="AUTO_CONFIRMED"),
)
def auto_confirmed_list(spark, sf):
    return review.auto_confirmed_list(_core(spark, sf), _cats(spark))


@query(
    "auto_rejected_list",
    with_frames("docs", "tax_cats") + _LIST.format(notes="", status="AUTO_REJECTED"),
)
def auto_rejected_list(spark, sf):
    return review.auto_rejected_list(_core(spark, sf), _cats(spark))


@query(
    "confidence_bands",
    with_frames("docs")
    + f"""SELECT CASE WHEN confidence_score >= 0.9 THEN '0.90–1.00 (very high)'
  WHEN confidence_score >= 0.75 THEN '0.75–0.89 (high)' WHEN confidence_score >= 0.5 THEN '0.50–0.74 (medium)'
  WHEN confidence_score >= 0.25 THEN '0.25–0.49 (low)' ELSE '0.00–0.24 (very low)' END AS confidence_band,
  count(*) AS cnt, {_STATUSES} AS statuses FROM docs GROUP BY 1""",
)
def confidence_bands(spark, sf):
    return review.confidence_bands(_core(spark, sf))


_PROFILE = (
    with_frames("docs", "tax_cats")
    + f"""SELECT coalesce(d.supplier_name, '— unknown —') AS supplier, coalesce(c.category_nme, '—') AS category,
  count(*) AS record_count, {_mean3('d.confidence_score')} AS avg_confidence,
  CAST(min(d.document_date) AS VARCHAR) AS earliest, CAST(max(d.document_date) AS VARCHAR) AS latest,
  CAST(sum(d.total_amount) AS DOUBLE) AS total_amount, {_STATUSES} AS statuses
FROM docs d {_CATS_JOIN} GROUP BY 1, 2"""
)


@query("supplier_profile", _PROFILE)
def supplier_profile(spark, sf):
    return review.supplier_profile(_core(spark, sf), _cats(spark))


@query("supplier_profile_one", f"SELECT * FROM ({_PROFILE}) WHERE supplier = 'src7'")
def supplier_profile_one(spark, sf):
    return review.supplier_profile(_core(spark, sf), _cats(spark), "src7")


@query(
    "supplier_rows",
    with_frames("docs") + "SELECT doc_id, CAST(received_at AS VARCHAR) AS received_at, review_status "
    "FROM docs WHERE supplier_name = 'src7'",
)
def supplier_rows(spark, sf):
    return review.supplier_rows(_core(spark, sf), "src7").select(
        "doc_id", "received_at", "review_status"
    )


@query(
    "fy_coverage",
    with_frames("docs")
    + f"""SELECT CAST(fy_year AS BIGINT) AS fy_year, count(*) AS record_count,
  {_mean3('confidence_score')} AS avg_confidence, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
  {_STATUSES} AS statuses FROM docs GROUP BY 1""",
)
def fy_coverage(spark, sf):
    return review.fy_coverage(_core(spark, sf))


@query(
    "dup_candidates",
    with_frames("docs")
    + """, g AS (SELECT supplier_name, document_date, total_amount, count(*) AS copies FROM docs
  WHERE supplier_name IS NOT NULL AND document_date IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT d.supplier_name, CAST(d.document_date AS VARCHAR) AS document_date,
  CAST(d.total_amount AS DOUBLE) AS total_amount, g.copies, d.doc_id // 1000 AS part,
  string_agg(CAST(d.doc_id AS VARCHAR), ', ' ORDER BY d.doc_id) AS doc_ids
FROM docs d JOIN g ON g.supplier_name = d.supplier_name AND g.document_date = d.document_date
  AND g.total_amount = d.total_amount GROUP BY ALL""",
)
def dup_candidates(spark, sf):
    return review.duplicate_candidates(_core(spark, sf))


@query(
    "record_lookup",
    with_frames("docs", "tax_cats")
    + f"""SELECT d.doc_id, d.subject, d.review_status, c.category_nme FROM docs d {_CATS_JOIN} WHERE d.doc_id = 42""",
)
def record_lookup(spark, sf):
    return review.record_lookup(_core(spark, sf), _cats(spark), 42).select(
        "doc_id", "subject", "review_status", "category_nme"
    )


@query(
    "status_counts",
    with_frames("docs")
    + """SELECT count(*) FILTER (review_status = 'AUTO_CONFIRMED') AS auto_confirmed,
  count(*) FILTER (review_status = 'NEEDS_REVIEW') AS needs_review,
  count(*) FILTER (review_status = 'AUTO_REJECTED') AS auto_rejected, count(*) AS total FROM docs""",
)
def status_counts(spark, sf):
    return review.status_counts(_core(spark, sf))


@query(
    "digest_rows",
    with_frames("docs", "tax_cats")
    + f"""SELECT d.doc_id, coalesce(d.supplier_name, '— unknown —') AS supplier_name, d.subject,
  coalesce(c.category_nme, '— uncategorised —') AS category,
  (CAST(d.confidence_score * 1000 AS BIGINT) + 5) // 10 / 100.0 AS confidence,
  CAST(d.total_amount AS DOUBLE) AS total_amount, CAST(d.document_date AS VARCHAR) AS document_date,
  coalesce('FY' || d.fy_year, '—') AS fy_label FROM docs d {_CATS_JOIN} WHERE d.review_status = 'NEEDS_REVIEW'""",
)
def digest_rows(spark, sf):
    return review.digest_rows(_core(spark, sf), _cats(spark))


@query(
    "digest_summary",
    with_frames("docs")
    + "SELECT count(*) FILTER (review_status = 'NEEDS_REVIEW') AS waiting, "
    "count(*) FILTER (review_status = 'NEEDS_REVIEW') = 0 AS all_clear FROM docs",
)
def digest_summary(spark, sf):
    return review.digest_summary(_core(spark, sf))


@query(
    "signed_links",
    with_frames("docs")
    + f"""SELECT doc_id, {_hmac_sql("doc_id || '|confirm'")} AS confirm_token,
  {_hmac_sql("doc_id || '|reject'")} AS reject_token FROM docs WHERE review_status = 'NEEDS_REVIEW'""",
)
def signed_links(spark, sf):
    rows = review.signed_links(review.digest_rows(_core(spark, sf), _cats(spark)), sample_pads(spark))
    return rows.select("doc_id", "confirm_token", "reject_token")


# --- actions -----------------------------------------------------------------

_SCRIPT = (
    review.BulkAction("accept_supplier", supplier="SRC7", note="known"),
    review.BulkAction("reject_supplier", supplier="src1", note="private"),
    review.BulkAction("accept_category", category="Donations", note="category"),
    review.BulkAction("accept_fy", fy_year=2024, note="sure"),
    review.BulkAction("accept", doc_id=5, note="one"),
    review.BulkAction("reject", doc_id=7, note="not relevant"),
    review.BulkAction("rescue", doc_id=11, note="rescued"),
    review.BulkAction("recategorise", doc_id=13, category="Foreign Income"),
    review.BulkAction("note", doc_id=17, note="see invoice"),
)

_NOW_SQL = "TIMESTAMP '2026-01-01 00:00:00'"
_BULK = (
    with_frames("docs", "tax_cats")
    + f""", b AS (SELECT *, review_status AS s0,
  CASE WHEN lower(supplier_name) = 'src7' AND review_status IN ('NEEDS_REVIEW', 'AUTO_CONFIRMED') THEN 1
    WHEN lower(supplier_name) = 'src1' AND review_status IN ('NEEDS_REVIEW', 'AUTO_CONFIRMED', 'AUTO_REJECTED') THEN 2
    WHEN tax_category_id = (SELECT category_id FROM tax_cats WHERE category_nme = 'Donations')
      AND review_status = 'AUTO_CONFIRMED' AND confidence_score >= 0.85 THEN 3
    WHEN fy_year = 2024 AND review_status = 'AUTO_CONFIRMED' AND confidence_score >= 0.9 THEN 4 END AS bulk FROM docs),
c AS (SELECT *, CASE WHEN bulk = 2 THEN 'REJECTED' WHEN bulk IS NOT NULL THEN 'CONFIRMED' ELSE review_status END AS s1,
  CASE bulk WHEN 1 THEN 'known' WHEN 2 THEN 'private' WHEN 3 THEN 'category' WHEN 4 THEN 'sure' ELSE reviewer_notes END AS n1
  FROM b),
e AS (SELECT *, CASE WHEN doc_id = 5 THEN 'CONFIRMED' WHEN doc_id = 7 THEN 'REJECTED'
    WHEN doc_id = 11 AND s1 = 'AUTO_REJECTED' THEN 'CONFIRMED' ELSE s1 END AS s2,
  CASE WHEN doc_id = 5 THEN 'one' WHEN doc_id = 7 THEN 'not relevant' WHEN doc_id = 11 AND s1 = 'AUTO_REJECTED' THEN 'rescued'
    WHEN doc_id = 17 THEN 'see invoice' ELSE n1 END AS n2 FROM c)
"""
)


def _scripted(spark, sf):
    now = F.lit("2026-01-01").cast("timestamp")
    return review.apply_bulk_actions(_core(spark, sf), _SCRIPT, _cats(spark), now)


@query(
    "bulk_actions",
    _BULK
    + """SELECT doc_id, s2 AS review_status, n2 AS reviewer_notes,
  CASE WHEN doc_id = 13 THEN 25 ELSE tax_category_id END AS tax_category_id FROM e""",
)
def bulk_actions(spark, sf):
    return _scripted(spark, sf).select(
        "doc_id", "review_status", "reviewer_notes", "tax_category_id"
    )


@query(
    "reviewed_at",
    _BULK
    + f"""SELECT doc_id, CAST(CASE WHEN s1 <> s0 OR s2 <> s1 THEN {_NOW_SQL} ELSE reviewed_at END AS VARCHAR)
  AS reviewed_at FROM e""",
)
def reviewed_at(spark, sf):
    return _scripted(spark, sf).select("doc_id", "reviewed_at")


@query(
    "status_verify", _BULK + "SELECT s2 AS review_status, count(*) AS record_count FROM e GROUP BY 1"
)
def status_verify(spark, sf):
    return review.status_verify(_scripted(spark, sf))


# Conversation turns as review actions: some replayed, some unsigned, some unknown.
ACTIONS_SQL = f"""actions AS (SELECT (conv_id * 3 + turn // 2) AS doc_id,
  CASE role WHEN 'user' THEN 'confirm' WHEN 'assistant' THEN 'reject' ELSE 'delete' END AS action,
  TIMESTAMP '2025-01-01 00:00:00' + to_hours(CAST(conv_id AS INT)) + to_minutes(CAST(turn AS INT)) AS action_ts,
  turn FROM conversations),
signed AS (SELECT *, CASE WHEN turn % 5 = 4 THEN 'forged' ELSE {_hmac_sql("doc_id || '|' || action")} END AS token
  FROM actions),
valid AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY action_ts, action) AS n FROM signed
  WHERE action IN ('confirm', 'reject') AND token = {_hmac_sql("doc_id || '|' || action")}),
first AS (SELECT * FROM valid WHERE n = 1)
"""


def review_actions(spark, sf):
    action = (
        F.when(F.col("role") == "user", "confirm")
        .when(F.col("role") == "assistant", "reject")
        .otherwise("delete")
    )
    rows = frames.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 3 + F.floor(F.col("turn") / 2)).alias("doc_id"),
        action.alias("action"),
        F.expr(
            "TIMESTAMP'2025-01-01 00:00:00' + make_dt_interval(0, CAST(conv_id AS INT), CAST(turn AS INT))"
        ).alias("action_ts"),
        "turn",
    )
    token = crypto.review_token(F.col("doc_id"), F.col("action"), sample_pads(spark))
    return rows.withColumn("token", F.when(F.col("turn") % 5 == 4, "forged").otherwise(token)).drop(
        "turn"
    )


@query(
    "signed_actions",
    with_frames("docs")
    + f""", {ACTIONS_SQL}, r AS (SELECT d.*, f.action, f.action_ts,
  f.action IS NOT NULL AND d.review_status NOT IN ('CONFIRMED', 'REJECTED') AS hit
  FROM docs d LEFT JOIN first f ON f.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN NOT hit THEN review_status WHEN action = 'confirm' THEN 'CONFIRMED' ELSE 'REJECTED' END
  AS review_status, CASE WHEN NOT hit THEN reviewer_notes WHEN action = 'confirm'
  THEN coalesce(reviewer_notes, 'Confirmed via email review bot')
  ELSE coalesce(reviewer_notes, 'Rejected via email review bot') END AS reviewer_notes,
  CAST(CASE WHEN hit THEN action_ts ELSE reviewed_at END AS VARCHAR) AS reviewed_at FROM r""",
)
def signed_actions(spark, sf):
    done = review.apply_signed_actions(_core(spark, sf), review_actions(spark, sf), sample_pads(spark))
    return done.select("doc_id", "review_status", "reviewer_notes", "reviewed_at")


_GROUPS = [g for g, _ in seeds.rows_of(seeds.CHECKLIST_QUESTIONS)]
_ANSWERS_SQL = f"""answers AS (SELECT [{', '.join(f"'{g}'" for g in _GROUPS)}][CAST(1 + conv_id % {len(_GROUPS)} AS INT)]
  AS group_code, 2024 + turn % 3 AS fy_year,
  CASE role WHEN 'user' THEN 'YES' WHEN 'assistant' THEN 'NO' ELSE 'MAYBE' END AS answer,
  TIMESTAMP '2025-01-01 00:00:00' + to_hours(CAST(conv_id AS INT)) + to_minutes(CAST(turn AS INT)) AS ts,
  turn FROM conversations),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_code, fy_year ORDER BY ts DESC, answer DESC) AS n
  FROM answers WHERE answer <> 'MAYBE' AND turn % 5 <> 4) WHERE n = 1),
fresh AS (SELECT i.item_id, l.fy_year, l.answer, l.ts FROM last l JOIN items i
  ON i.applicability_group = l.group_code AND i.item_type = 'DOCUMENT'),
merged AS (SELECT coalesce(r.item_id, f.item_id) AS item_id, coalesce(r.fy_year, f.fy_year) AS fy_year,
  coalesce(f.answer, r.is_applicable) AS is_applicable, f.ts
  FROM responses r FULL JOIN fresh f ON f.item_id = r.item_id AND f.fy_year = r.fy_year)
"""


def _answers(spark, sf):
    groups = F.array(*[F.lit(g) for g in _GROUPS])
    rows = frames.table(spark, sf, "conversations").select(
        F.element_at(groups, (F.col("conv_id") % len(_GROUPS) + 1).cast("int")).alias("group_code"),
        (F.col("turn") % 3 + 2024).cast("int").alias("fy_year"),
        F.when(F.col("role") == "user", "YES")
        .when(F.col("role") == "assistant", "NO")
        .otherwise("MAYBE")
        .alias("answer"),
        F.expr(
            "TIMESTAMP'2025-01-01 00:00:00' + make_dt_interval(0, CAST(conv_id AS INT), CAST(turn AS INT))"
        ).alias("action_ts"),
        "turn",
    )
    token = crypto.checklist_token(
        F.col("group_code"), F.col("fy_year"), F.col("answer"), sample_pads(spark)
    )
    return rows.withColumn("token", F.when(F.col("turn") % 5 == 4, "forged").otherwise(token))


def _answered(spark, sf):
    return checklist.apply_answers(
        _responses(spark, sf), seeds.checklist_items(spark), _answers(spark, sf), sample_pads(spark)
    )


_ANSWERED = f"WITH {ITEMS_SQL}, {RESPONSES_SQL}, {_ANSWERS_SQL}"


@query(
    "checklist_answers",
    _ANSWERED
    + """SELECT CAST(item_id AS BIGINT) AS item_id, CAST(fy_year AS BIGINT) AS fy_year, is_applicable,
  CAST(ts AS VARCHAR) AS responded_at FROM merged""",
)
def checklist_answers(spark, sf):
    return _answered(spark, sf).select("item_id", "fy_year", "is_applicable", "responded_at")


_QUESTIONS = """, q AS (SELECT i.applicability_group AS group_code, i.applicability_question, i.section,
  min(i.sort_order) AS sort_order, max(m.is_applicable) AS current_response
  FROM items i JOIN merged m ON m.item_id = i.item_id AND m.fy_year = 2025
  WHERE i.item_type = 'DOCUMENT' AND NOT i.always_required AND i.applicability_group IS NOT NULL GROUP BY 1, 2, 3)
"""


@query(
    "questionnaire",
    _ANSWERED
    + _QUESTIONS
    + """SELECT group_code, applicability_question, section, CAST(sort_order AS BIGINT) AS sort_order,
  current_response FROM q""",
)
def questionnaire(spark, sf):
    return checklist.questionnaire(seeds.checklist_items(spark), _answered(spark, sf), 2025)


@query(
    "questionnaire_progress",
    _ANSWERED
    + _QUESTIONS
    + """SELECT coalesce(section, 'ALL') AS section, count(*) FILTER (current_response <> 'UNKNOWN') AS answered,
  count(*) AS total, CAST(round(count(*) FILTER (current_response <> 'UNKNOWN') * 100.0 / count(*)) AS BIGINT) AS pct
FROM q GROUP BY ROLLUP (section)""",
)
def questionnaire_progress(spark, sf):
    return checklist.questionnaire_progress(
        checklist.questionnaire(seeds.checklist_items(spark), _answered(spark, sf), 2025)
    )


# --- accuracy, quality and control -------------------------------------------


@query(
    "class_accuracy",
    """WITH p AS (SELECT quality AS actual, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS predicted
  FROM documents JOIN labels USING (doc_id))
SELECT coalesce(CAST(actual AS VARCHAR), 'ALL') AS label, count(*) FILTER (actual = predicted) AS correct,
  count(*) AS reviewed, round(count(*) FILTER (actual = predicted) * 100.0 / count(*), 1) AS accuracy_pct
FROM p GROUP BY ROLLUP (actual)""",
)
def class_accuracy(spark, sf):
    return health.classification_accuracy(_predictions(spark, sf), "predicted", "actual")


def _predictions(spark, sf):
    docs = frames.table(spark, sf, "documents").select("doc_id", "n_chars")
    return docs.join(frames.table(spark, sf, "labels"), "doc_id").select(
        F.col("quality").alias("actual"),
        F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("predicted"),
    )


@query(
    "confusion_matrix",
    """SELECT CAST(quality AS BIGINT) AS actual, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS predicted, count(*) AS n
FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    return health.confusion_matrix(_predictions(spark, sf), "predicted", "actual")


@query(
    "dq_violations",
    with_frames("landing", "docs", "tax_cats", "txn", "budget")
    + """SELECT 'not_null:source_type' AS rule, CAST(landing_id AS VARCHAR) AS row_key FROM landing WHERE source_type IS NULL
UNION ALL SELECT 'not_null:source_id', CAST(landing_id AS VARCHAR) FROM landing WHERE source_id IS NULL
UNION ALL SELECT 'one_of:source_type', CAST(landing_id AS VARCHAR) FROM landing WHERE source_type = 'MANUAL'
UNION ALL SELECT 'length:content_preview', CAST(landing_id AS VARCHAR) FROM landing WHERE length(content_preview) > 400
UNION ALL SELECT 'unique:landing_key', source_type || '|' || source_id || '|' || coalesce(file_name, '') FROM landing
  WHERE source_type IS NOT NULL AND source_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'foreign_key:tax_category_id', CAST(tax_category_id AS VARCHAR) FROM docs
  WHERE tax_category_id NOT IN (SELECT category_id FROM tax_cats)
UNION ALL SELECT 'range:confidence_score', CAST(doc_id AS VARCHAR) FROM docs WHERE confidence_score NOT BETWEEN 0.1 AND 0.9
UNION ALL SELECT 'rule:deductible_needs_amount', CAST(txn_id AS VARCHAR) FROM txn WHERE NOT (is_deductible OR amount < 0)
UNION ALL SELECT 'range:budget_amount', CAST(month_num AS VARCHAR) FROM budget WHERE budget_amount < 500000""",
)
def dq_violations(spark, sf):
    landing = frames.landing_documents(spark, sf)
    core = _core(spark, sf)
    rules = [
        quality.not_null("source_type"),
        quality.not_null("source_id"),
        quality.one_of("source_type", ("GMAIL", "FOLDER")),
        quality.max_length("content_preview", 400),
    ]
    key = [F.col("source_type"), F.col("source_id"), F.coalesce("file_name", F.lit(""))]
    sign = quality.holds("deductible_needs_amount", F.col("is_deductible") | (F.col("amount") < 0))
    return quality.check(
        [
            quality.row_violations(landing, "landing_id", rules),
            quality.unique_violations(landing, "landing_key", key),
            quality.foreign_key_violations(core, "tax_category_id", _cats(spark), "category_id"),
            quality.row_violations(core, "doc_id", [quality.in_range("confidence_score", F.lit("0.1").cast("decimal(4,3)"), F.lit("0.9").cast("decimal(4,3)"))]),
            quality.row_violations(frames.transactions(spark, sf), "txn_id", [sign]),
            quality.row_violations(
                frames.budgets(spark, sf), "month_num", [quality.at_least("budget_amount", 500000)]
            ),
        ]
    )


@query(
    "seed_merge",
    """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CASE WHEN n_regionkey = 0 THEN 'kept' ELSE 'seeded' END AS origin
FROM nation UNION ALL SELECT CAST(c_custkey AS BIGINT) + 1000, 'kept' FROM customer""",
)
def seed_merge(spark, sf):
    nations = frames.table(spark, sf, "nation")
    extra = frames.table(spark, sf, "customer").selectExpr("c_custkey + 1000 AS c_custkey")
    existing = nations.filter("n_regionkey = 0").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS n_nationkey", "'kept' AS origin"
    ).unionByName(extra.selectExpr("c_custkey AS n_nationkey", "'kept' AS origin"))
    fresh = nations.selectExpr("CAST(n_nationkey AS BIGINT) AS n_nationkey", "'seeded' AS origin")
    return quality.seed_if_absent(existing, fresh, ["n_nationkey"])


@query(
    "config_vars",
    "SELECT c_name AS var_nme, CASE WHEN c_custkey % 2 = 0 THEN 'new ' ELSE 'old ' END || c_custkey AS var_val "
    "FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def config_vars(spark, sf):
    rows = frames.table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("package_nme"),
        F.col("c_name").alias("var_nme"),
        F.concat(F.lit("old "), "c_custkey").alias("value"),
        "c_custkey",
    )
    key = sample_key(spark)
    stored = config.seal(rows, key)
    changed = rows.filter("c_custkey % 2 = 0").withColumn(
        "value", F.concat(F.lit("new "), "c_custkey")
    )
    return config.config_vars(config.upsert_vars(stored, changed, key), "BUILDING", key)


@query(
    "stored_mark",
    "SELECT 'mail' AS package_nme, 'LAST_INTERNAL_DATE_MS' AS var_nme, "
    "CAST(epoch_ms(max(ts)) AS VARCHAR) AS value FROM events",
)
def stored_mark(spark, sf):
    sent = frames.table(spark, sf, "events").select(
        epoch_ms(F.col("ts").cast("timestamp")).cast("string").alias("internalDate")
    )
    return config.stored_mark(sent, "mail", "LAST_INTERNAL_DATE_MS")


def _log(spark, sf):
    """Events as a run log: a start row each, and an end row for all but errors."""
    events = frames.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    start = events.selectExpr(
        "CAST(event_id AS STRING) AS batch_id", "event_type AS workflow_nme",
        "CAST(NULL AS STRING) AS script_nme", "'STARTED' AS status", "0L AS rows_extracted",
        "0L AS rows_loaded", "0L AS rows_skipped", "CAST(NULL AS STRING) AS error_msg",
        "ts AS logged_at",
    )
    end = events.filter("event_type <> 'error'").selectExpr(
        "CAST(event_id AS STRING) AS batch_id", "event_type AS workflow_nme",
        "CAST(NULL AS STRING) AS script_nme",
        "CASE WHEN value > 100 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "user_id AS rows_extracted", "user_id - 1 AS rows_loaded", "1L AS rows_skipped",
        "CASE WHEN value > 100 THEN 'too slow' END AS error_msg",
        "ts + make_dt_interval(0, 0, 0, CAST(value AS INT)) AS logged_at",
    )
    return start.unionByName(end)


_RUNS = """WITH r AS (SELECT CAST(event_id AS VARCHAR) AS batch_id, event_type AS workflow_nme,
  CASE WHEN event_type = 'error' THEN 'STARTED' WHEN value > 100 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN event_type = 'error' THEN 0 ELSE greatest(user_id, 0) END AS rows_extracted,
  CASE WHEN event_type = 'error' THEN 0 ELSE greatest(user_id - 1, 0) END AS rows_loaded,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS rows_skipped,
  CASE WHEN event_type <> 'error' AND value > 100 THEN 'too slow' END AS error_msg, ts,
  CASE WHEN event_type <> 'error' THEN CAST(trunc(value) AS BIGINT) END AS duration_secs FROM events)
"""


@query(
    "run_log",
    _RUNS
    + "SELECT batch_id, workflow_nme, status, rows_extracted, rows_loaded, rows_skipped, error_msg FROM r",
)
def run_log(spark, sf):
    return runlog.runs(_log(spark, sf)).drop("started_at", "completed_at")


@query(
    "latest_run",
    _RUNS
    + """SELECT batch_id, status, rows_extracted, rows_loaded, rows_skipped, error_msg, duration_secs
FROM r WHERE workflow_nme = 'purchase' ORDER BY ts DESC LIMIT 1""",
)
def latest_run(spark, sf):
    return runlog.latest_run(_log(spark, sf), "purchase").drop(
        "workflow_nme", "started_at", "completed_at"
    )


@query(
    "run_totals",
    """SELECT count(*) AS rows_extracted, count(*) FILTER (k IS NULL OR k = 0) AS rows_loaded,
  count(*) FILTER (k <> 0) AS rows_skipped FROM (SELECT CASE WHEN event_type <> 'view' THEN
  CAST(json_extract(props, '$.k') AS INT) % 3 END AS k FROM events)""",
)
def run_totals(spark, sf):
    code = F.when(
        F.col("event_type") != "view", F.get_json_object("props", "$.k").cast("int") % 3
    )
    return runlog.run_totals(frames.table(spark, sf, "events"), code)
