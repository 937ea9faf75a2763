"""Mart views, portal cards and health reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.operators import checklist, health
from ledgermill.plans import frames, marts, portal
from ledgermill.plans.frames import with_frames
from ledgermill.plans.registry import query

_FY_OF = "CASE WHEN month({d}) >= 7 THEN year({d}) + 1 ELSE year({d}) END"


def _fy(column: str) -> str:
    return _FY_OF.format(d=column)


@query(
    "fy_cashflow",
    with_frames("txn", "cats", "order_fy")
    + f""", t AS (SELECT *, {_fy('txn_date')} AS fy FROM txn)
SELECT CAST(t.fy AS BIGINT) AS fy_year, f.fy_label,
  CAST(coalesce(sum(t.amount) FILTER (c.is_income), 0) AS DOUBLE) AS total_income,
  CAST(coalesce(sum(abs(t.amount)) FILTER (NOT c.is_income), 0) AS DOUBLE) AS total_spend,
  CAST(coalesce(sum(t.deductible_amount) FILTER (t.is_deductible), 0) AS DOUBLE) AS total_deductible
FROM t LEFT JOIN cats c USING (category_id) LEFT JOIN order_fy f ON f.fy_year = t.fy
GROUP BY t.fy, f.fy_label""",
)
def fy_cashflow(spark, sf):
    return marts.vw_fy_cashflow(
        frames.transactions(spark, sf), frames.spending_categories(spark, sf), frames.order_fy(spark)
    )


@query(
    "monthly_spending",
    with_frames("txn", "acct", "cats", "budget")
    + f"""SELECT t.account_id, a.account_nme, a.provider,
  CAST(CAST(date_trunc('month', t.txn_date) AS DATE) AS VARCHAR) AS month_start,
  strftime(t.txn_date, '%Y-%m') AS month_label, year(t.txn_date) AS txn_year,
  month(t.txn_date) AS txn_month, c.category_nme, c.subcategory_nme, c.is_income, c.is_deductible,
  CAST(b.budget_amount AS DOUBLE) AS budget_amount,
  CAST(sum(t.amount) AS DOUBLE) AS total_amount, count(*) AS txn_count
FROM txn t JOIN acct a USING (account_id) LEFT JOIN cats c USING (category_id)
LEFT JOIN budget b ON b.category_id = t.category_id AND b.fy_year = {_fy('t.txn_date')}
  AND b.month_num = month(t.txn_date)
GROUP BY ALL""",
)
def monthly_spending(spark, sf):
    return marts.vw_monthly_spending(
        frames.transactions(spark, sf),
        frames.accounts(spark, sf),
        frames.spending_categories(spark, sf),
        frames.budgets(spark, sf),
    )


@query(
    "spending_by_category",
    with_frames("txn", "cats")
    + """SELECT c.category_nme, c.subcategory_nme, c.is_income, c.is_deductible, count(*) AS txn_count,
  CAST(sum(t.amount) AS DOUBLE) AS total_amount,
  CAST(sum(t.amount) AS DOUBLE) / count(*) AS avg_amount,
  CAST(min(t.txn_date) AS VARCHAR) AS first_txn_date, CAST(max(t.txn_date) AS VARCHAR) AS last_txn_date
FROM txn t LEFT JOIN cats c USING (category_id) GROUP BY ALL""",
)
def spending_by_category(spark, sf):
    return marts.vw_spending_by_category(
        frames.transactions(spark, sf), frames.spending_categories(spark, sf)
    )


_SAVINGS = (
    with_frames("txn", "cats")
    + """, m AS (SELECT CAST(date_trunc('month', t.txn_date) AS DATE) AS month_start,
  coalesce(sum(t.amount) FILTER (c.is_income), 0) AS inc,
  coalesce(sum(abs(t.amount)) FILTER (NOT c.is_income), 0) AS spend
  FROM txn t LEFT JOIN cats c USING (category_id) GROUP BY 1),
s AS (SELECT month_start, inc, spend, inc - spend AS net, CASE WHEN inc > 0 THEN
  round(CAST(inc - spend AS DOUBLE) / CAST(inc AS DOUBLE) * 100, 1) END AS rate FROM m)
"""
)


@query(
    "savings_rate",
    _SAVINGS
    + """SELECT strftime(month_start, '%Y-%m') AS month_label, CAST(month_start AS VARCHAR) AS month_start,
  CAST(inc AS DOUBLE) AS total_income, CAST(spend AS DOUBLE) AS total_spend,
  CAST(net AS DOUBLE) AS net_savings, rate AS savings_rate_pct FROM s""",
)
def savings_rate(spark, sf):
    return marts.vw_savings_rate(
        frames.transactions(spark, sf), frames.spending_categories(spark, sf)
    )


@query(
    "anomaly_list",
    with_frames("txn", "acct", "cats")
    + """SELECT t.txn_id, t.account_id, a.account_nme, a.provider, CAST(t.txn_date AS VARCHAR) AS txn_date,
  CAST(t.amount AS DOUBLE) AS amount, t.description_raw AS description_clean, t.description_raw,
  c.category_nme, c.subcategory_nme, 'large amount' AS anomaly_reason,
  CASE t.o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'PENDING' ELSE 'NEEDS_REVIEW' END
    AS review_status, CAST(CAST(t.o_orderdate AS TIMESTAMP) AS VARCHAR) AS created_at
FROM txn t JOIN acct a USING (account_id) LEFT JOIN cats c USING (category_id) WHERE t.is_anomaly""",
)
def anomaly_list(spark, sf):
    return marts.vw_anomalies(
        frames.transactions(spark, sf),
        frames.accounts(spark, sf),
        frames.spending_categories(spark, sf),
    )


_ENRICHED_COLUMNS = """d.doc_id, d.source_type, d.subject, d.sender_email,
  CAST(d.received_at AS VARCHAR) AS received_at, f.fy_label, CAST(f.fy_year AS BIGINT) AS fy_year,
  c.category_nme AS tax_category, c.category_grp AS tax_category_group, c.ato_reference,
  d.is_deductible, CAST(d.deductible_amount AS DOUBLE) AS deductible_amount,
  CAST(d.confidence_score AS DOUBLE) AS confidence_score, d.review_status, d.reviewer_notes,
  d.file_name, d.file_ext, d.content_preview, CAST(d.created_at AS VARCHAR) AS created_at,
  CAST(d.updated_at AS VARCHAR) AS updated_at"""
_ENRICHED = f"""SELECT {_ENRICHED_COLUMNS} FROM docs d LEFT JOIN doc_fy f ON d.fy_year = f.fy_year
LEFT JOIN tax_cats c ON c.category_id = d.tax_category_id"""


def _doc_tables(spark, sf):
    return frames.core_documents(spark, sf), frames.doc_fy(spark), seeds.tax_categories(spark)


@query("doc_enriched", with_frames("docs", "doc_fy", "tax_cats") + _ENRICHED)
def doc_enriched(spark, sf):
    return marts.vw_tax_documents(*_doc_tables(spark, sf))


@query(
    "doc_enriched_accepted",
    with_frames("docs", "doc_fy", "tax_cats")
    + _ENRICHED
    + " WHERE d.review_status IS DISTINCT FROM 'AUTO_REJECTED'",
)
def doc_enriched_accepted(spark, sf):
    return marts.vw_tax_documents(*_doc_tables(spark, sf), include_rejected=False)


@query(
    "doc_summary",
    with_frames("docs", "doc_fy", "tax_cats")
    + """SELECT f.fy_label, CAST(f.fy_year AS BIGINT) AS fy_year, c.category_grp AS tax_category_group,
  c.category_nme AS tax_category, c.ato_reference, CAST(c.sort_order AS BIGINT) AS sort_order,
  count(*) AS document_count, CAST(sum(d.deductible_amount) AS DOUBLE) AS total_deductible_amt,
  CAST(min(d.received_at) AS VARCHAR) AS earliest_doc, CAST(max(d.received_at) AS VARCHAR) AS latest_doc
FROM docs d JOIN doc_fy f ON d.fy_year = f.fy_year JOIN tax_cats c ON c.category_id = d.tax_category_id
WHERE d.is_deductible AND d.review_status IN ('PENDING', 'CONFIRMED')
GROUP BY f.fy_label, f.fy_year, c.category_grp, c.category_nme, c.ato_reference, c.sort_order""",
)
def doc_summary(spark, sf):
    return marts.vw_tax_summary(*_doc_tables(spark, sf))


# --- checklist views ---------------------------------------------------------

# Answers derived from the label table: every labelled document answers one item.
_ITEM_COUNT = 53


def _responses(spark, sf):
    """Answers per item and year, derived from the labels."""
    items = seeds.checklist_items(spark).select("item_id")
    answers = (
        frames.table(spark, sf, "labels")
        .selectExpr(
            "CASE WHEN doc_id % 53 < 32 THEN 1 + doc_id % 53 ELSE 68 + doc_id % 53 END AS slot",
            "CAST(2024 + doc_id % 2 AS SMALLINT) AS fy_year",
            "CASE WHEN quality = 1 THEN 'YES' ELSE 'NO' END AS answer",
            "doc_id",
        )
        .groupBy("slot", "fy_year")
        .agg(F.max("answer").alias("is_applicable"), F.max("doc_id").alias("value"))
    )
    return answers.join(items, F.col("slot") == F.col("item_id")).select(
        "item_id",
        "fy_year",
        "is_applicable",
        F.col("value").cast("string").alias("response_value"),
        F.lit(None).cast("timestamp").alias("responded_at"),
        F.lit("EMAIL").alias("source"),
    )


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _items_sql() -> str:
    questions = dict(seeds.rows_of(seeds.CHECKLIST_QUESTIONS))
    rows = []
    for i, section, name, about, required, group, category, order in seeds.rows_of(
        seeds.CHECKLIST_DOCUMENTS
    ):
        rows.append(
            f"({i}, {_quoted(section)}, {_quoted(name)}, {_quoted(about)}, 'DOCUMENT', {required}, "
            f"{_quoted(group)}, {_quoted(questions.get(group))}, {category}, NULL, {order})"
        )
    for i, section, name, about, kind, order in seeds.rows_of(seeds.CHECKLIST_ANSWERS):
        rows.append(
            f"({i}, {_quoted(section)}, {_quoted(name)}, {_quoted(about)}, 'RESPONSE', false, "
            f"NULL, NULL, NULL, {_quoted(kind)}, {order})"
        )
    return (
        "items AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") v(item_id, section, item_name, "
        "description, item_type, always_required, applicability_group, applicability_question, "
        "category_id, response_format, sort_order))"
    )


ITEMS_SQL = _items_sql()
RESPONSES_SQL = """responses AS (SELECT i.item_id, a.fy_year, a.is_applicable, a.value FROM (
  SELECT CASE WHEN doc_id % 53 < 32 THEN 1 + doc_id % 53 ELSE 68 + doc_id % 53 END AS slot,
    2024 + doc_id % 2 AS fy_year, max(CASE WHEN quality = 1 THEN 'YES' ELSE 'NO' END) AS is_applicable,
    max(doc_id) AS value FROM labels GROUP BY 1, 2) a JOIN items i ON i.item_id = a.slot)"""
_COMPLETENESS = (
    with_frames("docs", "tax_cats")
    + f", {ITEMS_SQL}, {RESPONSES_SQL}"
    + """, n AS (SELECT tax_category_id, fy_year, count(*) AS doc_count FROM docs
  WHERE review_status IN ('CONFIRMED', 'AUTO_CONFIRMED') GROUP BY ALL),
j AS (SELECT i.*, c.category_nme, c.category_grp, c.is_deductible, r.fy_year, r.is_applicable,
    r.value, coalesce(n.doc_count, 0) AS doc_count,
    i.always_required OR coalesce(r.is_applicable = 'YES', false) AS required
  FROM items i LEFT JOIN responses r ON r.item_id = i.item_id
  LEFT JOIN tax_cats c ON c.category_id = i.category_id
  LEFT JOIN n ON n.tax_category_id = i.category_id AND n.fy_year = r.fy_year),
v AS (SELECT *, CASE WHEN item_type = 'RESPONSE' THEN 'N/A'
    WHEN required AND doc_count > 0 THEN 'SATISFIED' WHEN required THEN 'MISSING'
    WHEN is_applicable = 'NO' THEN 'NOT_APPLICABLE' ELSE 'UNKNOWN' END AS status,
    item_type = 'DOCUMENT' AND required AS in_scope FROM j)
"""
)


def _completeness(spark, sf):
    return marts.vw_checklist_completeness(
        seeds.checklist_items(spark),
        _responses(spark, sf),
        seeds.tax_categories(spark),
        frames.core_documents(spark, sf),
    )


@query(
    "checklist_status",
    _COMPLETENESS
    + """SELECT CAST(item_id AS BIGINT) AS item_id, section, item_name, description, item_type,
  always_required, applicability_group, applicability_question, category_nme, category_grp,
  is_deductible, CAST(fy_year AS BIGINT) AS fy_year, is_applicable,
  CAST(value AS VARCHAR) AS response_value, CAST(NULL AS VARCHAR) AS responded_at, doc_count, status,
  in_scope FROM v""",
)
def checklist_status(spark, sf):
    return _completeness(spark, sf)


_PCT = (
    "SELECT coalesce(section, 'ALL') AS section, count(*) FILTER (status = 'SATISFIED') AS satisfied, "
    "count(*) AS applicable, round(CAST(count(*) FILTER (status = 'SATISFIED') * 100 AS DOUBLE) "
    "/ count(*), 1) AS pct_complete FROM v WHERE in_scope AND fy_year = 2025 GROUP BY ROLLUP (section)"
)


@query(
    "checklist_pct",
    _COMPLETENESS
    + f"""SELECT *, CASE WHEN pct_complete < 50 THEN 'red' WHEN pct_complete < 80 THEN 'amber'
  ELSE 'green' END AS colour FROM ({_PCT})""",
)
def checklist_pct(spark, sf):
    return checklist.percent_complete(_completeness(spark, sf).filter("fy_year = 2025"))


@query(
    "days_outstanding",
    _COMPLETENESS
    + """SELECT CAST(item_id AS BIGINT) AS item_id, item_name, section, CAST(fy_year AS BIGINT) AS fy_year,
  DATE '2025-03-31' - make_date(CAST(fy_year AS INT) - 1, 7, 1) AS days_since_fy_start
FROM v WHERE in_scope AND status = 'MISSING'""",
)
def days_outstanding(spark, sf):
    return checklist.outstanding_items(_completeness(spark, sf), F.lit("2025-03-31").cast("date"))


@query(
    "checklist_responses",
    _COMPLETENESS
    + """SELECT CAST(item_id AS BIGINT) AS item_id, item_name, CAST(fy_year AS BIGINT) AS fy_year,
  CAST(value AS VARCHAR) AS response_value FROM v WHERE item_type = 'RESPONSE' AND value IS NOT NULL""",
)
def checklist_response_values(spark, sf):
    return checklist.response_values(_completeness(spark, sf))


@query(
    "wfh_deduction",
    f"WITH {ITEMS_SQL}, {RESPONSES_SQL}"
    + """, w AS (SELECT fy_year,
  coalesce(sum(value) FILTER (item_id = 110), 0) AS h, coalesce(sum(value) FILTER (item_id = 111), 0) AS ic,
  coalesce(sum(value) FILTER (item_id = 112), 0) AS ip, coalesce(sum(value) FILTER (item_id = 113), 0) AS mc,
  coalesce(sum(value) FILTER (item_id = 114), 0) AS mp
  FROM responses WHERE item_id BETWEEN 110 AND 114 GROUP BY fy_year)
SELECT CAST(fy_year AS BIGINT) AS fy_year, CAST(h AS DOUBLE) AS hours,
  CAST(h * 70 AS DOUBLE) / 100 AS fixed_rate_amount,
  CAST((ic * ip + mc * mp) * 12 AS DOUBLE) / 100 AS actual_cost_amount FROM w""",
)
def wfh(spark, sf):
    return checklist.wfh_deduction(_responses(spark, sf))


# --- utility bills -----------------------------------------------------------

_BILLS = (
    with_frames("bill", "order_fy", "tax_cats")
    + """, u AS (SELECT b.*, f.fy_label, f.fy_year AS fy, c.category_nme FROM bill b
  JOIN tax_cats c ON c.category_id = b.tax_category_id LEFT JOIN order_fy f ON f.fy_year = b.fy_year
  WHERE c.category_nme IN ('Work From Home — Electricity/Gas', 'Work From Home — Internet')),
li AS (SELECT u.*, x.* FROM u, LATERAL (VALUES
  (1, 'Peak Usage', CAST(u.total_amount AS DOUBLE), 'kWh', CAST(u.total_amount AS DOUBLE)),
  (2, 'Solar Feed-In Credit', NULL, 'kWh', CAST(-u.total_amount AS DOUBLE)),
  (3, 'Daily Supply Charge', 31.0, 'days', 29.39)) x(line_num, description, quantity, unit, amount)
  WHERE u.o_orderkey % 7 > 2)
"""
)


def _bill_tables(spark, sf):
    return frames.bills(spark, sf), frames.order_fy(spark), seeds.tax_categories(spark)


@query(
    "utility_bills",
    _BILLS
    + """SELECT doc_id, source_id, supplier_name, account_ref, CAST(billing_start AS VARCHAR) AS billing_start,
  CAST(last_day(billing_start) AS VARCHAR) AS billing_end, CAST(document_date AS VARCHAR) AS document_date,
  CAST(total_amount AS DOUBLE) AS total_amount, category_nme, fy_label, CAST(fy AS BIGINT) AS fy_year,
  review_status, CAST(confidence_score AS DOUBLE) AS confidence_score,
  CASE WHEN o_orderkey % 7 > 2 THEN 3 ELSE 0 END AS items FROM u""",
)
def utility_bills(spark, sf):
    return (
        marts.vw_utility_bills(*_bill_tables(spark, sf))
        .withColumn("items", F.size("line_items"))
        .drop("line_items", "subject", "supply_address", "gst_amount", "filed_path", "created_at")
    )


@query(
    "bill_line_items",
    _BILLS
    + """SELECT doc_id, supplier_name, account_ref, CAST(billing_start AS VARCHAR) AS billing_start,
  fy_label, CAST(fy AS BIGINT) AS fy_year, category_nme, CAST(line_num AS BIGINT) AS line_num,
  description, CAST(NULL AS VARCHAR) AS period, quantity, unit, CAST(0.25 AS DOUBLE) AS rate, amount,
  review_status FROM li""",
)
def bill_line_items(spark, sf):
    return marts.vw_utility_line_items(*_bill_tables(spark, sf)).drop(
        "supply_address", "billing_end", "created_at"
    )


@query(
    "energy_monthly",
    _BILLS
    + """SELECT CAST(billing_start AS VARCHAR) AS month_start,
  CAST(coalesce(sum(CAST(quantity AS DECIMAL(18,4))) FILTER (description ILIKE '%peak%'), 0) AS DOUBLE) AS peak_kwh,
  CAST(coalesce(sum(CAST(amount AS DECIMAL(18,4))) FILTER (description ILIKE '%solar%'), 0) AS DOUBLE) AS solar_credit,
  CAST(coalesce(sum(CAST(amount AS DECIMAL(18,4))) FILTER (description ILIKE '%daily%'), 0) AS DOUBLE) AS daily_charge,
  count(*) AS lines FROM li WHERE billing_start IS NOT NULL GROUP BY billing_start""",
)
def energy_monthly(spark, sf):
    return health.energy_monthly(
        marts.vw_utility_line_items(*_bill_tables(spark, sf), ordered=False)
    )


@query(
    "bill_details",
    with_frames("bill")
    + """SELECT doc_id, supplier_name AS provider_nme, account_ref AS account_number,
  CAST(billing_start AS VARCHAR) AS billing_period_start,
  CAST(last_day(billing_start) AS VARCHAR) AS billing_period_end,
  CAST(total_amount AS DOUBLE) AS total_amount, 3 AS items, 'rules' AS extracted_by,
  CAST(confidence_score AS DOUBLE) AS extraction_confidence, confidence_score < 0.75 AS needs_review
FROM bill WHERE o_orderkey % 7 > 2""",
)
def bill_details(spark, sf):
    from ledgermill.operators.classify import bill_details as details

    return details(frames.bills(spark, sf)).withColumn("items", F.size("line_items")).drop(
        "line_items"
    )


# --- portal ------------------------------------------------------------------


@query(
    "home_cards",
    with_frames("docs")
    + """SELECT count(*) FILTER (review_status = 'NEEDS_REVIEW') AS awaiting_review,
  CAST(sum(total_amount) FILTER (review_status = 'CONFIRMED' AND fy_year = 2025) AS DOUBLE) AS confirmed_total,
  count(*) FILTER (review_status = 'CONFIRMED' AND fy_year = 2025) AS confirmed_records FROM docs""",
)
def home_cards(spark, sf):
    return portal.home_cards(frames.core_documents(spark, sf), 2025)


@query(
    "records_by_status",
    with_frames("docs") + "SELECT review_status, count(*) AS records FROM docs GROUP BY ALL",
)
def records_by_status(spark, sf):
    return portal.records_by_status(frames.core_documents(spark, sf))


@query(
    "yoy",
    with_frames("docs")
    + """, y AS (SELECT fy_year, sum(total_amount) AS total, count(*) AS n,
  count(DISTINCT tax_category_id) AS k FROM docs
  WHERE review_status = 'CONFIRMED' AND fy_year IS NOT NULL GROUP BY fy_year)
SELECT CAST(fy_year AS BIGINT) AS fy_year, CAST(total AS DOUBLE) AS total_amount, n AS record_count,
  k AS categories_covered, CAST(lag(total) OVER (ORDER BY fy_year) AS DOUBLE) AS previous_total,
  CAST(total - lag(total) OVER (ORDER BY fy_year) AS DOUBLE) AS yoy_change FROM y""",
)
def yoy(spark, sf):
    return portal.fy_pack(frames.core_documents(spark, sf))


@query(
    "investment_docs",
    with_frames("docs", "doc_fy", "tax_cats")
    + f"""SELECT * FROM ({_ENRICHED}) WHERE tax_category_group = 'Income' OR tax_category IN
  ('Share Sale / CGT Event', 'Dividend Statement', 'Property Depreciation Schedule')""",
)
def investment_docs(spark, sf):
    return portal.investment_documents(marts.vw_tax_documents(*_doc_tables(spark, sf)))


@query(
    "tax_report",
    _COMPLETENESS.rstrip()
    + """, f(fy_year) AS (VALUES (2023), (2024), (2025), (2026)),
w AS (SELECT coalesce(sum(value) FILTER (item_id = 110), 0) AS h,
  coalesce(sum(value) FILTER (item_id = 111), 0) * coalesce(sum(value) FILTER (item_id = 112), 0)
  + coalesce(sum(value) FILTER (item_id = 113), 0) * coalesce(sum(value) FILTER (item_id = 114), 0) AS c
  FROM responses WHERE fy_year = 2025 AND item_id BETWEEN 110 AND 114 HAVING count(*) > 0)
SELECT '1 deductions' AS section, c.category_nme AS label, count(*) AS document_count,
  CAST(sum(d.deductible_amount) AS DOUBLE) AS amount
FROM docs d JOIN tax_cats c ON c.category_id = d.tax_category_id
WHERE d.fy_year = 2025 AND d.is_deductible AND d.review_status IN ('PENDING', 'CONFIRMED') GROUP BY ALL
UNION ALL SELECT '2 income', c.category_nme, count(*), NULL FROM docs d
JOIN tax_cats c ON c.category_id = d.tax_category_id
WHERE d.fy_year = 2025 AND c.category_grp = 'Income' GROUP BY ALL
UNION ALL SELECT '3 inventory', review_status, count(*), NULL FROM docs WHERE fy_year = 2025 GROUP BY ALL
UNION ALL SELECT '4 work from home', 'fixed rate', NULL, CAST(h * 70 AS DOUBLE) / 100 FROM w
UNION ALL SELECT '4 work from home', 'actual cost', NULL, CAST(c * 12 AS DOUBLE) / 100 FROM w""",
)
def tax_report(spark, sf):
    core, fy, categories = _doc_tables(spark, sf)
    return portal.tax_report(
        marts.vw_tax_summary(core, fy, categories),
        marts.vw_tax_documents(core, fy, categories),
        checklist.wfh_deduction(_responses(spark, sf)),
        2025,
    )


# --- health ------------------------------------------------------------------

_MONTHLY = """, m AS (SELECT category_id, CAST(date_trunc('month', txn_date) AS DATE) AS month_start,
  sum(-amount) AS actual FROM txn WHERE category_id IS NOT NULL GROUP BY 1, 2),
d AS (SELECT category_id, round(CAST(sum(actual) AS DOUBLE) / count(*), 2) AS derived FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY month_start) AS n FROM m)
  WHERE n <= 3 GROUP BY 1)
"""


@query(
    "budget_vs_actual",
    with_frames("txn", "budget")
    + _MONTHLY
    + f"""SELECT CAST(m.category_id AS BIGINT) AS category_id, CAST(m.month_start AS VARCHAR) AS month_start,
  CAST(m.actual AS DOUBLE) AS actual_amount,
  coalesce(CAST(b.budget_amount AS DOUBLE), d.derived) AS budget_amount,
  CASE WHEN b.budget_amount IS NULL THEN 'DERIVED' ELSE 'SET' END AS budget_source,
  CAST(coalesce(b.budget_amount, CAST(d.derived AS DECIMAL(22,2))) - m.actual AS DOUBLE) AS difference
FROM m JOIN d USING (category_id) LEFT JOIN budget b ON b.category_id = m.category_id
  AND b.fy_year = {_fy('m.month_start')} AND b.month_num = month(m.month_start)""",
)
def budget_vs_actual(spark, sf):
    return health.budget_vs_actual(frames.transactions(spark, sf), frames.budgets(spark, sf))


@query(
    "category_outliers",
    with_frames("txn", "cats")
    + """, p AS (SELECT category_id, date_trunc('month', txn_date) AS mon, count(*) AS n,
  sum(abs(amount)) AS s, sum(CAST(abs(amount) AS DECIMAL(18,2)) * CAST(abs(amount) AS DECIMAL(18,2))) AS ss
  FROM txn GROUP BY 1, 2),
q AS (SELECT category_id, sum(n) AS n, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(ss) AS DOUBLE) AS ss,
  count(*) AS months FROM p JOIN cats USING (category_id) GROUP BY 1),
b AS (SELECT category_id, s / n AS mean, sqrt(greatest((ss - s * s / n) / (n - 1), 0)) AS std
  FROM q WHERE months >= 3 AND n > 1)
SELECT t.txn_id, t.account_id, CAST(t.category_id AS BIGINT) AS category_id, CAST(t.amount AS DOUBLE) AS amount,
  'amount is more than 1.7 standard deviations from its category mean' AS anomaly_reason
FROM txn t JOIN b USING (category_id)
WHERE b.std > 0 AND abs((CAST(abs(t.amount) AS DOUBLE) - b.mean) / b.std) > 1.7""",
)
def category_outliers(spark, sf):
    flagged = health.detect_anomalies(
        frames.transactions(spark, sf), frames.spending_categories(spark, sf), z_limit=1.7
    )
    return flagged.filter("is_anomaly").select(
        "txn_id", "account_id", "category_id", "amount", "anomaly_reason"
    )


@query(
    "savings_trend",
    _SAVINGS
    + """SELECT strftime(month_start, '%Y-%m') AS month_label, CAST(month_start AS VARCHAR) AS month_start,
  rate AS savings_rate_pct,
  CAST(CAST(rate AS DECIMAL(18,1)) - lag(CAST(rate AS DECIMAL(18,1))) OVER (ORDER BY month_start) AS DOUBLE) AS rate_change,
  CAST(sum(net) OVER w AS DOUBLE) AS rolling_net,
  round(sum(rate) OVER w / count(rate) OVER w, 2) AS rolling_rate
FROM s WINDOW w AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def savings_trend(spark, sf):
    return health.savings_trend(
        marts.vw_savings_rate(frames.transactions(spark, sf), frames.spending_categories(spark, sf))
    )


@query(
    "missing_months",
    with_frames("txn", "acct")
    + """, w AS (SELECT account_id, account_nme, unnest([DATE '2001-04-01', DATE '2001-05-01', DATE '2001-06-01'])
  AS month_start FROM acct WHERE is_active)
SELECT account_id, account_nme, CAST(month_start AS VARCHAR) AS month_start FROM w
WHERE NOT EXISTS (SELECT 1 FROM txn t WHERE t.account_id = w.account_id
  AND date_trunc('month', t.txn_date) = w.month_start)""",
)
def missing_months(spark, sf):
    return health.missing_statements(
        frames.accounts(spark, sf),
        frames.transactions(spark, sf),
        F.lit("2001-07-15").cast("date"),
    )


@query(
    "net_position",
    with_frames("txn", "acct")
    + """, b AS (SELECT account_id, arg_max(amount, (txn_date, txn_id)) AS balance FROM txn GROUP BY 1)
SELECT coalesce(account_type, 'NET WORTH') AS account_type,
  CAST(sum(CASE WHEN account_type IN ('CREDIT_CARD', 'MORTGAGE') THEN -abs(b.balance) ELSE b.balance END)
  AS DOUBLE) AS net_amount, count(*) AS accounts
FROM acct JOIN b USING (account_id) GROUP BY ROLLUP (account_type)""",
)
def net_position(spark, sf):
    balances = frames.transactions(spark, sf).select(
        "account_id", F.col("amount").alias("balance"), F.col("txn_date").alias("as_of"),
        F.col("txn_id").alias("seq"),
    )
    return health.net_position(frames.accounts(spark, sf).drop("balance"), balances)


@query(
    "trade_running",
    with_frames("trade")
    + f""", d AS (SELECT security_code, trade_date,
  sum(CASE trade_type WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity ELSE 0 END) AS q,
  coalesce(sum(cost_base), 0) AS c, sum(brokerage) AS b, coalesce(sum(value) FILTER (cgt_event), 0) AS p,
  count(*) FILTER (cgt_event) AS n FROM trade GROUP BY 1, 2)
SELECT security_code, CAST(trade_date AS VARCHAR) AS trade_date, CAST({_fy('trade_date')} AS BIGINT) AS fy_year,
  n AS cgt_events, CAST(sum(q) OVER w AS DOUBLE) AS quantity_held, CAST(sum(c) OVER w AS DOUBLE) AS cost_base,
  CAST(sum(b) OVER w AS DOUBLE) AS brokerage, CAST(sum(p) OVER w AS DOUBLE) AS proceeds
FROM d WINDOW w AS (PARTITION BY security_code ORDER BY trade_date)""",
)
def trade_running(spark, sf):
    return health.trade_positions(frames.trades(spark, sf))


_TRADE_ORDER = "order_no, line_no, account_id, quantity, value, trade_type, brokerage"


@query(
    "trade_running_rows",
    with_frames("trade").replace("SELECT l_orderkey AS order_no", "SELECT l_suppkey AS account_id, l_orderkey AS order_no")
    + f"""SELECT order_no, line_no, security_code, CAST(trade_date AS VARCHAR) AS trade_date, trade_type,
  CAST(quantity AS DOUBLE) AS quantity, CAST(sum(CASE trade_type WHEN 'BUY' THEN quantity
  WHEN 'SELL' THEN -quantity ELSE 0 END) OVER (PARTITION BY security_code ORDER BY trade_date, {_TRADE_ORDER}
  ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS quantity_held FROM trade""",
)
def trade_running_rows(spark, sf):
    block = F.floor(F.col("order_no") / 1000)
    rows = health.running_trades(frames.trades(spark, sf), _TRADE_ORDER.split(", "), block)
    return rows.select(
        "order_no", "line_no", "security_code", "trade_date", "trade_type", "quantity",
        "quantity_held",
    )


_DEBTS = """, d AS (SELECT account_id, CAST(-balance AS DOUBLE) AS bal, 0.12 / 12 AS r, 50.0 AS pay
  FROM acct WHERE balance < 0),
m AS (SELECT *, CAST(ceil(-ln(1 - bal * r / pay) / ln(1 + r)) AS INT) AS months FROM d WHERE bal * r < pay)
"""


@query(
    "payoff_schedule",
    with_frames("acct")
    + _DEBTS
    + """SELECT account_id, CAST(months AS BIGINT) AS months, CAST(k AS BIGINT) AS month_no,
  floor((greatest(bal * pow(1 + r, k) - pay * (pow(1 + r, k) - 1) / r, 0) + 1e-9) * 100 + 0.5) / 100 AS balance_after
FROM (SELECT *, unnest(range(1, months + 1)) AS k FROM m)""",
)
def payoff_schedule(spark, sf):
    debts = frames.accounts(spark, sf).filter("balance < 0").select(
        "account_id",
        (-F.col("balance")).alias("balance"),
        F.lit("0.12").cast("decimal(5,4)").alias("annual_rate"),
        F.lit("50.00").cast("decimal(12,2)").alias("payment"),
    )
    return health.payoff_schedule(debts)
