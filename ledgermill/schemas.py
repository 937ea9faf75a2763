"""Row shapes of the landing, core, reference and control layers (Spark DDL)."""

from __future__ import annotations

# Status and type vocabularies.
REVIEW_STATUSES = (
    "PENDING",
    "NEEDS_REVIEW",
    "AUTO_CONFIRMED",
    "AUTO_REJECTED",
    "CONFIRMED",
    "REJECTED",
)
REVIEWED = ("CONFIRMED", "REJECTED")
SOURCE_TYPES = ("GMAIL", "FOLDER", "MANUAL")
RUN_STATUSES = ("STARTED", "SUCCESS", "FAILED", "PARTIAL")
ACCOUNT_TYPES = (
    "TRANSACTION",
    "SAVINGS",
    "CREDIT_CARD",
    "MORTGAGE",
    "INVESTMENT",
    "SUPER",
    "OTHER",
)
TRADE_TYPES = ("BUY", "SELL", "DIVIDEND", "SPLIT", "OTHER")

LINE_ITEMS = (
    "ARRAY<STRUCT<description: STRING, period: STRING, quantity: STRING, "
    "unit: STRING, rate: STRING, amount: STRING>>"
)

# Scalars arrive as text because the producer is not trusted; casts come later.
CLASSIFICATION = (
    "STRUCT<is_tax_relevant: STRING, category: STRING, fy_year: STRING, "
    "is_deductible: STRING, deductible_amount: STRING, total_amount: STRING, "
    "confidence: STRING, document_type: STRING, document_date: STRING, summary: STRING, "
    "billing_period_start: STRING, billing_period_end: STRING, supplier_name: STRING, "
    f"supply_address: STRING, account_reference: STRING, line_items: {LINE_ITEMS}>"
)

LANDING_DOCUMENTS = (
    "landing_id BIGINT, batch_id BIGINT, source_type STRING, source_id STRING, "
    "subject STRING, sender_email STRING, received_at TIMESTAMP, file_name STRING, "
    "file_ext STRING, file_size_bytes BIGINT, content_preview STRING, raw_json STRING, "
    "loaded_at TIMESTAMP, is_processed BOOLEAN"
)

CORE_DOCUMENTS = (
    "doc_id BIGINT, source_type STRING, source_id STRING, subject STRING, "
    "sender_email STRING, received_at TIMESTAMP, fy_year SMALLINT, file_name STRING, "
    "file_ext STRING, file_size_bytes BIGINT, content_preview STRING, "
    "tax_category_id INT, is_deductible BOOLEAN, deductible_amount DECIMAL(10,2), "
    "confidence_score DECIMAL(4,3), classification_model STRING, review_status STRING, "
    "reviewer_notes STRING, batch_id BIGINT, supplier_name STRING, account_ref STRING, "
    "supply_address STRING, document_date DATE, billing_start DATE, billing_end DATE, "
    "total_amount DECIMAL(12,2), gst_amount DECIMAL(12,2), filed_path STRING, "
    f"line_items {LINE_ITEMS}, reviewed_at TIMESTAMP, created_at TIMESTAMP, "
    "updated_at TIMESTAMP"
)

LANDING_TRANSACTIONS = (
    "source_file STRING, provider STRING, account_id INT, row_num INT, "
    "txn_date_raw STRING, amount_raw STRING, debit_raw STRING, credit_raw STRING, "
    "balance_raw STRING, description_raw STRING, raw_json STRING"
)

CORE_TRANSACTIONS = (
    "txn_id BIGINT, account_id INT, txn_date DATE, amount DECIMAL(12,2), "
    "description_raw STRING, description_clean STRING, category_id INT, "
    "subcategory STRING, is_deductible BOOLEAN, deductible_amount DECIMAL(10,2), "
    "confidence_score DECIMAL(4,3), classification_model STRING, is_anomaly BOOLEAN, "
    "anomaly_reason STRING, review_status STRING, source_file STRING, dedup_hash STRING, "
    "batch_id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"
)

CORE_TRADES = (
    "trade_id BIGINT, account_id INT, trade_date DATE, security_code STRING, "
    "security_name STRING, quantity DECIMAL(15,4), price DECIMAL(12,4), "
    "value DECIMAL(15,2), trade_type STRING, brokerage DECIMAL(10,2), "
    "cost_base DECIMAL(15,2), cgt_event BOOLEAN, fy_year SMALLINT, dedup_hash STRING, "
    "source_file STRING, batch_id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"
)

RUN_LOG = (
    "batch_id STRING, workflow_nme STRING, script_nme STRING, status STRING, "
    "rows_extracted BIGINT, rows_loaded BIGINT, rows_skipped BIGINT, error_msg STRING, "
    "logged_at TIMESTAMP"
)

# Levels of MIME parts read by one pass; what lies deeper is read by further passes.
MIME_DEPTH = 4


def message_part(depth: int) -> str:
    """MIME part unrolled to ``depth`` levels; anything deeper stays raw text."""
    parts = "STRING" if depth == 0 else f"ARRAY<{message_part(depth - 1)}>"
    return (
        "STRUCT<mimeType: STRING, filename: STRING, "
        "headers: ARRAY<STRUCT<name: STRING, value: STRING>>, "
        "body: STRUCT<attachmentId: STRING, data: STRING, size: BIGINT>, "
        f"parts: {parts}>"
    )


MESSAGE = (
    "id STRING, internalDate STRING, snippet STRING, " f"payload {message_part(MIME_DEPTH)}"
)
