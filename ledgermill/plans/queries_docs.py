"""Landing, merge and classification queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions import calendar, crypto, text, values
from ledgermill.operators import archive, classify, landing, merge, transactions
from ledgermill.operators.buckets import BucketedLog
from ledgermill.plans import frames
from ledgermill.plans.frames import with_frames
from ledgermill.plans.registry import query
from ledgermill.schemas import CLASSIFICATION, LANDING_DOCUMENTS
from ledgermill.session import scratch_dir
from ledgermill.sources import messages, queue
from ledgermill.streaming import ingest

# --- queue -------------------------------------------------------------------

_QUEUE_SQL = "SELECT landing_id, batch_id, source_type, source_id FROM landing WHERE NOT is_processed"


@query("queue_scan", with_frames("landing") + _QUEUE_SQL)
def queue_scan(spark, sf):
    return queue.unprocessed(frames.landing_documents(spark, sf)).select(
        "landing_id", "batch_id", "source_type", "source_id"
    )


@query("queue_scan_batch", with_frames("landing") + _QUEUE_SQL + " AND batch_id = 2")
def queue_scan_batch(spark, sf):
    return queue.unprocessed(frames.landing_documents(spark, sf), 2).select(
        "landing_id", "batch_id", "source_type", "source_id"
    )


@query(
    "unclassified",
    with_frames("landing")
    + "SELECT landing_id, subject, sender_email, file_name, file_ext FROM landing "
    "WHERE NOT is_processed AND bare",
)
def unclassified(spark, sf):
    return queue.unclassified(frames.landing_documents(spark, sf)).select(
        "landing_id", "subject", "sender_email", "file_name", "file_ext"
    )


@query(
    "hash_lookup",
    with_frames("landing")
    + """SELECT h.file_hash, min(l.landing_id) AS landing_id
FROM (SELECT DISTINCT md5(text) AS file_hash FROM documents UNION SELECT md5(text) FROM benchmark) h
LEFT JOIN landing l ON l.file_hash = h.file_hash GROUP BY 1""",
)
def hash_lookup(spark, sf):
    wanted = frames.table(spark, sf, "documents").select(F.md5("text").alias("file_hash"))
    wanted = wanted.unionByName(
        frames.table(spark, sf, "benchmark").select(F.md5("text").alias("file_hash"))
    ).distinct()
    return queue.find_by_hash(frames.landing_documents(spark, sf), wanted)


_KEY_SQL = "source_type, source_id, coalesce(file_name, '')"


@query(
    "append_new",
    with_frames("landing")
    + f""", old AS (SELECT * FROM landing WHERE is_processed),
new AS (SELECT * FROM landing WHERE NOT is_processed),
pick AS (SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL}
  ORDER BY file_size_bytes DESC NULLS LAST, file_name NULLS LAST, landing_id) AS n FROM new
  WHERE source_type IS NOT NULL AND source_id IS NOT NULL)
SELECT landing_id, source_type, source_id, file_name FROM pick p WHERE n = 1 AND NOT EXISTS (
  SELECT 1 FROM old o WHERE o.source_type = p.source_type AND o.source_id = p.source_id
  AND coalesce(o.file_name, '') = coalesce(p.file_name, ''))
UNION ALL SELECT landing_id, source_type, source_id, file_name FROM new
WHERE source_type IS NULL OR source_id IS NULL""",
)
def append_new(spark, sf):
    rows = frames.landing_documents(spark, sf)
    order = [
        F.col("file_size_bytes").desc_nulls_last(),
        F.col("file_name").asc_nulls_last(),
        F.col("landing_id").asc(),
    ]
    return landing.new_rows(rows.filter("is_processed"), rows.filter("NOT is_processed"), order).select(
        "landing_id", "source_type", "source_id", "file_name"
    )


@query(
    "json_update",
    with_frames("landing")
    + """, u AS (SELECT doc_id + 1 AS id, CASE WHEN quality = 1 THEN 'Donations' ELSE 'Other' END AS category
  FROM labels)
SELECT l.landing_id, l.file_hash, 'box/' || l.file_hash AS filed_path,
  CASE WHEN u.id IS NOT NULL THEN u.category WHEN NOT l.bare THEN l.cls_category END AS category,
  CASE WHEN u.id IS NULL AND NOT l.bare THEN l.cls_supplier END AS supplier
FROM landing l LEFT JOIN u ON u.id = l.landing_id""",
)
def json_update(spark, sf):
    one = F.to_json(
        F.array(
            F.struct(
                (F.col("doc_id") + 1).alias("landing_id"),
                F.to_json(
                    F.struct(
                        F.when(F.col("quality") == 1, "Donations").otherwise("Other").alias("category")
                    )
                ).alias("classification"),
            )
        )
    )
    updates = landing.classification_updates(
        frames.table(spark, sf, "labels").select(one.alias("updates"))
    )
    base = scratch_dir(spark, "updated")
    queued = landing.landing_log(spark, f"{base}/landing")
    queued.write(frames.landing_documents(spark, sf), 0)
    changes = landing.update_log(spark, f"{base}/updates")
    # An older classification of some rows, which the newer one replaces.
    changes.write(updates.filter("landing_id % 3 = 0").withColumn("classification", F.lit("{}")), 0)
    changes.write(updates, 1)
    rows = landing.read_updated(queued, changes)

    def field(path: str):
        return F.get_json_object("raw_json", path)

    return rows.select(
        "landing_id",
        field("$.file_hash").alias("file_hash"),
        field("$.filed_path").alias("filed_path"),
        field("$.classification.category").alias("category"),
        field("$.classification.supplier_name").alias("supplier"),
    )


@query(
    "landing_json",
    """SELECT doc_id, 'FOLDER' AS source_type, 'doc-' || doc_id AS source_id,
  CASE WHEN doc_id % 2 = 0 THEN 'Mail ' || doc_id END AS subject,
  CASE WHEN doc_id % 2 = 0 THEN 'Scan-' || doc_id || '.PDF' ELSE 'file ' || doc_id || '.pdf' END AS file_name,
  'pdf' AS file_ext, n_chars AS file_size_bytes, substr(text, 1, 500) AS content_preview, text AS full_text,
  length(text) AS text_length, 'Donations' AS category,
  CASE WHEN doc_id % 2 = 0 THEN 'Mail ' || doc_id END AS json_subject FROM documents""",
)
def landing_json(spark, sf):
    meta = F.when(
        F.col("doc_id") % 2 == 0,
        F.struct(
            F.concat(F.lit("Mail "), "doc_id").alias("subject"),
            F.lit("a@example.com").alias("sender_email"),
            F.lit(None).cast("timestamp").alias("received_at"),
            F.concat(F.lit("Scan-"), "doc_id", F.lit(".PDF")).alias("file_name"),
            F.lit("PDF").alias("file_ext"),
            F.lit(None).cast("bigint").alias("file_size_bytes"),
        ),
    )
    files = frames.table(spark, sf, "documents").select(
        "doc_id",
        F.lit("FOLDER").alias("source_type"),
        F.concat(F.lit("doc-"), "doc_id").alias("source_id"),
        F.concat(F.lit("/in/file "), "doc_id", F.lit(".pdf")).alias("path"),
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("modified_at"),
        F.col("n_chars").alias("size"),
        "text",
        F.lit("box/x").alias("filed_path"),
        F.struct(F.lit("Donations").alias("category")).alias("classification"),
        meta.alias("meta"),
    )
    rows = landing.land_documents(files, F.lit("2025-01-02T00:00:00Z"))
    return rows.select(
        F.regexp_extract("source_id", r"(\d+)", 1).cast("bigint").alias("doc_id"),
        "source_type", "source_id", "subject", "file_name", "file_ext", "file_size_bytes",
        "content_preview",
        F.get_json_object("raw_json", "$.full_text").alias("full_text"),
        F.get_json_object("raw_json", "$.text_length").cast("bigint").alias("text_length"),
        F.get_json_object("raw_json", "$.classification.category").alias("category"),
        F.get_json_object("raw_json", "$.subject").alias("json_subject"),
    )


@query(
    "hash_dedupe",
    """SELECT sha256(text) AS file_hash, min(printf('%08d', doc_id)) AS file_name FROM documents d
WHERE sha256(text) NOT IN (SELECT sha256(d2.text) FROM documents d2 JOIN labels l USING (doc_id))
GROUP BY 1""",
)
def hash_dedupe(spark, sf):
    docs = frames.table(spark, sf, "documents")
    labelled = docs.join(frames.table(spark, sf, "labels"), "doc_id", "left_semi")
    known = labelled.select(
        F.col("doc_id").alias("landing_id"),
        F.to_json(F.struct(crypto.content_hash(F.col("text")).alias("file_hash"))).alias("raw_json"),
    )
    files = docs.select(
        F.format_string("%08d", "doc_id").alias("file_name"), F.col("text").alias("content")
    )
    return landing.drop_known_files(files, known).select("file_hash", "file_name")


@query(
    "file_hash_known",
    "SELECT doc_id, sha256(text) AS file_hash FROM documents WHERE sha256(text) IN "
    "(SELECT sha256(text) FROM documents JOIN labels USING (doc_id))",
)
def file_hash_known(spark, sf):
    docs = frames.table(spark, sf, "documents").select(
        "doc_id", crypto.content_hash(F.col("text")).alias("file_hash")
    )
    labelled = docs.join(frames.table(spark, sf, "labels"), "doc_id", "left_semi")
    return docs.join(labelled.select("file_hash").distinct(), "file_hash", "left_semi").select(
        "doc_id", "file_hash"
    )


# --- merge -------------------------------------------------------------------

_PRIMARY = """, pick AS (SELECT *, row_number() OVER (PARTITION BY source_type, source_id
  ORDER BY coalesce(file_size_bytes, 0) DESC, coalesce(file_name, ''), landing_id) AS n
  FROM landing WHERE NOT is_processed AND source_type IS NOT NULL AND source_id IS NOT NULL),
prime AS (SELECT * FROM pick WHERE n = 1)
"""


@query(
    "primary_document",
    with_frames("landing")
    + _PRIMARY
    + "SELECT landing_id, source_type, source_id, file_name, file_size_bytes FROM prime",
)
def primary_document(spark, sf):
    return merge.primary_documents(queue.unprocessed(frames.landing_documents(spark, sf))).select(
        "landing_id", "source_type", "source_id", "file_name", "file_size_bytes"
    )


@query(
    "fy_by_range",
    with_frames("landing", "doc_fy")
    + """SELECT l.landing_id, CAST(l.received_at AS VARCHAR) AS received_at, CAST(f.fy_year AS BIGINT) AS fy_year
FROM landing l LEFT JOIN doc_fy f ON CAST(l.received_at AS DATE) BETWEEN f.start_date AND f.end_date""",
)
def fy_by_range(spark, sf):
    rows = frames.landing_documents(spark, sf).select("landing_id", "received_at")
    return calendar.with_fy_period(
        rows, F.to_date("received_at"), frames.doc_fy(spark), "fy_year"
    )


# The typed fields of the primary documents and whether every cast worked.
_TYPED = """, typed AS (SELECT p.*, CASE WHEN bare THEN NULL ELSE cls_category END AS category,
  TRY_CAST(CASE WHEN bare THEN NULL ELSE nullif(cls_fy_year, '') END AS INT) AS cfy,
  CASE WHEN bare THEN NULL ELSE TRY_CAST(nullif(cls_amount, '') AS DECIMAL(10,2)) END AS amount,
  CASE WHEN bare THEN NULL ELSE TRY_CAST(cls_confidence AS DECIMAL(4,3)) END AS conf,
  CASE WHEN bare THEN NULL ELSE TRY_CAST(cls_deductible AS BOOLEAN) END AS flag,
  CASE WHEN bare THEN NULL ELSE nullif(cls_supplier, '') END AS supplier,
  CASE WHEN bare THEN NULL WHEN regexp_full_match(cls_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
    THEN TRY_CAST(cls_date AS DATE) END AS ddate FROM prime p),
checked AS (SELECT *,
  NOT bare AND cls_deductible IS NOT NULL AND flag IS NULL AS bad_flag,
  NOT bare AND cls_confidence IS NOT NULL AND (conf IS NULL OR conf NOT BETWEEN 0 AND 1) AS bad_conf FROM typed)
"""


@query(
    "json_unpack",
    with_frames("landing")
    + _PRIMARY
    + _TYPED
    + """SELECT landing_id, category AS cls_category, CAST(cfy AS BIGINT) AS cls_fy_year,
  coalesce(flag, false) AS is_deductible, CAST(amount AS DOUBLE) AS deductible_amount,
  CAST(coalesce(conf, 0) AS DOUBLE) AS confidence_score, supplier AS supplier_name,
  CAST(ddate AS VARCHAR) AS document_date, 'box/' || file_hash AS filed_path, 0 AS items
FROM checked WHERE NOT bad_flag AND NOT bad_conf""",
)
def json_unpack(spark, sf):
    rows = merge.parse_classification(queue.unprocessed(frames.landing_documents(spark, sf)))
    primary = merge.primary_documents(rows)
    good = merge.unpack_classification(primary).filter(F.size("cast_errors") == 0)
    return good.select(
        "landing_id", "cls_category", "cls_fy_year", "is_deductible", "deductible_amount",
        "confidence_score", "supplier_name", "document_date", "filed_path",
        F.size("line_items").alias("items"),
    )


QUARANTINE_SQL = (
    with_frames("landing")
    + _PRIMARY
    + _TYPED
    + """SELECT landing_id, 'key' AS reasons FROM landing WHERE NOT is_processed
  AND (source_type IS NULL OR source_id IS NULL)
UNION ALL SELECT landing_id, concat_ws(',', CASE WHEN bad_flag THEN 'is_deductible' END,
  CASE WHEN bad_conf THEN 'confidence' END) FROM checked WHERE bad_flag OR bad_conf"""
)


@query("quarantine", QUARANTINE_SQL)
def quarantine(spark, sf):
    rows = merge.quarantined(frames.landing_documents(spark, sf))
    return rows.select("landing_id", F.array_join("reasons", ",").alias("reasons"))


_INCOMING = (
    _PRIMARY
    + _TYPED
    + """, inc AS (SELECT c.*, coalesce(k.fy_year, r.fy_year) AS new_fy, t.category_id AS cat,
  CASE WHEN coalesce(conf, 0) >= 0.75 THEN 'AUTO_CONFIRMED' ELSE 'NEEDS_REVIEW' END AS status
  FROM checked c LEFT JOIN doc_fy k ON k.fy_year = c.cfy
  LEFT JOIN doc_fy r ON CAST(c.received_at AS DATE) BETWEEN r.start_date AND r.end_date
  LEFT JOIN tax_cats t ON t.category_nme = c.category
  WHERE NOT bad_flag AND NOT bad_conf),
keyed AS (SELECT *, md5(source_type || '|' || source_id) AS digest,
  CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM inc),
numbered AS (SELECT *, (SELECT coalesce(max(doc_id), 0) FROM core)
  + (row_number() OVER (PARTITION BY bucket ORDER BY digest) - 1) * 4096 + bucket + 1 AS new_id FROM keyed)
"""
)

_MERGED = (
    with_frames("landing", "docs", "core", "doc_fy", "tax_cats")
    + _INCOMING
    + """, j AS (SELECT o.doc_id IS NULL AS ins,
  o.doc_id IS NOT NULL AND n.new_id IS NOT NULL AND o.review_status NOT IN ('CONFIRMED', 'REJECTED') AS upd,
  n.new_id, n.landing_id, n.file_name AS n_file, n.received_at AS n_received, n.subject AS n_subject,
  n.content_preview AS n_preview, n.new_fy, n.cat, coalesce(n.flag, false) AS n_flag, n.amount AS n_amount,
  coalesce(n.conf, 0) AS n_conf, n.status, n.supplier AS n_supplier, n.ddate AS n_date,
  'box/' || n.file_hash AS n_path, n.batch_id AS n_batch, n.source_type AS n_type, n.source_id AS n_sid, o.*
  FROM core o FULL JOIN numbered n ON o.source_type = n.source_type AND o.source_id = n.source_id)
"""
)
_MERGED_ROWS = """SELECT coalesce(doc_id, new_id) AS doc_id, coalesce(source_type, n_type) AS source_type,
  coalesce(source_id, n_sid) AS source_id,
  CASE WHEN ins OR upd THEN n_subject ELSE subject END AS subject,
  CAST(CASE WHEN ins OR upd THEN n_received ELSE received_at END AS VARCHAR) AS received_at,
  CAST(CASE WHEN ins THEN new_fy WHEN upd THEN coalesce(new_fy, fy_year) ELSE fy_year END AS BIGINT) AS fy_year,
  CASE WHEN ins OR upd THEN n_file ELSE file_name END AS file_name,
  CASE WHEN ins THEN n_preview WHEN upd THEN coalesce(n_preview, content_preview) ELSE content_preview END
    AS content_preview,
  CAST(CASE WHEN ins THEN cat WHEN upd THEN coalesce(cat, tax_category_id) ELSE tax_category_id END AS BIGINT)
    AS tax_category_id,
  CASE WHEN ins OR upd THEN n_flag ELSE is_deductible END AS is_deductible,
  CAST(CASE WHEN ins OR upd THEN n_amount ELSE deductible_amount END AS DOUBLE) AS deductible_amount,
  CAST(CASE WHEN ins OR upd THEN n_conf ELSE confidence_score END AS DOUBLE) AS confidence_score,
  CASE WHEN ins THEN status ELSE review_status END AS review_status,
  CASE WHEN ins THEN n_supplier WHEN upd THEN coalesce(n_supplier, supplier_name) ELSE supplier_name END
    AS supplier_name,
  CAST(CASE WHEN ins THEN n_date WHEN upd THEN coalesce(n_date, document_date) ELSE document_date END AS VARCHAR)
    AS document_date,
  CAST(CASE WHEN ins THEN n_amount WHEN upd THEN coalesce(n_amount, total_amount) ELSE total_amount END AS DOUBLE)
    AS total_amount,
  CASE WHEN ins OR upd THEN n_path ELSE filed_path END AS filed_path,
  CASE WHEN ins OR upd THEN n_batch ELSE batch_id END AS batch_id,
  CASE WHEN ins THEN 'inserted' WHEN upd THEN 'updated' WHEN new_id IS NOT NULL THEN 'protected'
    ELSE 'untouched' END AS merge_outcome FROM j"""

_MERGE_OUT = (
    "doc_id", "source_type", "source_id", "subject", "received_at", "fy_year", "file_name",
    "content_preview", "tax_category_id", "is_deductible", "deductible_amount",
    "confidence_score", "review_status", "supplier_name", "document_date", "total_amount",
    "filed_path", "batch_id", "merge_outcome",
)


def _merge_core(spark, sf):
    """Existing core under landing keys."""
    rows = frames.merged_core(spark, sf).drop("source_type", "source_id")
    keys = frames.table(spark, sf, "documents").alias("d").selectExpr(
        "doc_id AS _id", *frames._LANDING_KEY
    )
    columns = frames.core_documents(spark, sf).columns
    return rows.join(keys, F.col("doc_id") == F.col("_id")).select(*columns)


def _incoming(spark, sf, **options):
    return merge.incoming_documents(
        frames.landing_documents(spark, sf), frames.doc_fy(spark), seeds.tax_categories(spark),
        **options,
    )


@query("merge_v2", _MERGED + _MERGED_ROWS)
def merge_v2(spark, sf):
    return merge.merge_documents(_merge_core(spark, sf), _incoming(spark, sf)).select(*_MERGE_OUT)


@query(
    "merge_restatus",
    _MERGED
    + _MERGED_ROWS.replace("CASE WHEN ins THEN status ELSE", "CASE WHEN ins OR upd THEN status ELSE"),
)
def merge_restatus(spark, sf):
    return merge.merge_documents(
        _merge_core(spark, sf), _incoming(spark, sf), merge.RESTATUS_POLICY
    ).select(*_MERGE_OUT)


@query(
    "merge_changes",
    f"SELECT * FROM ({_MERGED}{_MERGED_ROWS}) WHERE merge_outcome IN ('inserted', 'updated')",
)
def merge_changes(spark, sf):
    return merge.merge_changes(_merge_core(spark, sf), _incoming(spark, sf)).select(*_MERGE_OUT)


@query(
    "merge_v1",
    with_frames("landing", "docs", "core", "doc_fy")
    + _PRIMARY
    + """, inc AS (SELECT p.*, r.fy_year AS new_fy FROM prime p
  LEFT JOIN doc_fy r ON CAST(p.received_at AS DATE) BETWEEN r.start_date AND r.end_date),
keyed AS (SELECT *, md5(source_type || '|' || source_id) AS digest,
  CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM inc),
numbered AS (SELECT *, (SELECT coalesce(max(doc_id), 0) FROM core)
  + (row_number() OVER (PARTITION BY bucket ORDER BY digest) - 1) * 4096 + bucket + 1 AS new_id FROM keyed),
j AS (SELECT o.doc_id IS NULL AS ins,
  o.doc_id IS NOT NULL AND n.new_id IS NOT NULL AND o.review_status = 'PENDING' AS upd, n.new_id,
  n.file_name AS n_file, n.content_preview AS n_preview, n.new_fy, n.batch_id AS n_batch,
  n.source_type AS n_type, n.source_id AS n_sid, o.*
  FROM core o FULL JOIN numbered n ON o.source_type = n.source_type AND o.source_id = n.source_id)
SELECT coalesce(doc_id, new_id) AS doc_id, coalesce(source_type, n_type) AS source_type,
  coalesce(source_id, n_sid) AS source_id,
  CAST(CASE WHEN ins THEN new_fy ELSE fy_year END AS BIGINT) AS fy_year,
  CASE WHEN ins OR upd THEN n_file ELSE file_name END AS file_name,
  CASE WHEN ins THEN n_preview WHEN upd THEN coalesce(n_preview, content_preview) ELSE content_preview END
    AS content_preview,
  CASE WHEN ins THEN 'PENDING' ELSE review_status END AS review_status,
  CASE WHEN ins OR upd THEN n_batch ELSE batch_id END AS batch_id,
  CASE WHEN ins THEN 'inserted' WHEN upd THEN 'updated' WHEN new_id IS NOT NULL THEN 'protected'
    ELSE 'untouched' END AS merge_outcome FROM j""",
)
def merge_v1(spark, sf):
    incoming = merge.incoming_metadata(frames.landing_documents(spark, sf), frames.doc_fy(spark))
    merged = merge.merge_documents(_merge_core(spark, sf), incoming, merge.FIRST_POLICY)
    return merged.select(
        "doc_id", "source_type", "source_id", "fy_year", "file_name", "content_preview",
        "review_status", "batch_id", "merge_outcome",
    )


@query(
    "merge_counts",
    _MERGED
    + """SELECT count(*) FILTER (ins OR upd) AS merged,
  count(*) FILTER (NOT ins AND NOT upd AND new_id IS NOT NULL) AS protected,
  (SELECT count(*) FROM landing WHERE NOT is_processed AND (source_type IS NULL OR source_id IS NULL))
  + (SELECT count(*) FROM checked WHERE bad_flag OR bad_conf) AS quarantined FROM j""",
)
def merge_counts(spark, sf):
    merged = merge.merge_documents(_merge_core(spark, sf), _incoming(spark, sf))
    return merge.merge_counts(merged, merge.quarantined(frames.landing_documents(spark, sf)))


_DONE = (
    "EXISTS (SELECT 1 FROM landing q WHERE NOT q.is_processed{batch} "
    "AND q.source_type = l.source_type AND q.source_id = l.source_id)"
)

_TAKEN = (
    "NOT EXISTS (SELECT 1 FROM checked c WHERE (c.bad_flag OR c.bad_conf) "
    "AND c.source_type = l.source_type AND c.source_id = l.source_id)"
)


@query(
    "mark_processed",
    with_frames("landing")
    + _PRIMARY
    + _TYPED
    + f"SELECT landing_id, is_processed OR ({_DONE.format(batch='')} AND {_TAKEN}) AS is_processed "
    + "FROM landing l",
)
def mark_processed(spark, sf):
    return merge.mark_processed(frames.landing_documents(spark, sf)).select(
        "landing_id", "is_processed"
    )


@query(
    "mark_processed_batch",
    with_frames("landing")
    + _PRIMARY.replace("NOT is_processed", "NOT is_processed AND batch_id = 3")
    + _TYPED
    + "SELECT landing_id, is_processed OR ("
    + _DONE.format(batch=" AND q.batch_id = 3")
    + f" AND {_TAKEN}) AS is_processed FROM landing l",
)
def mark_processed_batch(spark, sf):
    """The queue in buckets, and a log of the keys that the batch has merged."""
    rows, base = frames.landing_documents(spark, sf), scratch_dir(spark, "queue")
    stored = BucketedLog(spark, f"{base}/queue", LANDING_DOCUMENTS, merge.KEY)
    stored.write(rows, 0)
    marks = ingest.marks_log(spark, base)
    marks.write(merge.processed_keys(stored.read(), 3), 0)
    return stored.rows_marked(marks, "_marked").select(
        "landing_id", (F.col("is_processed") | F.col("_marked")).alias("is_processed")
    )


@query(
    "status_by_relevance",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN 'AUTO_REJECTED'
  WHEN CAST((doc_id * 37) % 1001 AS INT) >= 750 THEN 'AUTO_CONFIRMED' ELSE 'NEEDS_REVIEW' END AS review_status
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def status_by_relevance(spark, sf):
    rows = frames.table(spark, sf, "documents").join(
        frames.table(spark, sf, "labels"), "doc_id", "left"
    )
    confidence = ((F.col("doc_id") * 37 % 1001) * F.lit("0.001").cast("decimal(4,3)")).cast(
        "decimal(4,3)"
    )
    return rows.select(
        "doc_id",
        merge.review_status_by_relevance(F.col("toxic") != 1, confidence).alias("review_status"),
    )


# --- casts and dates ---------------------------------------------------------

_DATE_TEXTS = """CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-00') WHEN 2 THEN '' WHEN 3 THEN 'null'
  WHEN 4 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-02-30') END"""


@query(
    "safe_dates",
    f"""SELECT o_orderkey, t AS raw, CASE WHEN regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
  THEN CAST(TRY_CAST(t AS DATE) AS VARCHAR) END AS safe_date
FROM (SELECT o_orderkey, {_DATE_TEXTS} AS t FROM orders)""",
)
def safe_dates(spark, sf):
    raw = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
        "WHEN 1 THEN concat(date_format(o_orderdate, 'yyyy-MM'), '-00') WHEN 2 THEN '' "
        "WHEN 3 THEN 'null' WHEN 4 THEN date_format(o_orderdate, 'yyyy-MM') "
        "ELSE concat(date_format(o_orderdate, 'yyyy'), '-02-30') END"
    )
    return frames.table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).withColumn(
        "safe_date", values.safe_to_date(F.col("raw"))
    )


@query(
    "high_water_mark",
    with_frames("docs")
    + "SELECT epoch_ms(max(received_at) - INTERVAL 3 DAY) AS watermark_ms FROM docs WHERE source_type = 'GMAIL'",
)
def high_water_mark(spark, sf):
    return calendar.high_water_mark(frames.core_documents(spark, sf))


@query(
    "high_water_mark_previous",
    with_frames("docs")
    + """SELECT epoch_ms(max(received_at)) AS watermark_ms, '2025-06-30' AS before_date
FROM docs WHERE source_type = 'GMAIL'""",
)
def high_water_mark_previous(spark, sf):
    rows = frames.core_documents(spark, sf).select("source_type", "received_at")
    today = F.greatest(F.lit("2025-06-30"), F.lit("2025-06-15")).cast("date")
    return calendar.high_water_mark_previous_fy(rows, today)


@query("landing_mark", with_frames("landing") + "SELECT max(landing_id) AS mark FROM landing")
def landing_mark(spark, sf):
    return calendar.newest_mark(frames.landing_documents(spark, sf), "landing_id")


@query(
    "calendar_parts",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END
  AS fy_year, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
  strftime(o_orderdate, '%Y-%m') AS month_label,
  CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1)
  ELSE (year(o_orderdate) - 1) || '-' || year(o_orderdate) END AS fy_folder FROM orders""",
)
def calendar_parts(spark, sf):
    day = F.to_date("o_orderdate")
    return frames.table(spark, sf, "orders").select(
        "o_orderkey",
        calendar.fy_of(day).alias("fy_year"),
        calendar.month_start(day).alias("month_start"),
        calendar.month_label(day).alias("month_label"),
        calendar.fy_folder(calendar.fy_of(day)).alias("fy_folder"),
    )


# --- text --------------------------------------------------------------------


@query(
    "preview",
    "SELECT doc_id, nullif(substr(replace(text, chr(0), ''), 1, 500), '') AS content_preview, "
    "length(text) AS chars FROM documents",
)
def preview(spark, sf):
    return frames.table(spark, sf, "documents").select(
        "doc_id",
        text.preview(F.col("text")).alias("content_preview"),
        F.length("text").cast("bigint").alias("chars"),
    )


_TAGLESS = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
    "'(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), "
    "'(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
)


def _decoded_sql(expression: str) -> str:
    for entity, char in text._ENTITIES:
        expression = f"replace({expression}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return expression


_PAGE_TEXT = rf"trim(regexp_replace({_decoded_sql(_TAGLESS)}, '[ \t\r\n\f]+', ' ', 'g'))"


@query("html_text", f"SELECT page_id, {_PAGE_TEXT} AS text FROM pages")
def html_text(spark, sf):
    return frames.table(spark, sf, "pages").select(
        "page_id", text.html_to_text(F.col("html")).alias("text")
    )


@query(
    "body_text",
    f"SELECT page_id, CASE WHEN page_id % 5 = 0 THEN url ELSE {_PAGE_TEXT} END AS body FROM pages",
)
def body_text(spark, sf):
    encoded = F.rtrim(F.translate(F.base64(F.encode("html", "UTF-8")), "+/", "-_"), F.lit("="))
    encoded = F.regexp_replace(encoded, r"[\r\n]", "")
    data = F.when(F.col("page_id") % 5 != 0, encoded)
    return frames.table(spark, sf, "pages").select(
        "page_id", text.body_text(data, F.col("url")).alias("body")
    )


@query(
    "document_pages",
    "SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda p: p <> ''), chr(10)) "
    "AS text FROM documents",
)
def document_pages(spark, sf):
    pages = F.split("text", "\n")
    return frames.table(spark, sf, "documents").select(
        "doc_id", text.join_pages(pages).alias("text")
    )


@query(
    "safe_name",
    r"""SELECT doc_id, n AS raw, CASE WHEN trim(regexp_replace(n, '[\\/:*?"<>|''‘’“”]', '', 'g')) = '' THEN 'f.pdf'
  ELSE trim(regexp_replace(n, '[\\/:*?"<>|''‘’“”]', '', 'g')) || ' - f.pdf' END AS filed,
  regexp_replace(n, '[\\/:"*?<>|]', '_', 'g') AS staged
FROM (SELECT doc_id, split_part(text, chr(10), 1) || CASE doc_id % 3 WHEN 0 THEN ': "A/B" \ <c>|d?*'
  WHEN 1 THEN ' O’Neil''s “x”' ELSE '' END AS n FROM documents)""",
)
def safe_name(spark, sf):
    raw = F.concat(
        F.substring_index("text", "\n", 1),
        F.when(F.col("doc_id") % 3 == 0, F.lit(': "A/B" \\ <c>|d?*'))
        .when(F.col("doc_id") % 3 == 1, F.lit(" O’Neil's “x”"))
        .otherwise(""),
    )
    return frames.table(spark, sf, "documents").select("doc_id", raw.alias("raw")).withColumn(
        "filed", text.filed_name(F.col("raw"), F.lit("f.pdf"))
    ).withColumn("staged", text.staged_name(F.col("raw")))


# --- classification ----------------------------------------------------------

# Words of the invented documents stand in for tax words, so that rules do hit.
SAMPLE_RULES = {
    "Donations": ("thing", "worthless"),
    "Technology Equipment": ("nicht", "aulich"),
    "Bank Interest Statement": ("dans", "pour"),
    "Invoice / Receipt — Other": ("the", "und", "la", "des reaux"),
}
SAMPLE_PRIVATE = ("that", "for", "est")


def _hits_sql(words: tuple[str, ...]) -> str:
    """Whole-word hits: every separator is doubled so that neighbours both match."""
    body = "|".join(w.replace(" ", "( )") for w in words)
    return f"len(regexp_extract_all(spaced, ' ({body}) '))"


_SPACED_WORDS = r"' ' || regexp_replace(lower(text), '[^\p{L}\p{N}]+', '  ', 'g') || ' '"
# One-word rules only: a phrase needs its separator kept as it is.
_ONE_WORD = {k: tuple(w for w in v if " " not in w) for k, v in SAMPLE_RULES.items()}


@query(
    "category_rules",
    f"WITH w AS (SELECT doc_id, {_SPACED_WORDS} AS spaced FROM documents), h AS (SELECT doc_id, "
    + ", ".join(f"{_hits_sql(words)} AS h{i}" for i, words in enumerate(_ONE_WORD.values()))
    + f", {_hits_sql(SAMPLE_PRIVATE)} AS private FROM w), b AS (SELECT *, greatest(h0, h1, h2, h3) AS best FROM h) "
    + "SELECT doc_id, CASE best WHEN 0 THEN 'Invoice / Receipt — Other' "
    + " ".join(f"WHEN h{i} THEN '{name}'" for i, name in enumerate(_ONE_WORD))
    + " END AS category, CASE WHEN best = 0 THEN '0.1' WHEN best >= 5 THEN '0.900' "
    "ELSE '0.' || (best + 4) || '00' END AS confidence, best > 0 AND best >= private AS relevant FROM b",
)
def category_rules(spark, sf):
    docs = frames.table(spark, sf, "documents").select("doc_id", "text")
    rows = classify.classify_documents(docs, "text", _ONE_WORD, SAMPLE_PRIVATE)
    return rows.select(
        "doc_id",
        F.col("classification.category").alias("category"),
        F.col("classification.confidence").alias("confidence"),
        (F.col("classification.is_tax_relevant") == "true").alias("relevant"),
    )


# Rules of several words, which the head of the made-up bill holds.
_BILL_RULES = {
    "Donations": ("gift receipt", "charity fund"),
    "Technology Equipment": ("tax invoice", "invoice paid"),
    "Bank Interest Statement": ("interest earned",),
}
_BILL_HEAD = {
    "supplier": "concat('Shop ', source)",
    "kind": "CASE doc_id % 3 WHEN 0 THEN 'TAX INVOICE, tax invoice' WHEN 1 THEN 'Gift Receipt of the Charity Fund' "
    "ELSE 'Statement of interest earned' END",
    "day": "CASE doc_id % 4 WHEN 0 THEN '2024-02-30 or 05/03/2024' WHEN 1 THEN '2024-05-06' WHEN 2 THEN '31/02/2024' "
    "ELSE 'soon' END",
    "period": "CASE doc_id % 2 WHEN 0 THEN 'Billing period: 01/04/2024 to 30/04/2024' "
    "ELSE 'Service period 40/04/2024 - 30/04/2024' END",
    "address": "concat('Supply Address: ', doc_id, ' High St')",
    "account": "concat('Account number: AC-', 1000 + doc_id)",
    "total": "CASE WHEN doc_id % 5 <> 0 THEN concat('Total due $', CAST(doc_id AS {string}), '.50') ELSE 'Total due' END",
}


@query(
    "class_fields",
    """WITH f AS (SELECT doc_id, 'Shop ' || source AS supplier, doc_id % 3 AS k, doc_id % 5 <> 0 AS paid FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN 'Technology Equipment' WHEN 1 THEN 'Donations' ELSE 'Bank Interest Statement' END AS category,
  'true' AS is_tax_relevant,
  CASE k WHEN 0 THEN '0.600' WHEN 1 THEN '0.600' ELSE '0.500' END AS confidence,
  CASE k WHEN 2 THEN 'false' ELSE 'true' END AS is_deductible,
  '2024' AS fy_year,
  CASE WHEN paid THEN doc_id || '.50' END AS deductible_amount, CASE WHEN paid THEN doc_id || '.50' END AS total_amount,
  CASE k WHEN 0 THEN 'Tax Invoice' WHEN 1 THEN 'Receipt' ELSE 'Statement' END AS document_type,
  CASE doc_id % 4 WHEN 0 THEN '2024-03-05' WHEN 1 THEN '2024-05-06' WHEN 2 THEN '2024-04-01' ELSE '2024-04-30' END AS document_date,
  CASE k WHEN 0 THEN 'Technology Equipment' WHEN 1 THEN 'Donations' ELSE 'Bank Interest Statement' END || ' from ' || supplier
    || CASE WHEN paid THEN ', $' || doc_id || '.50' ELSE '' END AS summary,
  CASE doc_id % 2 WHEN 0 THEN '2024-04-01' END AS billing_period_start,
  '2024-04-30' AS billing_period_end,
  supplier AS supplier_name, doc_id || ' High St' AS supply_address, 'AC-' || (1000 + doc_id) AS account_reference,
  1 AS line_items FROM f""",
)
def class_fields(spark, sf):
    """All fields of the classification, of bills with a known head and the whole text below."""
    head = [F.expr(sql.format(string="STRING")) for sql in _BILL_HEAD.values()]
    body = F.concat_ws("\n", *head, F.lit("Usage 2 kWh @ 0.5000 = 1.00"), F.replace("text", F.lit("$"), F.lit("")))
    docs = frames.table(spark, sf, "documents").select("doc_id", body.alias("text"))
    rows = classify.classify_documents(docs, "text", _BILL_RULES, ("zzyzx",))
    return rows.select("doc_id", "classification.*").withColumn("line_items", F.size("line_items"))


@query(
    "default_class",
    """SELECT doc_id, 'Invoice / Receipt — Other' AS document_category, '0.1' AS document_confidence,
  'Other' AS folder_category, '0.0' AS folder_confidence, 'false' AS is_deductible FROM documents""",
)
def default_class(spark, sf):
    """Empty texts, missing ones, and whole texts that no rule speaks for."""
    docs = frames.table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("text")).alias("text"),
    )
    blank = classify.classify_documents(docs, "text", {"Donations": ("zzyzx",)})
    folder = classify.parse_response(F.lit("no answer"))
    return blank.withColumn("folder", folder).select(
        "doc_id",
        F.col("classification.category").alias("document_category"),
        F.col("classification.confidence").alias("document_confidence"),
        F.col("folder.category").alias("folder_category"),
        F.col("folder.confidence").alias("folder_confidence"),
        F.col("classification.is_deductible").alias("is_deductible"),
    )


@query(
    "parse_response",
    """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Donations' WHEN 3 THEN 'Dividends' ELSE 'Other' END AS category,
  CASE doc_id % 7 WHEN 0 THEN printf('0.%d', doc_id % 9) WHEN 1 THEN '0.5' WHEN 6 THEN '0.0' WHEN 3 THEN '0.0'
    ELSE '0.0' END AS confidence,
  CASE doc_id % 7 WHEN 0 THEN 'true' ELSE 'false' END AS is_deductible,
  CASE doc_id % 7 WHEN 0 THEN source END AS supplier_name FROM documents""",
)
def parse_response(spark, sf):
    def obj(**fields):
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))

    good = obj(
        category=F.lit("Donations"),
        confidence=F.concat(F.lit("0."), (F.col("doc_id") % 9).cast("string")).cast("decimal(2,1)"),
        is_deductible=F.lit(True),
        supplier_name=F.col("source"),
    )
    slot = F.col("doc_id") % 7
    answer = (
        F.when(slot == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(slot == 1, obj(category=F.lit("Nonsense"), confidence=F.lit(0.5)))
        .when(slot == 2, F.lit("I cannot tell."))
        .when(slot == 3, obj(category=F.lit("Dividends")))
        .when(slot == 4, obj(category=F.lit("Dividends"), confidence=F.lit("high")))
        .when(slot == 5, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(F.lit(None).cast("string"))
    )
    return (
        frames.table(spark, sf, "documents")
        .select("doc_id", classify.parse_response(answer).cast(CLASSIFICATION).alias("c"))
        .select("doc_id", "c.category", "c.confidence", "c.is_deductible", "c.supplier_name")
    )


_MERCHANTS = (
    classify.MerchantRule("urgent", 1, "Salary/Wages"),
    classify.MerchantRule(r"high.*order [of]$", 2, None, True),
    classify.MerchantRule("order p$", 3),
)


@query(
    "two_pass_class",
    with_frames("txn")
    + """, r AS (SELECT txn_id, CASE WHEN description_raw ILIKE '%urgent%' THEN 1
  WHEN regexp_matches(description_raw, '(?i)high.*order [of]$') THEN 2
  WHEN regexp_matches(description_raw, '(?i)order p$') THEN 3 END AS rule, category_id FROM txn)
SELECT txn_id, CAST(coalesce(rule, CASE WHEN category_id > 3 THEN category_id END) AS BIGINT) AS category_id,
  CASE rule WHEN 1 THEN 'Salary/Wages' END AS subcategory, coalesce(rule = 2, false) AS is_deductible,
  CAST(CASE WHEN rule IS NOT NULL THEN 1 WHEN category_id > 3 THEN 0.6 END AS DOUBLE) AS confidence_score,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN category_id > 3 THEN 'model' END AS classified_by FROM r""",
)
def two_pass_class(spark, sf):
    scored = F.when(
        F.col("category_id") > 3,
        F.struct(
            F.col("category_id").alias("category_id"),
            F.lit(None).cast("string").alias("subcategory"),
            F.lit(False).alias("is_deductible"),
            F.lit("0.600").cast("decimal(4,3)").alias("confidence_score"),
        ),
    )
    rows = classify.classify_transactions(frames.transactions(spark, sf), _MERCHANTS, scored)
    return rows.select(
        "txn_id", "category_id", "subcategory", "is_deductible", "confidence_score", "classified_by"
    )


@query(
    "reclassify_low",
    with_frames("landing")
    + """SELECT landing_id, CASE WHEN conf < 0.75 THEN 'Reviewed' ELSE cls_category END AS category, conf < 0.75 AS low
FROM (SELECT *, coalesce(CASE WHEN bare THEN NULL ELSE TRY_CAST(cls_confidence AS DECIMAL(4,3)) END, 0) AS conf FROM landing)""",
)
def reclassify_low(spark, sf):
    parsed = frames.landing_documents(spark, sf).withColumn(
        "classification", F.from_json("raw_json", f"classification {CLASSIFICATION}")["classification"]
    )
    again = F.coalesce(
        F.col("classification"), F.lit(None).cast(CLASSIFICATION), classify.document_default().cast(CLASSIFICATION)
    ).withField("category", F.lit("Reviewed"))
    rows = classify.reclassify_low(
        parsed, F.col("classification.confidence").try_cast("decimal(4,3)"), again
    )
    return rows.select(
        "landing_id", F.col("classification.category").alias("category"),
        F.col("reclassified").alias("low"),
    )


@query(
    "low_conf_route",
    with_frames("docs")
    + "SELECT doc_id, CASE WHEN confidence_score < 0.6 THEN 'NEEDS_REVIEW' ELSE 'PENDING' END AS status, "
    "CASE WHEN confidence_score < 0.6 THEN '08-receipts-bills/other' ELSE CASE doc_id % 4 "
    "WHEN 0 THEN '02-deductions/donations' WHEN 1 THEN '01-income/bank-interest' "
    "WHEN 2 THEN '07-property' ELSE '08-receipts-bills/other' END END AS path FROM docs",
)
def low_conf_route(spark, sf):
    names = F.array(*[F.lit(n) for n in ("Donations", "Bank Interest", "Rental Income", "Unknown")])
    category = F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int"))
    confidence = F.col("confidence_score")
    return frames.core_documents(spark, sf).select(
        "doc_id",
        archive.folder_status(confidence).alias("status"),
        archive.folder_path(category, confidence).alias("path"),
    )


def _slug_sql() -> str:
    pairs = seeds.path_map(seeds.SLUG_PATHS)
    names = list(pairs)
    return " ".join(f"WHEN {i} THEN '{pairs[n]}'" for i, n in enumerate(names))


@query(
    "slug_paths",
    f"SELECT doc_id, CASE doc_id % 21 {_slug_sql()} ELSE '08-receipts-bills/other' END AS path FROM documents",
)
def slug_paths(spark, sf):
    names = F.array(*[F.lit(n) for n in [*seeds.path_map(seeds.SLUG_PATHS), "something else"]])
    slug = F.element_at(names, (F.col("doc_id") % 21 + 1).cast("int"))
    return frames.table(spark, sf, "documents").select(
        "doc_id",
        archive.category_path(slug, seeds.SLUG_PATHS, seeds.FOLDER_DEFAULT_PATH).alias("path"),
    )


_PATH_SQL = " ".join(
    f"WHEN '{n}' THEN '{p}'" for n, p in seeds.path_map(seeds.DOCUMENT_PATHS).items()
)


@query(
    "archive_path",
    with_frames("docs", "tax_cats")
    + f"""SELECT d.doc_id, coalesce((fy - 1) || '-' || fy, '2024-2025') || '/' || CASE c.category_nme {_PATH_SQL}
  ELSE 'receipts-and-bills/other' END || '/' || coalesce(d.supplier_name || ' - ', '') || d.file_name AS path
FROM (SELECT *, CASE WHEN fy_year BETWEEN 2020 AND 2035 THEN fy_year END AS fy FROM docs) d
LEFT JOIN tax_cats c ON c.category_id = d.tax_category_id""",
)
def archive_path(spark, sf):
    return _archive_docs(spark, sf).select("doc_id", "path")


def _archive_docs(spark, sf):
    names = seeds.tax_categories(spark).select(
        F.col("category_id").alias("tax_category_id"), "category_nme"
    )
    year = archive.filing_fy(F.col("fy_year").cast("string"), F.lit("2025-03-01").cast("date"))
    path = archive.destination(
        year, archive.category_path(F.col("category_nme")), F.col("supplier_name"), F.col("file_name")
    )
    return frames.core_documents(spark, sf).join(names, "tax_category_id", "left").select(
        "doc_id", path.alias("path"), "received_at"
    )


@query(
    "archive_index",
    with_frames("docs", "tax_cats")
    + f""", p AS (SELECT d.doc_id, coalesce((fy - 1) || '-' || fy, '2024-2025') || '/' || CASE c.category_nme {_PATH_SQL}
  ELSE 'receipts-and-bills/other' END || '/' || coalesce(d.supplier_name || ' - ', '') || d.file_name AS path
FROM (SELECT *, CASE WHEN fy_year BETWEEN 2020 AND 2035 THEN fy_year END AS fy FROM docs) d
LEFT JOIN tax_cats c ON c.category_id = d.tax_category_id),
a AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY doc_id) > 1 AS collided FROM p),
b AS (SELECT *, row_number() OVER (PARTITION BY path, collided ORDER BY doc_id) AS n FROM a)
SELECT doc_id, path, collided, CASE WHEN NOT collided THEN path
  WHEN n = 1 THEN regexp_replace(path, '\\.pdf$', '_20250324_143022.pdf')
  ELSE regexp_replace(path, '\\.pdf$', '_20250324_143022_' || doc_id || '.pdf') END AS final_path FROM b""",
)
def archive_index(spark, sf):
    filed_at = F.lit("2025-03-24 14:30:22").cast("timestamp")
    return archive.archive_index(_archive_docs(spark, sf), filed_at)


@query(
    "filing_fy",
    with_frames("landing")
    + """SELECT landing_id, CASE WHEN TRY_CAST(cls_fy_year AS INT) BETWEEN 2020 AND 2035 THEN TRY_CAST(cls_fy_year AS INT)
  ELSE 2026 END AS filing_fy, coalesce(TRY_CAST(nullif(cls_fy_year, '') AS INT), 2025) AS folder_fy FROM landing""",
)
def filing_fy(spark, sf):
    rows = frames.landing_parts(spark, sf)
    return rows.select(
        "landing_id",
        archive.filing_fy(F.col("cls_fy_year"), F.lit("2025-07-01").cast("date")).alias("filing_fy"),
        archive.filing_fy_folder(values.safe_int(F.col("cls_fy_year")), frames.doc_fy(spark)).alias(
            "folder_fy"
        ),
    )


_EXAMPLES = """, x AS (SELECT d.*, c.category_nme AS category, row_number() OVER (PARTITION BY review_status
  ORDER BY reviewer_notes IS NULL, reviewed_at DESC NULLS LAST, doc_id) AS n FROM docs d
  LEFT JOIN tax_cats c ON c.category_id = d.tax_category_id
  WHERE review_status IN ('CONFIRMED', 'REJECTED') AND subject IS NOT NULL),
e AS (SELECT * FROM x WHERE n <= 8)
"""


def _balanced(spark, sf):
    return classify.few_shot_balanced(frames.core_documents(spark, sf), seeds.tax_categories(spark))


@query(
    "few_shot_balanced",
    with_frames("docs", "tax_cats")
    + _EXAMPLES
    + """SELECT doc_id, subject, supplier_name, category, review_status, reviewer_notes,
  CAST(reviewed_at AS VARCHAR) AS reviewed_at FROM e""",
)
def few_shot_balanced(spark, sf):
    return _balanced(spark, sf)


_RECENT = """, e AS (SELECT d.doc_id, d.subject, d.file_name, d.is_deductible, d.review_status, d.updated_at,
  c.category_nme FROM docs d JOIN tax_cats c ON c.category_id = d.tax_category_id
  WHERE review_status IN ('CONFIRMED', 'REJECTED') ORDER BY updated_at DESC NULLS LAST, doc_id LIMIT 10)
"""


def _recent(spark, sf):
    return classify.few_shot_recent(frames.core_documents(spark, sf), seeds.tax_categories(spark))


@query(
    "few_shot_recent",
    with_frames("docs", "tax_cats")
    + _RECENT
    + """SELECT doc_id, subject, file_name, is_deductible, review_status,
  CAST(updated_at AS VARCHAR) AS updated_at, category_nme FROM e""",
)
def few_shot_recent(spark, sf):
    return _recent(spark, sf)


_BLOCK = """, l AS (SELECT review_status, n, '  - ' || concat_ws(' | ',
  CASE WHEN supplier_name <> '' THEN 'Supplier: ' || supplier_name END,
  CASE WHEN subject <> '' THEN 'Subject: ' || subject END,
  CASE WHEN review_status = 'CONFIRMED' AND category <> '' THEN 'Category: ' || category END,
  CASE WHEN reviewer_notes <> '' THEN 'Note: ' || reviewer_notes END) AS line FROM e),
b AS (SELECT 'Past decisions by a human reviewer — use these to calibrate your classification:' || chr(10) || chr(10)
  || coalesce('CONFIRMED (is_tax_relevant=true):' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY n)
     FROM l WHERE review_status = 'CONFIRMED') || chr(10) || chr(10), '')
  || coalesce('REJECTED (is_tax_relevant=false):' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY n)
     FROM l WHERE review_status = 'REJECTED') || chr(10) || chr(10), '') AS block)
"""


@query("few_shot_block", with_frames("docs", "tax_cats") + _EXAMPLES + _BLOCK + "SELECT block FROM b")
def few_shot_block(spark, sf):
    return classify.few_shot_block(_balanced(spark, sf))


@query(
    "few_shot_recent_block",
    with_frames("docs", "tax_cats")
    + _RECENT
    + """SELECT 'Here are recent examples of correctly classified documents:' || chr(10)
  || string_agg('- "' || coalesce(nullif(subject, ''), nullif(file_name, ''), 'unknown') || '" → ' || category_nme
  || ' (is_deductible: ' || CASE WHEN is_deductible THEN 'True' WHEN NOT is_deductible THEN 'False' ELSE 'None' END
  || ')', chr(10) ORDER BY updated_at DESC NULLS LAST, doc_id) || chr(10) || chr(10) AS block FROM e""",
)
def few_shot_recent_block(spark, sf):
    return classify.few_shot_recent_block(_recent(spark, sf))


@query(
    "prompt",
    with_frames("docs", "tax_cats")
    + _EXAMPLES
    + _BLOCK
    + """SELECT d.doc_id, instr(p, 'Document text:' || chr(10) || d.text) > 0 AS has_text,
  instr(p, (SELECT block FROM b)) > 0 AS has_block, length(p) AS chars
FROM (SELECT doc_id, text, (SELECT block FROM b) || 'Document text:' || chr(10) || text AS p
  FROM documents) d""",
)
def prompt(spark, sf):
    docs = frames.table(spark, sf, "documents").select("doc_id", "text")
    block = classify.few_shot_block(_balanced(spark, sf))
    rows = classify.prompts(docs, "text", block)
    task = F.regexp_extract("prompt", r"(?s)^(.*?line_items\.\n\n)", 1)
    tail = F.lit("\n\nCategories:\n" + "\n".join(seeds.path_map(seeds.DOCUMENT_PATHS)))
    middle = F.length("prompt") - F.length(task) - F.length(tail)
    return rows.select(
        "doc_id",
        F.col("prompt").contains(F.concat(F.lit("Document text:\n"), F.col("text"))).alias("has_text"),
        F.col("prompt").contains(block.scalar()).alias("has_block"),
        middle.cast("bigint").alias("chars"),
    )


@query(
    "bill_items_from_text",
    with_frames("bill")
    + """SELECT doc_id, x.* FROM bill, LATERAL (VALUES
  (1, 'Peak Usage', CAST(total_amount AS DOUBLE), 'kWh', 0.3524, CAST(total_amount AS DOUBLE)),
  (2, 'Solar Feed-In Credit', 95.3, 'kWh', 0.05, -CAST(total_amount AS DOUBLE)),
  (3, 'Daily Supply Charge', 31.0, 'days', 0.9482, 29.39)) x(line_num, description, quantity, unit, rate, amount)""",
)
def bill_items_from_text(spark, sf):
    total = F.col("total_amount").cast("string")
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Supplier "), "supplier_name"),
        F.concat(F.lit("Peak Usage  "), total, F.lit(" kWh @ $0.3524 = $"), total),
        F.concat(F.lit("Solar Feed-In Credit 95.3 kWh @ $0.0500 = -$"), total),
        F.lit("Daily Supply Charge 31 days @ 0.9482 = $29.39"),
        F.lit("Total due by the end of the month"),
    )
    return (
        frames.bills(spark, sf)
        .select("doc_id", F.posexplode(text.bill_lines(body)).alias("pos", "i"))
        .select("doc_id", (F.col("pos") + 1).alias("line_num"), "i.description", "i.quantity",
                "i.unit", "i.rate", "i.amount")
    )


# --- transactions ------------------------------------------------------------


@query(
    "txn_hash",
    with_frames("txn")
    + """SELECT txn_id, sha256(account_id || '|' || CAST(txn_date AS VARCHAR) || '|' || CAST(amount AS VARCHAR) || '|'
  || description_raw) AS dedup_hash FROM txn""",
)
def txn_hash(spark, sf):
    return frames.transactions(spark, sf).select(
        "txn_id",
        crypto.dedup_hash(
            F.col("account_id"), F.col("txn_date"), F.col("amount"), F.col("description_raw")
        ).alias("dedup_hash"),
    )


def _statement_rows(spark, sf):
    """Orders as raw statement rows in the three layouts."""
    total = F.col("o_totalprice").cast("decimal(12,2)")
    provider = F.element_at(
        F.array(F.lit("NAB"), F.lit("Bendigo"), F.lit("CommSec")),
        (F.col("o_orderkey") % 3 + 1).cast("int"),
    )
    single = F.col("o_orderkey") % 3 == 0
    day = F.when(single, F.date_format("o_orderdate", "d MMM yy")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    credit = F.col("o_orderstatus") == "F"
    dollars = F.concat(F.lit("$"), F.format_number(total, 2))
    return frames.table(spark, sf, "orders").select(
        F.concat(F.lit("file-"), F.col("o_orderkey") % 7).alias("source_file"),
        provider.alias("provider"),
        F.col("o_custkey").cast("int").alias("account_id"),
        F.col("o_orderkey").alias("row_num"),
        day.alias("txn_date_raw"),
        F.when(single, F.when(credit, dollars).otherwise(F.concat(F.lit("("), dollars, F.lit(")"))))
        .alias("amount_raw"),
        F.when(~single & ~credit, dollars).alias("debit_raw"),
        F.when(~single & credit, dollars).alias("credit_raw"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit("   shop ")).alias("description_raw"),
    )


_NORMAL = """, n AS (SELECT o_orderkey AS row_num, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS txn_date,
  CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(12,2)) AS amount,
  '  ' || o_orderpriority || '   shop ' AS description_raw, o_orderpriority || ' shop' AS description_clean,
  'file-' || o_orderkey % 7 AS source_file FROM orders),
h AS (SELECT *, sha256(account_id || '|' || CAST(txn_date AS VARCHAR) || '|' || CAST(amount AS VARCHAR) || '|'
  || description_raw) AS dedup_hash FROM n)
"""


@query(
    "statement_normalised",
    "WITH " + _NORMAL.lstrip(", ")
    + """SELECT row_num, CAST(account_id AS BIGINT) AS account_id, CAST(txn_date AS VARCHAR) AS txn_date,
  CAST(amount AS DOUBLE) AS amount, description_clean, dedup_hash FROM h""",
)
def statement_normalised(spark, sf):
    rows = transactions.normalise_transactions(
        _statement_rows(spark, sf), seeds.statement_providers(spark)
    )
    return rows.select(
        "row_num", "account_id", "txn_date", "amount", "description_clean", "dedup_hash"
    )


@query(
    "statement_rejects",
    """SELECT o_orderkey AS row_num, CASE WHEN o_orderkey % 3 = 0 THEN 'txn_date,amount' ELSE 'txn_date' END AS reasons
FROM orders WHERE o_orderkey % 11 = 0""",
)
def statement_rejects(spark, sf):
    """Rows of a provider nobody knows cannot be read; they are reported with the reasons."""
    unknown = F.when(F.col("row_num") % 11 == 0, F.lit("Other Bank")).otherwise(F.col("provider"))
    rows = transactions.normalise_transactions(
        _statement_rows(spark, sf).withColumn("provider", unknown),
        seeds.statement_providers(spark),
    )
    return transactions.rejected_rows(rows).select(
        "row_num", F.array_join("reasons", ",").alias("reasons")
    )


@query(
    "transactions_new",
    "WITH " + _NORMAL.lstrip(", ")
    + """SELECT dedup_hash, CAST(account_id AS BIGINT) AS account_id, CAST(txn_date AS VARCHAR) AS txn_date,
  CAST(amount AS DOUBLE) AS amount, min(source_file) AS source_file, count(*) AS occurrences FROM h
WHERE dedup_hash NOT IN (SELECT dedup_hash FROM h WHERE row_num % 10 = 0) GROUP BY ALL""",
)
def transactions_new(spark, sf):
    raw = _statement_rows(spark, sf)
    rows = transactions.normalise_transactions(
        raw.unionByName(raw.filter("row_num % 4 = 1")).drop_duplicates(["row_num"]),
        seeds.statement_providers(spark),
    )
    known = rows.filter("row_num % 10 = 0").select("dedup_hash").distinct()
    return transactions.new_transactions(known, rows).select(
        "dedup_hash", "account_id", "txn_date", "amount", "source_file", "occurrences"
    )


@query(
    "account_watermark",
    "WITH " + _NORMAL.lstrip(", ")
    + """, a AS (SELECT account_id, max(txn_date) AS d, arg_max(source_file, (txn_date, source_file)) AS f
  FROM h GROUP BY 1),
m AS (SELECT c_custkey AS account_id, DATE '1999-06-30' AS d, 'old' AS f FROM customer WHERE c_custkey % 2 = 0)
SELECT CAST(account_id AS BIGINT) AS account_id, CAST(greatest(m.d, a.d) AS VARCHAR) AS last_txn_date,
  CASE WHEN a.d IS NOT NULL AND coalesce(a.d >= m.d, true) THEN a.f ELSE m.f END AS last_file_nme
FROM m FULL JOIN a USING (account_id)""",
)
def account_watermark(spark, sf):
    rows = transactions.normalise_transactions(
        _statement_rows(spark, sf), seeds.statement_providers(spark)
    )
    marks = frames.table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").cast("int").alias("account_id"),
        F.lit("1999-06-30").cast("date").alias("last_txn_date"),
        F.lit("old").alias("last_file_nme"),
        F.lit("1999-07-01").cast("timestamp").alias("last_loaded_at"),
    )
    now = F.lit("2002-01-01").cast("timestamp")
    return transactions.advance_watermark(marks, rows, now).drop("last_loaded_at")


@query(
    "share_merge",
    """WITH t AS (SELECT CAST(l_suppkey AS INT) AS account_id, CAST(l_shipdate AS DATE) AS trade_date,
  'P' || l_partkey AS security_code, CAST(l_quantity AS DECIMAL(15,4)) AS quantity,
  CAST(l_extendedprice / l_quantity AS DECIMAL(12,4)) AS price, CAST(l_extendedprice AS DECIMAL(15,2)) AS value,
  CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'OTHER' END AS trade_type FROM lineitem)
SELECT dedup_hash, count(*) AS occurrences, CAST(min(value) AS DOUBLE) AS value,
  any_value(trade_type = 'SELL') AS cgt_event,
  any_value(CASE WHEN month(trade_date) >= 7 THEN year(trade_date) + 1 ELSE year(trade_date) END) AS fy_year,
  CAST(min(CASE WHEN trade_type = 'BUY' THEN value + 9.95 END) AS DOUBLE) AS cost_base
FROM (SELECT *, sha256(account_id || '|' || CAST(trade_date AS VARCHAR) || '|' || security_code || '|'
  || CAST(quantity AS VARCHAR) || '|' || trade_type) AS dedup_hash FROM t WHERE account_id % 5 <> 0) GROUP BY 1""",
)
def share_merge(spark, sf):
    """Trades against a core that holds every fifth account already."""
    raw = frames.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("account_id"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("trade_date_raw"),
        F.concat(F.lit(" p"), "l_partkey").alias("security_raw"),
        F.col("l_quantity").cast("string").alias("quantity_raw"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(12,4)").cast("string").alias("price_raw"),
        F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(15,2)"), 2)).alias("value_raw"),
        F.when(F.col("l_returnflag") == "R", "sell").when(F.col("l_returnflag") == "A", "Buy")
        .otherwise("transfer").alias("trade_type_raw"),
        F.lit("9.95").alias("brokerage_raw"),
        F.lit("trades.csv").alias("source_file"),
    )
    rows = transactions.normalise_trades(raw)
    core = rows.filter("account_id % 5 = 0").select("dedup_hash").distinct()
    return transactions.new_trades(core, rows).select(
        "dedup_hash", "occurrences", "value", "cgt_event", "fy_year", "cost_base"
    )


# --- messages ----------------------------------------------------------------


def _message_json(spark, sf):
    """Documents as exported mail messages, PDF parts at several depths, down to sixty."""
    body = F.struct(
        F.lit("att").alias("attachmentId"), F.lit(None).cast("string").alias("data"),
        F.col("n_chars").alias("size"),
    )
    empty = F.struct(
        F.lit(None).cast("string").alias("attachmentId"), F.lit(None).cast("string").alias("data"),
        F.lit(0).cast("bigint").alias("size"),
    )
    slot = F.col("doc_id") % 4

    def part(name, mime, payload, parts=None):
        fields = [mime.alias("mimeType"), name.alias("filename"), payload.alias("body")]
        return F.struct(*fields, *([] if parts is None else [parts.alias("parts")]))

    def pdf(number):
        return F.concat(F.lit(f"{number}-"), "doc_id", F.lit(".PDF"))

    # Eight levels of multiparts around one file, and sixty in every fifth of them, as text:
    # the depth of the data is no schema.
    level = F.to_json(
        part(F.lit(""), F.lit("multipart/mixed"), empty, F.array(F.lit("@")))
    )
    opening, closing = F.substring_index(level, '"@"', 1), F.substring_index(level, '"@"', -1)
    leaf = F.to_json(part(pdf("deep"), F.lit("application/pdf"), body))
    levels = F.when(F.col("doc_id") % 20 == 1, 59).otherwise(7)
    deep = F.concat(F.repeat(opening, levels), leaf, F.repeat(closing, levels))
    flat = F.array(
        part(F.lit("note.txt"), F.lit("text/plain"), body),
        part(pdf("one"), F.lit("application/octet-stream"), body),
        part(pdf("two"), F.lit("application/pdf"), body),
        part(pdf("void"), F.lit("application/pdf"), empty),
    )
    unnamed = F.array(part(F.lit(""), F.lit("application/PDF"), body))
    headers = F.array(
        F.struct(F.lit("SUBJECT").alias("name"), F.concat(F.lit("Invoice "), "doc_id").alias("value")),
        F.struct(
            F.lit("from").alias("name"),
            F.when(slot == 1, F.concat("source", F.lit("@example.com")))
            .otherwise(F.concat(F.lit("Shop <"), "source", F.lit("@example.com>"))).alias("value"),
        ),
    )

    def message(parts, name):
        root = F.struct(
            F.lit("multipart/mixed").alias("mimeType"), name.alias("filename"), headers.alias("headers"),
            body.alias("body"), *([] if parts is None else [parts.alias("parts")]),
        )
        return F.to_json(
            F.struct(
                F.concat(F.lit("m"), "doc_id").alias("id"),
                (F.lit(1704067200000) + F.col("doc_id") * 3600000).cast("string").alias("internalDate"),
                F.col("lang").alias("snippet"),
                root.alias("payload"),
            )
        )

    return frames.table(spark, sf, "documents").select(
        F.when(slot == 0, message(flat, F.lit("")))
        .when(slot == 1, F.replace(message(F.array(F.lit("@")), F.lit("")), F.lit('"@"'), deep))
        .when(slot == 2, message(unnamed, F.lit("")))
        .otherwise(message(None, pdf("root")))
        .alias("json")
    )


_SENT = "TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id)"


@query(
    "flatten_messages",
    f"""SELECT 'GMAIL' AS source_type, 'm' || doc_id AS source_id, 'Invoice ' || doc_id AS subject,
  source || '@example.com' AS sender_email, CAST({_SENT} AS VARCHAR) AS received_at,
  p || '-' || doc_id || '.PDF' AS file_name, 'pdf' AS file_ext, n_chars AS file_size_bytes
FROM (SELECT *, unnest(CASE doc_id % 4 WHEN 0 THEN ['one', 'two'] WHEN 1 THEN ['deep'] WHEN 2 THEN []
  ELSE ['root'] END) AS p FROM documents)""",
)
def flatten_messages(spark, sf):
    parsed = messages.parse_messages(_message_json(spark, sf), "json")
    return messages.flatten_messages(parsed).drop("raw_json")


@query(
    "first_pdf",
    f"""SELECT 'GMAIL' AS source_type, 'm' || doc_id AS source_id, 'Invoice ' || doc_id AS subject,
  CASE WHEN doc_id % 4 = 1 THEN source || '@example.com' ELSE 'Shop <' || source || '@example.com>' END AS sender_email,
  CAST({_SENT} AS VARCHAR) AS received_at, f AS file_name, 'pdf' AS file_ext, CAST(NULL AS BIGINT) AS file_size_bytes,
  'm' || doc_id || '_' || f AS staged_name, false AS no_attachment
FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'one-' || doc_id || '.PDF' WHEN 1 THEN 'deep-' || doc_id || '.PDF'
  WHEN 2 THEN 'attachment.pdf' ELSE 'root-' || doc_id || '.PDF' END AS f FROM documents)""",
)
def first_pdf(spark, sf):
    return messages.first_pdf(messages.parse_messages(_message_json(spark, sf), "json"))


@query(
    "body_messages",
    f"""SELECT 'GMAIL' AS source_type, 'm' || doc_id AS source_id, 'Invoice ' || doc_id AS subject,
  source || '@example.com' AS sender_email, CAST({_SENT} AS VARCHAR) AS received_at, lang AS content_preview,
  length(lang) AS body_text_length FROM documents WHERE doc_id % 4 = 2""",
)
def body_messages(spark, sf):
    rows = messages.body_rows(messages.parse_messages(_message_json(spark, sf), "json"))
    return rows.drop("file_name", "file_ext", "file_size_bytes", "classifier_input")


@query(
    "select_window",
    f"""SELECT 'm' || doc_id AS source_id, CAST({_SENT} AS VARCHAR) AS received_at,
  printf('%s %d', CASE doc_id % 3 WHEN 0 THEN 'Tax note' WHEN 1 THEN 'Taxi ride' ELSE 'Your PAYSLIP' END, doc_id) AS subject
FROM documents WHERE {_SENT} >= TIMESTAMP '2024-01-05' AND {_SENT} < TIMESTAMP '2024-02-01'
AND doc_id % 3 <> 1""",
)
def select_window(spark, sf):
    word = F.element_at(
        F.array(F.lit("Tax note"), F.lit("Taxi ride"), F.lit("Your PAYSLIP")),
        (F.col("doc_id") % 3 + 1).cast("int"),
    )
    rows = frames.table(spark, sf, "documents").select(
        F.concat(F.lit("m"), "doc_id").alias("source_id"),
        F.timestamp_millis(F.lit(1704067200000) + F.col("doc_id") * 3600000).alias("received_at"),
        F.concat_ws(" ", word, F.col("doc_id").cast("string")).alias("subject"),
    )
    return messages.select_messages(
        rows, F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-31").cast("date"),
        F.col("subject"),
    )


@query(
    "select_since",
    f"""SELECT 'm' || doc_id AS source_id, CAST({_SENT} AS VARCHAR) AS received_at FROM documents
WHERE {_SENT} >= (SELECT max({_SENT}) - INTERVAL 3 DAY FROM documents) AND {_SENT} < TIMESTAMP '2024-02-10'""",
)
def select_since(spark, sf):
    rows = frames.table(spark, sf, "documents").select(
        F.lit("GMAIL").alias("source_type"),
        F.concat(F.lit("m"), "doc_id").alias("source_id"),
        F.timestamp_millis(F.lit(1704067200000) + F.col("doc_id") * 3600000).alias("received_at"),
    )
    mark = F.timestamp_millis(calendar.high_water_mark(rows).scalar())
    return messages.select_since(rows, mark, F.lit("2024-02-10").cast("date")).drop("source_type")
