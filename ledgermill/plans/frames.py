"""Warehouse-shaped frames over the given tables, and their SQL twins.

The tables are not tax data, so every query first projects the columns it needs
into the shape of the layer it works on. ``SQL`` holds the same projections as
common table expressions for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions.crypto import Pads
from ledgermill.operators import secrets
from ledgermill.schemas import LINE_ITEMS
from ledgermill.session import scratch_dir

# Financial years that cover the orders, and the document years.
ORDER_FY = (1995, 2002, 2001)
DOC_FY = (2023, 2026, 2025)

# Secret and key of the sample signatures and encrypted values.
SAMPLE_SECRET = "sample-signing-secret"
SAMPLE_KEY = "0123456789abcdef"


def sample_pads(spark: SparkSession) -> Pads:
    """The sample signing secret, kept in a table so that no plan holds it."""
    path = scratch_dir(spark, "secret")
    secrets.keep_secret(spark, path, SAMPLE_SECRET)
    return secrets.signing_pads(spark, path)


def sample_key(spark: SparkSession) -> Column:
    """The sample encryption key, kept in a table so that no plan holds it."""
    path = scratch_dir(spark, "secret")
    secrets.keep_secret(spark, path, SAMPLE_KEY)
    return secrets.encryption_key(spark, path)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def order_fy(spark: SparkSession) -> DataFrame:
    return seeds.fy_periods(spark, *ORDER_FY)


def doc_fy(spark: SparkSession) -> DataFrame:
    return seeds.fy_periods(spark, *DOC_FY)


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as bank transactions."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS txn_id",
        "o_custkey AS account_id",
        "CAST(o_orderdate AS DATE) AS txn_date",
        "CAST(CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' "
        "THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(12,2)) AS amount",
        "concat(o_orderpriority, ' order ', o_orderstatus) AS description_raw",
        "concat(o_orderpriority, ' order ', o_orderstatus) AS description_clean",
        "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL "
        "ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS category_id",
        "o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_deductible",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS deductible_amount",
        "o_totalprice > 450000 AS is_anomaly",
        "CASE WHEN o_totalprice > 450000 THEN 'large amount' END AS anomaly_reason",
        "CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'PENDING' "
        "ELSE 'NEEDS_REVIEW' END AS review_status",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
    )


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as accounts."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS account_id",
        "c_name AS account_nme",
        "c_mktsegment AS provider",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'TRANSACTION' WHEN 'AUTOMOBILE' THEN "
        "'CREDIT_CARD' WHEN 'MACHINERY' THEN 'MORTGAGE' WHEN 'HOUSEHOLD' THEN 'SAVINGS' "
        "ELSE 'INVESTMENT' END AS account_type",
        "c_acctbal >= 0 AS is_active",
        "CAST(c_acctbal AS DECIMAL(12,2)) AS balance",
    )


def spending_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as spending categories; the first one is income."""
    return table(spark, sf, "region").selectExpr(
        "r_regionkey + 1 AS category_id",
        "r_name AS category_nme",
        "CASE WHEN r_regionkey > 2 THEN concat(r_name, ' misc') END AS subcategory_nme",
        "r_regionkey = 0 AS is_income",
        "r_regionkey = 1 AS is_deductible",
    )


def budgets(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as budget targets, unique per category, year and month."""
    return table(spark, sf, "nation").selectExpr(
        "n_regionkey + 1 AS category_id",
        "CAST(1996 + floor(n_nationkey / 12) AS INT) AS fy_year",
        "n_nationkey % 12 + 1 AS month_num",
        "CAST(100000 * (n_nationkey + 1) AS DECIMAL(10,2)) AS budget_amount",
    )


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as share trades."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS order_no",
        "l_linenumber AS line_no",
        "l_suppkey AS account_id",
        "concat('P', l_partkey) AS security_code",
        "CAST(l_shipdate AS DATE) AS trade_date",
        "CAST(l_quantity AS DECIMAL(15,4)) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(15,2)) AS value",
        "CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'DIVIDEND' END AS trade_type",
        "CAST(l_tax * 100 AS DECIMAL(10,2)) AS brokerage",
        "CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END AS cost_base",
        "l_returnflag = 'R' AS cgt_event",
    )


_DOC_COLUMNS = (
    "d.doc_id",
    "CASE d.doc_id % 3 WHEN 0 THEN 'GMAIL' WHEN 1 THEN 'FOLDER' ELSE 'MANUAL' END AS source_type",
    "concat('doc-', d.doc_id) AS source_id",
    "CASE WHEN d.doc_id % 11 <> 0 THEN {first_line} END AS subject",
    "concat(d.source, '@example.com') AS sender_email",
    "{received} AS received_at",
    "CASE WHEN d.doc_id % 10 <> 9 THEN CAST(2023 + d.doc_id % 5 AS SMALLINT) END AS fy_year",
    "concat(d.source, '-', d.doc_id % 5, '.pdf') AS file_name",
    "'pdf' AS file_ext",
    "d.n_chars AS file_size_bytes",
    "substr(d.text, 1, 500) AS content_preview",
    "CAST(1 + d.doc_id % 35 AS INT) AS tax_category_id",
    "CASE d.n_chars % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_deductible",
    "CAST(CAST(d.n_chars AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) "
    "AS deductible_amount",
    "CAST(CAST((d.n_chars * 37 + d.doc_id) % 1001 AS DECIMAL(4,0)) * "
    "CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(4,3)) AS confidence_score",
    "'rules' AS classification_model",
    "CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'CONFIRMED' WHEN l.toxic = 1 THEN 'REJECTED' "
    "WHEN l.quality = 0 THEN 'AUTO_REJECTED' "
    "WHEN (d.n_chars * 37 + d.doc_id) % 1001 >= 750 THEN 'AUTO_CONFIRMED' "
    "WHEN d.lang = 'en' THEN 'PENDING' ELSE 'NEEDS_REVIEW' END AS review_status",
    "CASE WHEN l.quality = 1 AND d.n_chars % 4 = 0 THEN concat('checked ', d.lang) END "
    "AS reviewer_notes",
    "1 + d.doc_id % 4 AS batch_id",
    "CASE WHEN d.n_chars % 13 <> 0 THEN d.source END AS supplier_name",
    "concat('A-', d.doc_id % 97) AS account_ref",
    "CAST(NULL AS {string}) AS supply_address",
    "CASE WHEN d.doc_id % 17 <> 0 THEN {document_date} END AS document_date",
    "CAST(NULL AS DATE) AS billing_start",
    "CAST(NULL AS DATE) AS billing_end",
    "CAST(CAST(d.n_chars AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) "
    "AS total_amount",
    "CAST(NULL AS DECIMAL(12,2)) AS gst_amount",
    "CAST(NULL AS {string}) AS filed_path",
    "CASE WHEN l.quality IS NOT NULL AND d.doc_id % 6 <> 0 THEN {received} + INTERVAL '30' DAY "
    "END AS reviewed_at",
    "{received} AS created_at",
    "CASE WHEN d.doc_id % 19 <> 0 THEN {received} + {updated_days} END AS updated_at",
)

# The few expressions the two engines spell differently.
_SPARK_WORDS = {
    "string": "STRING",
    "first_line": "substring_index(d.text, '\\n', 1)",
    "received": "(TIMESTAMP'2022-06-30 00:00:00' + "
    "make_dt_interval(CAST(d.doc_id % 1500 AS INT), CAST(d.n_chars % 24 AS INT)))",
    "document_date": "date_add(DATE'2022-07-01', CAST(d.n_chars % 1400 AS INT))",
    "updated_days": "make_dt_interval(CAST(d.n_chars % 50 AS INT))",
}
_DUCK_WORDS = {
    "string": "VARCHAR",
    "first_line": "split_part(d.text, chr(10), 1)",
    "received": "(TIMESTAMP '2022-06-30 00:00:00' + to_days(CAST(d.doc_id % 1500 AS INT)) "
    "+ to_hours(d.n_chars % 24))",
    "document_date": "(DATE '2022-07-01' + CAST(d.n_chars % 1400 AS INT))",
    "updated_days": "to_days(CAST(d.n_chars % 50 AS INT))",
}


def _worded(columns: tuple[str, ...], words: dict[str, str]) -> list[str]:
    return [c.format(**words) for c in columns]


def _labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents").alias("d"), table(spark, sf, "labels").alias("l")
    return docs.join(labels, F.col("d.doc_id") == F.col("l.doc_id"), "left")


def core_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and their labels as core documents."""
    rows = _labelled_documents(spark, sf).selectExpr(*_worded(_DOC_COLUMNS, _SPARK_WORDS))
    return rows.withColumn("line_items", F.array().cast(LINE_ITEMS))


# The key of a landed document: equal texts of one language share it.
_LANDING_KEY = (
    "CASE d.lang WHEN 'en' THEN 'GMAIL' WHEN 'de' THEN 'FOLDER' ELSE 'MANUAL' END AS source_type",
    "md5(d.text) AS source_id",
)


def merged_core(spark: SparkSession, sf: str) -> DataFrame:
    """Existing core for the merge: the first labelled document of every landing key."""
    docs, labels = table(spark, sf, "documents").alias("d"), table(spark, sf, "labels").alias("l")
    first = (
        docs.join(labels, F.col("d.doc_id") == F.col("l.doc_id"))
        .selectExpr(*_LANDING_KEY, "d.doc_id AS first_id")
        .groupBy("source_type", "source_id")
        .agg(F.min("first_id").alias("first_id"))
    )
    rows = core_documents(spark, sf).drop("source_type", "source_id")
    columns = core_documents(spark, sf).columns
    return rows.join(first, F.col("doc_id") == F.col("first_id")).select(*columns)


# Classification texts of landed documents, some of them unreadable on purpose.
_CLASSIFICATION_TEXTS = {
    "cls_category": "CASE d.doc_id % 5 WHEN 0 THEN 'Donations' WHEN 1 THEN 'Bank Interest' "
    "WHEN 2 THEN 'Technology Equipment' WHEN 3 THEN 'Other' END",
    "cls_fy_year": "CASE d.doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1999' "
    "ELSE CAST(2023 + d.doc_id % 4 AS {string}) END",
    "cls_deductible": "CASE WHEN d.doc_id % 40 = 6 THEN 'perhaps' WHEN d.doc_id % 2 = 0 THEN 'true' "
    "WHEN d.doc_id % 3 = 0 THEN 'false' END",
    "cls_amount": "CASE d.doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE "
    "CAST(CAST(CAST(d.n_chars AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) "
    "AS {string}) END",
    "cls_confidence": "CASE d.doc_id % 40 WHEN 7 THEN 'abc' WHEN 8 THEN '1.2' WHEN 9 THEN '' "
    "WHEN 10 THEN NULL ELSE CAST(CAST(CAST((d.n_chars * 37) % 1001 AS DECIMAL(4,0)) * "
    "CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(4,3)) AS {string}) END",
    "cls_date": "CASE d.doc_id % 7 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '' WHEN 2 THEN 'null' "
    "WHEN 3 THEN '2024-05' WHEN 4 THEN '5 Mar 2024' ELSE '2024-02-29' END",
    "cls_supplier": "CASE WHEN d.doc_id % 4 = 0 THEN '' ELSE d.source END",
}

_LANDING_COLUMNS = (
    "d.doc_id + 1 AS landing_id",
    "1 + d.doc_id % 4 AS batch_id",
    "CASE WHEN d.doc_id % 50 <> 49 THEN " + _LANDING_KEY[0].split(" AS ")[0] + " END AS source_type",
    "CASE WHEN d.doc_id % 50 <> 48 THEN md5(d.text) END AS source_id",
    "CASE WHEN d.doc_id % 11 <> 0 THEN {first_line} END AS subject",
    "concat(d.source, '@example.com') AS sender_email",
    "{received} AS received_at",
    "CASE WHEN d.doc_id % 7 <> 0 THEN concat(d.source, '-', d.doc_id % 5, '.pdf') END AS file_name",
    "'pdf' AS file_ext",
    "CASE WHEN d.doc_id % 23 <> 0 THEN d.n_chars END AS file_size_bytes",
    "CASE WHEN d.doc_id % 13 <> 0 THEN substr(d.text, 1, 500) END AS content_preview",
    "{received} AS loaded_at",
    "d.doc_id % 5 = 4 AS is_processed",
)


def landing_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as landing rows with the classification still in separate columns."""
    extra = [f"{sql} AS {name}" for name, sql in _CLASSIFICATION_TEXTS.items()]
    return table(spark, sf, "documents").alias("d").selectExpr(
        *_worded(_LANDING_COLUMNS, _SPARK_WORDS),
        *_worded(tuple(extra), _SPARK_WORDS),
        "md5(d.text) AS file_hash",
        "d.doc_id % 9 = 0 AS bare",
    )


def landing_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as landing rows; ``raw_json`` is real JSON text."""
    rows = landing_parts(spark, sf)
    classification = F.struct(
        F.col("cls_category").alias("category"),
        F.col("cls_fy_year").alias("fy_year"),
        F.col("cls_deductible").alias("is_deductible"),
        F.col("cls_amount").alias("deductible_amount"),
        F.col("cls_confidence").alias("confidence"),
        F.col("cls_date").alias("document_date"),
        F.col("cls_supplier").alias("supplier_name"),
    )
    head = [F.col("file_hash"), F.concat(F.lit("box/"), "file_hash").alias("filed_path")]
    bare = F.to_json(F.struct(*head))
    full = F.to_json(F.struct(*head, classification.alias("classification")))
    return rows.withColumn("raw_json", F.when(F.col("bare"), bare).otherwise(full)).drop(
        *_CLASSIFICATION_TEXTS, "file_hash", "bare"
    )


_BILL_COLUMNS = (
    "o_orderkey AS doc_id",
    "concat('order-', o_orderkey) AS source_id",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 6 WHEN o_orderpriority = '2-HIGH' THEN 5 "
    "ELSE 20 END AS tax_category_id",
    "concat('Supplier ', o_custkey % 20) AS supplier_name",
    "concat('A-', o_custkey) AS account_ref",
    "CASE WHEN o_orderkey % 50 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END "
    "AS billing_start",
    "CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount",
    "CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'AUTO_CONFIRMED' "
    "ELSE 'NEEDS_REVIEW' END AS review_status",
    "CAST(CAST(o_orderkey % 1001 AS DECIMAL(4,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(4,3)) "
    "AS confidence_score",
)


def bills(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as utility bills; the items come from JSON text, as they are stored."""
    from ledgermill.plans.marts import line_items_from_json

    price = "CAST(o_totalprice AS DECIMAL(12,2))"
    item = (
        "named_struct('description', {d}, 'period', CAST(NULL AS STRING), 'quantity', {q}, "
        "'unit', {u}, 'rate', '0.2500', 'amount', {a})"
    )
    items = ", ".join(
        [
            item.format(d="'Peak Usage'", q=f"CAST({price} AS STRING)", u="'kWh'",
                        a=f"CAST({price} AS STRING)"),
            item.format(d="'Solar Feed-In Credit'", q="''", u="'kWh'",
                        a=f"CAST(-{price} AS STRING)"),
            item.format(d="'Daily Supply Charge'", q="'31'", u="'days'", a="'29.39'"),
        ]
    )
    json = (
        f"CASE WHEN o_orderkey % 7 = 0 THEN '[]' WHEN o_orderkey % 7 = 1 THEN 'null' "
        f"WHEN o_orderkey % 7 = 2 THEN NULL ELSE to_json(array({items})) END AS items_json"
    )
    rows = table(spark, sf, "orders").selectExpr(
        *_BILL_COLUMNS, "CAST(o_orderdate AS TIMESTAMP) AS created_at",
        "CAST(o_orderdate AS DATE) AS document_date",
        "CAST(1996 + o_orderkey % 8 AS SMALLINT) AS fy_year", json,
    )
    return (
        rows.withColumn("line_items", line_items_from_json(F.col("items_json")))
        .withColumn("billing_end", F.last_day("billing_start"))
        .withColumn("subject", F.lit(None).cast("string"))
        .withColumn("supply_address", F.lit(None).cast("string"))
        .withColumn("gst_amount", F.lit(None).cast("decimal(12,2)"))
        .withColumn("filed_path", F.lit(None).cast("string"))
        .drop("items_json")
    )


def _duck_fy(name: str, first: int, last: int, current: int) -> str:
    return (
        f"{name} AS (SELECT CAST(y AS INT) AS fy_year, 'FY' || y AS fy_label, "
        f"make_date(y - 1, 7, 1) AS start_date, make_date(y, 6, 30) AS end_date, "
        f"y = {current} AS is_current FROM range({first}, {last + 1}) t(y))"
    )


def _duck_values(name: str, block: str, columns: str) -> str:
    rows = ", ".join(
        "(" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in row) + ")"
        for row in seeds.rows_of(block)
    )
    return f"{name} AS (SELECT * FROM (VALUES {rows}) v({columns}))"


def _listing(columns) -> str:
    return ", ".join(columns)


SQL = {
    "order_fy": _duck_fy("order_fy", *ORDER_FY),
    "doc_fy": _duck_fy("doc_fy", *DOC_FY),
    "txn": """txn AS (SELECT o_orderkey AS txn_id, o_custkey AS account_id,
  CAST(o_orderdate AS DATE) AS txn_date,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F'
       THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(12,2)) AS amount,
  o_orderpriority || ' order ' || o_orderstatus AS description_raw,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
       ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS category_id,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_deductible,
  CAST(o_totalprice AS DECIMAL(10,2)) AS deductible_amount,
  o_totalprice > 450000 AS is_anomaly, o_orderstatus, o_orderpriority, o_orderdate FROM orders)""",
    "acct": """acct AS (SELECT c_custkey AS account_id, c_name AS account_nme,
  c_mktsegment AS provider, CASE c_mktsegment WHEN 'BUILDING' THEN 'TRANSACTION'
  WHEN 'AUTOMOBILE' THEN 'CREDIT_CARD' WHEN 'MACHINERY' THEN 'MORTGAGE'
  WHEN 'HOUSEHOLD' THEN 'SAVINGS' ELSE 'INVESTMENT' END AS account_type,
  c_acctbal >= 0 AS is_active, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer)""",
    "cats": """cats AS (SELECT r_regionkey + 1 AS category_id, r_name AS category_nme,
  CASE WHEN r_regionkey > 2 THEN r_name || ' misc' END AS subcategory_nme,
  r_regionkey = 0 AS is_income, r_regionkey = 1 AS is_deductible FROM region)""",
    "budget": """budget AS (SELECT n_regionkey + 1 AS category_id,
  1996 + n_nationkey // 12 AS fy_year, n_nationkey % 12 + 1 AS month_num,
  CAST(100000 * (n_nationkey + 1) AS DECIMAL(10,2)) AS budget_amount FROM nation)""",
    "trade": """trade AS (SELECT l_orderkey AS order_no, l_linenumber AS line_no,
  'P' || l_partkey AS security_code, CAST(l_shipdate AS DATE) AS trade_date,
  CAST(l_quantity AS DECIMAL(15,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS value,
  CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'DIVIDEND' END AS trade_type,
  CAST(l_tax * 100 AS DECIMAL(10,2)) AS brokerage,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END AS cost_base,
  l_returnflag = 'R' AS cgt_event FROM lineitem)""",
    "docs": "docs AS (SELECT "
    + _listing(_worded(_DOC_COLUMNS, _DUCK_WORDS))
    + " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
    "landing": "landing AS (SELECT "
    + _listing(_worded(_LANDING_COLUMNS, _DUCK_WORDS))
    + ", "
    + _listing(
        f"{sql.format(**_DUCK_WORDS)} AS {name}" for name, sql in _CLASSIFICATION_TEXTS.items()
    )
    + ", md5(d.text) AS file_hash, d.doc_id % 9 = 0 AS bare FROM documents d)",
    "core": "core AS (SELECT c.* EXCLUDE (source_type, source_id), k.source_type, k.source_id "
    "FROM docs c JOIN (SELECT source_type, source_id, min(doc_id) AS first_id FROM (SELECT "
    + _listing(_LANDING_KEY)
    + ", d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id) "
    "GROUP BY ALL) k ON c.doc_id = k.first_id)",
    "bill": "bill AS (SELECT " + _listing(_BILL_COLUMNS) + ", o_orderkey, "
    "CAST(1996 + o_orderkey % 8 AS INT) AS fy_year, CAST(o_orderdate AS DATE) AS document_date "
    "FROM orders)",
    "tax_cats": _duck_values(
        "tax_cats_text", seeds.TAX_CATEGORIES,
        "id, category_nme, category_grp, description, deductible, ato_reference, so",
    )
    + ", tax_cats AS (SELECT CAST(id AS INT) AS category_id, category_nme, category_grp, "
    "deductible = 'true' AS is_deductible, ato_reference, CAST(so AS INT) AS sort_order "
    "FROM tax_cats_text)",
}


def with_frames(*names: str) -> str:
    """``WITH`` clause of the named frames."""
    return "WITH " + ",\n".join(SQL[name] for name in names)
