"""File readers and streams: inputs are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.operators import archive, landing, runlog, transactions
from ledgermill.operators.snapshots import SnapshotTable
from ledgermill.plans import frames, portal
from ledgermill.plans.frames import sample_pads, with_frames
from ledgermill.plans.queries_docs import QUARANTINE_SQL, _INCOMING, _archive_docs
from ledgermill.plans.queries_mart import tax_report
from ledgermill.plans.queries_review import ACTIONS_SQL, review_actions
from ledgermill.plans.registry import ORACLES, query
from ledgermill.schemas import RUN_LOG
from ledgermill.session import scratch_dir
from ledgermill.sources import files, statements
from ledgermill.streaming import ingest

# --- statement files ---------------------------------------------------------


def _signed_total():
    total = F.col("o_totalprice").cast("decimal(12,2)")
    return F.when(F.col("o_orderstatus") == "F", total).otherwise(-total)


def _bank_csv(spark, sf, folder):
    """Orders as a signed-amount statement export."""
    frames.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "d MMM yy").alias("Date"),
        _signed_total().cast("string").alias("Amount"),
        F.col("o_orderkey").alias("Account Number"),
        F.col("o_orderstatus").alias("Transaction Type"),
        F.concat(F.lit("Order "), "o_orderkey", F.lit(", "), "o_orderpriority").alias(
            "Transaction Details"
        ),
        F.lit("0.00").alias("Balance"),
        F.lit("shop").alias("Category"),
        F.lit("").alias("Merchant Name"),
        F.lit("").alias("Processed On"),
    ).write.option("header", "true").csv(folder)


def _layout_csv(spark, sf, folder, provider: str, remainder: int) -> None:
    """A third of the orders in a provider's layout, descriptions quoted over two lines."""
    orders = frames.table(spark, sf, "orders").where(F.col("o_orderkey") % 3 == remainder)
    text = F.concat(F.lit("Order "), "o_orderkey", F.lit(",\n"), "o_orderpriority")
    if provider == "nab":
        columns = [
            F.date_format("o_orderdate", "d MMM yy").alias("Date"),
            _signed_total().cast("string").alias("Amount"),
            text.alias("Transaction Details"),
        ]
    else:
        paid = F.col("o_orderstatus") != "F"
        total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
        columns = [
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
            F.when(paid, total).alias("Debit"),
            F.when(~paid, total).alias("Credit"),
            text.alias("Description"),
        ]
    orders.select(*columns, F.lit("0.00").alias("Balance")).write.option("header", "true").csv(
        folder
    )


_STATEMENT_SQL = """SELECT {columns}CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS txn_date,
  CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DOUBLE) AS amount,
  'Order ' || o_orderkey || ', ' || o_orderpriority AS description_clean FROM orders"""


@query(
    "statement_read",
    _STATEMENT_SQL.format(columns="'NAB' AS provider, CAST(o_orderkey AS VARCHAR) AS account_text, "),
)
def statement_read(spark, sf):
    folder = scratch_dir(spark, "statements")
    _bank_csv(spark, sf, folder)
    rows = statements.read_statement(spark, folder, F.lit(1))
    typed = transactions.normalise_transactions(rows, seeds.statement_providers(spark))
    return typed.select(
        "provider",
        F.get_json_object("raw_json", "$['Account Number']").alias("account_text"),
        "txn_date",
        "amount",
        "description_clean",
    )


@query(
    "statement_read_split",
    _STATEMENT_SQL.format(
        columns="CASE o_orderkey % 3 WHEN 0 THEN 'NAB' WHEN 1 THEN 'Bendigo' ELSE 'CommSec' END "
        "AS provider, "
    ),
)
def statement_read_split(spark, sf):
    """The three layouts, told apart by file names, in one folder."""
    folder = scratch_dir(spark, "statements")
    for provider, remainder in (("nab", 0), ("bendigo", 1), ("commsec", 2)):
        _layout_csv(spark, sf, f"{folder}/{provider}", provider, remainder)
    typed = None
    for provider in ("nab", "bendigo", "commsec"):
        rows = statements.read_statement(
            spark, f"{folder}/{provider}", F.lit(1), file_name=F.lit(f"{provider}.csv")
        )
        typed = rows if typed is None else typed.unionByName(rows)
    typed = transactions.normalise_transactions(typed, seeds.statement_providers(spark))
    return typed.select("provider", "txn_date", "amount", "description_clean")


@query(
    "share_read",
    """SELECT 'P' || l_partkey AS security_code, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trade_date, l_quantity AS quantity,
  l_extendedprice AS value, CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'DIVIDEND' END AS trade_type
FROM lineitem""",
)
def share_read(spark, sf):
    folder = scratch_dir(spark, "trades")
    kind = (
        F.when(F.col("l_returnflag") == "R", "Sell")
        .when(F.col("l_returnflag") == "A", "Buy")
        .otherwise("Dividend")
    )
    price = (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(12,4)")
    frames.table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Trade Date"),
        F.concat(F.lit("p"), "l_partkey").alias("Security"),
        F.col("l_quantity").alias("Quantity"),
        price.alias("Price"),
        F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(15,2)"), 2)).alias("Value"),
        kind.alias("Type"),
        F.lit("9.95").alias("Brokerage"),
    ).write.option("header", "true").csv(folder)
    rows = transactions.normalise_trades(statements.read_share_trades(spark, folder, F.lit(4)))
    return rows.select("security_code", "trade_date", "quantity", "value", "trade_type")


# Files of a fixed content: one line per text of a part, in order.
_FILES_SQL = """parts AS (SELECT doc_id % 16 AS p,
  string_agg('x' || hex(encode(text)), chr(10) ORDER BY doc_id) || chr(10) AS body FROM documents GROUP BY 1),
files AS (SELECT sha256(body) AS file_hash, length(body) AS file_size_bytes FROM parts)"""


# Shuffle files go when the write that needed them has ended.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _drop_documents(spark, sf, folder: str, extension: str) -> None:
    """Write the documents as sixteen files of a type, one below each part's folder."""
    docs = frames.table(spark, sf, "documents").select(
        (F.col("doc_id") % 16).alias("p"), "doc_id", "text"
    )
    # A task per part: hashed parts would share some tasks. Texts are spelt out behind the shuffle.
    own = F.coalesce(F.pmod("p", F.lit(16)), F.lit(0)).cast("int")
    parts = docs.repartitionById(16, own).sortWithinPartitions("p", "doc_id").select(
        "p", F.concat(F.lit("x"), F.hex("text")).alias("line")
    )
    out = parts.write.mode("append").partitionBy("p")
    # The texts that were shuffled are not read again, so they need not stay beside the files.
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        out.option("extension", extension).csv(folder)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


@query(
    "staging_scan",
    f"""WITH {_FILES_SQL}
SELECT 'pdf' AS file_ext, 2 * count(*) AS files, count(DISTINCT file_hash) AS contents,
  CAST(2 * sum(file_size_bytes) AS BIGINT) AS bytes, md5(string_agg(file_hash, ',' ORDER BY file_hash)) AS digest FROM files
UNION ALL SELECT 'csv', count(*), NULL, NULL, NULL FROM files""",
)
def staging_scan(spark, sf):
    """Two copies of every file, and as many of a type that is refused."""
    folder = scratch_dir(spark, "staging")
    # The documents are shuffled and sorted for one set of files; the others are copies of it.
    _drop_documents(spark, sf, folder, "pdf")
    files.copy_staging(spark, folder, ("pdf", "csv"))
    # A small chunk, so that every file is read in many.
    found = files.scan_staging(spark, folder, chunk_bytes=4096, recursive=True)
    kept = found.groupBy("file_ext").agg(
        F.count(F.lit(1)).alias("files"),
        F.countDistinct("file_hash").alias("contents"),
        F.sum("file_size_bytes").alias("bytes"),
        F.md5(F.array_join(F.array_sort(F.collect_set("file_hash")), ",")).alias("digest"),
    )
    refused = files.unsupported_files(spark, folder, recursive=True).select(
        "file_ext", "files", F.lit(None).cast("bigint").alias("contents"),
        F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("string").alias("digest"),
    )
    return kept.unionByName(refused)


# --- streams -----------------------------------------------------------------


@query(
    "stream_ingest",
    f"""WITH {_FILES_SQL}
SELECT 'pdf' AS file_ext, file_hash, file_size_bytes, 0 AS epoch FROM files""",
)
def stream_ingest(spark, sf):
    """New files of a drop folder; a second run over copies of them adds nothing."""
    folder, base = scratch_dir(spark, "drop"), scratch_dir(spark, "ingest")
    for _ in range(2):
        _drop_documents(spark, sf, folder, "pdf")
        ingest.ingest_files(spark, f"{folder}/*", f"{base}/landing", f"{base}/checkpoint")
    landed = ingest.read_epochs(spark, f"{base}/landing", ingest.STAGED_FILE)
    return landed.select("file_ext", "file_hash", "file_size_bytes", "epoch")


@query(
    "stream_rows",
    """SELECT o_orderkey AS txn_id, o_custkey AS account_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS txn_date,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DOUBLE)
  AS amount FROM orders""",
)
def stream_rows(spark, sf):
    """Statement rows dropped in two overlapping parts land once."""
    folder, base = scratch_dir(spark, "rows"), scratch_dir(spark, "rows-landing")
    schema = "txn_id BIGINT, account_id BIGINT, txn_date DATE, amount DECIMAL(12,2)"
    rows = frames.transactions(spark, sf).select("txn_id", "account_id", "txn_date", "amount")
    for part in ("txn_id % 3 <> 0", "txn_id % 3 <> 1"):
        rows.filter(part).write.mode("append").option("header", "true").csv(folder)
        stream = spark.readStream.schema(schema).option("header", "true").csv(folder)
        ingest.ingest_rows(stream, f"{base}/landing", f"{base}/checkpoint", ["txn_id"], schema)
    return ingest.read_epochs(spark, f"{base}/landing", schema).drop("epoch")


@query(
    "stream_dedupe",
    "SELECT source_type, source_id FROM (SELECT CASE lang WHEN 'en' THEN 'GMAIL' WHEN 'de' THEN 'FOLDER' "
    "ELSE 'MANUAL' END AS source_type, md5(text) AS source_id FROM documents) GROUP BY ALL "
    "UNION ALL SELECT 'LATE', 'item-' || item_id FROM benchmark WHERE item_id % 2 = 0",
)
def stream_dedupe(spark, sf):
    """Mail of a day, then late mail: copies are dropped, two days are kept, four days refused."""
    base = scratch_dir(spark, "mail")
    day = "TIMESTAMP'2024-01-05 00:00:00'"
    mail = frames.table(spark, sf, "documents").alias("d").selectExpr(
        *frames._LANDING_KEY,
        f"{day} + make_dt_interval(0, 0, CAST(d.doc_id % 1440 AS INT)) AS received_at",
    )
    again = mail.withColumn("received_at", F.expr("received_at - INTERVAL '1' DAY"))
    late = frames.table(spark, sf, "benchmark").selectExpr(
        "'LATE' AS source_type",
        "concat('item-', item_id) AS source_id",
        f"{day} - make_dt_interval(CAST(IF(item_id % 2 = 0, 2, 4) AS INT)) AS received_at",
    )
    for batch in (mail, again.unionByName(late)):
        batch.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(mail.schema).parquet(f"{base}/in")
        once = ingest.dedupe_late(stream, ["source_type", "source_id"])
        run = (
            once.writeStream.format("parquet")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/out")
        )
        run.awaitTermination()
    return spark.read.schema(mail.schema).parquet(f"{base}/out").select(
        "source_type", "source_id"
    )


# Rows of one key arrive in one batch here, so the result does not depend on file order.
@query(
    "stream_merge",
    with_frames("landing", "docs", "core", "doc_fy", "tax_cats")
    + _INCOMING
    + """SELECT source_type, source_id, file_name, CAST(new_fy AS BIGINT) AS fy_year, CAST(cat AS BIGINT) AS tax_category_id,
  CAST(coalesce(conf, 0) AS DOUBLE) AS confidence_score, status AS review_status, supplier AS supplier_name FROM inc""",
)
def stream_merge(spark, sf):
    base = _drained(spark, sf)
    return ingest.read_core(spark, f"{base}/core").select(
        "source_type", "source_id", "file_name", "fy_year", "tax_category_id", "confidence_score",
        "review_status", "supplier_name",
    )


@query("stream_quarantine", QUARANTINE_SQL)
def stream_quarantine(spark, sf):
    """What the stream could not merge, from the quarantine of its batches."""
    base = _drained(spark, sf)
    return ingest.read_rejects(spark, f"{base}/core-rejects").select(
        "landing_id", F.array_join("reasons", ",").alias("reasons")
    )


def _drained(spark, sf) -> str:
    """Stream the landing queue into core; returns the folder it lies in."""
    base = scratch_dir(spark, "queue")
    queued = frames.landing_documents(spark, sf)
    queued.repartition(4, "source_type", "source_id").write.parquet(f"{base}/landing")
    stream = (
        spark.readStream.schema(queued.schema)
        .option("maxFilesPerTrigger", "2")
        .parquet(f"{base}/landing")
    )
    ingest.drain_queue(
        stream, f"{base}/core", f"{base}/checkpoint", frames.doc_fy(spark),
        seeds.tax_categories(spark),
    )
    return base


@query(
    "stream_actions",
    f"WITH {ACTIONS_SQL} SELECT doc_id, action, CAST(action_ts AS VARCHAR) AS action_ts FROM first",
)
def stream_actions(spark, sf):
    base = scratch_dir(spark, "actions")
    actions = review_actions(spark, sf)
    actions.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(actions.schema).parquet(f"{base}/in")
    ingest.log_decisions(stream, f"{base}/decisions", f"{base}/checkpoint", sample_pads(spark))
    return ingest.read_decisions(spark, f"{base}/decisions").drop("token")


# --- sinks -------------------------------------------------------------------


@query(
    "append_counts",
    with_frames("landing")
    + """, k AS (SELECT source_type, source_id, coalesce(file_name, '') AS f, bool_or(is_processed) AS known,
  count(*) FILTER (NOT is_processed) AS offered FROM landing
  WHERE source_type IS NOT NULL AND source_id IS NOT NULL GROUP BY ALL),
c AS (SELECT count(*) FILTER (NOT known) + (SELECT count(*) FROM landing WHERE NOT is_processed
  AND (source_type IS NULL OR source_id IS NULL)) AS loaded FROM k)
SELECT loaded, (SELECT count(*) FROM landing WHERE NOT is_processed) - loaded AS skipped,
  loaded + (SELECT count(*) FROM landing WHERE is_processed) AS rows_after FROM c""",
)
def append_counts(spark, sf):
    """Append the new rows to a stored queue and read the counters of the write."""
    path = scratch_dir(spark, "landing")
    rows = frames.landing_documents(spark, sf)
    rows.filter("is_processed").write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    counts = landing.append_new(stored, rows.filter("NOT is_processed"), path)
    return spark.read.schema(rows.schema).parquet(path).agg(
        F.lit(counts["loaded"]).cast("bigint").alias("loaded"),
        F.lit(counts["skipped"]).cast("bigint").alias("skipped"),
        F.count(F.lit(1)).alias("rows_after"),
    )


@query("queue_reset", "SELECT count(*) AS rows_before, 0 AS rows_after FROM documents")
def queue_reset(spark, sf):
    """The explicit call that empties the whole queue."""
    path = scratch_dir(spark, "reset")
    rows = frames.landing_documents(spark, sf)
    rows.write.parquet(path)
    before = spark.read.schema(rows.schema).parquet(path).count()
    landing.reset_landing(rows, path)
    return spark.read.schema(rows.schema).parquet(path).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )


@query(
    "snapshot_merge",
    with_frames("docs")
    + "SELECT review_status, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS total FROM docs GROUP BY 1",
)
def snapshot_merge(spark, sf):
    """Write a version, write it again (no-op) and read the current one."""
    core = frames.core_documents(spark, sf).drop("line_items")
    schema = core.schema.toDDL()
    stored = SnapshotTable(spark, scratch_dir(spark, "core"), schema)
    stored.write(core.limit(0), "run-1")
    for _ in range(2):
        stored.write(core, "run-2", partition_by=["fy_year"])
    return stored.read().groupBy("review_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total")
    )


@query(
    "archive_written",
    "SELECT CASE WHEN doc_id % 10 <> 9 THEN (2022 + doc_id % 5) || '-' || (2023 + doc_id % 5) ELSE '2024-2025' END AS fy_dir, "
    "count(*) AS files FROM documents GROUP BY 1",
)
def archive_written(spark, sf):
    """Archive index laid out by year folder and category path."""
    path = scratch_dir(spark, "archive")
    index = archive.archive_index(
        _archive_docs(spark, sf), F.lit("2025-03-24 14:30:22").cast("timestamp")
    )
    archive.write_archive_index(index, path)
    return spark.read.parquet(path).groupBy("fy_dir").agg(F.count(F.lit(1)).alias("files"))


@query(
    "tax_report_markdown",
    "SELECT '| ' || section || ' | ' || label || ' | ' || coalesce(CAST(document_count AS VARCHAR), '') || ' | ' "
    f"|| coalesce(printf('%.2f', amount), '') || ' |' AS value FROM ({ORACLES['tax_report']})",
)
def tax_report_markdown(spark, sf):
    """The report written as JSON and Markdown; the Markdown lines are read back."""
    path = scratch_dir(spark, "report")
    portal.write_tax_report(tax_report(spark, sf), path)
    return spark.read.text(f"{path}/markdown")


@query(
    "run_log_written",
    "SELECT 'load' AS workflow_nme, 'SUCCESS' AS status, count(*) AS rows_extracted, "
    "count(DISTINCT text) AS rows_loaded, count(*) - count(DISTINCT text) AS rows_skipped FROM documents",
)
def run_log_written(spark, sf):
    """A run that is opened, counted and closed in a stored log."""
    path = scratch_dir(spark, "runs")
    batch = runlog.start_run(spark, path, "load", "queries")
    docs = frames.table(spark, sf, "documents").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("d")
    ).first()
    runlog.end_run(spark, path, batch, "load", "SUCCESS", docs["n"], docs["d"], docs["n"] - docs["d"])
    log = spark.read.schema(RUN_LOG).parquet(path)
    return runlog.latest_run(log, "load").select(
        "workflow_nme", "status", "rows_extracted", "rows_loaded", "rows_skipped"
    )
