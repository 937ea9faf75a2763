"""Streams with keyed state and streams that log their runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions.calendar import epoch_ms
from ledgermill.operators import checklist, runlog
from ledgermill.operators.buckets import BucketedLog
from ledgermill.operators.keys import first_per_key
from ledgermill.plans import frames
from ledgermill.plans.frames import sample_pads
from ledgermill.plans.queries_review import _ANSWERED, _answers, _responses
from ledgermill.plans.registry import query
from ledgermill.schemas import RUN_LOG
from ledgermill.session import scratch_dir
from ledgermill.streaming import ingest, runs

# --- checklist answers -------------------------------------------------------


@query(
    "stream_answers",
    _ANSWERED
    + """SELECT CAST(item_id AS BIGINT) AS item_id, CAST(fy_year AS BIGINT) AS fy_year, is_applicable,
  CAST(ts AS VARCHAR) AS responded_at FROM merged""",
)
def stream_answers(spark, sf):
    """Answers in three batches, the latest first, the last batch with replays of the first."""
    base = scratch_dir(spark, "answers")
    rows = _answers(spark, sf)
    for part in ("turn >= 3", "turn IN (0, 2)", "turn = 1 OR turn >= 3"):
        rows.filter(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        ingest.keep_answers(stream, f"{base}/last", f"{base}/checkpoint", sample_pads(spark))
    done = checklist.apply_last_answers(
        _responses(spark, sf),
        seeds.checklist_items(spark),
        ingest.read_answers(spark, f"{base}/last"),
    )
    return done.select("item_id", "fy_year", "is_applicable", "responded_at")


# --- a run that fails --------------------------------------------------------

_MAIL = "source_type STRING, source_id STRING, received_at TIMESTAMP"


@query(
    "stream_failed_run",
    """WITH mail AS (SELECT CASE lang WHEN 'en' THEN 'GMAIL' WHEN 'de' THEN 'FOLDER' ELSE 'MANUAL' END AS source_type,
  md5(text) AS source_id, TIMESTAMP '2022-06-30 00:00:00' + to_days(CAST(doc_id % 1500 AS INT))
  + to_hours(n_chars % 24) AS received_at FROM documents),
n AS (SELECT count(*) AS seen, count(DISTINCT (source_type, source_id)) AS kept, epoch_ms(max(received_at)) AS newest FROM mail)
SELECT run_no, status, CASE run_no WHEN 2 THEN seen ELSE 0 END AS rows_extracted,
  CASE run_no WHEN 2 THEN kept ELSE 0 END AS rows_loaded, CASE run_no WHEN 2 THEN seen - kept ELSE 0 END AS rows_skipped,
  status = 'FAILED' AS has_error, CASE run_no WHEN 1 THEN 0 ELSE kept END AS landed,
  CASE run_no WHEN 1 THEN NULL ELSE newest END AS mark
FROM n, (VALUES (1, 'FAILED'), (2, 'SUCCESS'), (3, 'SUCCESS')) AS r(run_no, status)""",
)
def stream_failed_run(spark, sf):
    """A run whose sink fails, the run after it that takes the same mail, and one without any."""
    base = scratch_dir(spark, "runs")
    mail = frames.landing_documents(spark, sf).select("received_at", "landing_id")
    keys = frames.table(spark, sf, "documents").alias("d").selectExpr(
        *frames._LANDING_KEY, "d.doc_id + 1 AS landing_id"
    )
    mail = keys.join(mail, "landing_id").select("source_type", "source_id", "received_at")
    mail.write.parquet(f"{base}/in")
    key = ["source_type", "source_id"]
    stream = spark.readStream.schema(mail.schema).parquet(f"{base}/in")
    landing = BucketedLog(spark, f"{base}/landing", _MAIL, key)

    def land(batch, epoch):
        log = BucketedLog(batch.sparkSession, f"{base}/landing", _MAIL, key)
        once = first_per_key(batch, key, [F.col("received_at").desc()])
        return runs.written(log.unknown(once, before=epoch), lambda rows: log.write(rows, epoch))

    def broken(batch, epoch):
        raise RuntimeError(f"the sink is down for {batch.count()} rows")

    def advance():
        newest = landing.read().agg(epoch_ms(F.max("received_at")).alias("mark"))
        runs.advance_mark(spark, f"{base}/mark", newest)

    states = []
    for number, write in enumerate((broken, land, land), 1):
        batch_id = runs.run_logged(
            stream, write, f"{base}/checkpoint", f"{base}/log", "mail", advance
        )
        mark = runs.current_mark(spark, f"{base}/mark")
        states.append((number, batch_id, landing.read().count(), mark))
    after = spark.createDataFrame(states, "run_no LONG, batch_id STRING, landed LONG, mark LONG")
    log = runlog.runs(spark.read.schema(RUN_LOG).parquet(f"{base}/log"))
    return log.join(after, "batch_id").select(
        "run_no", "status", "rows_extracted", "rows_loaded", "rows_skipped",
        F.col("error_msg").isNotNull().alias("has_error"), "landed", "mark",
    )
