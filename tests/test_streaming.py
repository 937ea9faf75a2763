from __future__ import annotations

import datetime
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgermill import schemas, seeds
from ledgermill.functions.crypto import review_token
from ledgermill.operators import merge, review
from ledgermill.streaming import ingest
from tests.rows import core, landing, values

T = datetime.datetime


def drop(folder, name, content):
    with open(os.path.join(folder, name), "wb") as handle:
        handle.write(content)


def test_only_new_contents_are_ingested(spark, folder):
    inbox, base = f"{folder}/in", f"{folder}/out"
    os.mkdir(inbox)

    def run():
        ingest.ingest_files(spark, inbox, f"{base}/landing", f"{base}/checkpoint")
        rows = ingest.read_epochs(spark, f"{base}/landing", ingest.STAGED_FILE)
        return [r[0] for r in values(rows, "file_name")]

    drop(inbox, "a.pdf", b"one")
    drop(inbox, "b.pdf", b"one")
    drop(inbox, "c.csv", b"no")
    assert run() == ["a.pdf"]
    drop(inbox, "d.pdf", b"two")
    drop(inbox, "e.pdf", b"one")
    assert run() == ["a.pdf", "d.pdf"]
    assert run() == ["a.pdf", "d.pdf"]


def write_landing(spark, path, rows):
    landing(spark, rows).coalesce(1).write.mode("append").parquet(path)


def queue_stream(spark, path):
    schema = spark.createDataFrame([], schemas.LANDING_DOCUMENTS).schema
    return spark.readStream.schema(schema).parquet(path)


def rows_of(n, start=0, **more):
    return [{"source_id": f"k{i}", "subject": f"s{i}", "cls": {"confidence": 0.9}, **more}
            for i in range(start, start + n)]


def test_batches_add_up_to_one_merge(spark, folder):
    path, base = f"{folder}/landing", f"{folder}/state"
    fy, categories = seeds.fy_periods(spark), seeds.tax_categories(spark)
    parts = [rows_of(4), rows_of(3, 2, subject="later"), rows_of(2, 9)]
    for part in parts:
        write_landing(spark, path, part)
        ingest.drain_queue(
            queue_stream(spark, path), f"{base}/core", f"{base}/checkpoint", fy, categories)
    streamed = ingest.read_core(spark, f"{base}/core")
    assert values(streamed, "source_id", "subject") == [
        ("k0", "s0"), ("k1", "s1"), ("k10", "s10"), ("k2", "later"), ("k3", "later"),
        ("k4", "later"), ("k9", "s9"),
    ]
    assert streamed.select("doc_id").distinct().count() == 7
    state = core(spark, [])
    for part in parts:
        new = merge.incoming_documents(landing(spark, part), fy, categories)
        state = merge.merge_documents(state, new).drop("merge_outcome")
        state = spark.createDataFrame(state.collect(), state.schema)
    columns = ("source_id", "subject", "review_status", "fy_year", "doc_id")
    assert values(state, *columns) == values(streamed, *columns)


def test_a_compacted_log_goes_on_from_its_base(spark, folder):
    path, base = f"{folder}/landing", f"{folder}/state"
    fy, categories = seeds.fy_periods(spark), seeds.tax_categories(spark)

    def drain(core_path):
        ingest.drain_queue(queue_stream(spark, path), core_path, f"{base}/checkpoint", fy, categories)

    write_landing(spark, path, rows_of(3))
    drain(f"{base}/core")
    ingest.compact_core(spark, f"{base}/core", f"{base}/core-2")
    write_landing(spark, path, rows_of(2, 2, subject="later"))
    drain(f"{base}/core-2")
    assert values(ingest.read_core(spark, f"{base}/core-2"), "source_id", "subject") == [
        ("k0", "s0"), ("k1", "s1"), ("k2", "later"), ("k3", "later"),
    ]


def test_a_failed_batch_is_taken_again(spark, folder):
    """The checkpoint does not move past a batch whose sink failed."""
    path, base = f"{folder}/landing", f"{folder}/state"
    write_landing(spark, path, rows_of(3))
    seen = []

    def failing(batch, epoch):
        seen.append(batch.count())
        raise RuntimeError("sink is down")

    with pytest.raises(StreamingQueryException):
        ingest.run_available(queue_stream(spark, path), failing, f"{base}/checkpoint")
    assert seen == [3] and not os.path.exists(f"{base}/core")
    fy, categories = seeds.fy_periods(spark), seeds.tax_categories(spark)
    ingest.drain_queue(
        queue_stream(spark, path), f"{base}/core", f"{base}/checkpoint", fy, categories)
    assert ingest.read_core(spark, f"{base}/core").count() == 3


def test_a_repeated_epoch_replaces_its_rows(spark, folder):
    path = f"{folder}/decisions/epoch=0"
    one = spark.createDataFrame(
        [(1, "confirm", T(2025, 1, 1), "x")], ingest.DECISION)
    for _ in range(2):
        one.write.mode("overwrite").parquet(path)
    assert ingest.read_decisions(spark, f"{folder}/decisions").count() == 1


def test_late_mail_inside_the_window_is_deduplicated(spark, folder):
    inbox, base = f"{folder}/in", f"{folder}/out"
    schema = "source_id STRING, received_at TIMESTAMP"
    newest = T(2025, 6, 10)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = ingest.dedupe_late(
            spark.readStream.schema(schema).parquet(inbox), ["source_id"])
        query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/c")
                 .trigger(availableNow=True).start(f"{base}/rows"))
        query.awaitTermination()
        return [r[0] for r in values(spark.read.schema(schema).parquet(f"{base}/rows"), "source_id")]

    assert run([("new", newest), ("old key", newest)]) == ["new", "old key"]
    day = datetime.timedelta(days=1)
    # Two days late is kept, a repeated key is dropped, five days late is refused.
    late = [("late", newest - 2 * day), ("old key", newest - day), ("too late", newest - 5 * day)]
    assert run(late) == ["late", "new", "old key"]


def test_decisions_are_logged_once(spark, folder):
    secret, path = "s", f"{folder}/in"

    def send(rows):
        frame = spark.createDataFrame(rows, "action_ts TIMESTAMP, doc_id BIGINT, action STRING")
        frame = frame.withColumn("token", review_token(F.col("doc_id"), F.col("action"), secret))
        frame.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(frame.schema).parquet(path)
        ingest.log_decisions(stream, f"{folder}/log", f"{folder}/checkpoint", secret)

    send([(T(2025, 1, 2), 1, "reject"), (T(2025, 1, 1), 1, "confirm"), (T(2025, 1, 1), 2, "delete")])
    send([(T(2025, 1, 3), 1, "reject"), (T(2025, 1, 3), 3, "reject")])
    log = ingest.read_decisions(spark, f"{folder}/log")
    assert values(log, "doc_id", "action") == [(1, "confirm"), (3, "reject")]
    docs = core(spark, [{"doc_id": i, "review_status": "NEEDS_REVIEW"} for i in (1, 2, 3)])
    done = review.apply_signed_actions(docs, log, secret)
    assert [r[0] for r in values(done, "review_status")] == ["CONFIRMED", "NEEDS_REVIEW", "REJECTED"]


def test_the_last_answer_by_event_time_wins(spark, folder):
    """Out of order, replayed and late answers over three batches, and a restart between them."""
    from ledgermill.functions.crypto import checklist_token

    secret, path = "s", f"{folder}/in"
    schema = "action_ts TIMESTAMP, group_code STRING, fy_year INT, answer STRING"

    def send(rows, forged=False):
        frame = spark.createDataFrame(rows, schema)
        token = checklist_token(F.col("group_code"), F.col("fy_year"), F.col("answer"), secret)
        frame = frame.withColumn("token", F.lit("x") if forged else token)
        frame.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(frame.schema).parquet(path)
        ingest.keep_answers(stream, f"{folder}/last", f"{folder}/checkpoint", secret)
        return values(ingest.read_answers(spark, f"{folder}/last"), "group_code", "fy_year", "answer")

    first = [(T(2025, 1, 5), "RENT", 2025, "YES"), (T(2025, 1, 9), "CAR", 2025, "NO"), (T(2025, 1, 9), "CAR", 2024, "MAYBE")]
    assert send(first) == [("CAR", 2025, "NO"), ("RENT", 2025, "YES")]
    # Late by months: it loses; equal times go to the larger answer.
    late = [(T(2024, 6, 1), "RENT", 2025, "NO"), (T(2025, 1, 9), "CAR", 2025, "YES"), (T(2024, 1, 1), "CAR", 2024, "NO")]
    assert send(late) == [("CAR", 2024, "NO"), ("CAR", 2025, "YES"), ("RENT", 2025, "YES")]
    assert send([(T(2026, 1, 1), "RENT", 2025, "NO")], forged=True)[-1] == ("RENT", 2025, "YES")
    again = send(first + late + [(T(2025, 1, 6), "RENT", 2025, "NO")])
    assert again == [("CAR", 2024, "NO"), ("CAR", 2025, "YES"), ("RENT", 2025, "NO")]


def test_a_failed_run_is_logged_and_leaves_the_mark(spark, folder):
    from ledgermill.operators import runlog
    from ledgermill.streaming import runs

    path = f"{folder}/in"
    spark.range(7).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("id LONG").parquet(path)

    def fail(batch, epoch):
        raise RuntimeError("down")

    def land(batch, epoch):
        return runs.written(batch.filter("id > 1"), lambda rows: rows.write.mode("append").parquet(f"{folder}/out"))

    def advance():
        newest = spark.read.schema("id LONG").parquet(f"{folder}/out").agg(F.max("id").alias("mark"))
        runs.advance_mark(spark, f"{folder}/mark", newest)

    seen = []
    for write in (fail, land, land):
        runs.run_logged(stream, write, f"{folder}/checkpoint", f"{folder}/log", "w", advance)
        seen.append(runs.current_mark(spark, f"{folder}/mark"))
    assert seen == [None, 6, 6]
    log = runlog.runs(spark.read.schema(schemas.RUN_LOG).parquet(f"{folder}/log")).orderBy("started_at").collect()
    assert [(r.status, r.rows_extracted, r.rows_loaded, r.rows_skipped) for r in log] == [
        ("FAILED", 0, 0, 0), ("SUCCESS", 7, 5, 2), ("SUCCESS", 0, 0, 0)]
    assert "down" in log[0].error_msg and log[1].error_msg is None
