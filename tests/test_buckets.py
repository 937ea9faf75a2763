from __future__ import annotations

import re
import time

from pyspark.sql import functions as F

from ledgermill import schemas, seeds
from ledgermill.operators import merge
from ledgermill.operators.buckets import CO_LOCATED, SLOT, BucketedLog, scoped
from ledgermill.streaming import ingest
from tests.rows import landing, values

KEY = ["source_type", "source_id"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_reads_the_buckets_of_its_keys(spark, folder):
    log = BucketedLog(spark, f"{folder}/log", "id BIGINT, text STRING", ["id"], buckets=32)
    log.write(spark.range(1000).withColumn("text", F.lit("x")), 0)
    batch = spark.createDataFrame([(3, "new"), (5, "new")], "id BIGINT, text STRING")
    slots = log.slots_of(batch)
    assert 1 <= len(slots) <= 2
    part = log.read(slots)
    latest = merge.first_per_key(part, [SLOT, "id"], [F.col("epoch").desc()])
    text = latest._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    chosen, total = re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", text).groups()
    assert int(chosen) <= 2 and int(total) == 32
    # The window per key works inside the buckets.
    assert "Exchange" not in plan_of(latest)
    assert {r["id"] for r in part.collect()} >= {3, 5}
    assert part.count() < 200


def test_an_epoch_is_replaced_and_unknown_rows_are_found(spark, folder):
    log = BucketedLog(spark, f"{folder}/log", "id BIGINT, text STRING", ["id"], buckets=8)
    for text in ("first", "second"):
        log.write(spark.createDataFrame([(1, text), (2, text)], "id BIGINT, text STRING"), 0)
    assert values(log.read(), "id", "text") == [(1, "second"), (2, "second")]
    batch = spark.createDataFrame([(2, "b"), (3, "b"), (None, "b")], "id BIGINT, text STRING")
    assert values(log.unknown(batch), "id") == [(3,), (None,)]
    assert values(log.unknown(batch, before=0), "id") == [(2,), (3,), (None,)]
    # Attached again, as after a restart.
    spark.sql(f"DROP TABLE {log.name}")
    again = BucketedLog(spark, f"{folder}/log", "id BIGINT, text STRING", ["id"], buckets=8)
    assert again.read().count() == 2


def test_marks_join_the_queue_without_moving_it(spark, folder):
    rows = landing(spark, [{"source_id": f"k{i}", "cls": {"confidence": 0.9}} for i in range(40)]
                   + [{"source_id": None}, {"source_id": "k1"}])
    queue = BucketedLog(spark, f"{folder}/queue", schemas.LANDING_DOCUMENTS, KEY)
    queue.write(rows, 0)
    marks = BucketedLog(spark, f"{folder}/marks", "source_type STRING, source_id STRING", KEY)
    done = merge.processed_keys(rows.filter("landing_id <= 10"))
    marks.write(done, 0)
    marks.write(done.limit(3), 1)
    with scoped(spark, {**CO_LOCATED, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        left = queue.rows_without(marks)
        flagged = queue.rows_marked(marks, "done")
        assert "Exchange" not in plan_of(left)
        assert "Exchange" not in plan_of(flagged)
        assert left.count() == 31
        assert flagged.count() == 42 and flagged.filter("done").count() == 11


def test_twenty_batches_take_level_time_and_match_one_merge(spark, folder):
    """A batch reads its buckets; the history of the others costs nothing."""
    fy, categories = seeds.fy_periods(spark), seeds.tax_categories(spark)
    path, base = f"{folder}/landing", f"{folder}/state"
    schema = spark.createDataFrame([], schemas.LANDING_DOCUMENTS).schema
    parts, seconds = [], []
    for b in range(20):
        rows = [{"source_id": f"k{i}", "subject": f"b{b}", "cls": {"confidence": 0.5}}
                for i in range(3 * b, 3 * b + 5)]
        parts.append(rows)
        landing(spark, rows).coalesce(1).write.mode("append").parquet(path)
        began = time.time()
        ingest.drain_queue(spark.readStream.schema(schema).parquet(path), f"{base}/core",
                           f"{base}/checkpoint", fy, categories)
        seconds.append(time.time() - began)
    newest = {r["source_id"]: r["subject"] for rows in parts for r in rows}
    streamed = ingest.read_core(spark, f"{base}/core")
    assert dict(values(streamed, "source_id", "subject")) == newest
    assert streamed.select("doc_id").distinct().count() == len(newest)
    marked = ingest.marks_log(spark, f"{base}/core").read()
    assert marked.select("source_id").distinct().count() == len(newest)
    early, late = sorted(seconds[2:8])[3], sorted(seconds[14:])[3]
    assert late < 2.5 * early, seconds


def test_updates_meet_the_json_in_its_bucket(spark, folder):
    from ledgermill.operators import landing as queue_of

    rows = landing(spark, [{"source_id": f"k{i}", "raw_json": '{"a": 1, "classification": {"x": 0}}'} for i in range(30)])
    queued = queue_of.landing_log(spark, f"{folder}/queue")
    queued.write(rows, 0)
    updates = queue_of.update_log(spark, f"{folder}/updates")
    for epoch, ids in enumerate(([1, 2, 3], [2, 99])):
        made = [(i, f'{{"x": {10 * epoch + i}}}') for i in ids]
        updates.write(spark.createDataFrame(made, queue_of.UPDATE), epoch)
    with scoped(spark, {**CO_LOCATED, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        done = queue_of.read_updated(queued, updates)
        assert "Exchange" not in plan_of(done)
        x = F.get_json_object("raw_json", "$.classification.x").cast("int")
        found = dict(values(done.withColumn("x", x), "landing_id", "x"))
    assert len(found) == 30 and {k: found[k] for k in (1, 2, 3, 4)} == {1: 1, 2: 12, 3: 3, 4: 0}


def test_sorted_places_split_groups_over_ranges(spark):
    from ledgermill.operators.keys import sorted_places

    rows = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 = 8 THEN NULL ELSE 'cold' END AS g",
        "id * 7919 % 1009 AS v", "1 AS _at_least")
    order = [F.col("v").desc(), F.col("id").asc()]
    found = sorted_places(rows, [F.col("g")], order, "place")
    plain = spark.createDataFrame(rows.collect(), rows.schema)
    plain.createOrReplaceTempView("places")
    wanted = spark.sql("SELECT id, row_number() OVER (PARTITION BY g ORDER BY v DESC, id) AS place FROM places")
    assert values(found, "id", "place") == values(wanted, "id", "place")
    whole = sorted_places(rows, [], order, "place")
    assert sorted(r[0] for r in whole.select("place").collect()) == list(range(1, 3001))
    assert sorted_places(rows.limit(0), [F.col("g")], order, "place").count() == 0
