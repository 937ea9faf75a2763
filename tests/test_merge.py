from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.operators import keys, merge
from ledgermill.sources import queue
from tests.rows import core, landing, values

def now():
    return F.lit("2026-01-01").cast("timestamp")


def incoming(spark, rows, **options):
    return merge.incoming_documents(
        rows, seeds.fy_periods(spark), seeds.tax_categories(spark), **options
    )


def merged(spark, old, rows, policy=merge.CURRENT_POLICY, **options):
    return merge.merge_documents(old, incoming(spark, rows, **options), policy, now())


def test_largest_file_then_smallest_name_wins_and_all_are_marked(spark):
    rows = landing(
        spark,
        [
            {"source_id": "k", "file_size_bytes": 100, "file_name": "z.pdf"},
            {"source_id": "k", "file_size_bytes": 300, "file_name": "b.pdf"},
            {"source_id": "k", "file_size_bytes": 300, "file_name": "a.pdf"},
            {"source_id": "k", "file_size_bytes": None, "file_name": "c.pdf"},
        ],
    )
    assert values(merge.primary_documents(rows), "file_name") == [("a.pdf",)]
    assert merge.mark_processed(rows).filter("is_processed").count() == 4


def test_hot_key_is_limited_before_the_shuffle(spark):
    plan = merge.primary_documents(landing(spark, [{}]))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_thresholds_and_quarantine(spark):
    confidences = ["0.749", "0.750", None, "", "abc", "1.2"]
    rows = landing(spark, [{"cls": {"confidence": c}} for c in confidences])
    found = values(incoming(spark, rows), "source_id", "review_status")
    assert found == [
        ("m0", "NEEDS_REVIEW"), ("m1", "AUTO_CONFIRMED"), ("m2", "NEEDS_REVIEW"),
    ]
    assert values(merge.quarantined(rows), "landing_id") == [(4,), (5,), (6,)]


def test_rows_without_a_key_are_quarantined_and_stay_unmarked(spark):
    rows = landing(spark, [{"source_id": None}, {}])
    assert values(merge.quarantined(rows), "landing_id", "reasons") == [(1, ["key"])]
    assert values(merge.mark_processed(rows), "landing_id", "is_processed") == [
        (1, False), (2, True),
    ]


@pytest.mark.parametrize("status", ["PENDING", "NEEDS_REVIEW", "AUTO_CONFIRMED", "AUTO_REJECTED"])
def test_open_rows_are_updated_and_keep_their_status(spark, status):
    old = core(spark, [{"source_id": "k", "review_status": status, "subject": "old"}])
    rows = landing(spark, [{"source_id": "k", "subject": "new", "cls": {"confidence": 0.9}}])
    row = merged(spark, old, rows).first()
    assert (row.subject, row.review_status, row.merge_outcome) == ("new", status, "updated")
    assert row.updated_at == datetime.datetime(2026, 1, 1) and row.doc_id == 1


@pytest.mark.parametrize("status", ["CONFIRMED", "REJECTED"])
def test_reviewed_rows_never_change(spark, status):
    old = core(spark, [{"source_id": "k", "review_status": status, "subject": "old"}])
    rows = landing(spark, [{"source_id": "k", "subject": "new", "cls": {"confidence": 0.9}}])
    after = merged(spark, old, rows)
    assert after.drop("merge_outcome").collect() == old.collect()
    assert after.first().merge_outcome == "protected"


def test_status_may_follow_the_confidence_when_asked(spark):
    old = core(spark, [{"source_id": "k", "review_status": "NEEDS_REVIEW"}])
    rows = landing(spark, [{"source_id": "k", "cls": {"confidence": 0.9}}])
    assert merged(spark, old, rows, merge.RESTATUS_POLICY).first().review_status == "AUTO_CONFIRMED"


def test_field_rules(spark):
    item = {"description": "Peak", "amount": "1"}
    old = core(
        spark,
        [{"source_id": "k", "supplier_name": "Acme", "subject": "old", "fy_year": 2024,
          "line_items": [(item["description"], None, None, None, None, item["amount"])],
          "document_date": datetime.date(2024, 1, 1)}],
    )
    rows = landing(
        spark,
        [{"source_id": "k", "subject": None, "received_at": None,
          "cls": {"supplier_name": "", "line_items": [], "document_date": "2024-13-01"}}],
    )
    row = merged(spark, old, rows).first()
    assert (row.supplier_name, row.subject, row.fy_year) == ("Acme", None, 2024)
    assert row.line_items[0].description == "Peak"
    assert row.document_date == datetime.date(2024, 1, 1)


def test_year_resolution(spark):
    rows = landing(
        spark,
        [
            {"cls": {"fy_year": 2024}},
            {"cls": {"fy_year": 1999}},
            {"cls": {"fy_year": None}},
            {"cls": {"fy_year": ""}, "received_at": datetime.datetime(2024, 6, 30, 23, 59)},
            {"cls": {}, "received_at": datetime.datetime(2024, 7, 1)},
            {"cls": {}, "received_at": None},
            {"cls": {}, "received_at": datetime.datetime(2001, 1, 1)},
        ],
    )
    assert values(incoming(spark, rows), "source_id", "fy_year") == [
        ("m0", 2024), ("m1", 2025), ("m2", 2025), ("m3", 2024), ("m4", 2025), ("m5", None),
        ("m6", None),
    ]


def test_line_items_that_are_no_array_count_as_empty(spark):
    shapes = [[{"description": "a"}, {"description": "b"}], [], None, "text", 5, {"x": 1}]
    rows = landing(spark, [{"cls": {"confidence": 0.8, "line_items": s}} for s in shapes])
    sized = incoming(spark, rows).withColumn("n", F.size("line_items"))
    assert values(sized, "source_id", "n") == [(f"m{i}", 2 if i == 0 else 0) for i in range(6)]


def test_total_comes_from_the_deductible_amount_unless_asked(spark):
    rows = landing(spark, [{"cls": {"deductible_amount": 5, "total_amount": 7.25}}])
    assert float(incoming(spark, rows).first().total_amount) == 5
    assert float(incoming(spark, rows, total_from="total_amount").first().total_amount) == 7.25


def test_folder_vocabulary_resolves_half_without_aliases(spark):
    names = list(seeds.path_map(seeds.FOLDER_PATHS))
    rows = landing(spark, [{"cls": {"category": n}} for n in names])
    assert incoming(spark, rows).filter("tax_category_id IS NULL").count() == 11
    with_names = incoming(spark, rows, aliases=seeds.category_aliases(spark))
    assert with_names.filter("tax_category_id IS NULL").count() == 0


def test_relevance_rule(spark):
    rows = landing(
        spark,
        [{"cls": {"is_tax_relevant": r, "confidence": c}}
         for r, c in ((True, 0.9), (True, 0.5), (False, 0.9), (None, 0.9))],
    )
    assert values(incoming(spark, rows, by_relevance=True), "source_id", "review_status") == [
        ("m0", "AUTO_CONFIRMED"), ("m1", "NEEDS_REVIEW"), ("m2", "AUTO_REJECTED"),
        ("m3", "AUTO_CONFIRMED"),
    ]


def test_merging_twice_equals_merging_once(spark):
    rows = landing(
        spark,
        [{"source_id": f"k{i % 7}", "file_size_bytes": i, "subject": f"s{i}",
          "cls": {"confidence": i / 20, "category": "Donations"}} for i in range(20)],
    )
    old = core(spark, [{"source_id": f"k{i}", "review_status": s} for i, s in
                       enumerate(["PENDING", "CONFIRMED", "REJECTED"])])
    once = merged(spark, old, rows).drop("merge_outcome")
    kept = spark.createDataFrame(once.collect(), once.schema)
    twice = merged(spark, kept, rows).drop("merge_outcome")
    key = lambda r: r.source_id
    assert sorted(twice.collect(), key=key) == sorted(kept.collect(), key=key)


def test_changes_are_the_changed_rows_of_the_full_merge(spark):
    rows = landing(spark, [{"source_id": f"k{i}", "cls": {"confidence": 0.9}} for i in range(6)])
    old = core(spark, [{"source_id": f"k{i}", "review_status": s} for i, s in
                       enumerate(["PENDING", "CONFIRMED", "REJECTED", "PENDING"])]
               + [{"source_id": "other"}])
    new = incoming(spark, rows)
    full = merge.merge_documents(old, new, now=now())
    changes = merge.merge_changes(old, new, now=now())
    expected = full.filter("merge_outcome IN ('inserted', 'updated')")
    assert values(changes, *full.columns) == values(expected, *full.columns)
    counts = merge.merge_counts(full, merge.quarantined(rows)).first()
    assert (counts.merged, counts.protected, counts.quarantined) == (4, 2, 0)


def test_first_policy_touches_pending_rows_only(spark):
    old = core(spark, [{"source_id": "a", "subject": "old"},
                       {"source_id": "b", "subject": "old", "review_status": "AUTO_CONFIRMED"}])
    rows = landing(spark, [{"source_id": s, "subject": "new"} for s in ("a", "b", "c")])
    new = merge.incoming_metadata(rows, seeds.fy_periods(spark))
    after = merge.merge_documents(old, new, merge.FIRST_POLICY, now())
    assert values(after, "source_id", "subject", "review_status") == [
        ("a", "new", "PENDING"), ("b", "old", "AUTO_CONFIRMED"), ("c", "new", "PENDING"),
    ]


def test_batch_run_marks_its_keys_in_every_batch(spark):
    rows = landing(
        spark,
        [{"source_id": "a", "batch_id": 1}, {"source_id": "a", "batch_id": 2},
         {"source_id": "b", "batch_id": 2}],
    )
    assert values(merge.mark_processed(rows, 1), "landing_id", "is_processed") == [
        (1, True), (2, True), (3, False),
    ]
    assert queue.unprocessed(rows, 2).count() == 2


def test_surrogate_keys_are_unique_and_stable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    first = keys.with_surrogate_key(rows, [F.col("k")], F.lit(100).cast("bigint"), "new_id")
    again = keys.with_surrogate_key(
        rows.repartition(7), [F.col("k")], F.lit(100).cast("bigint"), "new_id"
    )
    assert first.select("new_id").distinct().count() == 5000
    assert first.agg(F.min("new_id")).first()[0] > 100
    assert first.join(again, ["k", "new_id"]).count() == 5000


def test_a_rejected_document_stays_unmarked_until_it_can_be_merged(spark):
    rows = landing(
        spark,
        [
            {"source_id": "a", "cls": {"confidence": "0.9"}},
            {"source_id": "b", "file_size_bytes": 9, "cls": {"confidence": "very"}},
            {"source_id": "b", "file_size_bytes": 1, "cls": {"confidence": "0.9"}},
            {"source_id": None, "cls": {"confidence": "0.9"}},
        ],
    )
    for batch in (None, 1):
        # The largest file of "b" cannot be read, so no row of "b" was merged.
        assert values(merge.mark_processed(rows, batch), "landing_id", "is_processed") == [
            (1, True), (2, False), (3, False), (4, False),
        ]


def test_the_quarantine_follows_the_field_the_total_is_read_from(spark):
    rows = landing(spark, [{"cls": {"confidence": "0.9", "total_amount": "a lot"}}])
    assert merge.quarantined(rows).count() == 0
    found = merge.quarantined(rows, total_from="total_amount")
    assert values(found, "reasons") == [(["total_amount"],)]
