from __future__ import annotations

import datetime
import hashlib
import hmac
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.operators import archive, checklist, classify, landing, quality, review, transactions
from tests.rows import core, frame, landing as landing_rows, values

T = datetime.datetime
SECRET = "s3cret"


def sign(message: str) -> str:
    return hmac.new(SECRET.encode(), message.encode(), hashlib.sha256).hexdigest()


def test_balanced_examples(spark):
    rows = [{"review_status": "CONFIRMED", "subject": f"c{i}", "reviewer_notes": "n" if i < 3 else None,
             "reviewed_at": T(2025, 1, 1 + i) if i != 5 else None} for i in range(10)]
    rows += [{"review_status": "REJECTED", "subject": f"r{i}"} for i in range(2)]
    rows += [{"review_status": "REJECTED", "subject": None}, {"review_status": "PENDING", "subject": "p"}]
    picked = classify.few_shot_balanced(core(spark, rows), seeds.tax_categories(spark))
    confirmed = [r[0] for r in values(picked.filter("review_status = 'CONFIRMED'"), "subject")]
    assert confirmed == ["c0", "c1", "c2", "c4", "c6", "c7", "c8", "c9"]
    assert picked.filter("review_status = 'REJECTED'").count() == 2
    block = classify.few_shot_block(picked).first().block
    lines = block.split("\n")
    assert lines[2:6] == [
        "CONFIRMED (is_tax_relevant=true):", "  - Subject: c2 | Note: n", "  - Subject: c1 | Note: n",
        "  - Subject: c0 | Note: n",
    ]
    assert block.endswith("  - Subject: r0\n  - Subject: r1\n\n")


def test_blocks_without_examples(spark):
    empty = core(spark, [])
    categories = seeds.tax_categories(spark)
    assert classify.few_shot_block(classify.few_shot_balanced(empty, categories)).first().block == ""
    two = core(spark, [{"review_status": "CONFIRMED", "subject": "x", "tax_category_id": 1}] * 2)
    recent = classify.few_shot_recent(two, categories)
    assert classify.few_shot_recent_block(recent).first().block == ""


def test_duplicates_and_their_parts(spark):
    day = datetime.date(2025, 1, 1)
    same = {"supplier_name": "A", "document_date": day, "total_amount": 5}
    rows = [{**same, "doc_id": i} for i in (3, 4, 11)] + [
        {**same, "doc_id": 5, "supplier_name": None}, {**same, "doc_id": 6, "total_amount": 6},
    ]
    for row in rows:
        row["total_amount"] = __import__("decimal").Decimal(row["total_amount"])
    found = review.duplicate_candidates(core(spark, rows), ids_per_row=10)
    assert values(found, "copies", "part", "doc_ids") == [(3, 0, "3, 4"), (3, 1, "11")]


def test_confidence_bands(spark):
    from decimal import Decimal

    numbers = ["0.249", "0.25", "0.499", "0.5", "0.749", "0.75", "0.899", "0.9", None]
    rows = [{"confidence_score": n and Decimal(n)} for n in numbers]
    bands = values(review.confidence_bands(core(spark, rows)), "confidence_band", "cnt")
    assert bands == [
        ("0.00–0.24 (very low)", 2), ("0.25–0.49 (low)", 2), ("0.50–0.74 (medium)", 2),
        ("0.75–0.89 (high)", 2), ("0.90–1.00 (very high)", 1),
    ]


def test_signed_actions(spark):
    docs = core(
        spark,
        [{"doc_id": i, "review_status": s, "reviewer_notes": n} for i, s, n in (
            (1, "NEEDS_REVIEW", None), (2, "NEEDS_REVIEW", "mine"), (3, "PENDING", None),
            (4, "CONFIRMED", None), (5, "NEEDS_REVIEW", None))],
    )
    actions = spark.createDataFrame(
        [
            (T(2025, 1, 1), 1, "confirm", sign("1|confirm")),
            (T(2025, 1, 2), 1, "reject", sign("1|reject")),  # replay: the first counts
            (T(2025, 1, 1), 2, "reject", sign("2|reject")),
            (T(2025, 1, 1), 3, "confirm", "wrong"),
            (T(2025, 1, 1), 4, "reject", sign("4|reject")),  # reviewed already
            (T(2025, 1, 1), 5, "delete", sign("5|delete")),  # unknown action
        ],
        "action_ts TIMESTAMP, doc_id BIGINT, action STRING, token STRING",
    )
    done = review.apply_signed_actions(docs, actions, SECRET)
    assert values(done, "doc_id", "review_status", "reviewer_notes") == [
        (1, "CONFIRMED", "Confirmed via email review bot"), (2, "REJECTED", "mine"),
        (3, "PENDING", None), (4, "CONFIRMED", None), (5, "NEEDS_REVIEW", None),
    ]
    assert done.filter("doc_id = 1").first().reviewed_at == T(2025, 1, 1)
    again = review.apply_signed_actions(done, actions, SECRET)
    assert values(again, *done.columns) == values(done, *done.columns)


def test_bulk_actions_see_earlier_statements(spark):
    docs = core(spark, [{"doc_id": 1, "supplier_name": "ACME", "review_status": "AUTO_REJECTED"},
                        {"doc_id": 2, "supplier_name": "acme", "review_status": "NEEDS_REVIEW"}])
    script = [review.BulkAction("rescue", doc_id=1, note="r"),
              review.BulkAction("reject_supplier", supplier="Acme", note="x"),
              review.BulkAction("recategorise", doc_id=2, category="no such name"),
              review.BulkAction("note", doc_id=2, note="later")]
    now = F.lit("2026-01-01").cast("timestamp")
    done = review.apply_bulk_actions(docs, script, seeds.tax_categories(spark), now)
    assert values(done, "doc_id", "review_status", "reviewer_notes") == [
        (1, "CONFIRMED", "r"), (2, "REJECTED", "later"),
    ]
    with pytest.raises(ValueError):
        review.apply_bulk_actions(docs, [review.BulkAction("drop")], docs, now)


def test_a_long_script_is_one_pass(spark):
    docs = core(spark, [{"doc_id": i, "review_status": "NEEDS_REVIEW"} for i in range(50)])
    script = [review.BulkAction("note", doc_id=i % 50, note=str(i)) for i in range(1000)]
    script += [review.BulkAction("accept", doc_id=7, note="last")]
    now = F.lit("2026-01-01").cast("timestamp")
    done = review.apply_bulk_actions(docs, script, seeds.tax_categories(spark), now)
    found = dict(values(done, "doc_id", "reviewer_notes"))
    assert found[7] == "last" and found[49] == "999" and len(found) == 50


def test_a_moved_document_meets_the_statements_on_its_new_category(spark):
    names = seeds.tax_categories(spark).orderBy("category_id").limit(2).collect()
    docs = core(spark, [{"doc_id": 1, "review_status": "AUTO_CONFIRMED", "confidence_score": D("0.95"),
                         "tax_category_id": names[0].category_id}])
    move = review.BulkAction("recategorise", doc_id=1, category=names[1].category_nme)
    accept = review.BulkAction("accept_category", category=names[1].category_nme, note="ok")
    now = F.lit("2026-01-01").cast("timestamp")
    for script, status in (([move, accept], "CONFIRMED"), ([accept, move], "AUTO_CONFIRMED")):
        done = review.apply_bulk_actions(docs, script, seeds.tax_categories(spark), now).first()
        assert (done.review_status, done.tax_category_id) == (status, names[1].category_id)


def test_answers_cover_the_group_and_the_last_one_counts(spark):
    items = seeds.checklist_items(spark)
    answers = spark.createDataFrame(
        [
            (T(2025, 1, 1), "WFH", 2025, "NO", sign("WFH|2025|NO")),
            (T(2025, 1, 2), "WFH", 2025, "YES", sign("WFH|2025|YES")),
            (T(2025, 1, 3), "WFH", 2025, "NO", "forged"),
            (T(2025, 1, 1), "CRYPTO", 2026, "YES", sign("CRYPTO|2026|YES")),
            (T(2025, 1, 1), "TECH", 2025, "MAYBE", sign("TECH|2025|MAYBE")),
        ],
        "action_ts TIMESTAMP, group_code STRING, fy_year INT, answer STRING, token STRING",
    )
    after = checklist.apply_answers(seeds.checklist_responses(spark), items, answers, SECRET)
    assert after.count() == 54  # one row was added for a year that was never seeded
    assert values(after.filter("is_applicable = 'YES'"), "item_id", "fy_year") == [
        (10, 2026), (12, 2025), (13, 2025), (14, 2025),
    ]
    questions = checklist.questionnaire(items, after, 2025)
    assert questions.count() == 24
    progress = {r.section: (r.answered, r.total, r.pct)
                for r in checklist.questionnaire_progress(questions).collect()}
    assert progress["ALL"] == (1, 24, 4) and progress["Deductions"][0] == 1


def test_questionnaire_shows_the_largest_text(spark):
    items = seeds.checklist_items(spark)
    rows = [(15, "YES"), (16, "NO"), (17, "NO"), (21, "UNKNOWN")]
    responses = spark.createDataFrame(
        [(i, 2025, a) for i, a in rows], "item_id INT, fy_year INT, is_applicable STRING"
    )
    found = dict(values(checklist.questionnaire(items, responses, 2025), "group_code", "current_response"))
    assert found == {"TECH": "YES", "SELF_ED": "UNKNOWN"}


def test_append_key_treats_a_missing_name_as_empty(spark):
    known = landing_rows(spark, [{"source_id": "k", "file_name": None}])
    rows = landing_rows(spark, [{"source_id": "k", "file_name": ""}, {"source_id": "k", "file_name": "a"},
                                {"source_id": "j", "file_name": ""}, {"source_id": "j", "file_name": None},
                                {"source_id": None}, {"source_id": None}])
    fresh = landing.new_rows(known, rows)
    assert values(fresh, "source_id", "file_name") == [
        ("j", ""), ("k", "a"), (None, None), (None, None),
    ]


def test_update_json_keeps_unknown_fields(spark):
    rows = landing_rows(
        spark, [{"raw_json": '{"a":[1,{"b":null}],"classification":{"x":1}}'}, {"raw_json": None},
                {"raw_json": '{"keep":true}'}])
    updates = spark.createDataFrame(
        [('[{"landing_id":1,"classification":{"category":"Other"}},{"landing_id":2,"classification":{}}]',)],
        "updates STRING",
    )
    done = landing.update_json(rows, landing.classification_updates(updates))
    assert values(done, "landing_id", "raw_json") == [
        (1, '{"a":[1,{"b":null}],"classification":{"category":"Other"}}'),
        (2, '{"classification":{}}'), (3, '{"keep":true}'),
    ]


def test_archive_collisions(spark):
    docs = spark.createDataFrame(
        [(1, "x/a.pdf"), (2, "x/a.pdf"), (3, "x/a.pdf"), (4, "x/b"), (5, "x/b"), (6, "y/c.pdf")],
        "doc_id BIGINT, path STRING",
    )
    taken = spark.createDataFrame([("y/c.pdf",)], "path STRING")
    when = F.lit("2025-03-24 14:30:22").cast("timestamp")
    found = values(archive.archive_index(docs, when, taken), "doc_id", "final_path")
    assert found == [
        (1, "x/a.pdf"), (2, "x/a_20250324_143022.pdf"), (3, "x/a_20250324_143022_3.pdf"),
        (4, "x/b"), (5, "x/b_20250324_143022"), (6, "y/c_20250324_143022.pdf"),
    ]


def test_classification_of_real_words(spark):
    bill = ("Energy Co\nABN 12 345 678 901\nAccount number: A-12345\nElectricity supply charge\n"
            "Peak Usage 180.2 kWh @ $0.3524 = $63.51\nIssued 2024-08-15\nTotal due $1,063.51")
    docs = spark.createDataFrame(
        [(1, bill), (2, "Dinner at the restaurant, cafe and cinema. Invoice $30.00"), (3, ""), (4, "hello")],
        "id INT, text STRING",
    )
    rows = {r.id: r.classification for r in classify.classify_documents(docs, "text").collect()}
    assert rows[1].category == "Work From Home — Electricity/Gas"
    assert (rows[1].fy_year, rows[1].total_amount, rows[1].is_tax_relevant) == ("2025", "1063.51", "true")
    assert rows[1].supplier_name == "Energy Co" and rows[1].account_reference == "A-12345"
    assert rows[1].line_items[0].amount == "63.51"
    assert rows[2].is_tax_relevant == "false"
    assert rows[3].confidence == "0.1" and rows[3].document_type == "Unknown"
    assert rows[4].category == "Invoice / Receipt — Other"
    abn = docs.select(classify.extract_abn(F.col("text")).alias("a")).first().a
    assert abn == "12345678901"


def test_transactions_collapse_under_the_hash(spark):
    raw = spark.createDataFrame(
        [("f", "NAB", 1, 1, "4 Mar 26", "$1,234.50", None, None, None, "  Shop  A ", None),
         ("f", "NAB", 1, 2, "4 Mar 26", "1234.50", None, None, None, "  Shop  A ", None),
         ("f", "Bendigo", 1, 3, "24/03/2026", None, "10.00", None, None, "out", None),
         ("f", "Bendigo", 1, 4, "24/03/2026", None, None, "7.00", None, "in", None),
         ("f", "Bendigo", 1, 5, "bad", None, None, "7.00", None, "in", None)],
        "source_file STRING, provider STRING, account_id INT, row_num INT, txn_date_raw STRING, "
        "amount_raw STRING, debit_raw STRING, credit_raw STRING, balance_raw STRING, "
        "description_raw STRING, raw_json STRING",
    )
    rows = transactions.normalise_transactions(raw, seeds.statement_providers(spark))
    new = transactions.new_transactions(rows.select("dedup_hash").limit(0), rows)
    found = [(d, float(a), n) for d, a, n in values(new, "description_clean", "amount", "occurrences")]
    assert found == [("Shop A", 1234.5, 2), ("in", 7.0, 1), ("out", -10.0, 1)]
    assert transactions.new_transactions(new, rows).count() == 0


def test_seeds_pass_their_checks(spark):
    categories = seeds.tax_categories(spark)
    assert categories.count() == 33 and seeds.tax_categories(spark, base_only=True).count() == 20
    assert seeds.tax_categories(spark, base_only=True).filter("is_deductible").count() == 9
    assert seeds.transaction_categories(spark).count() == 43
    assert seeds.statement_providers(spark).count() == 3 and seeds.accounts(spark).count() == 5
    items = seeds.checklist_items(spark)
    assert values(items.groupBy("item_type").count(), "item_type", "count") == [
        ("DOCUMENT", 32), ("RESPONSE", 21),
    ]
    assert seeds.checklist_responses(spark).count() == 53
    years = seeds.fy_periods(spark)
    assert values(years.filter("is_current"), "fy_label") == [("FY2025",)]
    spending = seeds.transaction_categories(spark)
    key = [F.col("category_nme"), F.coalesce("subcategory_nme", F.lit(""))]
    clean = quality.check([
        quality.row_violations(items, "item_id", quality.checklist_item_rules()),
        quality.row_violations(years, "fy_year", quality.fy_rules()),
        quality.row_violations(seeds.statement_providers(spark), "provider_id", quality.provider_rules()),
        quality.row_violations(seeds.accounts(spark), "account_id", quality.account_rules()),
        quality.row_violations(seeds.checklist_responses(spark), "item_id", quality.response_rules()),
        quality.unique_violations(years, "current_fy", [F.col("is_current")], F.col("is_current")),
        quality.unique_violations(spending, "category", key),
        quality.unique_violations(categories, "name", [F.col("category_nme")]),
        quality.foreign_key_violations(items, "category_id", categories, "category_id"),
        quality.foreign_key_violations(seeds.accounts(spark), "csv_provider_id",
                                       seeds.statement_providers(spark), "provider_id"),
    ])
    assert clean.count() == 0


def test_each_rule_reports_its_violation_once(spark):
    from decimal import Decimal

    docs = core(spark, [
        {"doc_id": 1, "source_id": None}, {"doc_id": 2, "review_status": "DONE"},
        {"doc_id": 3, "confidence_score": Decimal("1.200")}, {"doc_id": 4, "subject": "x" * 1001},
        {"doc_id": 5, "source_id": "same"}, {"doc_id": 6, "source_id": "same"},
        {"doc_id": 7, "tax_category_id": 99},
    ])
    found = quality.check([
        quality.row_violations(docs, "doc_id", quality.document_rules()),
        quality.unique_violations(docs, "key", [F.col("source_type"), F.col("source_id")]),
        quality.foreign_key_violations(docs, "tax_category_id", seeds.tax_categories(spark), "category_id"),
    ])
    assert values(found, "rule", "row_key") == [
        ("foreign_key:tax_category_id", "99"), ("length:subject", "4"), ("not_null:source_id", "1"),
        ("one_of:review_status", "2"), ("range:confidence_score", "3"), ("unique:key", "GMAIL|same"),
    ]
    budget = frame(spark, "month_num INT, budget_amount DECIMAL(10,2)",
                   [{"month_num": 13, "budget_amount": Decimal(1)}, {"month_num": 1, "budget_amount": Decimal(-1)}])
    assert quality.row_violations(budget, "month_num", quality.budget_rules()).count() == 2


def test_seed_if_absent_is_idempotent(spark):
    table = seeds.transaction_categories(spark).filter("category_id <= 10")
    key = ["category_nme", F.coalesce("subcategory_nme", F.lit(""))]
    once = quality.seed_if_absent(table, seeds.transaction_categories(spark), key)
    assert once.count() == 43
    assert quality.seed_if_absent(once, seeds.transaction_categories(spark), key).count() == 43


def test_unique_keys_are_compared_by_column(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("x", "y"), ("x", "y")], "k STRING, v STRING")
    found = quality.unique_violations(rows, "pair", [F.col("k"), F.col("v")]).collect()
    assert [tuple(r) for r in found] == [("unique:pair", "x|y")]
