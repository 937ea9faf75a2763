from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill import schemas, seeds
from ledgermill.operators import checklist, health
from ledgermill.plans import marts, portal
from tests.rows import core, frame, values

D = datetime.date


def txns(spark, rows):
    full = [
        {"txn_id": i + 1, "account_id": 1, "is_deductible": False, "is_anomaly": False, **r,
         "amount": Decimal(str(r["amount"]))}
        for i, r in enumerate(rows)
    ]
    return frame(spark, schemas.CORE_TRANSACTIONS, full)


def test_savings_rate(spark):
    rows = txns(
        spark,
        [
            {"txn_date": D(2025, 1, 3), "amount": -50, "category_id": 12},
            {"txn_date": D(2025, 2, 3), "amount": 1000, "category_id": 1},
            {"txn_date": D(2025, 3, 3), "amount": 900, "category_id": 1},
            {"txn_date": D(2025, 3, 4), "amount": 30, "category_id": 12},  # refund counts as spend
            {"txn_date": D(2025, 3, 5), "amount": -999, "category_id": None},  # counts nowhere
        ],
    )
    found = values(
        marts.vw_savings_rate(rows, seeds.transaction_categories(spark)),
        "month_label", "total_income", "total_spend", "savings_rate_pct",
    )
    assert found == [
        ("2025-01", Decimal("0.00"), Decimal("50.00"), None),
        ("2025-02", Decimal("1000.00"), Decimal("0.00"), Decimal("100.0")),
        ("2025-03", Decimal("900.00"), Decimal("30.00"), Decimal("96.7")),
    ]


def test_budget_joins_on_category_year_and_month(spark):
    rows = txns(spark, [{"txn_date": D(2024, 7, 15), "amount": -80, "category_id": 12},
                        {"txn_date": D(2024, 7, 16), "amount": -20, "category_id": 12}])
    budgets = spark.createDataFrame(
        [(12, 2025, 7, Decimal("90.00")), (12, 2024, 7, Decimal("10.00"))],
        "category_id INT, fy_year INT, month_num INT, budget_amount DECIMAL(10,2)",
    )
    view = marts.vw_monthly_spending(
        rows, seeds.accounts(spark), seeds.transaction_categories(spark), budgets
    )
    assert values(view, "total_amount", "txn_count", "budget_amount") == [
        (Decimal("-100.00"), 2, Decimal("90.00"))
    ]


def test_cashflow_label_is_missing_outside_the_periods(spark):
    rows = txns(spark, [{"txn_date": D(2025, 6, 30), "amount": 10, "category_id": 1},
                        {"txn_date": D(2025, 7, 1), "amount": 20, "category_id": 1},
                        {"txn_date": D(2019, 7, 1), "amount": -5, "category_id": 12,
                         "is_deductible": True, "deductible_amount": Decimal("5.00")}])
    view = marts.vw_fy_cashflow(
        rows, seeds.transaction_categories(spark), seeds.fy_periods(spark)
    )
    assert values(view, "fy_year", "fy_label", "total_income", "total_deductible") == [
        (2020, None, Decimal("0.00"), Decimal("5.00")),
        (2025, "FY2025", Decimal("10.00"), Decimal("0.00")),
        (2026, "FY2026", Decimal("20.00"), Decimal("0.00")),
    ]


def test_views_run_on_empty_tables(spark):
    empty = frame(spark, schemas.CORE_TRANSACTIONS, [])
    docs = core(spark, [])
    tables = {
        "documents": docs, "transactions": empty, "accounts": seeds.accounts(spark),
        "categories": seeds.transaction_categories(spark),
        "budgets": spark.createDataFrame(
            [], "category_id INT, fy_year INT, month_num INT, budget_amount DECIMAL(10,2)"),
        "fy_periods": seeds.fy_periods(spark), "tax_categories": seeds.tax_categories(spark),
        "items": seeds.checklist_items(spark), "responses": seeds.checklist_responses(spark),
    }
    marts.register_views(tables)
    for view in ("vw_tax_documents", "vw_tax_summary", "vw_monthly_spending", "vw_savings_rate",
                 "vw_anomalies", "vw_fy_cashflow", "vw_spending_by_category", "vw_utility_bills",
                 "vw_utility_line_items"):
        assert spark.table(view).count() == 0
    assert spark.table("vw_checklist_completeness").count() == 53


def status_docs(spark):
    rows = [
        {"review_status": s, "is_deductible": d, "fy_year": 2025, "tax_category_id": 30,
         "deductible_amount": Decimal("1.00")}
        for s in schemas.REVIEW_STATUSES
        for d in (True, False, None)
    ]
    return core(spark, rows)


def test_summary_and_checklist_count_different_statuses(spark):
    docs, categories = status_docs(spark), seeds.tax_categories(spark)
    summary = marts.vw_tax_summary(docs, seeds.fy_periods(spark), categories)
    assert values(summary, "tax_category", "document_count") == [("Donations", 2)]
    view = marts.vw_checklist_completeness(
        seeds.checklist_items(spark), seeds.checklist_responses(spark), categories, docs
    )
    assert view.filter("category_nme = 'Donations'").first().doc_count == 6


def test_checklist_statuses(spark):
    items, categories = seeds.checklist_items(spark), seeds.tax_categories(spark)
    answers = {2: "YES", 3: "YES", 4: "NO", 5: "UNKNOWN", 100: "YES", 1: "UNKNOWN"}
    responses = spark.createDataFrame(
        [(i, 2025, a, None, None, "EMAIL") for i, a in answers.items()],
        "item_id INT, fy_year SMALLINT, is_applicable STRING, response_value STRING, "
        "responded_at TIMESTAMP, source STRING",
    )
    docs = core(spark, [{"review_status": "CONFIRMED", "fy_year": 2025, "tax_category_id": 2}])
    view = marts.vw_checklist_completeness(items, responses, categories, docs)
    found = {r.item_id: (r.status, r.in_scope, r.fy_year) for r in view.collect()}
    assert found[1] == ("MISSING", True, 2025)
    assert found[2] == ("SATISFIED", True, 2025)
    assert found[3] == ("MISSING", True, 2025)
    assert found[4] == ("NOT_APPLICABLE", False, 2025)
    assert found[5] == ("UNKNOWN", False, 2025)
    assert found[100] == ("N/A", False, 2025)
    assert found[24] == ("MISSING", True, None)  # required, never answered
    pct = {r.section: (r.satisfied, r.applicable, r.colour)
           for r in checklist.percent_complete(view.filter("fy_year = 2025")).collect()}
    assert pct["ALL"] == (1, 3, "red")
    as_of = F.lit("2024-07-11").cast("date")
    late = checklist.outstanding_items(view.filter("fy_year = 2025"), as_of)
    assert {r.days_since_fy_start for r in late.collect()} == {10}


def test_all_items_satisfied_is_a_hundred_percent(spark):
    items = seeds.checklist_items(spark).filter("item_id IN (1, 24)")
    docs = core(spark, [{"review_status": "AUTO_CONFIRMED", "fy_year": 2025, "tax_category_id": c}
                        for c in (1, 32)])
    view = marts.vw_checklist_completeness(
        items, seeds.checklist_responses(spark), seeds.tax_categories(spark), docs
    )
    top = checklist.percent_complete(view).filter("section = 'ALL'").first()
    assert (float(top.pct_complete), top.colour) == (100.0, "green")


def test_line_items_are_numbered_and_typed(spark):
    json = spark.createDataFrame(
        [(1, '[{"description":"Peak","quantity":"10","amount":2.5},{"description":"x","quantity":""},'
             '{"amount":"-4.77"},{"rate":"a"}]'), (2, "[]"), (3, "null"), (4, None), (5, "{}")],
        "doc_id BIGINT, j STRING",
    )
    items = json.select("doc_id", marts.line_items_from_json(F.col("j")).alias("items"))
    docs = core(spark, [{"doc_id": i, "tax_category_id": 6} for i in range(1, 6)])
    joined = docs.drop("line_items").join(items, "doc_id").withColumnRenamed("items", "line_items")
    view = marts.vw_utility_line_items(joined, seeds.fy_periods(spark), seeds.tax_categories(spark))
    assert values(view, "doc_id", "line_num", "quantity", "amount") == [
        (1, 1, Decimal("10.0000"), Decimal("2.5000")), (1, 2, None, None),
        (1, 3, None, Decimal("-4.7700")), (1, 4, None, None),
    ]


def test_outliers_need_three_months(spark):
    rows = [{"txn_date": D(2025, m, d), "amount": -10, "category_id": 12}
            for m in (1, 2, 3) for d in range(1, 9)]
    rows += [{"txn_date": D(2025, 3, 20), "amount": -500, "category_id": 12}]
    rows += [{"txn_date": D(2025, 1, d), "amount": -10, "category_id": 13} for d in range(1, 9)]
    rows += [{"txn_date": D(2025, 1, 20), "amount": -500, "category_id": 13}]
    flagged = health.detect_anomalies(txns(spark, rows), seeds.transaction_categories(spark))
    assert values(flagged.filter("is_anomaly"), "category_id", "amount") == [(12, Decimal("-500.00"))]


def test_derived_budget_is_the_mean_of_the_first_three_months(spark):
    rows = [{"txn_date": D(2025, m, 1), "amount": -a, "category_id": 12}
            for m, a in ((1, 10), (2, 20), (3, 60), (4, 900))]
    monthly = health.monthly_by_category(txns(spark, rows))
    assert values(health.derived_budgets(monthly), "derived_amount") == [(Decimal("30.00"),)]


def test_payoff(spark):
    debts = spark.createDataFrame(
        [(1, Decimal("100.00"), Decimal("0.0000"), Decimal("30.00")),
         (2, Decimal("1000.00"), Decimal("0.1200"), Decimal("10.00")),
         (3, Decimal("100.00"), Decimal("0.1200"), Decimal("60.00"))],
        "account_id INT, balance DECIMAL(12,2), annual_rate DECIMAL(5,4), payment DECIMAL(12,2)",
    )
    found = values(health.payoff_schedule(debts), "account_id", "month_no", "balance_after")
    assert found == [(1, 1, 70.0), (1, 2, 40.0), (1, 3, 10.0), (1, 4, 0.0), (3, 1, 41.0), (3, 2, 0.0)]


def test_running_trades_match_a_plain_window(spark):
    rows = spark.range(400).selectExpr(
        "id", "IF(id % 3 = 0, 'HOT', concat('S', id % 5)) AS security_code",
        "date_add(DATE'2025-01-01', CAST(id % 11 AS INT)) AS trade_date",
        "CAST(id % 7 AS DECIMAL(15,4)) AS quantity",
        "CASE id % 4 WHEN 0 THEN 'SELL' WHEN 1 THEN 'OTHER' ELSE 'BUY' END AS trade_type",
    )
    by_day = health.running_trades(rows, ["id"], F.lit(0)).select("id", F.col("quantity_held").alias("day"))
    blocks = health.running_trades(rows, ["id"], F.floor(F.col("id") / 7))
    mine = blocks.select("id", F.col("quantity_held").alias("mine")).join(by_day, "id")
    assert mine.filter("mine <> day").count() == 0
    rows.createOrReplaceTempView("t")
    plain = spark.sql(
        "SELECT id, sum(CASE trade_type WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity ELSE 0 END) "
        "OVER (PARTITION BY security_code ORDER BY trade_date, id) AS plain FROM t"
    )
    assert mine.join(plain, "id").filter("mine <> plain").count() == 0
    assert mine.count() == 400


def test_report_and_pack(spark):
    docs = status_docs(spark)
    pack = portal.fy_pack(docs).first()
    assert (pack.record_count, pack.categories_covered) == (3, 1)
    cards = portal.home_cards(docs, 2025).first()
    assert (cards.awaiting_review, cards.confirmed_records) == (3, 3)
    view = marts.vw_tax_documents(docs, seeds.fy_periods(spark), seeds.tax_categories(spark))
    assert view.count() == 18
    hidden = marts.vw_tax_documents(
        docs, seeds.fy_periods(spark), seeds.tax_categories(spark), include_rejected=False
    )
    assert hidden.count() == 15
    assert portal.investment_documents(view).count() == 0
