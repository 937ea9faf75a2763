from __future__ import annotations

import datetime
import hashlib
import hmac

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions import calendar, crypto, text, values


def one(spark, column, **fields):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()], F.lit(1).alias("_"))
    return row.select(column.alias("x")).first()["x"]


def test_financial_year_agrees_with_the_bounds_on_every_day(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'2022-07-01', DATE'2026-06-30')) AS day"
    ).withColumn("computed", calendar.fy_of(F.col("day")))
    both = calendar.with_fy_period(days, F.col("day"), seeds.fy_periods(spark), "looked_up")
    assert both.count() == 1461
    assert both.filter("computed <> looked_up OR looked_up IS NULL").count() == 0


def test_day_outside_every_period_has_no_year(spark):
    days = spark.sql("SELECT DATE'2022-06-30' AS day UNION ALL SELECT DATE'2026-07-01'")
    found = calendar.with_fy_period(days, F.col("day"), seeds.fy_periods(spark), "fy")
    assert [r.fy for r in found.collect()] == [None, None]


def test_year_edge_follows_the_session_time_zone(spark):
    moment = "SELECT TIMESTAMP'2025-06-30 23:30:00 UTC' AS t"
    try:
        assert spark.sql(moment).select(calendar.fy_of(F.to_date("t"))).first()[0] == 2025
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        assert spark.sql(moment).select(calendar.fy_of(F.to_date("t"))).first()[0] == 2026
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_parts(spark):
    day = F.lit("2024-07-15").cast("date")
    assert one(spark, calendar.month_start(day)) == datetime.date(2024, 7, 1)
    assert one(spark, calendar.month_label(day)) == "2024-07"
    assert one(spark, calendar.fy_folder(F.lit(2025))) == "2024-2025"
    assert one(spark, calendar.days_since_fy_start(day, F.lit(2025))) == 14


def test_high_water_mark_falls_back_to_the_floor(spark):
    empty = spark.createDataFrame([], "source_type STRING, received_at TIMESTAMP")
    mark = calendar.high_water_mark(empty).first()["watermark_ms"]
    assert mark == int(datetime.datetime(2022, 7, 1, tzinfo=datetime.UTC).timestamp() * 1000)
    today = F.lit("2025-03-01").cast("date")
    row = calendar.high_water_mark_previous_fy(empty, today).first()
    start = datetime.datetime(2023, 7, 1, tzinfo=datetime.UTC).timestamp() * 1000
    assert row["watermark_ms"] == int(start)
    assert row["before_date"] == datetime.date(2025, 3, 1)


def test_safe_dates(spark):
    texts = ["2026-01-00", "", "null", "2026-01", "5 Mar 2026", None, "2025-02-28"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = [r[0] for r in rows.select(values.safe_to_date(F.col("t"))).collect()]
    assert found == [None] * 6 + [datetime.date(2025, 2, 28)]


def test_money_and_statement_dates(spark):
    assert str(one(spark, values.money(F.lit("$1,234.50")))) == "1234.50"
    assert str(one(spark, values.money(F.lit("(1,234.50)")))) == "-1234.50"
    assert one(spark, values.money(F.lit("n/a"))) is None
    assert one(spark, values.money(F.lit(""))) is None
    for raw, day in (("4 Mar 26", 4), ("24 Mar 26", 24)):
        assert one(spark, values.statement_date(F.lit(raw), "%d %b %y")) == datetime.date(2026, 3, day)
    assert one(spark, values.statement_date(F.lit("24 Mar 99"), "%d %b %y")).year == 1999
    assert one(spark, values.statement_date(F.lit("24/03/2026"), "%d/%m/%Y")).month == 3
    assert one(spark, values.statement_date(F.lit("31/02/2026"), "%d/%m/%Y")) is None


@settings(max_examples=20, deadline=None)
@given(message=st.text(max_size=80), secret=st.text("abcXYZ-123", min_size=1, max_size=64))
def test_signature_equals_the_library_one(spark, message, secret):
    expected = hmac.new(secret.encode(), message.encode(), hashlib.sha256).hexdigest()
    row = spark.createDataFrame([(message,)], "m STRING")
    assert row.select(crypto.hmac_sha256(F.col("m"), secret)).first()[0] == expected


def test_a_signing_secret_is_required():
    import pytest

    with pytest.raises(ValueError):
        crypto.hmac_pads("")


def test_encryption_round_trip(spark):
    key = "0123456789abcdef"
    assert one(spark, crypto.decrypt(crypto.encrypt(F.lit("geheim ü"), key), key)) == "geheim ü"


def test_hash_text_keeps_the_place_of_missing_parts(spark):
    a = one(spark, crypto.dedup_hash(F.lit(None), F.lit("x")))
    b = one(spark, crypto.dedup_hash(F.lit("x"), F.lit(None)))
    assert a == hashlib.sha256(b"|x").hexdigest() and a != b


def test_preview_and_html(spark):
    assert len(one(spark, text.preview(F.lit("x" * 501)))) == 500
    assert one(spark, text.preview(F.lit("a\0b"))) == "ab"
    assert one(spark, text.preview(F.lit(""))) is None
    html = (
        "<html><head><style>p{}</style><script>var a='</p>';</script></head>"
        "<body><!-- x --><p>Total &amp;&nbsp;due: 5 &lt; 6</p></body></html>"
    )
    assert one(spark, text.html_to_text(F.lit(html))) == "Total & due: 5 < 6"
    assert one(spark, text.html_to_text(F.lit("&amp;lt;"))) == "&lt;"


def test_message_body_and_names(spark):
    import base64

    coded = base64.urlsafe_b64encode("<p>Grüße ??>></p>".encode()).decode().rstrip("=")
    assert one(spark, text.body_text(F.lit(coded), F.lit("snippet"))) == "Grüße ??>>"
    assert one(spark, text.body_text(F.lit(None).cast("string"), F.lit("snippet"))) == "snippet"
    assert one(spark, text.sender_address(F.lit("Ann <a@b.c>"))) == "a@b.c"
    assert one(spark, text.sender_address(F.lit(" a@b.c "))) == "a@b.c"
    assert one(spark, text.filed_name(F.lit('A/B: "C"'), F.lit("x.pdf"))) == "AB C - x.pdf"
    assert one(spark, text.filed_name(F.lit("?*"), F.lit("x.pdf"))) == "x.pdf"
    assert one(spark, text.file_extension(F.lit("a.b.PDF"))) == "pdf"
    assert one(spark, text.file_extension(F.lit("none"))) is None


def test_bill_lines(spark):
    bill = (
        "Energy Co\nPeak Usage 180.2 kWh @ $0.3524 = $63.51\n"
        "Solar Feed-In Credit 95.3 kWh @ 0.05 = -$4.77\nRebate 1 months @ 5.00 = $1,005.00 CR\n"
        "Daily Supply Charge 31 days @ 0.9482 = $29.39\nTotal $88.13"
    )
    items = one(spark, text.bill_lines(F.lit(bill)))
    assert [i["description"] for i in items] == [
        "Peak Usage", "Solar Feed-In Credit", "Rebate", "Daily Supply Charge",
    ]
    assert [float(i["amount"]) for i in items] == [63.51, -4.77, -1005.0, 29.39]
    assert float(items[0]["quantity"]) == 180.2 and items[3]["unit"] == "days"


def test_long_signing_secrets_are_hashed_first(spark):
    secret = "s" * 100
    found = spark.range(1).select(crypto.hmac_sha256(F.lit("text"), secret)).first()[0]
    assert found == hmac.new(secret.encode(), b"text", hashlib.sha256).hexdigest()
