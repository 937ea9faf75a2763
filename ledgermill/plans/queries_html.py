"""Charge lines of bills that are HTML tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill.functions import tables
from ledgermill.plans import frames
from ledgermill.plans.registry import query

# A bill of two tables before the page's own markup; the credit has two rows under one name.
_BILL = (
    "<table border=0><tr><th>Charge</th><th>Usage</th><th>Rate</th><th>Amount</th></tr>",
    "<tr><td>Peak <b>Usage</b></td><td>{n} kWh</td><td>$0.3524</td><td>${n}.50</td></tr>",
    "<tr><td rowspan='2'>Solar &amp; Feed-In</td><td>95.3 kWh</td><td>0.05</td><td>{n}.25 CR</td></tr>",
    "<tr><td>1 kWh</td><td>0.05</td><td>($0.05)</td></tr>",
    "<!-- <tr><td>Hidden</td><td>1</td><td>1</td><td>1</td></tr> -->",
    "<tr><td colspan=3>Total due</td><td></td></tr></table>",
    "<table><tr><th>Item</th><th>Period</th><th>Qty</th><th>Unit</th><th>Total</th></tr>",
    "<tr><td>Supply</td><td>May</td><td>31</td><td>days</td><td>29.39</td></tr></table>",
)


@query(
    "bill_items_from_html",
    """SELECT page_id, x.* FROM pages, LATERAL (VALUES
  (1, 'Peak Usage', NULL, CAST(page_id AS DOUBLE), 'kWh', 0.3524, page_id + 0.5),
  (2, 'Solar & Feed-In', NULL, 95.3, 'kWh', 0.05, -(page_id + 0.25)),
  (3, 'Solar & Feed-In', NULL, 1.0, 'kWh', 0.05, -0.05),
  (4, 'Supply', 'May', 31.0, 'days', NULL, 29.39)) x(line_num, description, period, quantity, unit, rate, amount)""",
)
def bill_items_from_html(spark, sf):
    number = F.col("page_id").cast("string")
    bill = F.replace(F.lit("".join(_BILL)), F.lit("{n}"), number)
    pages = frames.table(spark, sf, "pages").select(
        "page_id", F.concat(bill, F.coalesce("html", F.lit(""))).alias("html")
    )
    items = pages.select("page_id", F.posexplode(tables.bill_items(F.col("html"))).alias("pos", "i"))
    return items.select(
        "page_id", (F.col("pos") + 1).alias("line_num"), "i.description", "i.period", "i.quantity",
        "i.unit", "i.rate", "i.amount",
    )
