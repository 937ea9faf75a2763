from __future__ import annotations

from decimal import Decimal
from html.parser import HTMLParser

import random

from pyspark.sql import functions as F

from ledgermill.functions import tables


class Reference(HTMLParser):
    """Rows of tables by the standard's grid: spans fill places from the left, rows from above."""

    def __init__(self):
        super().__init__()
        self.rows, self.table, self.reach, self.cell = [], 0, {}, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.close_row()
            self.table, self.reach = self.table + 1, {}
        elif tag == "tr":
            self.close_row()
            self.row, self.below = [], {}
        elif tag in ("td", "th"):
            self.close_cell()
            self.cell, self.spans = "", dict(attrs)

    def handle_data(self, data):
        if self.cell is not None:
            self.cell += data

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.close_cell()
        elif tag in ("tr", "table"):
            self.close_row()

    def fill(self):
        while len(self.row) in self.reach:
            self.row.append(self.reach[len(self.row)][0])

    def close_cell(self):
        if self.cell is None:
            return
        text, wide, high = " ".join(self.cell.split()), int(self.spans.get("colspan") or 1), int(self.spans.get("rowspan") or 1)
        self.fill()
        for _ in range(max(1, wide)):
            if high > 1:
                self.below[len(self.row)] = (text, high - 1)
            self.row.append(text)
        self.cell = None

    row = None

    def close_row(self):
        self.close_cell()
        if self.row is not None:
            self.fill()
            self.rows.append((self.table, self.row))
            left = {c: (t, n - 1) for c, (t, n) in self.reach.items() if n > 1}
            self.reach = {**left, **self.below}
            self.row = None


def rows_of(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i INT, html STRING")
    found = df.select("i", tables.table_rows(F.col("html")).alias("r")).collect()
    return {r["i"]: None if r["r"] is None else [(x["table_no"], list(x["cells"])) for x in r["r"]] for r in found}


def test_rows_match_a_parser(spark):
    rng = random.Random(5)
    pages = []
    for _ in range(60):
        page = "<p>text</p>"
        for _ in range(rng.randint(1, 2)):
            page += rng.choice(["<table>", "<TABLE class='a > b'>"])
            for r in range(rng.randint(1, 5)):
                page += "<tr>"
                for c in range(rng.randint(0, 4)):
                    tag = rng.choice(["td", "th", "TD"])
                    spans = rng.choice(["", "", "", ' colspan="2"', " rowspan=2", " rowspan='3' colspan=2", ' title="x > y"'])
                    page += f"<{tag}{spans}> <b>c{r}</b> {c}&amp;  z" + rng.choice([f"</{tag}>", ""])
                page += rng.choice(["</tr>", ""])
            page += "</table>between"
        pages.append(page)
    found = rows_of(spark, pages)
    for i, page in enumerate(pages):
        parser = Reference()
        parser.feed(page)
        parser.close_row()
        assert found[i] == parser.rows, page


def test_hidden_markup_and_odd_pages(spark):
    pages = [None, "", "<td>no row</td>", "<table><!-- <tr><td>x</td></tr> --><script>'<tr><td>'</script></table>",
             "<tr><td>outside", "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr><tr><td>c</td></tr></table>",
             "<table><tr>" + "<td>w</td>" * 500 + "</tr></table>"]
    found = rows_of(spark, pages)
    assert found[0] is None and [found[i] for i in (1, 2, 3)] == [[], [], []]
    assert found[4] == [(0, ["outside"])]
    assert found[5] == [(1, ["a"]), (2, ["in"]), (2, ["c"])]
    assert found[6] == [(1, ["w"] * 500)]


def test_bill_items(spark):
    page = (
        "<table><tr><th>Charge</th><th>Usage</th><th>Rate</th><th>Amount ($)</th></tr>"
        "<tr><td>Peak <i>Usage</i></td><td>1,180.2 kWh</td><td>$0.3524</td><td>$415.90</td></tr>"
        "<tr><td rowspan=2>Solar</td><td>95.3 kWh</td><td>0.05</td><td>4.77 CR</td></tr>"
        "<tr><td>1 kWh</td><td>0.05</td><td>($0.05)</td></tr>"
        "<tr><td colspan=3>Total due</td><td></td></tr></table>"
        "<table><tr><td>Peak</td><td>1</td><td>2</td><td>3</td></tr></table>"
    )
    df = spark.createDataFrame([(page,), (None,), ("<p>",)], "html STRING")
    found = df.select(tables.bill_items(F.col("html")).alias("i")).collect()
    assert [tuple(x) for x in found[0]["i"]] == [
        ("Peak Usage", None, Decimal("1180.2000"), "kWh", Decimal("0.3524"), Decimal("415.90")),
        ("Solar", None, Decimal("95.3000"), "kWh", Decimal("0.0500"), Decimal("-4.77")),
        ("Solar", None, Decimal("1.0000"), "kWh", Decimal("0.0500"), Decimal("-0.05")),
    ]
    assert found[1]["i"] is None and found[2]["i"] == []
