from __future__ import annotations

import datetime
import random
from fractions import Fraction

from pyspark.sql import functions as F

from ledgermill.operators import health, parcels
from tests.rows import frame

D = datetime.date
TRADE = (
    "security_code STRING, trade_date DATE, trade_no LONG, trade_type STRING, quantity DECIMAL(15,4), "
    "value DECIMAL(15,2), brokerage DECIMAL(10,2), cost_base DECIMAL(15,2), cgt_event BOOLEAN"
)


def rows_of(trades):
    return [
        {"security_code": c, "trade_date": d, "trade_no": i, "trade_type": t, "quantity": q,
         "value": v, "brokerage": f, "cgt_event": t == "SELL"}
        for i, (c, d, t, q, v, f) in enumerate(trades)
    ]


def found_rows(spark, trades, **options):
    from decimal import Decimal as De

    rows = [{**r, **{k: None if r[k] is None else De(str(r[k])) for k in ("quantity", "value", "brokerage")}}
            for r in rows_of(trades)]
    df = frame(spark, TRADE, rows).repartition(3)
    found = parcels.cgt_parcels(df, ["trade_no"], F.floor(F.col("trade_no") / 7), **options).collect()
    return sorted(
        ((r["security_code"], r["sell_trade_no"], r["buy_trade_no"], Fraction(str(r["quantity"])),
          r["cost_base"], r["proceeds"]) for r in found),
        key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0),
    )


def brute(trades):
    """A queue of purchases per security, in the shares of today."""
    rows = rows_of(trades)

    def factor(r):
        result = Fraction(1)
        for s in rows:
            if (s["trade_type"] == "SPLIT" and s["quantity"] > 0 and s["security_code"] == r["security_code"]
                    and s["trade_date"] > r["trade_date"]):
                result *= Fraction(str(s["quantity"]))
        return result

    def cents(value):
        return round(float(value) + 1e-9, 2)

    found = []
    for code in {r["security_code"] for r in rows}:
        mine = sorted((r for r in rows if r["security_code"] == code), key=lambda r: (r["trade_date"], r["trade_no"]))

        def line(kind):
            return [[r, Fraction(str(r["quantity"])) * factor(r)] for r in mine
                    if r["trade_type"] == kind and r["quantity"] and r["quantity"] > 0]

        queue = line("BUY")
        for sell, left in line("SELL"):
            each = (Fraction(str(sell["value"] or 0)) - Fraction(str(sell["brokerage"] or 0))) / left
            while left:
                if not queue:
                    found.append((code, sell["trade_no"], None, left, None, cents(each * left)))
                    break
                buy, have = queue[0]
                full = Fraction(str(buy["quantity"])) * factor(buy)
                cost = (Fraction(str(buy["value"] or 0)) + Fraction(str(buy["brokerage"] or 0))) / full
                part = min(left, have)
                found.append((code, sell["trade_no"], buy["trade_no"], part, cents(cost * part), cents(each * part)))
                left -= part
                queue[0][1] -= part
                if not queue[0][1]:
                    queue.pop(0)
    return sorted(found, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0))


def near(found, expected):
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for f, e in zip(found, expected, strict=True):
        for a, b in zip(f[4:], e[4:], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 0.011), (f, e)


def test_partial_disposals_and_a_split(spark):
    trades = [
        ("X", D(2024, 1, 1), "BUY", 10, 100, 5),
        ("X", D(2024, 2, 1), "BUY", 10, 200, 0),
        ("X", D(2024, 3, 1), "SPLIT", 2, 0, 0),
        ("X", D(2024, 4, 1), "SELL", 25, 500, 10),
        ("X", D(2025, 6, 1), "SELL", 20, 500, 0),
    ]
    found = found_rows(spark, trades)
    assert found == [
        ("X", 3, 0, 20, 105.0, 392.0), ("X", 3, 1, 5, 50.0, 98.0),
        ("X", 4, 1, 15, 150.0, 375.0), ("X", 4, None, 5, None, 125.0),
    ]


def test_matches_a_queue_and_cells_do_not_matter(spark):
    rng = random.Random(6)
    trades = []
    for _ in range(400):
        # One security has two thirds of the trades, many of them on one day.
        code = rng.choice(["HOT"] * 6 + ["A", "B", "C"])
        day = D(2024, 1, 1) if rng.random() < 0.4 else D(2024, 1, 1) + datetime.timedelta(rng.randrange(500))
        kind = rng.choice(["BUY", "BUY", "SELL", "SELL", "DIVIDEND", "OTHER"])
        trades.append((code, day, kind, rng.choice([1, 2, 3.5, 40, 0, None, -1]), rng.randrange(1, 900), rng.choice([0, 9.95, None])))
    trades = [t for t in trades if t[3] is not None]
    trades += [("HOT", D(2024, 5, 1), "SPLIT", 3, 0, 0), ("HOT", D(2024, 9, 1), "SPLIT", 0.5, 0, 0), ("A", D(2024, 1, 1), "SPLIT", 2, 0, 0)]
    trades += [("NONE", D(2024, 1, 1), "SELL", 4, 10, 0)]
    expected = brute(trades)
    for cell in (1, 10, 10**6):
        near(found_rows(spark, trades, cell_shares=cell), expected)


def test_positions_are_in_the_shares_of_the_day(spark):
    from decimal import Decimal as De

    trades = [("X", D(2024, 1, 1), "BUY", 10, 100, 5), ("X", D(2024, 3, 1), "SPLIT", 2, 0, 0),
              ("X", D(2024, 4, 1), "SELL", 5, 50, 0), ("X", D(2024, 5, 1), "DIVIDEND", 7, 50, 0)]
    rows = [{**r, **{k: De(str(r[k])) for k in ("quantity", "value", "brokerage")}} for r in rows_of(trades)]
    df = frame(spark, TRADE, rows)
    daily = health.trade_positions(df).orderBy("trade_date").collect()
    assert [float(r["quantity_held"]) for r in daily] == [10, 20, 15, 15]
    running = health.running_trades(df, ["trade_no"], F.lit(0)).orderBy("trade_no").collect()
    assert [float(r["quantity_held"]) for r in running] == [10, 20, 15, 15]


def test_running_trades_are_sorted_once_in_tasks_by_their_number(spark, monkeypatch):
    from decimal import Decimal as De

    rng = random.Random(3)
    trades = [
        (rng.choice(["HOT", "HOT", "HOT", "A", "B", None]), rng.choice([None, *[D(2024, 1, d) for d in range(1, 9)]]),
         rng.choice(["BUY", "SELL", "DIVIDEND", "SPLIT"]), rng.choice([1, 2, 4, None]), 1, 0)
        for _ in range(300)
    ]
    # Nearly all ratios are one, so that positions stay short.
    trades = [(c, d, t, 1 if t == "SPLIT" and rng.random() < 0.9 else q, v, f) for c, d, t, q, v, f in trades]
    rows = [{**r, **{k: None if r[k] is None else De(str(r[k])) for k in ("quantity", "value", "brokerage")}}
            for r in rows_of(trades)]

    def shares(r):
        if r["quantity"] is None and r["trade_type"] in ("BUY", "SELL"):
            return None
        sign = {"BUY": 1, "SELL": -1}.get(r["trade_type"], 0)
        return sign * Fraction(str(r["quantity"] or 0)) * factor(r)

    def factor(r):
        result = Fraction(1)
        for s in rows:
            if (s["trade_type"] == "SPLIT" and s["quantity"] and s["security_code"] == r["security_code"]
                    and s["trade_date"] and r["trade_date"] and s["trade_date"] > r["trade_date"]):
                result *= Fraction(str(s["quantity"]))
        return result

    expected = {}
    for code in ("HOT", "A", "B"):
        held, at, counted = Fraction(0), None, False
        mine = [r for r in rows if r["security_code"] == code]
        for r in sorted(mine, key=lambda r: (r["trade_date"] or D(1, 1, 1), r["trade_no"])):
            here = (r["trade_date"], r["trade_no"] // 7)
            added, counted = shares(r), counted and here == at
            at, held, counted = here, held + (added or 0), counted or added is not None
            if r["trade_date"]:
                expected[r["trade_no"]] = round(float(held / factor(r)), 4) if counted else None
    df = frame(spark, TRADE, rows).repartition(3)
    monkeypatch.setattr(health, "TASK_TRADES", 10)
    for most in (0, 100, 10**6):
        monkeypatch.setattr(health, "PLAIN_TRADES", most)
        found = health.running_trades(df, ["trade_no"], F.floor(F.col("trade_no") / 7))
        plan = found._jdf.queryExecution().executedPlan().toString()
        known = sum(r["security_code"] is not None for r in rows)
        assert "_cut_block#" in plan and f", {-(-known // 10)}), REPARTITION_BY_NUM" in plan
        assert {r.trade_no: None if r.quantity_held is None else float(r.quantity_held) for r in found.collect()} == expected


def test_empty_and_hot_plan(spark):
    empty = frame(spark, TRADE, [])
    found = parcels.cgt_parcels(empty, ["trade_no"], F.lit(0))
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_trades_are_laid_on_their_line_once(spark):
    rows = [{**r, "quantity": None, "value": None, "brokerage": None} for r in rows_of([("A", D(2024, 1, 1), "BUY", 1, 1, 0)])]
    found = parcels.cgt_parcels(frame(spark, TRADE, rows), ["trade_no"], F.lit(0))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # What follows reads the written line, and matches every piece once.
    assert "parquet" in plan and "RDD" not in plan and "Union" not in plan
    assert found.count() == 0
