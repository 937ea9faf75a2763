from __future__ import annotations

import datetime
import math
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import baselines

TXN = "txn_id LONG, category_id INT, txn_date DATE, amount DECIMAL(12,2)"


def txns(spark, rows):
    return spark.createDataFrame(rows, TXN)


def rows_of(count, seed, months=6):
    rng = random.Random(seed)
    return [
        (i, rng.choice([1, 1, 1, 2]), datetime.date(2024, 1 + rng.randrange(months), 1 + rng.randrange(28)),
         Decimal(rng.randint(-10**6, 10**6)) / 100)
        for i in range(count)
    ]


def test_small_months_are_exact(spark):
    rows = rows_of(300, 1) + [(900, None, datetime.date(2024, 1, 1), Decimal(1)), (901, 1, datetime.date(2024, 1, 1), None)]
    known = baselines.month_baselines(baselines.month_sketches(txns(spark, rows)), months=3)
    found = {(r["category_id"], r["month_start"]): r for r in known.collect()}
    for (category, month), r in found.items():
        first = month.month + 12 * (month.year - 2024)
        values = sorted(abs(a) for _, c, d, a in rows if c == category and a is not None and first - 3 <= d.month < first)
        assert r["amounts"] == len(values)
        for name, rank in (("low_quartile", 0.25), ("median", 0.5), ("high_quartile", 0.75)):
            assert r[name] == values[math.ceil(rank * len(values)) - 1]


def test_large_months_stay_inside_the_error(spark):
    """Merged sketches of many amounts: the rank is off by the sketch's error at most."""
    k, rows = 200, rows_of(20_000, 2)
    error = 0.0165 * 2
    sketches = baselines.month_sketches(txns(spark, rows).repartition(8), k)
    known = baselines.month_baselines(sketches, months=12).filter("month_start = DATE'2024-07-01'")
    for r in known.collect():
        values = sorted(abs(a) for _, c, _, a in rows if c == r["category_id"])
        for name, rank in (("low_quartile", 0.25), ("median", 0.5), ("high_quartile", 0.75)):
            at = sum(v <= r[name] for v in values) / len(values)
            assert abs(at - rank) <= error
        assert sum(1 for _ in values) == r["amounts"] > 10 * k


def test_a_new_month_reads_only_itself(spark, folder):
    rows = rows_of(400, 3)
    path = f"{folder}/sketches"
    whole = baselines.month_sketches(txns(spark, rows))
    for month in (1, 2, 3, 4, 5, 6, 4):
        new = [r for r in rows if r[2].month == month]
        baselines.write_months(baselines.month_sketches(txns(spark, new)), path)
    stored = baselines.read_months(spark, path)
    assert stored.count() == whole.count()
    one = baselines.month_baselines(stored).orderBy("category_id", "month_start").collect()
    two = baselines.month_baselines(whole).orderBy("category_id", "month_start").collect()
    assert one == two
    flagged = baselines.median_outliers(txns(spark, rows), baselines.month_baselines(stored), spreads=0.1)
    assert 0 < flagged.count() < 200
    assert flagged.filter(F.abs("amount") <= F.col("high_quartile")).count() == 0
    empty = baselines.month_sketches(txns(spark, []))
    assert baselines.month_baselines(empty).count() == 0
