"""Financial-health reports on core transactions, trades and balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.calendar import fy_of, month_start
from ledgermill.operators.parcels import SHARES, later_factor, split_factors
from ledgermill.session import kept_copy

# Account types that are owed, and months of the statement check.
DEBT_TYPES = ("CREDIT_CARD", "MORTGAGE")
REMINDER_MONTHS = 3
BASELINE_MONTHS = 3
DERIVED_BUDGET_MONTHS = 3

# Our own threshold: standard deviations that make an outlier.
Z_LIMIT = 2.0

# Trades of a security from which on it is cut into blocks, and trades a sorting task gets.
PLAIN_TRADES, TASK_TRADES = 100_000, 500_000


def monthly_by_category(txns: DataFrame) -> DataFrame:
    """Spend (money out positive) per category and month."""
    return txns.groupBy(
        "category_id", month_start(F.col("txn_date")).alias("month_start")
    ).agg(F.sum(-F.col("amount")).alias("actual_amount"), F.count(F.lit(1)).alias("txn_count"))


def derived_budgets(monthly: DataFrame, months: int = DERIVED_BUDGET_MONTHS) -> DataFrame:
    """Budget per category: mean of its first months. Works on the grouped months."""
    first = Window.partitionBy("category_id").orderBy("month_start")
    return (
        monthly.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") <= months)
        .groupBy("category_id")
        .agg(
            F.round(F.try_divide(F.sum("actual_amount"), F.count(F.lit(1))), 2).alias(
                "derived_amount"
            )
        )
    )


def budget_vs_actual(txns: DataFrame, budgets: DataFrame) -> DataFrame:
    """Month and category with set or derived budget and the difference."""
    monthly = monthly_by_category(txns.filter(F.col("category_id").isNotNull()))
    targets = budgets.select(
        "category_id", F.col("fy_year").alias("_fy"), F.col("month_num").alias("_m"),
        "budget_amount",
    )
    return (
        monthly.withColumn("_fy", fy_of(F.col("month_start")))
        .withColumn("_m", F.month("month_start"))
        .join(targets, ["category_id", "_fy", "_m"], "left")
        .join(derived_budgets(monthly), "category_id")
        .select(
            "category_id",
            "month_start",
            "actual_amount",
            F.coalesce("budget_amount", "derived_amount").alias("budget_amount"),
            F.when(F.col("budget_amount").isNotNull(), "SET").otherwise("DERIVED").alias("budget_source"),
            (F.coalesce("budget_amount", "derived_amount") - F.col("actual_amount")).alias("difference"),
        )
    )


def category_baseline(txns: DataFrame, min_months: int = BASELINE_MONTHS) -> DataFrame:
    """Mean and sample deviation of the absolute amount per category.

    Categories seen in fewer months than ``min_months`` have no baseline. The
    first grouping is per category and month, so counting months needs no
    distinct over the facts.
    """
    size = F.abs("amount").cast("decimal(18,2)")
    per_month = txns.groupBy("category_id", month_start(F.col("txn_date")).alias("_month")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(size).alias("_s"),
        F.sum((size * size).cast("decimal(28,4)")).alias("_ss"),
    )
    totals = per_month.groupBy("category_id").agg(
        F.sum("_n").alias("n"),
        F.sum("_s").cast("double").alias("s"),
        F.sum("_ss").cast("double").alias("ss"),
        F.count(F.lit(1)).alias("months"),
    )
    mean = F.col("s") / F.col("n")
    variance = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    return totals.filter((F.col("months") >= min_months) & (F.col("n") > 1)).select(
        "category_id", mean.alias("mean_amount"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std_amount")
    )


def detect_anomalies(
    txns: DataFrame, categories: DataFrame, z_limit: float = Z_LIMIT
) -> DataFrame:
    """Set ``is_anomaly`` and ``anomaly_reason`` from the category baseline.

    The baseline is taken from the category list outwards: it has one row per
    listed category, so it is as small as that reference table and may be
    broadcast; a category that holds a third of all rows shuffles nothing.
    """
    baseline = categories.select("category_id").join(category_baseline(txns), "category_id")
    score = F.when(
        F.col("std_amount") > 0,
        (F.abs("amount").cast("double") - F.col("mean_amount")) / F.col("std_amount"),
    )
    outlier = F.coalesce(F.abs(score) > z_limit, F.lit(False))
    reason = F.concat(
        F.lit("amount is more than "), F.lit(f"{z_limit:g}"),
        F.lit(" standard deviations from its category mean"),
    )
    kept = [c for c in txns.columns if c not in ("is_anomaly", "anomaly_reason")]
    return txns.join(baseline, "category_id", "left").select(
        *kept, outlier.alias("is_anomaly"), F.when(outlier, reason).alias("anomaly_reason")
    )


def savings_trend(savings: DataFrame, months: int = 3) -> DataFrame:
    """Savings rate with its change and rolling mean; one row per month goes in."""
    by_month = Window.orderBy("month_start")
    rolling = by_month.rowsBetween(-(months - 1), 0)
    rate = F.col("savings_rate_pct").cast("double")
    return savings.select(
        "month_label",
        "month_start",
        "savings_rate_pct",
        (F.col("savings_rate_pct") - F.lag("savings_rate_pct").over(by_month)).alias("rate_change"),
        (F.sum("net_savings").over(rolling)).alias("rolling_net"),
        F.round(F.sum(rate).over(rolling) / F.count(rate).over(rolling), 2).alias("rolling_rate"),
    )


def months_to_payoff(balance: Column, monthly_rate: Column, payment: Column) -> Column:
    """Months until a debt is paid; NULL when the payment never covers the interest."""
    interest_free = F.ceil(balance / payment)
    closed = F.ceil(-F.ln(1 - balance * monthly_rate / payment) / F.ln(1 + monthly_rate))
    return (
        F.when(balance <= 0, F.lit(0))
        .when(payment <= 0, F.lit(None))
        .when(monthly_rate == 0, interest_free)
        .when(balance * monthly_rate < payment, closed)
        .cast("int")
    )


def payoff_schedule(debts: DataFrame) -> DataFrame:
    """Month-by-month balance: ``debts(account_id, balance, annual_rate, payment)``.

    The balance after ``k`` payments has a closed form, so rows are independent.
    """
    balance, payment = F.col("balance").cast("double"), F.col("payment").cast("double")
    rate = F.col("annual_rate").cast("double") / 12
    months = months_to_payoff(balance, rate, payment)
    rows = (
        debts.withColumn("months", months)
        .filter(F.col("months") > 0)
        .withColumn("month_no", F.explode(F.sequence(F.lit(1), F.col("months"))))
    )
    k = F.col("month_no").cast("double")
    growth = F.pow(1 + rate, k)
    left = F.when(rate == 0, balance - payment * k).otherwise(
        balance * growth - payment * (growth - 1) / F.nullif(rate, F.lit(0.0))
    )
    return rows.select(
        "account_id", "months", "month_no",
        # Half a cent must round up although the power leaves a tiny error.
        F.round(F.greatest(left, F.lit(0.0)) + F.lit(1e-9), 2).alias("balance_after"),
    )


def latest_balances(balances: DataFrame) -> DataFrame:
    """Newest balance per account; the maximum is combined before the shuffle."""
    return balances.groupBy("account_id").agg(
        F.max_by("balance", F.struct("as_of", "seq")).alias("balance"), F.max("as_of").alias("as_of")
    )


def net_position(accounts: DataFrame, balances: DataFrame) -> DataFrame:
    """Worth per account type and in total; debts count against it."""
    signed = F.when(F.col("account_type").isin(*DEBT_TYPES), -F.abs("balance")).otherwise(
        F.col("balance")
    )
    return (
        accounts.join(latest_balances(balances), "account_id")
        .rollup("account_type")
        .agg(F.sum(signed).alias("net_amount"), F.count(F.lit(1)).alias("accounts"))
        .withColumn("account_type", F.coalesce("account_type", F.lit("NET WORTH")))
    )


def missing_statements(
    accounts: DataFrame, loaded: DataFrame, as_of: Column, months: int = REMINDER_MONTHS
) -> DataFrame:
    """Active accounts and full months before ``as_of`` without a loaded row."""
    last = F.trunc(as_of, "MM")
    window = F.sequence(
        F.add_months(last, -months), F.add_months(last, -1), F.expr("interval 1 month")
    )
    wanted = accounts.filter("is_active").select(
        "account_id", "account_nme", F.explode(window).alias("month_start")
    )
    seen = (
        loaded.filter(
            (F.col("txn_date") >= F.add_months(last, -months)) & (F.col("txn_date") < last)
        )
        .select("account_id", month_start(F.col("txn_date")).alias("month_start"))
        .distinct()
    )
    return wanted.join(seen, ["account_id", "month_start"], "left_anti")


def _signed_quantity() -> Column:
    """Shares of today that a trade adds; needs ``_factor``."""
    zero = F.lit(0).cast("decimal(15,4)")
    signed = (
        F.when(F.col("trade_type") == "BUY", F.col("quantity"))
        .when(F.col("trade_type") == "SELL", -F.col("quantity"))
        .otherwise(zero)
    )
    return (signed * F.col("_factor")).cast(SHARES)


def _with_factor(trades: DataFrame) -> DataFrame:
    """Add ``_factor``: shares of today for one share of the trade's day."""
    factor = later_factor(F.col("trade_date"), F.col("splits"))
    # Splits are few: a task holds those of its securities and does not sort the trades.
    splits = split_factors(trades).hint("shuffle_hash")
    joined = trades.join(splits, "security_code", "left")
    return joined.withColumn("_factor", factor).drop("splits")


def _held(running: Column) -> Column:
    """Shares of today as shares of the row's day."""
    return (running / F.col("_factor")).cast("decimal(25,4)")


def trade_positions(trades: DataFrame) -> DataFrame:
    """Position per security at the end of each trading day, in the shares of that day.

    Trades are grouped per day first, so the running window of a security sees
    at most one row per calendar day, whatever its trading volume. A split counts
    from the beginning of its day.
    """
    trades = _with_factor(trades)
    zero = F.lit(0).cast("decimal(15,2)")
    sales = F.when(F.col("cgt_event"), F.col("value")).otherwise(zero)
    daily = trades.groupBy("security_code", "trade_date").agg(
        F.sum(_signed_quantity()).alias("_quantity"),
        F.sum(F.coalesce("cost_base", zero)).alias("_cost"),
        F.sum("brokerage").alias("_fee"),
        F.sum(sales).alias("_sales"),
        F.count_if("cgt_event").alias("cgt_events"),
        F.max("_factor").alias("_factor"),
    )
    running = (
        Window.partitionBy("security_code")
        .orderBy("trade_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily.select(
        "security_code",
        "trade_date",
        fy_of(F.col("trade_date")).alias("fy_year"),
        "cgt_events",
        _held(F.sum("_quantity").over(running)).alias("quantity_held"),
        F.sum("_cost").over(running).alias("cost_base"),
        F.sum("_fee").over(running).alias("brokerage"),
        F.sum("_sales").over(running).alias("proceeds"),
    )


def running_trades(
    trades: DataFrame, order: list[str], block: Column
) -> DataFrame:
    """Row-level running quantity per security, in order of day and ``order``.

    A security of up to ``PLAIN_TRADES`` trades is summed in one window. One with more
    is cut into blocks, whose quantities are summed first; a row adds the blocks before
    its own to the window inside its block. Blocks are trading days, cut further by
    ``block``, which must not decrease along ``order`` and should bound the rows of
    a block, for instance a range of the leading order column. So a heavily traded
    security, or day, does not end up in one task. Rows are sorted once, in tasks whose
    number follows the number of trades. Trades are counted when this is called; those
    without security, day or block are summed but not returned. Quantities are those of
    the row's day; a split counts from the beginning of its day.
    """
    trades = trades.filter(F.col("security_code").isNotNull())
    counts = kept_copy(trades.groupBy("security_code").agg(F.count(F.lit(1)).alias("_n")), "counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # No more than one in PLAIN_TRADES trades names such a security.
    busy = F.broadcast(counts.filter(F.col("_n") > PLAIN_TRADES).select("security_code"))
    of_day, keys = ["trade_date", "_block"], ["security_code", "trade_date", "_block"]
    cut = ["_cut_day", "_cut_block"]

    rows = trades.withColumn("_block", block).join(
        busy.withColumn("_busy", F.lit(True)), "security_code", "left"
    )
    rows = _with_factor(rows).withColumn("_q", _signed_quantity())
    for name, column in zip(cut, of_day, strict=True):
        rows = rows.withColumn(name, F.when(F.col("_busy"), F.col(column)))
    tasks = max(trades.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_TRADES))
    rows = rows.drop("_busy").repartition(tasks, "security_code", *cut)
    inside = (
        Window.partitionBy("security_code", *cut)
        .orderBy(*of_day, *order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # A block without a quantity so far has no position.
    counted = F.struct(*of_day)
    last = F.last(F.when(F.col("_q").isNotNull(), counted), ignorenulls=True).over(inside)
    rows = rows.withColumn("_inside", F.when(last.eqNullSafe(counted), F.sum("_q").over(inside)))

    cut_trades = _with_factor(trades.withColumn("_block", block).join(busy, "security_code"))
    blocks = cut_trades.groupBy(*keys).agg(F.sum(_signed_quantity()).alias("_sum"))
    earlier = (
        Window.partitionBy("security_code")
        .orderBy(*of_day)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        "security_code",
        *[F.col(c).alias(name) for name, c in zip(cut, of_day, strict=True)],
        F.sum("_sum").over(earlier).alias("_before"),
    )
    before = F.coalesce("_before", F.lit(0))
    return (
        rows.dropna(subset=of_day)
        .join(offsets, ["security_code", *cut], "left")
        .withColumn("quantity_held", _held(before + F.col("_inside")))
        .drop("_q", "_inside", "_before", "_block", "_factor", *cut)
    )


def confusion_matrix(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    return rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_accuracy(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Share of predictions equal to the reviewed label, per label and overall."""
    right = F.sum(F.when(F.col("predicted") == F.col("actual"), F.col("n")).otherwise(0))
    return (
        confusion_matrix(rows, predicted, actual)
        .rollup("actual")
        .agg(right.alias("correct"), F.sum("n").alias("reviewed"))
        .select(
            F.coalesce(F.col("actual").cast("string"), F.lit("ALL")).alias("label"),
            "correct",
            "reviewed",
            F.round(F.col("correct") * 100 / F.col("reviewed"), 1).alias("accuracy_pct"),
        )
    )


def energy_monthly(line_items: DataFrame) -> DataFrame:
    """Peak usage, feed-in credit and daily charge per month of the bill."""
    text = F.col("description")
    zero = F.lit(0).cast("decimal(18,4)")

    def total(pattern: str, column: str) -> Column:
        return F.sum(F.when(text.ilike(pattern), F.col(column)).otherwise(zero))

    return (
        line_items.filter(F.col("billing_start").isNotNull())
        .groupBy(month_start(F.col("billing_start")).alias("month_start"))
        .agg(
            total("%peak%", "quantity").alias("peak_kwh"),
            total("%solar%", "amount").alias("solar_credit"),
            total("%daily%", "amount").alias("daily_charge"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
