"""Cost base by parcel: disposals matched with purchases, first in, first out.

The purchases of a security lie side by side on a line of shares, in the order they
were made, and so do its disposals; where a purchase and a disposal overlap, that many
shares of the purchase were sold. Both lines are in the shares of today: a split
multiplies what was traded on earlier days. The starts of purchases and disposals cut
the line into pieces, and every piece belongs to the last purchase and the last disposal
that start before it. So there is no join of intervals, and the work is in proportion
to the trades.

A line is cut into cells of a fixed number of shares. A cell needs only the last starts
and the next start outside it, one row per cell, so a security with very many trades
is worked on in many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import kept_copy

SHARES = "decimal(28,8)"
CELL_SHARES = 1_000_000
KEYS = ("security_code",)


def split_factors(trades: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, splits: the days and ratios (new shares for an old one) of each security."""
    split = F.struct("trade_date", F.col("quantity").cast(SHARES).alias("ratio"))
    return (
        trades.filter("trade_type = 'SPLIT' AND quantity > 0")
        .groupBy(*keys)
        .agg(F.collect_list(split).alias("splits"))
    )


def later_factor(day: Column, splits: Column) -> Column:
    """Shares of today for one share of ``day``: the product of the splits after it."""
    later = F.filter(F.coalesce(splits, F.array()), lambda s: s["trade_date"] > day)
    return F.aggregate(
        later,
        F.lit(1).cast(SHARES),
        lambda product, s: (product * s["ratio"]).cast(SHARES),
    )


def running_shares(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: str, out: str
) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over the rows before each.

    Rows are ordered by day, ``block`` and ``order``; ``block`` must not decrease along
    ``order``. A window holds the rows of one block, another one row per block.
    """
    inside = [*keys, "trade_date", "_block"]
    blocked = rows.withColumn("_block", block)
    sums = blocked.groupBy(*inside).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("trade_date", "_block")
    offsets = sums.select(
        *inside,
        F.coalesce(
            F.sum("_sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    window = Window.partitionBy(*inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum(value).over(window), F.lit(0)))
        .join(offsets, inside)
        .withColumn(out, (F.col("_inside") + F.col("_offset")).cast(SHARES))
        .drop("_block", "_inside", "_offset")
    )


def _pieces(starts: DataFrame, keys: Sequence[str], cell_shares: int) -> DataFrame:
    """keys, at, next_at, buy_start, sell_start of every piece of the lines."""
    points = (
        starts.groupBy(*keys, "start")
        .agg(
            F.max(F.when(F.col("side") == "BUY", F.col("start"))).alias("_buy"),
            F.max(F.when(F.col("side") == "SELL", F.col("start"))).alias("_sell"),
        )
        .withColumn("_cell", F.floor(F.col("start") / cell_shares))
    )
    cells = points.groupBy(*keys, "_cell").agg(
        F.min("start").alias("_first"), F.max("_buy").alias("_buy"), F.max("_sell").alias("_sell")
    )
    along = Window.partitionBy(*keys).orderBy("_cell")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    around = cells.select(
        *keys,
        "_cell",
        F.max("_buy").over(earlier).alias("_buy_before"),
        F.max("_sell").over(earlier).alias("_sell_before"),
        F.lead("_first").over(along).alias("_first_after"),
    )
    inside = Window.partitionBy(*keys, "_cell").orderBy("start")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        points.withColumn("_buy_here", F.max("_buy").over(so_far))
        .withColumn("_sell_here", F.max("_sell").over(so_far))
        .withColumn("_next", F.lead("start").over(inside))
        .join(around, [*keys, "_cell"])
        .select(
            *keys,
            F.col("start").alias("at"),
            F.coalesce("_next", "_first_after").alias("next_at"),
            F.coalesce("_buy_here", "_buy_before").alias("buy_start"),
            F.coalesce("_sell_here", "_sell_before").alias("sell_start"),
        )
    )


def _cents(value: Column) -> Column:
    return F.floor(value * 100 + F.lit(0.5) + F.lit(1e-6)) / 100


def cgt_parcels(
    trades: DataFrame,
    order: Sequence[str],
    block: Column,
    keys: Sequence[str] = KEYS,
    cell_shares: int = CELL_SHARES,
) -> DataFrame:
    """One row per disposal and the purchase it draws on, with cost, proceeds and gain.

    ``order`` names the columns that order the trades of a day, ``keys`` and ``order``
    a trade. Returns ``keys``, ``sell_<order>``, ``sell_date``, ``buy_<order>``,
    ``buy_date``, quantity (shares of today), cost_base (share of the purchase's value
    and brokerage), proceeds (share of the disposal's value less brokerage), gain and
    held_over_year. Shares sold beyond all purchases have no purchase and no cost. If a
    disposal came before the purchase it draws on (a short sale), the row says so by
    its dates. Trades without a positive quantity, and other types, draw on nothing. A
    split counts from the beginning of its day.
    """
    sides = trades.filter("trade_type IN ('BUY', 'SELL') AND quantity > 0")
    adjusted = (
        sides.join(split_factors(trades, keys), list(keys), "left")
        .withColumn(
            "shares",
            (F.col("quantity") * later_factor(F.col("trade_date"), F.col("splits"))).cast(SHARES),
        )
        .withColumnRenamed("trade_type", "side")
        .drop("splits")
    )
    lined = running_shares(adjusted, [*keys, "side"], order, block, "shares", "start").select(
        *keys,
        "side",
        "trade_date",
        *order,
        "start",
        "shares",
        F.coalesce("value", F.lit(0)).cast("double").alias("value"),
        F.coalesce("brokerage", F.lit(0)).cast("double").alias("brokerage"),
    )
    # Read three times: for the pieces, the disposals and the purchases.
    lined = kept_copy(lined, "lined")
    pieces = _pieces(lined, keys, cell_shares)

    def trade(side: str, amount: Column) -> DataFrame:
        name = side.lower()
        return lined.filter(F.col("side") == side).select(
            *keys,
            F.col("start").alias(f"{name}_start"),
            (F.col("start") + F.col("shares")).cast(SHARES).alias(f"{name}_end"),
            F.col("trade_date").alias(f"{name}_date"),
            *[F.col(c).alias(f"{name}_{c}") for c in order],
            (amount / F.col("shares").cast("double")).alias(f"{name}_per_share"),
        )

    sold = pieces.join(
        trade("SELL", F.col("value") - F.col("brokerage")), [*keys, "sell_start"]
    )
    matched = sold.join(
        trade("BUY", F.col("value") + F.col("brokerage")), [*keys, "buy_start"], "left"
    )
    # Past the end of the last purchase a piece has a start to its left but no purchase.
    inside = F.col("at") < F.col("buy_end")
    end = F.least("next_at", "sell_end", F.when(inside, F.col("buy_end")))
    has = F.coalesce(inside, F.lit(False))
    part = F.struct(has.alias("_has"), (end - F.col("at")).cast(SHARES).alias("quantity"))
    # The rest of a piece that outlasts the last purchase.
    rest = F.struct(
        F.lit(False).alias("_has"),
        F.when(has, F.least("next_at", "sell_end") - F.col("buy_end")).cast(SHARES).alias("quantity"),
    )
    both = (
        matched.withColumn("_part", F.explode(F.array(part, rest)))
        .select("*", "_part.*")
        .filter("quantity > 0")
    )

    def bought(name: str) -> Column:
        return F.when(F.col("_has"), F.col(name)).alias(name)

    shares = F.col("quantity").cast("double")
    rows = both.select(
        *keys,
        *[f"sell_{c}" for c in order],
        "sell_date",
        *[bought(f"buy_{c}") for c in order],
        bought("buy_date"),
        F.col("quantity"),
        F.when(F.col("_has"), _cents(F.col("buy_per_share") * shares)).alias("cost_base"),
        _cents(F.col("sell_per_share") * shares).alias("proceeds"),
    )
    return rows.withColumn("gain", F.round(F.col("proceeds") - F.col("cost_base"), 2)).withColumn(
        "held_over_year", F.add_months("buy_date", 12) < F.col("sell_date")
    )
