"""Bank and share statement rows: canonical form, dedupe and watermarks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import values
from ledgermill.functions.calendar import fy_of
from ledgermill.functions.crypto import dedup_hash
from ledgermill.schemas import TRADE_TYPES

# Date formats of the statement providers.
STATEMENT_FORMATS = ("%d %b %y", "%d/%m/%Y")
TRADE_FORMATS = ("%d/%m/%Y", "%Y-%m-%d")


def clean_description(raw: Column) -> Column:
    """Blanks collapsed and trimmed; the whole text, as rules search all of it."""
    return F.trim(F.regexp_replace(raw, r"\s+", " "))


def canonical_amount(amount: Column, debit: Column, credit: Column, single: Column) -> Column:
    """Positive is money in: a signed column as it is, else credit less debit."""
    zero = F.lit(0).cast("decimal(12,2)")
    paid, received = values.money(debit), values.money(credit)
    split = F.when(
        paid.isNotNull() | received.isNotNull(),
        (F.coalesce(received, zero) - F.coalesce(paid, zero)).cast("decimal(12,2)"),
    )
    return F.when(single, values.money(amount)).otherwise(split)


def _date_in(text: Column, format_name: Column, formats: tuple[str, ...]) -> Column:
    """Parse by the row's format; one fixed pattern per branch keeps the parser cached."""
    branches = [F.when(format_name == f, values.statement_date(text, f)) for f in formats]
    return F.coalesce(*branches)


def normalise_transactions(
    landing: DataFrame, providers: DataFrame, formats: tuple[str, ...] = STATEMENT_FORMATS
) -> DataFrame:
    """Typed rows with sign, clean text and hash; unreadable rows keep NULLs."""
    layout = providers.select(
        F.col("provider_nme").alias("provider"),
        "date_format",
        F.col("amount_col").isNotNull().alias("_single"),
    )
    amount = canonical_amount(
        F.col("amount_raw"), F.col("debit_raw"), F.col("credit_raw"), F.col("_single")
    )
    return (
        landing.join(layout, "provider", "left")
        .withColumn("txn_date", _date_in(F.col("txn_date_raw"), F.col("date_format"), formats))
        .withColumn("amount", amount)
        .withColumn("description_clean", clean_description(F.col("description_raw")))
        .withColumn(
            "dedup_hash",
            dedup_hash(
                F.col("account_id"), F.col("txn_date"), F.col("amount"), F.col("description_raw")
            ),
        )
        .drop("date_format", "_single")
    )


# What a row must have to enter core.
TRANSACTION_FIELDS = ("account_id", "txn_date", "amount", "description_raw")
TRADE_FIELDS = ("account_id", "trade_date", "security_code", "quantity", "price", "value")


def _complete(rows: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    return rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed]))


def rejected_rows(rows: DataFrame, needed: tuple[str, ...] = TRANSACTION_FIELDS) -> DataFrame:
    """Rows that cannot enter core, with the fields they lack as ``reasons``.

    Together with the rows that can, they are all rows: nothing is lost unseen.
    """
    lacking = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    return rows.withColumn("reasons", F.filter(lacking, lambda c: c.isNotNull())).filter(
        F.size("reasons") > 0
    )


def readable_transactions(rows: DataFrame) -> DataFrame:
    return _complete(rows, TRANSACTION_FIELDS)


def new_transactions(core: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows to insert: one per hash, not in core. ``occurrences`` counts equal rows.

    Equal rows collapse under the hash, as the key demands; the count keeps
    what collapsed visible. Grouping combines on the map side, so a hash that
    many rows share is no hot key, and both join sides are unique.
    """
    once = (
        readable_transactions(rows)
        .groupBy(
            "dedup_hash", "account_id", "txn_date", "amount", "description_raw",
            "description_clean",
        )
        .agg(F.min("source_file").alias("source_file"), F.count(F.lit(1)).alias("occurrences"))
    )
    return once.join(core.select("dedup_hash"), "dedup_hash", "left_anti")


def trade_type(raw: Column) -> Column:
    word = F.upper(F.trim(raw))
    return F.when(word.isin(*TRADE_TYPES), word).otherwise("OTHER")


def normalise_trades(landing: DataFrame) -> DataFrame:
    """Typed share trades; a sale is a CGT event and carries no cost base.

    The texts are parsed in a projection of their own, so that each is parsed
    once although the hash and the derived columns use it again.
    """
    no_fee = F.lit(0).cast("decimal(10,2)")
    date = F.coalesce(
        *[values.statement_date(F.col("trade_date_raw"), f) for f in TRADE_FORMATS]
    )
    parsed = landing.select(
        "account_id",
        date.alias("trade_date"),
        F.upper(F.trim("security_raw")).alias("security_code"),
        values.money(F.col("quantity_raw"), 15, 4).alias("quantity"),
        values.money(F.col("price_raw"), 12, 4).alias("price"),
        values.money(F.col("value_raw"), 15, 2).alias("value"),
        trade_type(F.col("trade_type_raw")).alias("trade_type"),
        F.coalesce(values.money(F.col("brokerage_raw"), 10, 2), no_fee).alias("brokerage"),
        "source_file",
    )
    bought = (F.col("value") + F.col("brokerage")).cast("decimal(15,2)")
    return parsed.select(
        *parsed.columns,
        F.when(F.col("trade_type") == "BUY", bought).alias("cost_base"),
        (F.col("trade_type") == "SELL").alias("cgt_event"),
        fy_of(F.col("trade_date")).cast("smallint").alias("fy_year"),
        dedup_hash(
            *[
                F.col(c)
                for c in ("account_id", "trade_date", "security_code", "quantity", "trade_type")
            ]
        ).alias("dedup_hash"),
    )


def new_trades(core: DataFrame, rows: DataFrame) -> DataFrame:
    """Trades to insert: complete, one per hash, not in core.

    The key leaves out price and value, so of trades that differ only there the
    first by file, value and price is kept; the rest is counted.
    """
    payload = [c for c in rows.columns if c not in ("dedup_hash", "source_file", "value", "price")]
    first = F.min(F.struct("source_file", "value", "price", *payload))
    # One pass: parsing the texts again for a count costs more than the sorted aggregate.
    once = _complete(rows, TRADE_FIELDS).groupBy("dedup_hash").agg(
        first.alias("t"), F.count(F.lit(1)).alias("occurrences")
    )
    return once.select("dedup_hash", "t.*", "occurrences").join(
        core.select("dedup_hash"), "dedup_hash", "left_anti"
    )


def advance_watermark(marks: DataFrame, loaded: DataFrame, loaded_at: Column) -> DataFrame:
    """Per account: newest loaded day and its file, merged into the stored marks."""
    newest = loaded.groupBy("account_id").agg(
        F.max("txn_date").alias("_date"),
        F.max_by("source_file", F.struct("txn_date", "source_file")).alias("_file"),
    )
    joined = marks.join(newest, "account_id", "full_outer")
    fresh = F.col("_date").isNotNull()
    return joined.select(
        "account_id",
        F.greatest("last_txn_date", "_date").alias("last_txn_date"),
        F.when(
            fresh & (F.coalesce(F.col("_date") >= F.col("last_txn_date"), F.lit(True))),
            F.col("_file"),
        ).otherwise(F.col("last_file_nme")).alias("last_file_nme"),
        F.when(fresh, loaded_at).otherwise(F.col("last_loaded_at")).alias("last_loaded_at"),
    )
