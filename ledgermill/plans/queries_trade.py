"""Cost base by parcel and positions across splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill.operators import health, parcels
from ledgermill.plans import frames
from ledgermill.plans.registry import query

# Every seventh line of an order that is no purchase or disposal is a two-for-one split.
_KIND = (
    "CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' "
    "ELSE CASE WHEN l_linenumber = 7 THEN 'SPLIT' ELSE 'DIVIDEND' END END"
)

_SPLIT_SQL = f"""WITH trade AS (SELECT 'P' || l_partkey AS security_code, l_orderkey AS order_no, l_linenumber AS line_no,
  CAST(l_shipdate AS DATE) AS trade_date, {_KIND} AS kind, l_quantity AS q, l_extendedprice AS value,
  l_suppkey AS account_id, CAST(CAST(l_tax * 100 AS DECIMAL(10,2)) AS DOUBLE) AS fee FROM lineitem),
splits AS (SELECT security_code, trade_date FROM trade WHERE kind = 'SPLIT'),
adjusted AS (SELECT t.*, pow(2, (SELECT count(*) FROM splits s WHERE s.security_code = t.security_code
  AND s.trade_date > t.trade_date)) AS factor FROM trade t)"""

_CENTS = "floor(({value}) * 100 + 0.5 + 1e-6) / 100"


# Order lines of one part may agree in all but their value.
_ORDER = ["order_no", "line_no", "account_id", "trade_value"]


def _trades(spark, sf):
    """Order lines as trades, with splits among them."""
    return frames.trades(spark, sf).withColumn("trade_value", F.col("value")).withColumn(
        "trade_type",
        F.when(
            (F.col("trade_type") == "DIVIDEND") & (F.col("line_no") == 7), F.lit("SPLIT")
        ).otherwise(F.col("trade_type")),
    ).withColumn(
        "quantity", F.when(F.col("trade_type") == "SPLIT", 2).otherwise(F.col("quantity"))
    )


@query(
    "cgt_parcels",
    _SPLIT_SQL
    + f""", lined AS (SELECT *, sum(q * factor) OVER w - q * factor AS low, sum(q * factor) OVER w AS high
  FROM adjusted WHERE kind IN ('BUY', 'SELL') AND q > 0
  WINDOW w AS (PARTITION BY security_code, kind ORDER BY trade_date, order_no, line_no, account_id, value ROWS UNBOUNDED PRECEDING)),
bought AS (SELECT *, (value + fee) / (q * factor) AS each FROM lined WHERE kind = 'BUY'),
sold AS (SELECT *, (value - fee) / (q * factor) AS each FROM lined WHERE kind = 'SELL'),
totals AS (SELECT security_code, max(high) AS total FROM bought GROUP BY 1),
parts AS (SELECT s.security_code, s.order_no AS sell_order_no, s.line_no AS sell_line_no, s.trade_date AS sell_date,
  b.order_no AS buy_order_no, b.line_no AS buy_line_no, b.trade_date AS buy_date,
  least(s.high, b.high) - greatest(s.low, b.low) AS quantity, b.each AS buy_each, s.each AS sell_each
  FROM sold s JOIN bought b ON s.security_code = b.security_code AND s.low < b.high AND b.low < s.high
  UNION ALL SELECT s.security_code, s.order_no, s.line_no, s.trade_date, NULL, NULL, NULL,
  s.high - greatest(s.low, coalesce(total, 0)), NULL, s.each
  FROM sold s LEFT JOIN totals USING (security_code) WHERE s.high > coalesce(total, 0)),
priced AS (SELECT *, {_CENTS.format(value="buy_each * quantity")} AS cost_base,
  {_CENTS.format(value="sell_each * quantity")} AS proceeds FROM parts)
SELECT security_code, sell_order_no, CAST(sell_line_no AS BIGINT) AS sell_line_no, CAST(sell_date AS VARCHAR) AS sell_date,
  buy_order_no, CAST(buy_line_no AS BIGINT) AS buy_line_no, CAST(buy_date AS VARCHAR) AS buy_date,
  CAST(quantity AS DOUBLE) AS quantity, cost_base, proceeds, round(proceeds - cost_base, 2) AS gain,
  buy_date + INTERVAL 12 MONTH < sell_date AS held_over_year FROM priced""",
)
def cgt_parcels(spark, sf):
    """What every disposal cost, parcel by parcel, first in, first out."""
    found = parcels.cgt_parcels(
        _trades(spark, sf), _ORDER, F.floor(F.col("order_no") / 1000)
    )
    return found.drop(*[f"{side}_{c}" for side in ("sell", "buy") for c in _ORDER[2:]])


@query(
    "trade_running_split",
    _SPLIT_SQL
    + """SELECT order_no, line_no, security_code, CAST(trade_date AS VARCHAR) AS trade_date, kind AS trade_type,
  sum(CASE kind WHEN 'BUY' THEN q * factor WHEN 'SELL' THEN -q * factor ELSE 0 END) OVER (PARTITION BY security_code
  ORDER BY trade_date, order_no, line_no, account_id, value ROWS UNBOUNDED PRECEDING) / factor AS quantity_held
FROM adjusted""".replace(" line_no, security", " CAST(line_no AS BIGINT) AS line_no, security", 1),
)
def trade_running_split(spark, sf):
    """Shares held after every trade, in the shares of its day."""
    rows = health.running_trades(
        _trades(spark, sf), _ORDER, F.floor(F.col("order_no") / 1000)
    )
    return rows.select(
        "order_no", "line_no", "security_code", "trade_date", "trade_type", "quantity_held"
    )
