"""First pass over transactions for thousands of merchant rules: a trie kept as a table.

A rule is a phrase of tokens. Its prefixes are the edges of a trie: ``(node, token)``
names the edge, and a prefix is its own node. A description enters the trie at every
token and follows it by equi-joins on node and token, as many as the longest phrase has
tokens; the plan does not grow with the number of rules. An edge is unique, so no join
multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.learned import tokens

RULE = (
    "rule_id BIGINT, phrase STRING, priority INT, category_id INT, subcategory STRING, "
    "is_deductible BOOLEAN"
)
MOST_TOKENS = 255
_RULE_BITS, _SIZE_BITS = 40, 8


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def merchant_trie(rules: DataFrame) -> DataFrame:
    """node, token, next_node, hit: the edges of the rules' trie.

    ``hit`` orders the rules that end on an edge, smallest first: priority, then the
    longer phrase, then the smaller rule id, in one number. Rules without a token match
    nothing. Priorities run from 0 to 32767, rule ids to 2^40.
    """
    split = rules.withColumn("_words", words(F.col("phrase"))).filter(F.size("_words") > 0)
    size = F.size("_words")
    hit = F.shiftleft(F.col("priority").cast("bigint"), _RULE_BITS + _SIZE_BITS)
    hit = hit.bitwiseOR(F.shiftleft((MOST_TOKENS - size).cast("bigint"), _RULE_BITS))
    hit = hit.bitwiseOR(F.col("rule_id"))
    checked = F.when(
        (size <= MOST_TOKENS) & F.col("priority").between(0, 2**15 - 1)
        & F.col("rule_id").between(0, 2**_RULE_BITS - 1),
        hit,
    ).otherwise(F.raise_error(F.lit("a merchant rule is out of range")))
    edges = split.withColumn("_hit", checked).select(
        "_words", "_hit", F.posexplode("_words").alias("_at", "token")
    )
    return (
        edges.select(
            F.array_join(F.slice("_words", F.lit(1), F.col("_at")), " ").alias("node"),
            "token",
            F.when(F.col("_at") == F.size("_words") - 1, F.col("_hit")).alias("hit"),
        )
        .groupBy("node", "token")
        .agg(F.min("hit").alias("hit"))
        .withColumn("next_node", F.ltrim(F.concat_ws(" ", "node", "token")))
    )


def depth_of(trie: DataFrame) -> int:
    """Tokens of the longest phrase."""
    return trie.agg(F.max(F.size(F.split("next_node", " ")))).first()[0] or 0


def match_merchants(
    txns: DataFrame, rules: DataFrame, key: str = "txn_id", text: str = "description_clean"
) -> DataFrame:
    """``key`` and ``rule_id`` of the best rule of every row that has one.

    A rule matches where its tokens stand side by side. Smaller priority wins, then the
    longer phrase, then the smaller rule id. ``key`` must be unique.
    """
    trie = merchant_trie(rules)
    entered = txns.select(key, words(F.col(text)).alias("_words"))
    walk = entered.select(key, "_words", F.posexplode("_words").alias("_at", "_token"))
    first = trie.filter("node = ''").select("token", F.col("hit").alias("_best"), "next_node")
    # Most tokens enter no rule and end here.
    walk = walk.join(first, F.col("_token") == F.col("token")).select(
        key, "_words", "_at", "_best", F.col("next_node").alias("_node")
    )
    for step in range(1, depth_of(trie)):
        token = F.try_element_at("_words", F.col("_at") + F.lit(step + 1))
        edge = trie.select(
            "node", "token", F.col("hit").alias("_hit"), F.col("next_node").alias("_next")
        )
        # A walk that has ended gets a node of its own, so ended walks are no hot key.
        walk = (
            walk.withColumn("_token", F.coalesce(token, F.lit("")))
            .join(edge, (F.col("_node") == F.col("node")) & (F.col("_token") == F.col("token")), "left")
            .select(
                key,
                "_words",
                "_at",
                F.least("_best", "_hit").alias("_best"),
                F.coalesce(
                    "_next", F.concat(F.lit("\n"), F.col(key).cast("string"), F.lit(" "), "_at")
                ).alias("_node"),
            )
        )
    best = walk.groupBy(key).agg(F.min("_best").alias("_best")).filter("_best IS NOT NULL")
    return best.select(key, F.col("_best").bitwiseAND(F.lit(2**_RULE_BITS - 1)).alias("rule_id"))


def classify_by_merchant(
    txns: DataFrame, rules: DataFrame, key: str = "txn_id", text: str = "description_clean"
) -> DataFrame:
    """``txns`` with the category fields of the best rule, null where none matches."""
    found = match_merchants(txns, rules, key, text)
    fields = rules.select("rule_id", "category_id", "subcategory", "is_deductible")
    named = found.join(fields, "rule_id")
    return txns.drop("rule_id", "category_id", "subcategory", "is_deductible").join(
        named, key, "left"
    )
