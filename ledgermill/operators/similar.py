"""Reviewed examples that resemble a document, found in an inverted index of key terms.

A document is described by its heaviest terms, where a term weighs more the fewer
reviewed documents hold it. The index lists, per term, the descriptions that contain
it, so a document meets only what shares a term with it. Equal descriptions are one
entry on both sides: of the reviewed documents behind an entry only the few that can be
shown are kept, and documents with equal descriptions are looked up once. So copies,
however many, cost one entry. Scores are sums of whole numbers.

A list is read whole up to a bound. Of a longer list only the newest entries can be
shown to a document that shares nothing but its term, so these are read, and what shares
more is found by lists of that term and a second one, again read up to the bound, and so
on. So a document meets a bounded number of entries per list, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators.classify import BLOCK_HEADS, BLOCK_TITLE
from ledgermill.operators.merchants import words
from ledgermill.session import kept_copy

KEY_TERMS = 12
SIMILAR_EXAMPLES = 5
DECIDED = ("CONFIRMED", "REJECTED")
# A weight is a logarithm in these parts.
PARTS = 1_000_000
# Terms held by the most documents, broadcast with their weights.
COMMON = 1 << 16
# Lists up to this length are read whole.
LIST = 16
# Tokens of a term are numbered inside a span of this width.
SPAN = 1 << 16


def _terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, term: every term of a document once."""
    return docs.select(
        F.col(key).alias("key"), F.explode(F.array_distinct(words(F.col(text)))).alias("term")
    )


def term_weights(reviewed: DataFrame, key: str, text: str) -> DataFrame:
    """term, weight: ``ln(1 + reviewed documents / documents with the term)`` in parts."""
    total = reviewed.agg(F.count(F.lit(1)).alias("n"))
    held = _terms(reviewed, key, text).groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    return held.select(
        "term",
        F.round(F.log(F.lit(1.0) + total.scalar() / F.col("held")) * PARTS)
        .cast("bigint")
        .alias("weight"),
    )


def descriptions(
    docs: DataFrame, weights: DataFrame, key: str, text: str, terms: int = KEY_TERMS
) -> DataFrame:
    """key, description: the heaviest weighted terms in order; equal weights by the term."""
    order = [F.col("weight").desc(), F.col("term").asc()]
    held = _terms(docs, key, text)
    # Most terms of a text are common ones: these are weighed, and cut to the heaviest, in the scan.
    common = F.broadcast(weights.select("term", "weight").orderBy("weight", "term").limit(COMMON))
    rare = held.join(common, "term", "left_anti").join(weights.select("term", "weight"), "term")
    weighed = held.join(common, "term").unionByName(rare)
    ranked = weighed.withColumn(
        "place", F.row_number().over(Window.partitionBy("key").orderBy(*order))
    )
    return (
        ranked.filter(F.col("place") <= terms)
        .groupBy("key")
        .agg(F.array_join(F.sort_array(F.collect_list("term")), " ").alias("description"))
    )


def _counted(described: DataFrame, weights: DataFrame) -> DataFrame:
    """description, number, weight and times of each of its terms."""
    terms = described.select("description", F.explode(F.split("description", " ")).alias("term"))
    times = terms.groupBy("description", "term").agg(F.count(F.lit(1)).alias("times"))
    return times.join(weights, "term").select("description", "number", "weight", "times")


def _tokens(counted: DataFrame, most: Column) -> DataFrame:
    """description, tokens, gains: a term is a token for each of ``most`` times, rarest terms first.

    ``gains`` is what a shared token adds to the score. Terms repeat in a description
    only where a document's key does.
    """
    order = F.struct(
        (-F.col("weight")).alias("_light"),
        (F.col("number") * SPAN + F.col("time")).alias("token"),
        (F.col("weight") * F.col("times")).alias("gain"),
    )
    spelt = counted.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), most)))
    sets = spelt.groupBy("description").agg(F.sort_array(F.collect_list(order)).alias("_all"))
    return sets.select("description", F.col("_all.token").alias("tokens"), F.col("_all.gain").alias("gains"))


def _longer(rows: DataFrame) -> DataFrame:
    """``rows`` with every token of ``rest`` added to the set ``held``; ``rest`` is what follows it."""
    added = F.transform(
        "rest",
        lambda token, i: F.struct(
            F.concat("held", F.array(token)).alias("held"),
            F.slice("rest", i + 2, F.size("rest")).alias("rest"),
        ),
    )
    return rows.withColumn("_added", F.explode(added)).withColumns(
        {"held": F.col("_added.held"), "rest": F.col("_added.rest")}
    ).drop("_added")


def _worth(tokens: Column) -> Column:
    """What an asked document gains by ``tokens``, all of them its own."""
    return F.aggregate(
        tokens,
        F.lit(0).cast("bigint"),
        lambda total, x: total + F.element_at("gains", F.array_position("tokens", x).cast("int")),
    )


def _best_listed(asked: DataFrame, listed: DataFrame, n: int, longest: int) -> DataFrame:
    """asked_no, review_status, example_id, reviewed_at, score: the ``n`` best of ``listed``.

    ``listed`` is read by sets of tokens: by single ones first, then, where more than
    ``longest`` entries hold a set, by that set and a later token. An entry is missed by
    the set of all that it shares only if ``n`` newer ones hold that set, so score no
    less. A set is given up where all it can lead to scores less than ``n`` found ones.
    """
    whose, newest = ["asked_no", "review_status"], [F.col("reviewed_at").desc_nulls_last(), F.col("example_id").asc()]
    none = F.array().cast("array<bigint>")
    asking = asked.withColumns({"held": none, "rest": F.col("tokens")})
    listing = listed.withColumns({"held": none, "rest": F.col("tokens")})
    along = Window.partitionBy("held", "review_status").orderBy(*newest)
    ranked = Window.partitionBy(*whose).orderBy(F.col("score").desc(), *newest)
    member = F.struct("place", "example_id", "reviewed_at", F.col("tokens").alias("theirs"))
    longest = max(longest, n)

    def best(found: DataFrame) -> DataFrame:
        return (
            found.groupBy(*whose, "example_id")
            .agg(F.max("reviewed_at").alias("reviewed_at"), F.max("score").alias("score"))
            .withColumn("place", F.row_number().over(ranked))
            .filter(F.col("place") <= n)
        )

    on, found, least = ["held"], None, None
    while True:
        asking, listing = _longer(asking), _longer(listing)
        lists = kept_copy(
            listing.withColumn("place", F.row_number().over(along))
            .filter(F.col("place") <= longest + 1)
            .groupBy("held", "review_status")
            .agg(F.collect_list(member).alias("members")),
            "lists",
        )
        long = F.size("members") > longest
        read = F.when(long, F.filter("members", lambda m: m["place"] <= n)).otherwise(F.col("members"))
        met = (
            asking.join(lists.select("held", "review_status", read.alias("members")), on)
            .select(*whose, "tokens", "gains", F.inline("members"))
            .select(
                *whose, "example_id", "reviewed_at",
                _worth(F.array_intersect("tokens", "theirs")).alias("score"),
            )
        )
        hot = lists.filter(long).select("held", "review_status")
        last = hot.isEmpty()
        if found is None:
            first = best(met)
            if last:
                return first.drop("place")
            first = kept_copy(first, "first")
            least = first.filter(F.col("place") == n).select(*whose, F.col("score").alias("_least"))
            found = first.drop("place")
        else:
            found = found.unionByName(met)
        if last:
            return best(found).drop("place")
        # Sets of a status go on, where a document may still find better entries by them.
        asking = kept_copy(
            asking.join(hot, on)
            .join(least, whose, "left")
            .filter(
                (F.size("rest") > 0)
                & (_worth(F.concat("held", "rest")) >= F.coalesce("_least", F.lit(0)))
            )
            .drop("_least"),
            "asking",
        )
        on = ["held", "review_status"]
        listing = kept_copy(listing.join(asking.select(*on).distinct(), on, "left_semi"), "listing")


def few_shot_similar(
    docs: DataFrame,
    reviewed: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SIMILAR_EXAMPLES,
    terms: int = KEY_TERMS,
    longest: int = LIST,
) -> DataFrame:
    """Up to ``n`` confirmed and ``n`` rejected examples for every document of ``docs``.

    Returns ``key``, review_status, rank, example_id and score (summed weights of the
    shared key terms); nothing for a document that shares no term with a reviewed one.
    Best score first, then the latest review, then the smaller id. ``reviewed`` holds
    ``key``, ``text``, review_status and reviewed_at; a document is no example for itself.
    Lists of more than ``longest`` entries are read by the sets of terms they hold; the
    result does not depend on it. Descriptions and lists are written to the scratch
    folder when this is called.
    """
    decided = reviewed.filter(F.col("review_status").isin(*DECIDED))
    # Numbers hold for this run only, so what follows reads what it wrote.
    weights = kept_copy(
        term_weights(decided, key, text).withColumn("number", F.monotonically_increasing_id()),
        "weights",
    )
    newest = [F.col("reviewed_at").desc_nulls_last(), F.col("example_id").asc()]
    shown = Window.partitionBy("entry", "review_status").orderBy(*newest)
    # One more than is shown, as a document may be among its own examples.
    examples = kept_copy(
        descriptions(decided, weights, key, text, terms)
        .withColumnRenamed("description", "entry")
        .join(
            decided.select(
                F.col(key).alias("key"), F.col(key).alias("example_id"), "review_status", "reviewed_at"
            ),
            "key",
        )
        .withColumn("place", F.row_number().over(shown))
        .filter(F.col("place") <= n + 1)
        .select("entry", "example_id", "review_status", "reviewed_at", "place"),
        "examples",
    )
    asked = kept_copy(descriptions(docs, weights, key, text, terms), "asked")
    # An entry stands for its newest example of a status.
    firsts = examples.filter("place = 1").withColumnRenamed("entry", "description")
    theirs = _counted(firsts.select("description").distinct(), weights)
    most = theirs.agg(F.coalesce(F.max("times"), F.lit(1)))
    held = _tokens(theirs, F.col("times")).drop("gains")
    listed = kept_copy(firsts.join(held, "description").drop("description", "place"), "listed")
    mine = _tokens(_counted(asked.select("description").distinct(), weights), most.scalar())
    wanted = kept_copy(mine.withColumn("asked_no", F.monotonically_increasing_id()), "wanted")
    best = _best_listed(wanted.drop("description"), listed, n + 1, longest).drop("reviewed_at")
    order = [F.col("score").desc(), *newest]
    entries = examples.filter("place = 1").select("entry", "review_status", "example_id")
    candidates = (
        best.join(entries, ["review_status", "example_id"])
        .drop("example_id")
        .join(examples.drop("place"), ["entry", "review_status"])
        .join(wanted.select("asked_no", "description"), "asked_no")
        .withColumn(
            "place",
            F.row_number().over(Window.partitionBy("asked_no", "review_status").orderBy(*order)),
        )
        .filter(F.col("place") <= n + 1)
        .drop("entry", "place", "asked_no")
    )
    ranked = Window.partitionBy("key", "review_status").orderBy(*order)
    return (
        asked.join(candidates, "description")
        .filter(F.col("key") != F.col("example_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= n)
        .select(F.col("key").alias(key), "review_status", "rank", "example_id", "score")
    )


def few_shot_similar_block(found: DataFrame, reviewed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``block``: the examples of each document as text for a prompt.

    ``reviewed`` needs ``key``, subject and category. A document has ten lines at most.
    """
    known = reviewed.select(F.col(key).alias("example_id"), "subject", "category")
    line = F.concat(
        F.lit("  - "), F.concat_ws(" | ", F.nullif("subject", F.lit("")), F.nullif("category", F.lit("")))
    )

    def section(status: str) -> Column:
        mine = F.array_sort(
            F.collect_list(F.when(F.col("review_status") == status, F.struct("rank", line.alias("line"))))
        )
        lines = F.array_join(F.transform(mine, lambda e: e["line"]), "\n")
        body = F.concat(F.lit(BLOCK_HEADS[status] + "\n"), lines, F.lit("\n\n"))
        return F.when(F.size(mine) > 0, body).otherwise("")

    return (
        found.join(known, "example_id")
        .groupBy(key)
        .agg(F.concat(F.lit(BLOCK_TITLE + "\n\n"), *map(section, DECIDED)).alias("block"))
    )
