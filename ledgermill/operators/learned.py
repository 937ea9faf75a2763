"""Second pass over transactions: a multinomial naive Bayes model kept as two tables.

Counting is a grouped aggregate over tokens, the model is joined on tokens, and scores
are sums of whole numbers (millionths of a logarithm), so a result does not depend on
the order in which rows are added up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A logarithm is kept in these parts.
PARTS = 1_000_000
CONFIDENCE = "decimal(4,3)"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; a run with a digit is ``#`` (a reference)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.transform(words, lambda w: F.when(w.rlike(r"\p{N}"), F.lit("#")).otherwise(w))


def _parts(value: Column) -> Column:
    return F.round(F.log(value) * PARTS).cast("long")


@dataclass(frozen=True)
class CategoryModel:
    """``weights``: token, category, weight. ``categories``: category, prior, fallback.

    A weight is what a token of the category adds over ``fallback``, which is what a
    token adds that the category was never seen with. Both tables can be stored.
    """

    weights: DataFrame
    categories: DataFrame


def train(labelled: DataFrame, text: str, category: str) -> CategoryModel:
    """Count tokens per category, with one added to every count.

    Rows without a category are left out. Tokens are counted on the map side, so a
    token or a category that most rows share costs one row per task.
    """
    rows = labelled.filter(F.col(category).isNotNull())
    counted = (
        rows.select(F.col(category).alias("category"), F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    vocabulary = counted.agg(F.countDistinct("token").alias("v"))
    sizes = counted.groupBy("category").agg(F.sum("n").alias("tokens"))
    known = rows.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("rows"))
    total = known.agg(F.sum("rows").alias("rows"))
    categories = (
        known.join(sizes, "category", "left")
        .select(
            "category",
            _parts(F.col("rows") / total.scalar()).alias("prior"),
            (-_parts(F.coalesce("tokens", F.lit(0)) + vocabulary.scalar())).alias("fallback"),
        )
    )
    # ln((n + 1) / size) - ln(1 / size): the size of the category cancels out.
    weights = counted.select("token", "category", _parts(F.col("n") + 1).alias("weight"))
    return CategoryModel(weights, categories)


def predict(rows: DataFrame, model: CategoryModel, key: str, text: str) -> DataFrame:
    """``key``, ``predicted`` and ``confidence`` (posterior) for every row of ``rows``.

    ``key`` must be unique. Categories are few (a seeded list) and become one sum each,
    so a row of the join is never multiplied by them. Equal scores go to the smallest
    category; without any category the prediction is null.
    """
    known = [r["category"] for r in model.categories.select("category").orderBy("category").collect()]
    if not known:
        kind = model.categories.schema["category"].dataType
        return rows.select(
            key,
            F.lit(None).cast(kind).alias("predicted"),
            F.lit(None).cast(CONFIDENCE).alias("confidence"),
        )
    by_token = model.weights.groupBy("token").agg(
        *[
            F.sum(F.when(F.col("category") == c, F.col("weight"))).alias(f"w_{i}")
            for i, c in enumerate(known)
        ]
    )
    # One row at least for every key: a text without tokens is scored by the priors.
    spread = rows.select(key, F.explode_outer(tokens(F.col(text))).alias("token"))
    summed = (
        spread.join(by_token, "token", "left")
        .groupBy(key)
        .agg(
            F.count("token").alias("tokens"),
            *[F.coalesce(F.sum(f"w_{i}"), F.lit(0)).alias(f"s_{i}") for i in range(len(known))],
        )
    )
    constants = model.categories.agg(
        F.map_from_entries(
            F.collect_list(F.struct("category", F.struct("prior", "fallback")))
        ).alias("m")
    ).scalar()
    scored = summed.withColumn("_m", constants)
    entry = [F.element_at("_m", F.lit(c)) for c in known]
    scores = [
        F.col(f"s_{i}") + e["prior"] + F.col("tokens") * e["fallback"] for i, e in enumerate(entry)
    ]
    scored = scored.withColumn("_scores", F.array(*scores)).withColumn(
        "_best", F.array_max("_scores")
    )
    place = F.array_position("_scores", F.col("_best"))
    posterior = 1 / F.aggregate(
        "_scores",
        F.lit(0.0),
        lambda total, s: total + F.exp((s - F.col("_best")) / F.lit(float(PARTS))),
    )
    return scored.select(
        key,
        F.element_at(F.array(*map(F.lit, known)), place.cast("int")).alias("predicted"),
        F.round(posterior, 3).cast(CONFIDENCE).alias("confidence"),
    )


def accuracy(predicted: DataFrame, category: str, by: str | None = None) -> DataFrame:
    """Rows, right ones and their share, of the whole or by a column."""
    right = F.count_if(F.col("predicted").eqNullSafe(F.col(category)))
    count = F.count(F.lit(1))
    grouped = predicted.groupBy(by) if by else predicted.groupBy()
    return grouped.agg(
        count.alias("rows"), right.alias("right"), F.round(right / count, 4).alias("accuracy")
    )


def learned_second_pass(
    txns: DataFrame, model: CategoryModel, threshold: float, key: str = "txn_id"
) -> DataFrame:
    """``txns`` with ``learned``, the struct that ``classify_transactions`` takes for pass two.

    A prediction below ``threshold`` is none: the row stays for a person.
    """
    found = predict(txns, model, key, "description_clean")
    sure = F.col("confidence") >= F.lit(str(threshold)).cast(CONFIDENCE)
    learned = F.when(
        sure,
        F.struct(
            F.col("predicted").cast("int").alias("category_id"),
            F.lit(None).cast("string").alias("subcategory"),
            F.lit(False).alias("is_deductible"),
            F.col("confidence").alias("confidence_score"),
        ),
    )
    return txns.join(found.select(key, learned.alias("learned")), key, "left")
