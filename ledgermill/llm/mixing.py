"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source has a weight and may be repeated a bounded number of times. All
targets rise with one water level, weight by weight; a source that reaches its
cap stays there and the level of the rest rises, until the targets sum to the
size asked for. In order of cap over weight the capped sources are a prefix, so
the level follows from running sums over one row per source.

A source's target is met by whole repetitions of all its documents and a seeded
part of one more: documents are ordered by a hash and taken until the words left
are used up; the one document on the border is taken in part. The order is cut
into hash buckets, so that only bucket sums, one row per source and bucket, are
summed up in sequence and a hot source is dealt over all its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import (
    WORD,
    fresh,
    numbered_rows,
    quoted,
    stored,
    with_row_id,
    word_count,
)

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 42
BUCKETS = 4096


def source_key(source: Column) -> Column:
    """A key that is never null; sorted, it is code point order with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def water_levels(
    sources: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """``key, source_size`` plus ``weight`` and ``target``; the targets sum to all sizes.

    One row per source goes through one ordered window.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy("key")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    )
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    weighed = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.withColumn(
        "level",
        (
            F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(before), F.lit(0))
        )
        / (
            F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0))
        ),
    )
    filled = filled.withColumn("capped", F.col("level") >= F.col("ratio"))
    water = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return filled.select(
        "key",
        "source_size",
        "weight",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * water))
        .alias("target"),
    )


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    row_column: str | None = None,
    max_epochs: int = MAX_EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    ``size`` counts words, null texts have 0. A null source is a source of its
    own, ordered last. A document without words is taken with 0 words, a source
    without words has target 0. The order of sampling depends on the seed, the id
    and the text, so rows without an id, or with one id, are dealt like others;
    rows that repeat both are ordered by place. Empty input gives no rows; other columns of ``docs`` are ignored. With ``row_column`` the row
    numbers of ``docs`` are kept in the result.
    """
    row = row_column or fresh(docs.columns, "row_no")
    numbered = docs if row_column else with_row_id(docs, row)
    sized = stored(
        numbered.select(
            F.col(row).alias("row_no"),
            F.col(id_column).cast("long").alias("doc_id"),
            source_key(F.col(source_column)).alias("key"),
            word_count(F.col(text_column)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_column).cast("long"), F.col(text_column)).alias("draw"),
        ).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)).cast("int")),
        "sized",
    )
    sums = stored(
        sized.groupBy("key", "bucket").agg(F.sum("size").alias("bucket_size")), "bucket-sums"
    )
    sources = sums.groupBy("key").agg(F.sum("bucket_size").alias("source_size"))
    wanted = water_levels(sources, max_epochs, weights)
    wanted = wanted.withColumn("words", F.round("target").cast("long"))
    wanted = wanted.withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)),
    )
    wanted = wanted.withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
    before = (
        Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    shares = sums.withColumn(
        "taken_before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))
    ).join(wanted, "key")
    shares = shares.select(
        "key",
        "bucket",
        "source_size",
        "target",
        "whole",
        (F.col("rest") - F.col("taken_before")).alias("left_words"),
    )
    inside = (
        Window.partitionBy("key", "bucket")
        .orderBy("draw", "doc_id", "size", "row_no")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    drawn = sized.join(shares, ["key", "bucket"]).withColumn(
        "left_words", F.col("left_words") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left_words")))
    result = drawn.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + part).alias("taken"),
        F.col("row_no").alias(row_column or "row_no"),
    )
    return result if row_column else result.drop("row_no")


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    max_epochs: int = MAX_EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
    scanned: bool = False,
) -> DataFrame:
    """``docs`` repeated and cut as :func:`mixture` says; columns unchanged.

    A document taken in part is its first words, joined by spaces; ``n_chars``
    follows where there is such a column. ``scanned`` says that ``docs`` is the direct
    read of files, so that its rows can be numbered by their places in the scan and
    nothing is copied.
    """
    row = fresh([*docs.columns, "doc_id", "size", "taken", "part", "copies"], "row_no")
    numbered = numbered_rows(docs, row, scanned)
    plan = mixture(
        numbered, id_column, text_column, source_column, row, max_epochs, weights, seed
    )
    whole, part, copy = (fresh([*docs.columns, row], n) for n in ("whole_n", "part_n", "copy_n"))
    plan = stored(
        plan.where("taken > 0").select(
            row,
            F.expr("taken div size").alias(whole),
            F.expr("taken % size").cast("int").alias(part),
        ),
        "mixture",
    )
    repeats = F.sequence(
        F.lit(1), (F.col(whole) + F.when(F.col(part) > 0, 1).otherwise(0)).cast("int")
    )
    # The plan has a row for nearly every document: it is never small next to them.
    rows = numbered.join(plan.hint("merge"), row).withColumn(copy, F.explode(repeats))
    cut = F.col(copy) > F.col(whole)
    words = F.regexp_extract_all(F.col(quoted(text_column)), F.lit(WORD), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col(part)), " ")).otherwise(
        F.col(quoted(text_column))
    )
    out = []
    for name in docs.columns:
        if name == text_column:
            out.append(text.alias(name))
        elif name == "n_chars":
            out.append(
                F.when(cut, F.length(text))
                .otherwise(F.col(quoted(name)))
                .cast(docs.schema[name].dataType)
                .alias(name)
            )
        else:
            out.append(F.col(quoted(name)))
    return rows.select(*out)
