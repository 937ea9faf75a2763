"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (left, right long columns, not null).

    ``root`` is the smallest node of the component. In a round every node points
    to its smallest neighbour or itself, pointers are followed twice, and the
    edges between different targets are the edges of the next round. A round
    keeps one row per node and the minimum is combined before the shuffle, so a
    node with very many edges costs no more than its edges.
    """
    current = stored(
        edges.where("left != right")
        .select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))
        .distinct(),
        "edges",
    )
    roots = None
    while current.limit(1).count():
        both = current.select(F.col("left").alias("node"), F.col("right").alias("other")).unionAll(
            current.select(F.col("right").alias("node"), F.col("left").alias("other"))
        )
        nearest = stored(
            both.groupBy("node").agg(F.min("other").alias("other")).select(
                "node", F.least("node", "other").alias("parent")
            ),
            "nearest",
        )
        # A parent is itself a node, and points at most as far down as it can.
        step = nearest.alias("a").join(
            nearest.alias("b"), F.col("a.parent") == F.col("b.node")
        )
        pointers = stored(
            step.select(F.col("a.node").alias("node"), F.col("b.parent").alias("root")), "pointers"
        )
        if roots is None:
            roots = pointers
        else:
            moved = roots.join(
                pointers.select(F.col("node").alias("root"), F.col("root").alias("next")),
                "root",
                "left",
            )
            roots = stored(moved.select("node", F.coalesce("next", "root").alias("root")), "roots")
        left = pointers.select(F.col("node").alias("left"), F.col("root").alias("left_root"))
        right = pointers.select(F.col("node").alias("right"), F.col("root").alias("right_root"))
        contracted = current.join(left, "left").join(right, "right").where(
            "left_root != right_root"
        )
        current = stored(
            contracted.select(
                F.least("left_root", "right_root").alias("left"),
                F.greatest("left_root", "right_root").alias("right"),
            ).distinct(),
            "edges",
        )
    if roots is None:
        return current.select(F.col("left").alias("node"), F.col("right").alias("root"))
    return roots
