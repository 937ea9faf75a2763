"""Centroid clustering (Lloyd's rounds in whole numbers) over a vantage-point tree.

The centroids of a round are few and sent to every task as a vantage-point tree. A
node holds one centroid, the vantage point, and two children: the centroids nearer
to it and those farther away, each with the least and the greatest distance to the
vantage point. A leaf holds a handful of centroids. By the triangle inequality a
vector at distance d from the vantage point is at least ``max(d - greatest, least - d)``
away from everything in a child.

Every vector searches best first: it keeps a queue of nodes by that lower bound,
opens the least one, and stops when the bound exceeds the best distance found. The
radius is inclusive and widened by the rounding of the square roots, so a centroid
at an equal distance with a smaller number is still met. What decides are squared
distances of integers, which are exact. A block of vectors walks together: the queue
of a vector is its row in a matrix of bounds.

Sums of components are gathered per task first, so a cluster that holds most vectors
costs one row per task and cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import stored

CLUSTERS = 16
ROUNDS = 3
COMPONENTS = 64
SCALE = 64
LEAF = 3
# Squared norms below this keep every squared distance inside 64 bits.
MOST_NORM = float(2**61)
_SLACK = 1e-9


@dataclass
class VantageTree:
    """Nodes of the tree, by number; node 0 is the root."""

    points: np.ndarray
    leaf: int = LEAF
    members: list[np.ndarray] = field(default_factory=list)
    # (child, least, greatest) per node; none for a leaf.
    children: list[list[tuple[int, float, float]]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if len(self.points):
            self._grow(np.arange(len(self.points)))

    def _grow(self, members: np.ndarray) -> int:
        node = len(self.members)
        self.children.append([])
        if len(members) <= self.leaf:
            self.members.append(members)
            return node
        vantage, rest = members[:1], members[1:]
        self.members.append(vantage)
        apart = self.points[rest] - self.points[vantage]
        distance = np.sqrt((apart * apart).sum(axis=1).astype(np.float64))
        order = np.argsort(distance, kind="stable")
        half = len(rest) // 2
        for part in (order[:half], order[half:]):
            if len(part):
                child = self._grow(rest[part])
                self.children[node].append(
                    (child, float(distance[part].min()), float(distance[part].max()))
                )
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest point; ties to the smaller number."""
        count = len(vectors)
        best = np.full(count, np.iinfo(np.int64).max, dtype=np.int64)
        number = np.full(count, len(self.points), dtype=np.int64)
        bounds = np.full((count, len(self.members)), np.inf)
        bounds[:, 0] = 0.0
        searching = np.arange(count)
        while len(searching):
            node = bounds[searching].argmin(axis=1)
            least = bounds[searching, node]
            # Inclusive: an equal distance may belong to a smaller number.
            open_ = least <= np.sqrt(best[searching].astype(np.float64)) * (1 + _SLACK)
            open_ &= np.isfinite(least)
            searching, node, least = searching[open_], node[open_], least[open_]
            for one in np.unique(node):
                at = node == one
                self._visit(int(one), searching[at], least[at], vectors, best, number, bounds)
        return number, best

    def _visit(self, node, rows, least, vectors, best, number, bounds) -> None:
        bounds[rows, node] = np.inf
        block = vectors[rows]
        for point in self.members[node]:
            apart = block - self.points[point]
            squared = np.einsum("ij,ij->i", apart, apart)
            better = (squared < best[rows]) | ((squared == best[rows]) & (point < number[rows]))
            best[rows[better]] = squared[better]
            number[rows[better]] = point
        if self.children[node]:
            away = np.sqrt(squared.astype(np.float64))
            for child, nearest, farthest in self.children[node]:
                bound = np.maximum(away - farthest, nearest - away)
                bound -= _SLACK * (away + farthest)
                bounds[rows, child] = np.maximum(bound, least)


def _matrix(batch: pa.RecordBatch, components: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("vector"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, components)


def _summer(tree, components: int):
    """Rows, and sums of components, of every cluster a task met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters = len(tree.value.points)
        sums = np.zeros((clusters, components), dtype=object)
        rows = np.zeros(clusters, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch, components)
                number, _ = tree.value.nearest(vectors)
                for one in np.unique(number):
                    mine = vectors[number == one]
                    # Halves of 32 bits: their sums over a batch stay inside 64 bits.
                    high = (mine >> 32).sum(axis=0).astype(object)
                    low = (mine & 0xFFFFFFFF).sum(axis=0).astype(object)
                    sums[one] += high * (1 << 32) + low
                    rows[one] += len(mine)
        met = np.flatnonzero(rows)
        # Text, as a sum may be wider than 64 bits.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(met, pa.int32()),
                pa.array(rows[met], pa.int64()),
                pa.array([[str(v) for v in sums[one]] for one in met], pa.list_(pa.string())),
            ],
            names=["cluster", "rows", "sums"],
        )

    return run


def _assigner(tree, components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, squared = tree.value.nearest(_matrix(batch, components))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("vec_id")),
                        pa.array(number, pa.int32()),
                        pa.array(squared, pa.int64()),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def whole_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, vector: components ``floor(scale * x)`` of the vectors that take part.

    Vectors that are null, of another length, or hold a null or non-finite component
    take no part. One whose squared distances could leave 64 bits stops the job.
    """
    value = F.col("given")
    parts = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("given"),
    ).where(F.size("given") == components)
    parts = parts.where(
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    norm = F.aggregate(
        value, F.lit(0.0), lambda total, x: total + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1)
    )
    checked = F.when(norm < MOST_NORM, value).otherwise(
        F.raise_error(F.lit("a vector is too long for 64-bit squared distances"))
    )
    return parts.select(
        "vec_id", F.transform(checked, lambda x: F.floor(x * scale).cast("long")).alias("vector")
    )


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector.

    Centroids start as the vectors with the smallest sha256 of ``1:<id>``; null ids come
    last, equal ids in the order of their components. Fewer vectors than ``clusters``
    give fewer centroids. A round assigns every vector to the nearest centroid (ties:
    smaller number) and moves each non-empty centroid to the floor of its vectors' mean.
    Repeated rows count as often as they occur. No vector that takes part, no row;
    :func:`whole_vectors` says which take part. Other columns are ignored.
    """
    spark = vectors.sparkSession
    whole = stored(
        whole_vectors(vectors, id_column, vector_column, components, scale), "whole-vectors"
    )
    label = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = whole.orderBy(label.asc_nulls_last(), "vector").limit(clusters).collect()
    points = np.array([r["vector"] for r in first], dtype=np.int64).reshape(-1, components)
    summed = [
        F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"sum_{i}") for i in range(components)
    ]
    shape = "cluster int, rows long, sums array<string>"
    for _ in range(rounds if len(points) else 0):
        tree = spark.sparkContext.broadcast(VantageTree(points))
        parts = whole.mapInArrow(_summer(tree, components), shape)
        # One row per cluster comes to the driver.
        for r in parts.groupBy("cluster").agg(F.sum("rows").alias("rows"), *summed).collect():
            points[r["cluster"]] = [int(r[f"sum_{i}"]) // r["rows"] for i in range(components)]
        tree.unpersist()
    tree = spark.sparkContext.broadcast(VantageTree(points))
    assigned = whole.mapInArrow(
        _assigner(tree, components), "vec_id long, cluster int, distance long"
    )
    assigned = stored(assigned, "assigned")
    inertia = {
        r["cluster"]: int(r["inertia"])
        for r in assigned.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
        .collect()
    }
    digests = [
        hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in points.tolist()
    ]
    known = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)],
        T.StructType.fromDDL(
            "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
        ),
    )
    # At most one row per centroid.
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
