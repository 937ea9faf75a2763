"""Approximate nearest neighbours over balanced posting lists.

Centroids are trained by balanced k-means on a bounded sample; their number
follows the number of vectors up to a fixed bound. Every vector is written to the
list of its nearest centroid and, near a boundary, to lists of further centroids
whose distance is at most ``REPLICA_RATIO`` times the nearest one, unless such a
centroid lies closer to one already taken than to the vector.

Queries search the centroids through an in-memory graph: each centroid is linked
to its nearest others, and a best-first walk collects the nearest ones until their
lists hold enough rows for all neighbours, and then those whose distance is at most
a ratio times that of the last of these; their lists are read, however many. Centroids
that the walk did not come by are compared at its end, so that groups without a link
between them hide nothing. How far the lists must be read depends on the vectors: a
bounded sample of the queries is compared with every row, and the ratio is the one that
reaches ``TUNE_RECALL`` of their true neighbours, never below ``PROBE_RATIO``. Distances
to centroids are taken from the sample's median, so a common offset costs no digits.
A query at a centroid of its own thus reads on until it has its neighbours. The lists lie
behind each other on a line of rows that is cut into blocks, so that short lists share a
block and one common vector does not make a long task. A query goes to a block once, with
the lists it reads there, and not to every list; many queries of a block are cut into
blocks as well, and every pair of blocks is one task's work. The nearest lists are read
first; from the others a query takes only what is no further than its last neighbour so
far. Matrix products, with a bound on their rounding, tell which rows cannot be among the
neighbours; the distances of the others are exact and in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import stored

NEIGHBOURS = 10
QUERY_STEP = 100
SAMPLE_ROWS = 20_000
LIST_ROWS = 128
MAX_LISTS = 4096
REPLICAS = 4
REPLICA_RATIO = 1.05
PROBE_RATIO = 1.22
WALK_LEAST = 8
FIRST_LISTS = 8
GRAPH_LINKS = 16
ENTRY_POINTS = 16
# Least rows of a block; a longer table has blocks of so many components, and so many of them.
BLOCK_ROWS = 1024
BLOCK_VALUES, BLOCKS = 1 << 20, 64
# Distances in memory at once, in training and in a search, and components of one batch that
# a task gives back.
HELD_DISTANCES, TRAINED_DISTANCES, BATCH_VALUES = 1 << 20, 1 << 23, 1 << 18
# Queries whose true neighbours set the ratio, and the part of these to be found.
TUNE_QUERIES = 256
TUNE_RECALL = 0.98


@dataclass
class Centroids:
    """Centroid vectors and the links of their graph; vectors are seen from ``middle``."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    middle: np.ndarray | float = 0.0

    def all_away(self, vector: np.ndarray) -> np.ndarray:
        """Distances of a vector from every centroid."""
        return np.sqrt(((self.points - np.append(vector - self.middle, 0.0)) ** 2).sum(axis=1))

    def within(
        self, vector: np.ndarray, ratio: float, sizes: np.ndarray, enough: int
    ) -> tuple[np.ndarray, int]:
        """Best-first walk: lists to read, nearest first, and how many of them hold ``enough`` rows.

        Lists up to ``ratio`` times the distance at which the nearer lists hold
        ``enough`` rows; all lists if they hold fewer. Every step opens the nearest
        centroids ahead, twice as many as the step before. The walk ends when nothing
        ahead is within the ratio and WALK_LEAST centroids were opened; what it has not
        seen is then compared once.
        """
        point = np.append(vector - self.middle, 0.0)
        seen = np.zeros(len(self.points), dtype=bool)
        opened = np.zeros(len(self.points), dtype=bool)
        away = np.full(len(self.points), np.inf)
        reach, steps = np.inf, 0

        def meet(places: np.ndarray) -> None:
            nonlocal reach
            seen[places] = True
            away[places] = np.sqrt(((self.points[places] - point) ** 2).sum(axis=1))
            # The nearest lists found that hold enough rows.
            near = np.flatnonzero(seen & (away <= reach))
            near = near[np.argsort(away[near], kind="stable")]
            held = np.cumsum(sizes[near])
            if len(held) and held[-1] >= enough:
                reach = away[near[np.searchsorted(held, enough)]]

        meet(self.entries)
        while True:
            ahead = np.flatnonzero(seen & ~opened)
            ahead = ahead[np.argsort(away[ahead], kind="stable")][: 1 << steps]
            least = max(0, WALK_LEAST - int(opened.sum()))
            ahead = ahead[: max(least, int((away[ahead] <= ratio * reach).sum()))]
            if not len(ahead):
                break
            opened[ahead] = True
            steps += 1
            new = np.unique(self.links[ahead])
            new = new[~seen[new]]
            if len(new):
                meet(new)
        # The links may lead past some centroids, or not to them at all.
        rest = np.flatnonzero(~seen)
        if len(rest):
            far = np.sqrt(((self.points[rest] - point) ** 2).sum(axis=1))
            rest = rest if reach == np.inf else rest[far <= ratio * reach]
        if len(rest):
            meet(rest)
        ranked = np.flatnonzero(seen & (away <= ratio * reach))
        ranked = ranked[np.argsort(away[ranked], kind="stable")]
        return ranked, int((away[ranked] <= reach).sum())


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two bounded blocks; for choosing, not for results."""
    return np.maximum(
        0.0, (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    )


def train(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 42) -> Centroids:
    """Balanced k-means: a full cluster moves away from all vectors, an empty one nearer.

    The way it has moved is one more coordinate of the centroid, where vectors
    have 0, so that placing, walking and probing use one plain distance.
    """
    rng = np.random.default_rng(seed)
    middle = np.median(sample, axis=0)
    sample = np.unique(sample, axis=0) - middle
    lists = max(1, min(lists, len(sample)))
    points = sample[rng.choice(len(sample), lists, replace=False)].copy()
    fair = len(sample) / lists
    moved = np.zeros(lists)
    scale = 0.0
    owner = np.zeros(len(sample), dtype=np.int64)
    # Few distances are kept for a round; many are computed anew for every pass over them.
    few = len(sample) * lists <= TRAINED_DISTANCES
    step = len(sample) if few else max(1, TRAINED_DISTANCES // 4 // lists)
    parts = [slice(at, at + step) for at in range(0, len(sample), step)]
    for _ in range(rounds):
        away = [squared(sample, points)] if few else (squared(sample[p], points) for p in parts)
        if not scale:
            scale = float(np.median(np.concatenate([a.min(axis=1) for a in away]))) or 1.0
        for last in (False, False, False, False, True):
            away = away if few else (squared(sample[p], points) for p in parts)
            for part, distances in zip(parts, away, strict=True):
                owner[part] = np.argmin(distances + moved, axis=1)
            load = np.bincount(owner, minlength=lists)
            if not last:
                moved += 0.05 * scale * np.clip(load / fair - 1.0, -1.0, 2.0)
        sums = np.zeros_like(points)
        np.add.at(sums, owner, sample)
        used = load > 0
        points[used] = sums[used] / load[used][:, None]
    points = np.concatenate([points, np.sqrt(moved - moved.min())[:, None]], axis=1)
    degree = min(GRAPH_LINKS, lists - 1)
    near = np.zeros((lists, degree), dtype=np.int64)
    step = max(1, TRAINED_DISTANCES // 4 // lists)
    for at in range(0, lists, step):
        away = squared(points[at : at + step], points)
        away[np.arange(len(away)), np.arange(at, at + len(away))] = np.inf
        near[at : at + step] = np.argsort(away, axis=1, kind="stable")[:, :degree]
    # Random long links keep the graph in one piece.
    far = rng.integers(0, lists, (lists, 2))
    links = np.concatenate([near, far], axis=1)
    entries = np.sort(rng.choice(lists, min(ENTRY_POINTS, lists), replace=False))
    return Centroids(points, links, entries, middle)


def _usable(vector: Column) -> Column:
    """A vector without null or non-finite components that is not zero."""
    known = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x) != F.lit(float("inf"))),
    )
    return vector.isNotNull() & known & F.exists(vector, lambda x: x != 0)


def copies(index: Centroids, vectors: np.ndarray, replicas: int, ratio: float) -> np.ndarray:
    """Lists of each vector: its nearest centroid, and boundary copies; -1 where there are none.

    A further centroid is taken if it is within ``ratio`` and no centroid taken
    before lies closer to it than the vector does.
    """
    points = np.concatenate([vectors - index.middle, np.zeros((len(vectors), 1))], axis=1)
    away = np.sqrt(squared(points, index.points))
    width = min(2 * replicas, away.shape[1])
    near = np.argpartition(away, width - 1, axis=1)[:, :width]
    near_away = np.take_along_axis(away, near, axis=1)
    order = np.lexsort((near, near_away), axis=1)
    near = np.take_along_axis(near, order, axis=1)
    near_away = np.take_along_axis(near_away, order, axis=1)
    taken = np.zeros(near.shape, dtype=bool)
    taken[:, 0] = True
    for k in range(1, width):
        fits = near_away[:, k] <= ratio * near_away[:, 0]
        for j in range(k):
            gap = np.sqrt(((index.points[near[:, j]] - index.points[near[:, k]]) ** 2).sum(axis=1))
            fits &= ~taken[:, j] | (gap > near_away[:, k])
        taken[:, k] = fits & (taken.sum(axis=1) < replicas)
    return np.where(taken, near, -1)


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column, all of one length, in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(vectors), -1)


def _listed(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(found).astype(np.int32))


def _placer(shared, replicas: int, ratio: float):
    """Every row with the lists it is written to."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = copies(shared.value, _matrix(batch.column("vector")), replicas, ratio)
                yield batch.append_column("lists", _listed([row[row >= 0] for row in own]))

    return place


def _prober(shared, ratio: float, sizes: np.ndarray, enough: int):
    """Every query with the lists it reads, nearest first, and how many are read first."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"))
                found = [shared.value.within(v, ratio, sizes, enough) for v in vectors]
                first = pa.array([max(FIRST_LISTS, n) for _, n in found], pa.int32())
                listed = batch.append_column("lists", _listed([lists for lists, _ in found]))
                yield listed.append_column("first", first)

    return probe


def _dealer(sizes: np.ndarray, block_rows: int, nearest: bool):
    """A row per query and block, with the lists that the query reads there.

    ``nearest`` takes the lists that are read first, or else the others. Batches are
    bounded, however many blocks a query goes to.
    """
    starts = np.cumsum(sizes) - sizes
    leading, closing = starts // block_rows, (starts + sizes - 1) // block_rows

    def pairs(lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the lists, in order, and the list of each."""
        lists = np.sort(lists[sizes[lists] > 0])
        spans = closing[lists] - leading[lists] + 1
        at = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        return np.repeat(leading[lists], spans) + at, np.repeat(lists, spans)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max(1, len(batch.column("vector").flatten()) // max(1, batch.num_rows))
            most = max(1, BATCH_VALUES // width)
            slim = batch.drop_columns(["lists", "first"])
            taken, blocks, lists = [], [], []
            for i, first in enumerate(batch.column("first").to_pylist()):
                own = batch.column("lists")[i].values.to_numpy()
                block, listed = pairs(own[:first] if nearest else own[first:])
                cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
                at = 0
                while at < len(cuts) - 1:
                    ends = cuts[at : at + most - len(taken) + 1]
                    at += len(ends) - 1
                    taken += [i] * (len(ends) - 1)
                    blocks += block[ends[:-1]].tolist()
                    lists += [listed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    if len(taken) >= most:
                        yield dealt(slim, taken, blocks, lists)
                        taken, blocks, lists = [], [], []
            if taken:
                yield dealt(slim, taken, blocks, lists)

    def dealt(slim: pa.RecordBatch, taken: list, blocks: list, lists: list) -> pa.RecordBatch:
        out = slim.take(pa.array(taken, pa.int64()))
        out = out.append_column("block", pa.array(blocks, pa.int64()))
        return out.append_column("lists", _listed(lists))

    return deal


def _true_neighbours(shared, count: int):
    """The ``count`` nearest rows of a task for every query of a bounded sample."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked_rows, asked, middle = shared.value
        away = np.zeros((len(asked), 0))
        places = np.zeros((len(asked), 0), dtype=np.int64)
        for frame in frames:
            if not len(frame):
                continue
            points = np.array(frame["vector"].tolist(), dtype=np.float64) - middle
            rows = np.broadcast_to(frame["row_no"].to_numpy(), (len(asked), len(frame)))
            new = squared(asked, points)
            new[rows == asked_rows[:, None]] = np.inf
            away = np.concatenate([away, new], axis=1)
            places = np.concatenate([places, rows], axis=1)
            if away.shape[1] > count:
                near = np.argpartition(away, count - 1, axis=1)[:, :count]
                away = np.take_along_axis(away, near, axis=1)
                places = np.take_along_axis(places, near, axis=1)
        known = np.isfinite(away)
        yield pd.DataFrame(
            {
                "query_row": np.repeat(asked_rows, known.sum(axis=1)),
                "row_no": places[known],
                "away": away[known],
            }
        )

    return search


def tuned_ratio(
    index: Centroids,
    vectors: dict[int, np.ndarray],
    lists: dict[tuple[int, int], list[int]],
    sizes: np.ndarray,
    enough: int,
    least: float,
) -> float:
    """The ratio that reads a list of ``TUNE_RECALL`` of the true neighbours, at least ``least``.

    ``lists`` holds, for a query and a true neighbour, the lists of the neighbour.
    """
    needed = []
    away, reach = {}, {}
    for query, vector in vectors.items():
        away[query] = index.all_away(vector)
        order = np.argsort(away[query], kind="stable")
        held = np.cumsum(sizes[order])
        last = order[min(np.searchsorted(held, enough), len(order) - 1)]
        reach[query] = away[query][last]
    for (query, _), of in lists.items():
        far = away[query][of].min()
        needed.append(1.0 if far <= reach[query] else far / reach[query] if reach[query] else np.inf)
    if not needed:
        return least
    needed.sort()
    # A little more, as a list at the ratio itself must be within it.
    ratio = needed[min(len(needed) - 1, int(np.ceil(TUNE_RECALL * len(needed))) - 1)]
    return max(least, ratio * (1 + 1e-9))


def _searcher(count: int, middle: np.ndarray | float):
    """The ``count`` nearest of every list for every query that reads it, at most ``most`` away."""

    def near(points, ids, places, asked, own, most) -> Iterator[tuple[np.ndarray, ...]]:
        """Number of the query, of the row, and distance, for one list."""
        seen = points - middle
        norms = (seen**2).sum(axis=1)
        step = max(1, HELD_DISTANCES // len(points))
        slack = 8 * (points.shape[1] + 8) * np.finfo(float).eps
        for at in range(0, len(asked), step):
            there = slice(at, at + step)
            block = asked[there] - middle
            squares = (block**2).sum(axis=1)
            # Above the squared distances by what rounding can add to or take from them.
            away = norms - 2.0 * (block @ seen.T) + squares[:, None]
            error = 2 * slack * (norms.max() + squares)
            limit = most[there] ** 2 * (1 + slack) + error
            may = ~(away > limit[:, None])
            many = np.flatnonzero(may.sum(axis=1) > 2 * count)
            if len(many) and len(points) > count + 1:
                # One more, as the query itself may be among them.
                last = np.partition(away[many], count, axis=1)[:, count]
                may[many] &= ~(away[many] > (last + error[many])[:, None])
            query, row = np.nonzero(may)
            kept = own[there][query] != places[row]
            query, row = query[kept] + at, row[kept]
            # Whole queries, as many as fit.
            held = max(1, HELD_DISTANCES // points.shape[1])
            while len(query):
                end = np.searchsorted(query, query[min(held, len(query)) - 1], "right")
                q, r = query[:end], row[:end]
                query, row = query[end:], row[end:]
                exact = np.concatenate(
                    [
                        np.sqrt(((points[r[p : p + held]] - asked[q[p : p + held]]) ** 2).sum(axis=1))
                        for p in range(0, len(q), held)
                    ]
                )
                order = np.lexsort((ids[r], exact, q))
                q, r, exact = q[order], r[order], exact[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                good = (rank < count) & (exact <= most[q])
                yield q[good], r[good], exact[good]

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(queries):
            rows = rows.sort_by("list")
            points, asked = _matrix(rows["vector"]), _matrix(queries["vector"])
            ids, places = rows["vec_id"].to_numpy(), rows["row_no"].to_numpy()
            own, most = queries["row_no"].to_numpy(), queries["most"].to_numpy()
            wanted = queries["lists"].combine_chunks()
            readers = np.repeat(np.arange(len(queries)), wanted.value_lengths().to_numpy())
            wanted = wanted.flatten().to_numpy()
            order = np.argsort(wanted, kind="stable")
            readers, wanted = readers[order], wanted[order]
            lists, starts = np.unique(rows["list"].to_numpy(), return_index=True)
            for one, start, end in zip(lists, starts, [*starts[1:], len(rows)], strict=True):
                reading = readers[slice(*np.searchsorted(wanted, [one, one + 1]))]
                if len(reading):
                    there = slice(start, end)
                    with np.errstate(over="ignore", invalid="ignore"):
                        found += [
                            (reading[q], r + start, away)
                            for q, r, away in near(
                                points[there], ids[there], places[there],
                                asked[reading], own[reading], most[reading],
                            )
                        ]
        query, row, away = (
            np.concatenate(c) if c else np.zeros(0, dtype=np.int64)
            for c in ([f[k] for f in found] for k in range(3))
        )
        return pa.table(
            {
                "query_row": queries["row_no"].take(pa.array(query)),
                "query_id": queries["vec_id"].take(pa.array(query)),
                "row_no": rows["row_no"].take(pa.array(row)),
                "vec_id": rows["vec_id"].take(pa.array(row)),
                "score": pa.array(away, pa.float64()),
            }
        )

    return search


def nearest(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    neighbours: int = NEIGHBOURS,
    query_step: int = QUERY_STEP,
    sample_rows: int = SAMPLE_ROWS,
    list_rows: int = LIST_ROWS,
    max_lists: int = MAX_LISTS,
    replicas: int = REPLICAS,
    replica_ratio: float = REPLICA_RATIO,
    probe_ratio: float = PROBE_RATIO,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every ``query_step``-th id.

    Vectors that are null, zero or hold null or non-finite components take no
    part, neither do rows with a null id or another length than most vectors of
    the sample. A query has fewer than ``neighbours`` rows only where there are fewer
    candidates. Ties go to the smaller id, then the earlier row; repeated rows
    are candidates of their own. An empty table gives no rows; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    # Floats travel as such and are widened where distances are computed.
    given = vectors.schema[vector_column].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    vector = "array<float>" if single else "array<double>"
    usable = vectors.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast(vector).alias("vector"),
    ).where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    usable = stored(usable, "vectors")
    total = usable.count()
    # The rows with the smallest hashes: every part of the table is as likely.
    drawn = usable.orderBy(F.xxhash64("vec_id", "row_no"), "row_no").limit(sample_rows)
    drawn = drawn.select("vector").toPandas()["vector"].tolist()
    widths = [len(v) for v in drawn]
    width = max(set(widths), key=lambda w: (widths.count(w), w)) if widths else 1
    usable = usable.where(F.size("vector") == width)
    sample = np.array([v for v in drawn if len(v) == width], dtype=np.float64)
    sample = sample.reshape(-1, width) if len(sample) else np.zeros((1, width))
    lists = max(1, min(max_lists, -(-total // list_rows)))
    # At most max_lists centroids, whatever the input.
    index = train(sample, lists)
    shared = spark.sparkContext.broadcast(index)

    columns = ["row_no", "vec_id", "vector"]
    schema = f"row_no long, vec_id long, vector {vector}"
    # A row per vector; what is written is not repeated for every list.
    placed = stored(
        usable.select(*columns).mapInArrow(
            _placer(shared, replicas, replica_ratio), f"{schema}, lists array<int>"
        ),
        "postings",
    )
    rows = placed.select(*columns, F.explode("lists").alias("list"))
    asking = usable.where(F.col("vec_id") % query_step == 0).select(*columns)
    sizes = np.zeros(len(index.points), dtype=np.int64)
    for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("rows")).collect():
        sizes[r["list"]] = r["rows"]
    # A vector is in at most ``replicas`` lists and may be the query itself.
    enough = replicas * (neighbours + 1)
    # A bounded number of queries is compared with every row.
    tuned = asking.orderBy(F.xxhash64("vec_id", "row_no"), "row_no").limit(TUNE_QUERIES).toPandas()
    asked = np.array(tuned["vector"].tolist(), dtype=np.float64).reshape(-1, width)
    compared_with = (tuned["row_no"].to_numpy(dtype=np.int64), asked - index.middle, index.middle)
    compared = usable.select("row_no", "vector").mapInPandas(
        _true_neighbours(spark.sparkContext.broadcast(compared_with), neighbours),
        "query_row long, row_no long, away double",
    )
    nearest_first = Window.partitionBy("query_row").orderBy("away", "row_no")
    true = compared.withColumn("rank", F.row_number().over(nearest_first)).where(
        F.col("rank") <= neighbours
    )
    lists_of: dict[tuple[int, int], list[int]] = {}
    for r in placed.join(F.broadcast(true), "row_no").select("query_row", "row_no", "lists").collect():
        lists_of[(r["query_row"], r["row_no"])] = r["lists"]
    vectors_of = dict(zip(compared_with[0].tolist(), asked, strict=True))
    ratio = tuned_ratio(index, vectors_of, lists_of, sizes, enough, probe_ratio)
    queries = stored(
        asking.mapInArrow(
            _prober(shared, ratio, sizes, enough), f"{schema}, lists array<int>, first int"
        ),
        "probes",
    )
    held = int(sizes.sum())
    block_rows = max(BLOCK_ROWS, min(BLOCK_VALUES // max(1, width), held // BLOCKS))
    # One row per list, so at most max_lists rows.
    line = spark.createDataFrame(
        [(i, int(s), int(n)) for i, (s, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes, strict=True))],
        "list int, start long, held long",
    )
    own = F.xxhash64("row_no")
    place = F.col("start") + F.pmod(own, F.col("held"))
    laid = rows.join(F.broadcast(line), "list").withColumn(
        "block", F.floor(place / F.lit(block_rows)).cast("long")
    )

    def searched(asked: DataFrame, nearest: bool) -> DataFrame:
        """The nearest of every asked list, at most ``most`` away."""
        dealt = asked.mapInArrow(
            _dealer(sizes, block_rows, nearest),
            f"{schema}, most double, block long, lists array<int>",
        )
        # One row per block.
        blocks = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("queries"))
        blocks = blocks.select(
            "block", F.ceil(F.col("queries") / F.lit(block_rows)).alias("query_blocks")
        )
        key = ["block", "query_block"]
        numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1))
        stored_rows = laid.join(F.broadcast(blocks), "block").select(
            "block", numbers.alias("query_block"), "list", *columns
        )
        asking_rows = dealt.join(F.broadcast(blocks), "block").select(
            "block",
            F.pmod(own, F.col("query_blocks")).alias("query_block"),
            "lists",
            "most",
            *columns,
        )
        found = stored_rows.groupBy(*key).cogroup(asking_rows.groupBy(*key)).applyInArrow(
            _searcher(neighbours, index.middle),
            "query_row long, query_id long, row_no long, vec_id long, score double",
        )
        return stored(found, "found")

    # The nearest lists first: what lies beyond their last neighbour need not be returned
    # by any other list, so that a query gets few rows back however many lists it reads.
    order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row_no")
    whole = [*columns, F.lit(float("inf")).alias("most"), "lists", "first"]
    near = searched(queries.select(*whole), True)
    once = near.dropDuplicates(["query_row", "row_no"])
    limits = once.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") == neighbours
    )
    limits = limits.select(F.col("query_row").alias("row_no"), F.col("score").alias("most"))
    whole[3] = F.coalesce("most", F.lit(float("inf"))).alias("most")
    far = searched(queries.join(limits, "row_no", "left").select(*whole), False)
    found = near.unionAll(far)
    # A vector may be found in several lists.
    found = found.groupBy("query_row", "query_id", "row_no", "vec_id").agg(
        F.min("score").alias("score")
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
