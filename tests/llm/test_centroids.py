"""Centroid clustering and its vantage-point tree against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ledgermill.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def brute_clusters(rows: list[tuple], clusters: int, rounds: int, components: int) -> list[tuple]:
    kept = []
    for row in rows:
        given = row[1]
        if given and len(given) == components and all(x is not None for x in given):
            given = [float(np.float32(x)) for x in given]
            if all(math.isfinite(x) for x in given):
                kept.append((row[0], [math.floor(64 * x) for x in given]))

    def start(item):
        text = "" if item[0] is None else hashlib.sha256(f"1:{item[0]}".encode()).hexdigest()
        return (item[0] is None, text, item[1])

    points = [v for _, v in sorted(kept, key=start)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), i) for i, p in enumerate(points))

    for _ in range(rounds):
        mine = [[] for _ in points]
        for _, v in kept:
            mine[nearest(v)[1]].append(v)
        points = [
            [sum(c) // len(m) for c in zip(*m)] if m else p for m, p in zip(mine, points)
        ]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    total = sum(f[2] for f in found)
    return [
        (
            *f,
            sum(g[2] for g in found if g[1] == f[1]),
            total,
            hashlib.sha256(",".join(map(str, points[f[1]])).encode()).hexdigest(),
        )
        for f in found
    ]


def odd_vectors(components: int) -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for i in range(300):
        # Coarse values: many ties between centroids, many equal vectors.
        rows.append((i, [rng.choice((-1.0, -0.02, 0.0, 0.5)) for _ in range(components)]))
    rows += [(400 + i, rows[7][1]) for i in range(60)]
    rows += [(i, rows[i][1]) for i in (3, 3, 9)] + [(9, rows[10][1])]
    rows += [(None, rows[2][1]), (None, None), (500, None), (501, []), (502, [1.0])]
    bad = [1.0] * (components - 1)
    rows += [(503, bad + [None]), (504, bad + [math.nan]), (505, bad + [math.inf])]
    rows += [(506, [1000.5, -7.25] * (components // 2))]
    return [(*r, "clash", 1) for r in rows]


@pytest.mark.parametrize("clusters", [1, 2, 16, 40])
def test_clusters_match_brute_force(spark, clusters):
    rows = odd_vectors(4)
    found = centroids.clustered(
        spark.createDataFrame(rows, SCHEMA).repartition(3), clusters=clusters, components=4
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        brute_clusters(rows, clusters, 3, 4), key=repr
    )


def test_fewer_vectors_than_clusters_and_none_at_all(spark):
    rows = odd_vectors(64)[:5]
    found = centroids.clustered(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == sorted(brute_clusters(rows, 16, 3, 64))
    empty = centroids.clustered(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns[:3] == ["vec_id", "cluster", "distance"]


def test_a_vector_beyond_64_bits_stops_the_job(spark):
    rows = [(1, [3e38] + [0.0] * 63, None, None)]
    with pytest.raises(Exception, match="too long for 64-bit"):
        centroids.clustered(spark.createDataFrame(rows, SCHEMA)).collect()


def test_tree_finds_the_nearest_with_the_smallest_number_and_prunes():
    rng = np.random.default_rng(3)
    for points, spread in ((1, 5), (2, 5), (17, 3), (200, 1000)):
        known = rng.integers(-spread, spread, (points, 6))
        asked = rng.integers(-spread, spread, (500, 6))
        tree = centroids.VantageTree(known)
        number, squared = tree.nearest(asked)
        every = ((asked[:, None, :] - known[None]) ** 2).sum(axis=2)
        assert (squared == every.min(axis=1)).all()
        assert (number == every.argmin(axis=1)).all()
    # Tight groups far apart: most nodes are never opened.
    known = np.repeat(rng.integers(-(10**6), 10**6, (50, 6)), 4, axis=0) + rng.integers(-3, 3, (200, 6))
    tree, opened = centroids.VantageTree(known), []
    visit = tree._visit
    tree._visit = lambda node, rows, *rest: (opened.append(len(rows)), visit(node, rows, *rest))
    tree.nearest(known)
    assert sum(opened) < 0.5 * len(known) * len(tree.members)
