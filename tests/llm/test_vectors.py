"""Clusters against brute force: every distance of every vector in every round."""

import hashlib
import random

import numpy as np
import pytest

from brandflow.llm.vp_clusters import VantageTree, clustered_vectors, squared_distances

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def brute(rows, k, rounds, d):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    ranked = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "z", r[1]))
    centroids = [list(v) for _, v in ranked[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        for n, vs in held.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    total = sum(f[2] for f in found)
    return sorted(
        ((i, c, far, sum(f[2] for f in found if f[1] == c), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, far in found),
        key=str,
    )


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in clustered_vectors(spark, df, **options).collect()), key=str)


def test_equals_brute_force_with_ties_copies_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(n, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for n in range(300)]  # a small grid: many ties
    rows += [(n, rows[n][1]) for n in range(20)] + [(1000 + n, rows[0][1]) for n in range(150)]  # repeated rows, a hot vector
    odd = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [1.0, None, 0.0, 0.0]), (6, [float("nan")] * 4), (7, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5] * 4)]
    rows += odd
    assert run(spark, rows, k=12, rounds=3, dimensions=4) == brute(rows, 12, 3, 4)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [5.0, -5.0])]
    assert run(spark, rows, k=40, rounds=2, dimensions=2) == brute(rows, 40, 2, 2)
    empty = clustered_vectors(spark, spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_components_beyond_the_range_of_long_distances_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit"):
        run(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])], k=2, rounds=1, dimensions=2)


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 24])
def test_tree_finds_the_smallest_of_equally_near_centroids(spread):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread + 1, (40, 6))
    vectors = rng.integers(-spread, spread + 1, (2000, 6))
    vectors[:40] = centroids
    far = squared_distances(vectors, centroids)
    assert (far == ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)).all()
    number, best = VantageTree.of(centroids).nearest(vectors)
    assert (number == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_search_prunes():
    rng = np.random.default_rng(1)
    tree = VantageTree.of(rng.integers(-10000, 10000, (40, 2)))
    vectors = tree.centroids[rng.integers(0, 40, 500)] + rng.integers(-50, 50, (500, 2))
    seen = []
    import brandflow.llm.vp_clusters as module

    whole = module.squared_distances
    try:
        module.squared_distances = lambda a, b: seen.append(len(a) * len(b)) or whole(a, b)
        tree.nearest(vectors)
    finally:
        module.squared_distances = whole
    assert sum(seen) < 0.6 * 500 * 40
