"""Centroid clustering of vectors in exact integer arithmetic, with a vantage-point tree.

Vectors become integers, floor(scale * x), so distances, sums and centroids are
exact and don't depend on the order of rows. Each round the driver builds a
vantage-point tree over the centroids (at most ``k`` rows) and broadcasts it; every
vector looks up its nearest centroid there, tasks sum their vectors by centroid,
and the driver gets one sum a centroid and component.

The tree: a node has a vantage point, one of its centroids; the others are split
at the median of their distances to it into an inner and an outer child, each with
the range of those distances. Small nodes are leaves.

The search, best-first branch and bound: of a vector's open nodes the one with the
smallest lower bound is taken, and the search ends when that bound exceeds the best
distance. The bounds of a node's children follow from the triangle inequality; they
are real numbers, so a slack beyond their rounding error keeps the radius inclusive:
a centroid exactly as near as the best one is never pruned. Leaf and vantage-point
distances are exact integers, and of equally near centroids the smaller number wins.
A block's vectors take their steps together, grouped by the node they open, so a
step is one matrix operation a node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import free_name, written

#: Centroids of a leaf at most.
LEAF = 4
#: Vectors that search together.
BLOCK_ROWS = 8192
#: Components are smaller in size than this, so that any squared distance of 64 of them fits into 62 bits.
LIMIT = 1 << 27


# ------------------------------------------------------------------------ the tree


class Node(NamedTuple):
    members: np.ndarray  # centroid numbers: those of a leaf, or the vantage point alone
    children: tuple[tuple[int, float, float], ...]  # (node, least, greatest distance to the vantage point)


class VantageTree(NamedTuple):
    centroids: np.ndarray  # k x d, int64
    nodes: list[Node]  # the root is the first

    @classmethod
    def of(cls, centroids: np.ndarray) -> "VantageTree":
        nodes: list[Node] = []

        def grow(members: np.ndarray) -> int:
            at = len(nodes)
            nodes.append(Node(members, ()))
            if len(members) <= LEAF:
                return at
            apart = squared_distances(centroids[members], centroids[members])
            vantage = int(np.argmax(np.sqrt(apart.astype(float)).var(axis=1)))  # the widest spread of distances
            others = np.delete(np.arange(len(members)), vantage)
            order = others[np.argsort(apart[vantage][others], kind="stable")]
            children = []
            for part in (order[: len(order) // 2], order[len(order) // 2 :]):
                far = np.sqrt(apart[vantage][part].astype(float))
                children.append((grow(np.sort(members[part])), float(far.min()), float(far.max())))
            nodes[at] = Node(members[[vantage]], tuple(children))
            return at

        grow(np.arange(len(centroids)))
        return cls(centroids, nodes)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid; of equally near ones the smaller number."""
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids), np.int64)
        bound = np.full((n, len(self.nodes)), np.inf)  # of the open nodes
        bound[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            opened = bound[active].argmin(axis=1)
            for at in np.unique(opened):
                rows = active[opened == at]
                node = self.nodes[at]
                # a bound may exceed the best distance by rounding only: it is kept within a slack
                reach = np.sqrt(best[rows].astype(float))
                rows = rows[bound[rows, at] <= reach * (1 + 1e-9) + 1e-3]
                bound[rows, at] = np.inf
                apart = squared_distances(vectors[rows], self.centroids[node.members])
                first = apart.argmin(axis=1)  # members rise, so the first is the smallest number
                near, which = apart[np.arange(len(rows)), first], node.members[first]
                better = (near < best[rows]) | ((near == best[rows]) & (which < number[rows]))
                best[rows[better]], number[rows[better]] = near[better], which[better]
                to_vantage = np.sqrt(apart[:, 0].astype(float))
                for child, least, greatest in node.children:
                    bound[rows, child] = np.maximum(0.0, np.maximum(to_vantage - greatest, least - to_vantage))
            open_ = bound[active].min(axis=1)
            active = active[open_ <= np.sqrt(best[active].astype(float)) * (1 + 1e-9) + 1e-3]
            active = active[np.isfinite(bound[active].min(axis=1))]
        return number, best


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, n x m."""
    largest = max((int(np.abs(x).max()) for x in (a, b) if x.size), default=0)
    if largest and 4 * largest * largest * a.shape[1] < 1 << 53:  # every partial sum is an exact double
        x, y = a.astype(float), b.astype(float)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    for k, row in enumerate(b):
        gap = a - row
        out[:, k] = (gap * gap).sum(axis=1)
    return out


# ------------------------------------------------------------------------ vectors


def whole_vectors(rows: DataFrame, dimensions: int, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector has ``dimensions`` components, none null, NaN or infinite. JVM-side, and pushed below every stage."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return rows.where(v.isNotNull() & (F.size(v) == dimensions) & finite)


def _integers(column: pa.Array, dimensions: int, scale: float) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimensions)
    scaled = np.floor(scale * values)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise OverflowError(f"a component of {np.abs(scaled).max():.0f} after scaling: squared distances would not fit into a long")
    return scaled.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of at least ``BLOCK_ROWS``, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def starting_centroids(vectors: DataFrame, k: int, rank: Column, dimensions: int, scale: float, vector_col: str) -> np.ndarray:
    """The ``k`` vectors of smallest ``rank`` (a top-k of rows); of equal ranks, as of repeated rows, by their components."""
    v = F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    rows = vectors.select(rank.alias("rank"), v.alias("v")).orderBy(F.col("rank").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, dimensions)


def cluster_sums(vectors: DataFrame, tree: VantageTree, *, scale: float = 256.0, vector_col: str = "embedding") -> dict[int, tuple[int, list[int]]]:
    """{centroid: (vectors, componentwise sums)} of the vectors nearest to each centroid. One row a task, centroid and component is shuffled."""
    d = tree.centroids.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        count, total = np.zeros(len(tree.centroids), np.int64), np.zeros(tree.centroids.shape, np.int64)
        for block in _blocks(batches):
            x = _integers(block.column(0), d, scale)
            number, _ = tree.nearest(x)
            order = np.argsort(number, kind="stable")
            found, starts = np.unique(number[order], return_index=True)
            total[found] += np.add.reduceat(x[order], starts, axis=0)
            count += np.bincount(number, minlength=len(count))
        held = np.flatnonzero(count)
        columns = [np.repeat(held, d).astype(np.int32), np.tile(np.arange(d, dtype=np.int32), len(held)), np.repeat(count[held], d), total[held].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "place", "n", "s"])

    by_task = vectors.select(vector_col).mapInArrow(sums, "cluster int, place int, n long, s long")
    # a sum over all vectors may need more than 64 bits
    total = by_task.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(total.collect()):  # one row a centroid and component
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["s"]))
    shared.unpersist()
    return out


def fit_centroids(
    vectors: DataFrame,
    rank: Column,
    *,
    k: int = 40,
    rounds: int = 5,
    dimensions: int = 64,
    scale: float = 256.0,
    vector_col: str = "embedding",
) -> np.ndarray:
    """Centroids after ``rounds`` rounds of assignment and of exact floored means; one without vectors stays as it is.

    ``vectors`` come from ``whole_vectors``. They start as the ``k`` vectors of smallest
    ``rank``; with fewer vectors there are as many centroids, with none there is none.
    """
    centroids = starting_centroids(vectors, k, rank, dimensions, scale, vector_col)
    for _ in range(rounds if len(centroids) else 0):
        for number, (n, sums) in cluster_sums(vectors, VantageTree.of(centroids), scale=scale, vector_col=vector_col).items():
            centroids[number] = [s // n for s in sums]
    return centroids


def assign_clusters(vectors: DataFrame, centroids: np.ndarray, *, scale: float = 256.0, vector_col: str = "embedding") -> DataFrame:
    """``vectors`` without ``vector_col``, with ``cluster`` (int) and ``distance`` (long, squared). Map-only."""
    shared = vectors.sparkSession.sparkContext.broadcast(VantageTree.of(centroids))
    kept = [c for c in vectors.columns if c != vector_col]
    added = []
    for name in ("cluster", "distance"):
        added.append(free_name([*kept, *added], name))
    schema = T.StructType([vectors.schema[c] for c in kept])
    schema = schema.add(added[0], T.IntegerType()).add(added[1], T.LongType())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for block in _blocks(batches):
            number, far = tree.nearest(_integers(block.column(vector_col), tree.centroids.shape[1], scale))
            columns = [*[block.column(c) for c in kept], pa.array(number.astype(np.int32)), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    return vectors.mapInArrow(assign, schema)


def clustered_vectors(
    spark: SparkSession,
    rows: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dimensions: int = 64,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """id, cluster, distance, inertia of the cluster and of all, sha256 of the cluster's final centroid, one row a kept vector.

    Rows whose vector is null, of other length, or holds a null or non-finite component
    are left out. Repeated rows count as often as they occur; a null id ranks last. An
    empty table gives an empty result. Components of 2^27 or more after scaling are an
    error, since squared distances would not fit into a long. Other columns are ignored.
    """
    vectors = whole_vectors(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")), dimensions)
    rank = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    centroids = fit_centroids(vectors, rank, k=k, rounds=rounds, dimensions=dimensions, scale=scale)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    assigned = written(assign_clusters(vectors, centroids, scale=scale), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # one row a centroid
    total = sum(r["cluster_inertia"] for r in sums)
    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    info = spark.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], total, texts[r["cluster"]]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid string",
    ).withColumn("centroid_sha256", F.sha2(F.col("centroid").cast("binary"), 256))
    return assigned.join(F.broadcast(info.drop("centroid")), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
