"""Centroid clustering of vectors: exact nearest centroids through a vantage-point tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import grid, int_rows, written

LEAF = 4
#: Entries of the matrix of open bounds (vectors x nodes) that a search holds at once.
MAX_OPEN = 1 << 21
_NONE = np.iinfo(np.int64).max
#: Rounding of the square roots below, with room; bounds are widened by it, so no equal distance is cut off.
_SLACK = 1e-14


def largest_component(dim: int) -> int:
    """Components up to this magnitude keep every squared distance of ``dim`` of them within 62 bits."""
    return 1 << ((62 - max(dim - 1, 1).bit_length()) // 2 - 1)


class VantageTree:
    """Vantage-point tree over integer centroids, in arrays; small, rebuilt each round and broadcast.

    An inner node has one centroid as vantage point and the others below it,
    ordered by their distance from it and halved; each half keeps the least
    and greatest distance. A leaf has up to LEAF centroids.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = np.ascontiguousarray(centroids, np.int64)
        self.members: list[np.ndarray] = []  # centroids to compare at each node: the vantage point, or a leaf's
        self.below: list[list[tuple[int, float, float]]] = []  # (node, nearest, farthest) of each half
        self._build(np.arange(len(self.centroids)), leaf)

    def _build(self, members: np.ndarray, leaf: int) -> int:
        at = len(self.members)
        self.members.append(members)
        self.below.append([])
        if len(members) > leaf:
            spread = self._squares(self.centroids[members], members).astype(np.float64).std(axis=0)
            vantage = members[spread.argmax()]  # the one that tells the others apart best
            rest = members[members != vantage]
            far = np.sqrt(self._squares(self.centroids[rest], np.array([vantage]))[:, 0].astype(np.float64))
            order = np.argsort(far, kind="stable")
            self.members[at] = np.array([vantage])
            for half in np.array_split(order, 2):
                node = self._build(rest[half], leaf)
                self.below[at].append((node, float(far[half[0]]), float(far[half[-1]])))
        return at

    def _squares(self, x: np.ndarray, members: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(members)), np.int64)
        for j, m in enumerate(members):
            step = x - self.centroids[m]
            out[:, j] = np.einsum("ij,ij->i", step, step)
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and exact squared distance of each row's nearest centroid; the smaller number among equals.

        Best-first branch and bound: every row opens its own open node of the
        least bound next, and is done when that bound is beyond its best
        distance. A bound equal to it is still opened, since an equal distance
        with a smaller number may lie there. Rows that open the same node are
        compared with it together.
        """
        size = max(1, MAX_OPEN // len(self.members))
        parts = [self._nearest(x[i : i + size]) for i in range(0, len(x), size)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        who, best = np.full(len(x), _NONE), np.full(len(x), _NONE)
        bound = np.full((len(x), len(self.members)), np.inf)
        bound[:, 0] = 0
        rows = np.arange(len(x))
        while len(rows):
            node = bound[rows].argmin(axis=1)
            low = bound[rows, node]
            go = np.isfinite(low) & (low <= np.sqrt(best[rows].astype(np.float64)) * (1 + _SLACK))
            rows, node = rows[go], node[go]
            low = low[go]
            bound[rows, node] = np.inf
            for v in np.unique(node):
                here = rows[node == v]
                self._compare(x, here, v, who, best, bound, low[node == v])
        return who, best

    def _compare(self, x, rows, v, who, best, bound, low) -> None:
        squares = self._squares(x[rows], self.members[v])
        for j, m in enumerate(self.members[v]):
            d = squares[:, j]
            better = (d < best[rows]) | ((d == best[rows]) & (m < who[rows]))
            best[rows[better]], who[rows[better]] = d[better], m
        if self.below[v]:
            far = np.sqrt(squares[:, 0].astype(np.float64))
            for node, least, most in self.below[v]:
                gap = np.maximum(far - most, least - far) - _SLACK * (far + most)
                bound[rows, node] = np.maximum(low, gap)


def _first(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of the least SHA-256 of ``<seed>:<id>`` (a null id is empty; ties by the vector)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r.x for r in vectors.select(key.alias("h"), "x").orderBy("h", "x").limit(k).collect()], np.int64)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round. Each task sends one row a cluster; the driver gets a number a component."""
    k, dim = centroids.shape
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, seen = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), 0

        def row_each() -> pa.RecordBatch:
            own = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(list(total[own]), pa.list_(pa.int64()))],
                ["cluster", "n", "total"],
            )

        for b in batches:
            x = int_rows(b.column("x"), dim)
            if seen + len(x) > 1 << 33:  # sums of 2**33 components of 28 bits still fit
                yield row_each()
                total[:], count[:], seen = 0, 0, 0
            seen += len(x)
            who, _ = tree.value.nearest(x)
            for c in np.unique(who):
                own = x[who == c]
                total[c] += own.sum(axis=0)
                count[c] += len(own)
        yield row_each()

    parts = vectors.select("x").mapInArrow(sums, "cluster int, n long, total array<long>")
    whole = F.col("total").cast("decimal(38,0)")
    rows = (
        parts.select("cluster", "n", F.posexplode("total").alias("i", "total"))
        .groupBy("cluster", "i")
        .agg(F.sum("n").alias("n"), F.sum(whole).alias("total"))
        .collect()  # k x dim numbers
    )
    moved = centroids.copy()
    for r in rows:
        moved[r.cluster, r.i] = int(r.total) // r.n  # floors, also below zero
    return moved


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dim = centroids.shape[1]
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, best = tree.value.nearest(int_rows(b.column("x"), dim))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(who.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"id {id_type}, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    id: str = "vec_id",
    vec: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    dim: int = 64,
    seed: int = 1,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row a kept vector.

    Kept are vectors of exactly ``dim`` components, none null, NaN or infinite.
    Components become integers ``floor(scale * x)``, held within
    ``largest_component(dim)`` (2**27 for 64 components) so that squared
    distances are exact. The ``k`` first centroids are the vectors of the least
    SHA-256 of ``<seed>:<id>``; each round assigns every vector to its nearest
    centroid (ties: the smaller number) and moves each non-empty centroid to
    the floor of its mean; a last assignment follows. Inertias that no long
    holds are null.

    The tree over the ``k`` centroids is all that is broadcast, and the driver
    holds ``k * dim`` numbers: both follow the parameters, not the rows. Vectors
    never move: a task sends one row of sums a cluster, so a vector or cluster
    that holds a third of all rows costs no more than another.

    Rows without a kept vector (null, empty or of another length) are left out;
    repeated rows, also of one id, count each; a null id is an id like any
    other; with fewer than ``k`` vectors each is a first centroid; an empty
    table gives no rows. Other columns are not read.
    """
    limit = largest_component(dim)
    x = grid(F.col(vec), scale, limit)
    kept = vectors.filter(F.size(vec) == dim).select(F.col(id).alias("id"), x.alias("x")).filter(F.col("x").isNotNull())
    kept = written(kept)
    spark = vectors.sparkSession
    centroids = _first(kept, k, seed)
    if not len(centroids):
        types = f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], types).withColumnRenamed("id", id)
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    found = written(_assigned(kept, centroids))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def held(n: int) -> int | None:
        return n if n < 2**63 else None

    rows = [(c, held(s), held(sum(sums.values())), digest[c]) for c, s in sums.items()]
    info = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(info), "cluster").select(  # k rows at most
        F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
