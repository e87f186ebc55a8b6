"""Whitening of embeddings; covariances by polarisation of exact sums of squares."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import grid, int_rows, written

SCALE = 256
#: Integer components are held within this magnitude (an embedding component of a million).
LIMIT = 1 << 28
COMPONENTS = 4


class Whitening(NamedTuple):
    """What the fit list gives: all that a row needs to be whitened."""

    n: int  #: distinct vectors
    sums: tuple[int, ...]  #: their sum in each dimension
    vectors: np.ndarray  #: eigenvectors by columns, by falling eigenvalue
    values: np.ndarray  #: eigenvalues
    trace: float


def _squares(fit: DataFrame, centre: list[int]) -> np.ndarray:
    """Exact sums over ``fit`` of (u_i + u_j)**2, and of u_i**2 on the diagonal, u being x minus ``centre``; Python integers.

    A task adds up its rows and sends a row for each pair of dimensions; the
    driver gets one number a pair.
    """
    dim, middle = len(centre), np.array(centre, np.int64)
    upper = np.triu_indices(dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = np.zeros((dim, dim), np.int64), 0

        def row_each() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v) for v in (upper[0].astype(np.int32), upper[1].astype(np.int32), total[upper])], ["i", "j", "total"])

        for b in batches:
            u = int_rows(b.column("x"), dim) - middle
            largest = max(1, 2 * int(np.abs(u).max(initial=0))) ** 2
            size = max(1, min(4096, 2**60 // largest))
            for k in range(0, len(u), size):
                v = u[k : k + size]
                if most + largest * len(v) >= 2**62:
                    yield row_each()
                    total[:], most = 0, 0
                most += largest * len(v)
                for i in range(dim):
                    pair = v[:, i:] + v[:, i : i + 1]
                    pair[:, 0] = v[:, i]  # the dimension itself
                    total[i, i:] += np.einsum("ij,ij->j", pair, pair)
        yield row_each()

    rows = (
        fit.select("x")
        .mapInArrow(sums, "i int, j int, total long")
        .groupBy("i", "j")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()  # dim * (dim + 1) / 2 numbers
    )
    out = np.zeros((dim, dim), object)
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = int(r.total)
    return out


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the integer vectors ``x`` in ``fit`` (divisor n): exact, then rounded once.

    Polarisation: with y = n * x - S, 2 * cov(i, j) is the variance of
    (y_i + y_j) less those of y_i and y_j. The squares are taken of x less the
    integer next to its mean; what that leaves of the mean (half a unit at most)
    is taken off exactly: sum(y**2) = n * (n * sum(u**2) - r**2), r = sum(u).
    """
    dim = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    squares = _squares(fit, centre)

    def spread(i: int, j: int) -> int:  # n**2 times the variance
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i, j] - r * r

    out = np.zeros((dim, dim))
    for i in range(dim):
        out[i, i] = spread(i, i) / n**2
        for j in range(i):
            out[i, j] = out[j, i] = (spread(i, j) - spread(i, i) - spread(j, j)) / (2 * n**2)
    return out


def fit(vectors: DataFrame) -> Whitening | None:
    """Whitening of the distinct vectors ``x`` (integers, all of one length) of a written table; None if it has no row."""
    dim = next((len(r.x) for r in vectors.limit(1).collect()), None)
    if dim is None:
        return None
    total = (
        vectors.select(F.posexplode("x").alias("i", "v"))
        .groupBy("i")
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
        .collect()  # a number a dimension
    )
    sums = [0] * dim
    for r in total:
        sums[r.i] = int(r.s)
    n = vectors.count()
    found = covariance(vectors, n, sums)
    values, basis = np.linalg.eigh(found)
    order = np.argsort(values)[::-1]
    values, basis = values[order], basis[:, order]
    turn = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(dim)])  # the largest entry is positive
    return Whitening(n, tuple(sums), basis * turn, values, float(np.trace(found)))


def _rank(model: Whitening, components: int) -> int:
    """How many of the first components have a variance beyond rounding."""
    floor = model.trace * len(model.sums) * np.finfo(np.float64).eps
    return int((model.values[:components] > floor).sum())


def _project(x: np.ndarray, model: Whitening, components: int) -> np.ndarray:
    centred = x - np.array([s / model.n for s in model.sums])
    return centred @ model.vectors[:, :components] / np.sqrt(model.values[:components])


def identity_error(vectors: DataFrame, model: Whitening, components: int) -> float:
    """Largest entry of the whitened fit list's covariance less the identity; a task sends one row of sums."""
    dim = len(model.sums)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(components + components**2)
        for b in batches:
            w = _project(int_rows(b.column("x"), dim), model, components)
            total += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "total"])

    rows = vectors.select("x").mapInArrow(sums, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
    mean = np.zeros(components + components**2)
    for r in rows:
        mean[r.i] = r.total / model.n
    first = mean[:components]
    cov = mean[components:].reshape(components, components) - np.outer(first, first)
    return float(np.abs(cov - np.eye(components)).max())


def _told(rows: DataFrame, model: Whitening, components: int, error: float) -> DataFrame:
    dim = len(model.sums)
    sums = np.array(model.sums, object)

    def deviations(x: np.ndarray) -> pa.Array:
        n, largest = model.n, int(np.abs(x).max(initial=0))
        bound = n * largest + max(abs(s) for s in model.sums)
        if bound**2 * dim < 2**63:
            y = n * x - sums.astype(np.int64)
            return pa.array(np.einsum("ij,ij->i", y, y))
        exact = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
        return pa.array([v if v < 2**63 else None for v in map(int, exact)], pa.int64())

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = model.values[:components] / model.trace
        for b in batches:
            x = int_rows(b.column("x"), dim)
            each = np.repeat(np.arange(len(x)), components)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    deviations(x).take(pa.array(each)),
                    pa.array(_project(x, model, components).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(told, _result(rows))


def _result(rows: DataFrame) -> str:
    kind = rows.schema["id"].dataType.simpleString()
    return f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Vectors that are null, or hold a null, NaN or infinite entry, are left out.
    The others become integers ``floor(scale * c)`` (held within LIMIT); the fit
    list is each distinct integer vector once, however often it occurs, and a
    vector in a third of all rows is reduced to one in each task before it
    moves. A component without variance (a rank below ``components``, a single
    distinct vector) has no rows. ``deviation`` is null where no long holds it.

    The table's vectors have one length. Where they do not, the length that most
    rows have counts (the greater among equals), and rows of other lengths are
    left out, as are empty vectors; repeated rows stay; a null id is an id like any other;
    an empty table gives no rows. Other columns are not read. The driver holds a
    number for each pair of dimensions, whatever the number of rows.
    """
    x = grid(F.col(vec), scale, LIMIT)
    rows = written(vectors.select(F.col(id).alias("id"), x.alias("x")).filter("x IS NOT NULL AND size(x) > 0"))
    spark = vectors.sparkSession
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if lengths:
        rows = rows.filter(F.size("x") == lengths[0].dim)
        distinct = written(rows.select("x").distinct())
        model = fit(distinct)
        keep = _rank(model, components)
        if keep:
            error = identity_error(distinct, model, keep)
            return _told(rows, model, keep, error).withColumnRenamed("id", id)
    return spark.createDataFrame([], _result(rows)).withColumnRenamed("id", id)
