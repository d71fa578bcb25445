"""Nearest centroids by a progressive search over Walsh-Hadamard coefficients.

Vectors become integers, floor(scale * x), and are transformed exactly: additions and
subtractions of 64-bit integers only. The transform keeps distances up to the factor
``dims``, so the sum of squared coefficient differences over the first few, coarse
coefficients is a lower bound of the whole. Coefficients are taken in order of their sign
changes. After each step the centroid that looks nearest is finished for an upper bound, and
centroids whose sum already is strictly greater are dropped; those that remain at the
end have all ``dims`` coefficients, so distances and ties are exact.

Each round is one pass over the vectors: a task sends the count and the component sums of
each cluster, which Spark adds up; as many rows as there are centroids come to the driver.

Cases: vectors that are missing, of another length, or with a null or non-finite component
are left out; a component beyond ``LARGEST`` once scaled raises ValueError, as distances
would no longer fit 64 bits; rows that share a key are vectors of their own, in the order of their components
where the start picks among them; a missing key comes last at the start; with fewer
vectors than centroids there are fewer centroids; equal centroids share ties, which the smaller
number wins; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import stored

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
LARGEST = 1 << 24
_ROWS = 4096  # vectors compared at once


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, those of the fewest sign changes first."""
    n, dims = vectors.shape
    out, half = vectors.astype(np.int64), 1
    while half < dims:
        pairs = out.reshape(n, dims // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dims)
        half *= 2
    return out[:, sequency(dims)]


def sequency(dims: int) -> np.ndarray:
    """Rows of the Hadamard matrix in the order of their sign changes."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < dims:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    if len(matrix) != dims:
        raise ValueError("the number of components must be a power of two")
    return np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1), kind="stable")


def steps(dims: int) -> list[int]:
    """How many coefficients are summed after each step: 1, 4, 16, ..., all."""
    return sorted({min(4**i, dims) for i in range(dims.bit_length())})


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector, given their coefficients."""
    n, dims = vectors.shape
    every, most = np.arange(n), np.iinfo(np.int64).max
    total = np.zeros((n, len(centroids)), np.int64)
    alive, bound, done = np.ones(total.shape, bool), np.full(n, most), 0
    for stop in steps(dims):
        row, number = np.nonzero(alive)
        gap = vectors[row, done:stop] - centroids[number, done:stop]
        total[row, number] += (gap * gap).sum(axis=1)
        if stop < dims:
            guess = np.where(alive, total, most).argmin(axis=1)
            rest = vectors[:, stop:] - centroids[guess, stop:]
            bound = np.minimum(bound, total[every, guess] + (rest * rest).sum(axis=1))
            alive &= total <= bound[:, None]
        done = stop
    best = np.where(alive, total, most).argmin(axis=1)  # the first of equals has the smaller number
    return best, total[every, best] // dims


def integers(column: pa.ListArray, dims: int, scale: int) -> np.ndarray:
    """Scaled and floored components, a row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(scale * flat).reshape(-1, dims)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST} / {scale} in magnitude cannot be compared exactly")
    return scaled.astype(np.int64)


def kept_vectors(vectors: DataFrame, embedding: str = "embedding", dims: int = DIMS) -> DataFrame:
    """Rows with exactly ``dims`` components, none null or non-finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.filter((F.size(embedding) == dims) & finite)


class Centroids:
    """Integer centroids, number 0 first."""

    def __init__(self, values: np.ndarray, scale: int = SCALE):
        self.values, self.scale = values, scale

    def digest(self, number: int) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.values[number]).encode()).hexdigest()

    def search(self, column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integer components, nearest centroid and squared distance of each vector."""
        found = integers(column, self.values.shape[1], self.scale)
        centres = transform(self.values)
        parts = [nearest(transform(found[i : i + _ROWS]), centres) for i in range(0, len(found), _ROWS)]
        numbers, far = zip(*parts) if parts else ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        return found, np.concatenate(numbers), np.concatenate(far)

    def moved(self, rows: DataFrame, embedding: str) -> Centroids:
        """Each non-empty centroid replaced by the floored mean of its vectors; one pass."""
        k, dims = self.values.shape
        sent = rows.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, number, _ = sent.value.search(batch.column(0))
                own, at = np.unique(number, return_inverse=True)
                sums = np.zeros((len(own), dims), np.int64)
                np.add.at(sums, at, found)
                yield pa.RecordBatch.from_pydict({"cluster": pa.array(own, pa.int64()), "n": pa.array(np.bincount(at, minlength=len(own)), pa.int64()),
                                                  "sums": pa.array(list(sums), pa.list_(pa.int64()))})

        parts = rows.select(embedding).mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
        total = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
        values = self.values.copy()
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():  # one row a centroid
            values[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
        return Centroids(values, self.scale)


def fit_centroids(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS,
                  dims: int = DIMS, scale: int = SCALE, salt: str = "1:") -> Centroids:
    """Start from the ``k`` vectors of the smallest digest of salt and key, then move the centroids ``rounds`` times."""
    rows = kept_vectors(vectors, embedding, dims)
    digest = F.sha2(F.concat(F.lit(salt), F.col(vec_id).cast("string")), 256)
    start = rows.select(digest.alias("__digest"), F.col(embedding).alias("__v")).orderBy(F.asc_nulls_last("__digest"), "__v").limit(k)
    first = [r["__v"] for r in start.collect()]  # k rows
    found = integers(pa.array(first, pa.list_(pa.float64())), dims, scale) if first else np.empty((0, dims), np.int64)
    centroids = Centroids(found, scale)
    for _ in range(rounds if first else 0):
        centroids = centroids.moved(rows, embedding)
    return centroids


def assign(vectors: DataFrame, centroids: Centroids, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every kept vector."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = kept_vectors(vectors, embedding, centroids.values.shape[1]).select(F.col(vec_id).alias("__id"), F.col(embedding).alias("__v"))
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, far = sent.value.search(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(far, pa.int64())], ["__id", "cluster", "distance"])

    return rows.mapInArrow(run, f"__id {kind}, cluster int, distance bigint").withColumnRenamed("__id", vec_id)


def cluster_vectors(vectors: DataFrame, centroids: Centroids, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``assign`` with the summed distances of the cluster and of all, and the digest of the centroid."""
    found = stored(assign(vectors, centroids, vec_id, embedding), "centroids")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row a centroid
    rows = [(number, s, sum(sums.values()), centroids.digest(number)) for number, s in sorted(sums.items())]
    table = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
