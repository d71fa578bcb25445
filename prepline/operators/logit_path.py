"""Ridge logits of many strengths fitted together.

One scan of the rows carries the weight vectors of all strengths that are still open and
returns, for each, the summed loss, its gradient and its curvature; Spark adds these up by
(vector, place), so the driver receives a few hundred numbers a vector, whatever the number of
rows. As only the penalty differs between strengths, what a scan found at one vector serves
every strength: each goes on from the best vector any of them has reached, which is a
warm start along the path. A Newton step does not depend on the scale of the columns. The number of scans is that of
the hardest strength, not the sum over all.

Rows with a missing label are not counted. Without rows, or with labels of one class, weights stay at what the penalty allows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 256  # columns up to which curvatures are gathered
_INLINE = 100  # columns whose products are written out


@dataclass(frozen=True)
class LogitModel:
    coefficients: tuple[float, ...]
    intercept: float

    def probability(self, features: str = "features") -> Column:
        """The chance of class 1 from a vector column."""
        x = vector_to_array(features)
        if len(self.coefficients) <= _INLINE:
            margin = F.lit(self.intercept)
            for i, w in enumerate(self.coefficients):
                if w:
                    margin = margin + x[i] * F.lit(w)
        else:
            products = F.zip_with(x, F.lit(list(self.coefficients)), lambda a, b: a * b)
            margin = F.aggregate(products, F.lit(self.intercept), lambda s, v: s + v)
        return 1 / (1 + F.exp(-margin))

    def to_json(self) -> str:
        return json.dumps({"coefficients": self.coefficients, "intercept": self.intercept})

    @classmethod
    def from_json(cls, text: str) -> LogitModel:
        state = json.loads(text)
        return cls(tuple(state["coefficients"]), state["intercept"])


@dataclass(frozen=True)
class LogitPath:
    """A model for every strength, how often the rows were scanned, and which strengths came to rest."""

    models: tuple[LogitModel, ...]
    scans: int
    settled: tuple[bool, ...]


def design(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of numbers with a last column of ones."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.hstack([x, np.ones((len(x), 1))])


def chances(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probability of class 1 of every row under every weight vector."""
    return 1.0 / (1.0 + np.exp(-np.clip(x @ weights.T, -700, 700)))


def block_sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each weight vector: rows, loss, gradient, and the upper triangle of the curvature."""
    margin, p = x @ weights.T, chances(x, weights)
    upper = np.triu_indices(x.shape[1])
    loss = (np.logaddexp(0.0, margin) - y[:, None] * margin).sum(axis=0)
    slope = (p - y[:, None]).T @ x
    bend = np.stack([(x.T @ (x * v[:, None]))[upper] for v in (p * (1.0 - p)).T])
    return np.hstack([np.full((len(weights), 1), float(len(x))), loss[:, None], slope, bend])


@dataclass
class Point:
    """What a scan found at one weight vector, in means over the rows."""

    weights: np.ndarray
    loss: float
    slope: np.ndarray
    bend: np.ndarray

    def value(self, ridge: float) -> float:
        return self.loss + 0.5 * ridge * float(self.weights[:-1] @ self.weights[:-1])

    def step(self, ridge: float) -> tuple[np.ndarray, float]:
        """Newton direction under a penalty, and how much a whole step promises."""
        penalty = np.append(np.full(len(self.weights) - 1, ridge), 0.0)
        slope, bend = self.slope + penalty * self.weights, self.bend + np.diag(penalty)
        size = np.sqrt(np.maximum(np.diag(bend), 1e-300))
        scaled = bend / np.outer(size, size) + 1e-13 * np.eye(len(size))
        direction = np.linalg.lstsq(scaled, slope / size, rcond=None)[0] / size
        return direction, float(slope @ direction)


def scan(rows: DataFrame, label: str, features: str, weights: np.ndarray) -> tuple[float, list[Point]]:
    """Number of rows, and a point for every weight vector, from one pass."""
    width = weights.shape[1] - 1
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            known = ~np.isnan(y)
            found = block_sums(design(batch.column(1), width)[known], y[known], sent.value)
            total = found if total is None else total + found
        if total is not None:
            model, place = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (model, place, total)], ["model", "place", "value"])

    parts = rows.select(F.col(label).cast("double"), features).mapInArrow(run, "model bigint, place bigint, value double")
    q = width + 1
    sums = np.zeros((len(weights), 2 + q + q * (q + 1) // 2))
    found = parts.groupBy("model", "place").agg(F.sum("value").alias("value")).toPandas()
    sums[found["model"], found["place"]] = found["value"]
    n, points, upper = max(sums[0, 0], 1.0), [], np.triu_indices(q)
    for w, s in zip(weights, sums / n):
        bend = np.zeros((q, q))
        bend[upper] = s[2 + q :]
        points.append(Point(w, s[1], s[2 : 2 + q], bend + np.triu(bend, 1).T))
    return sums[0, 0], points


def fit_path(rows: DataFrame, label: str, features: str, strengths: Sequence[float], width: int, max_scans: int = 60,
             tolerance: float = 1e-11) -> LogitPath:
    """Logits with inverse strengths on the summed loss and a free intercept; ``features`` is an array column of a held table."""
    n, (start,) = scan(rows, label, features, np.zeros((1, width + 1)))
    ridges = [1.0 / (c * max(n, 1.0)) for c in strengths]
    best, length, settled, scans = [start] * len(ridges), [1.0] * len(ridges), [False] * len(ridges), 1
    while scans < max_scans:
        tries = {}
        for k, ridge in enumerate(ridges):
            if not settled[k]:
                direction, promise = best[k].step(ridge)
                settled[k] = promise <= tolerance * max(1.0, best[k].value(ridge)) or length[k] < 1e-6
                if not settled[k]:
                    tries[k] = best[k].weights - length[k] * direction
        if not tries:
            break
        _, points = scan(rows, label, features, np.stack(list(tries.values())))
        scans += 1
        for k in tries:
            lowest = min(points, key=lambda p: p.value(ridges[k]))
            if lowest.value(ridges[k]) < best[k].value(ridges[k]):
                best[k], length[k] = lowest, 1.0
            else:
                length[k] /= 2
    models = tuple(LogitModel(tuple(float(w) for w in p.weights[:-1]), float(p.weights[-1])) for p in best)
    return LogitPath(models, scans, tuple(settled))


def score_path(df: DataFrame, features: str, models: Sequence[LogitModel], keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``keep`` and one probability column a model, from one pass over an array column."""
    weights = np.array([[*m.coefficients, m.intercept] for m in models])
    names = [f"p1_{i}" for i in range(len(models))]
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chances(design(batch.column(len(keep)), weights.shape[1] - 1), sent.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *[pa.array(c) for c in p.T]], [*keep, *names])

    kept = df.select(*keep)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema], *[f"{n} double" for n in names]])
    return df.select(*keep, features).mapInArrow(run, schema), names
