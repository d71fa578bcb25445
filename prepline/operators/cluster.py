"""Clustering interval columns by their correlations.

The rows are read once, for the correlation matrix. Everything after that works
on the matrix, whose size depends on the number of columns alone: components of
a cluster are eigenvectors of its block, and correlations with the component of
another cluster follow from the entries between the two.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.catalog import INTERVAL, Catalog
from prepline.operators.profile import one_row_per_column

METHODS = ("VariationProportion", "MaxEigenvalue")
_DIGITS = 10  # loadings that agree this far count as equal
_CONSTANT = 1e-12  # a variance up to this is that of a constant column


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlations from a pass for the means and one for the products of deviations; only sums leave the tasks.

    A constant column correlates with nothing. Missing values raise an error.
    """
    columns = list(columns)
    safe, width = [f"f{i}" for i in range(len(columns))], len(columns)
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(s) for c, s in zip(columns, safe)])
    n, present, means = wide.agg(F.count(F.lit(1)), F.array(*[F.count(F.nanvl(s, F.lit(None).cast("double"))) for s in safe]),
                                 F.array(*[F.avg(s) for s in safe])).first()
    if min(present, default=n) < n:
        raise ValueError("missing values cannot be correlated")
    if n < 2:
        raise ValueError("correlations need two rows")
    centre = np.array(means)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            total += x @ x.T
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["place", "value"])

    sums = wide.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    found = sums.sort_values("place")["value"].to_numpy().reshape(width, width) / (n - 1)
    spread = np.sqrt(np.where(np.diag(found) > _CONSTANT, np.diag(found), np.nan))
    found = np.nan_to_num(found / spread[:, None] / spread, nan=0.0)
    np.fill_diagonal(found, 1.0)
    return found


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var_a, var_b, corr)`` for every ordered pair of columns."""
    columns = list(columns)
    found = correlation_matrix(df, columns)
    rows = [(a, b, float(found[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "var_a string, var_b string, corr double")


def _block(c: np.ndarray, members: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from large to small, and their vectors as columns; signs are fixed."""
    values, vectors = np.linalg.eigh(c[np.ix_(members, members)])
    values, vectors = values[::-1], vectors[:, ::-1]
    strongest = np.argmax(np.round(np.abs(vectors), _DIGITS), axis=0)
    signs = np.sign(vectors[strongest, np.arange(vectors.shape[1])])
    return np.clip(values, 0.0, None), vectors * np.where(signs == 0, 1.0, signs)


def _split(c: np.ndarray, members: list[int]) -> tuple[list[int], list[int]]:
    """Each column joins the component it loads on more; neither side stays empty."""
    values, vectors = _block(c, members)
    loadings = np.round((vectors[:, :2] ** 2) * values[:2], _DIGITS)
    to_first = loadings[:, 0] >= loadings[:, 1]
    if to_first.all():
        to_first[np.argmin(loadings[:, 0])] = False
    elif not to_first.any():
        to_first[np.argmin(loadings[:, 1])] = True
    return ([m for m, f in zip(members, to_first) if f], [m for m, f in zip(members, to_first) if not f])


def split_columns(c: np.ndarray, method: str, hyper: float, n_rows: int) -> list[list[int]]:
    """Start from one cluster and split the worst until the rule holds for all."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {METHODS}")
    sample = n_rows / (n_rows - 1) if n_rows > 1 else 1.0

    def worst() -> int | None:
        """Position of the cluster to split next, the first of equals."""
        spread = [_block(c, m)[0] for m in clusters]
        if method == "VariationProportion":
            shares = [round(float(v[0] / v.sum()), _DIGITS) for v in spread]
            at = min(range(len(shares)), key=shares.__getitem__)
            return at if shares[at] < hyper and len(clusters[at]) > 1 else None
        seconds = [round(float(v[1]) * sample, _DIGITS) if len(v) > 1 else 1.0 for v in spread]
        many = [i for i in range(len(seconds)) if len(clusters[i]) > 1]
        at = max(many, key=seconds.__getitem__, default=None)
        return at if at is not None and seconds[at] > hyper else None

    clusters = [list(range(len(c)))]
    while (at := worst()) is not None:
        clusters[at], other = _split(c, clusters[at])
        clusters.append(other)
    return clusters


@dataclass(frozen=True)
class ClusterRow:
    cluster: int
    var: str
    r2_own: float
    r2_next: float
    ratio: float | None
    selected: bool


@dataclass(frozen=True)
class Component:
    """First principal component of a cluster on standardised columns."""

    cluster: int
    variables: tuple[str, ...]
    weights: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]


@dataclass(frozen=True)
class ClusterModel:
    rows: tuple[ClusterRow, ...]
    components: tuple[Component, ...]

    def selected(self) -> list[str]:
        return [r.var for r in self.rows if r.selected]

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.reject(r.var for r in self.rows if not r.selected)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(r.cluster, r.var, r.r2_own, r.r2_next, r.ratio, r.selected) for r in self.rows],
            "cluster int, var string, r2_own double, r2_next double, ratio double, selected boolean")

    def scores(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and one score per cluster; the weight of largest size is positive."""
        new = []
        for part in self.components:
            terms = [
                F.lit(w) * (F.col(f"`{v}`").cast("double") - F.lit(m)) / F.lit(d or 1.0)
                for v, w, m, d in zip(part.variables, part.weights, part.means, part.deviations)
            ]
            new.append(sum(terms[1:], terms[0]).alias(f"PC1_{part.cluster}"))
        return df.select(*keep, *new)

    def to_json(self) -> str:
        return json.dumps({"rows": [vars(r) for r in self.rows], "components": [vars(p) for p in self.components]})

    @classmethod
    def from_json(cls, text: str) -> ClusterModel:
        state = json.loads(text)
        parts = [{k: tuple(v) if isinstance(v, list) else v for k, v in p.items()} for p in state["components"]]
        return cls(tuple(ClusterRow(**r) for r in state["rows"]), tuple(Component(**p) for p in parts))


def cluster_columns(df: DataFrame, columns: Sequence[str], method: str = "VariationProportion",
                    hyper: float = 0.8) -> ClusterModel:
    columns = list(columns)
    if not columns:
        return ClusterModel((), ())
    c = correlation_matrix(df, columns)
    moments = {
        r["var"]: r for r in one_row_per_column(
            df, columns, n=lambda x: F.count(F.lit(1)), mean=lambda x: F.avg(F.col(f"`{x}`").cast("double")),
            dev=lambda x: F.stddev_pop(F.col(f"`{x}`").cast("double"))).collect()
    }
    n_rows = moments[columns[0]]["n"]
    sample = n_rows / (n_rows - 1) if n_rows > 1 else 1.0
    clusters = split_columns(c, method, hyper, n_rows)
    firsts = []
    for members in clusters:
        values, vectors = _block(c, members)
        firsts.append((float(values[0]), vectors[:, 0]))

    rows, parts = [], []
    for at, members in enumerate(clusters):
        value, vector = firsts[at]
        own = vector**2 * value * sample if len(members) > 1 else np.ones(1)
        nearest = np.zeros(len(members))
        for other, (v, w) in enumerate(firsts):
            if other != at and v > 0:
                along = c[np.ix_(members, clusters[other])] @ w
                nearest = np.maximum(nearest, along**2 / v)
        ratio = np.round((1 - own) / np.where(nearest < 1, 1 - nearest, np.nan), _DIGITS)
        chosen = int(np.nanargmin(ratio)) if len(members) > 1 and not np.isnan(ratio).all() else 0
        for i, m in enumerate(members):
            shown = None if np.isnan(ratio[i]) else float(ratio[i])
            rows.append(ClusterRow(at + 1, columns[m], float(own[i]), float(nearest[i]), shown, i == chosen))
        names = tuple(columns[m] for m in members)
        parts.append(Component(at + 1, names, tuple(float(x) for x in vector),
                               tuple(moments[n]["mean"] for n in names), tuple(moments[n]["dev"] for n in names)))
    return ClusterModel(tuple(rows), tuple(parts))


def fit_clusters(df: DataFrame, catalog: Catalog, method: str = "VariationProportion", hyper: float = 0.8) -> ClusterModel:
    return cluster_columns(df, catalog.inputs(INTERVAL), method, hyper)
