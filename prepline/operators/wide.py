"""Correlations and clusters of very many columns.

Rows are vectors. No matrix of columns by columns reaches the driver: correlations are tables of square
blocks, summed by (block, block), and the leading components of clusters come from power
iteration. A pass multiplies every row with the present vectors and adds up the products; as
clusters share no columns, one pass serves all clusters that are open, and what it
returns is a few numbers a column. Whether a cluster splits depends on it alone, so all clusters
that must split do so in the same round, and the order in which the worst was split first is
replayed afterwards. Rows with a missing or non-finite value raise an error, as for few columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.operators.cluster import _DIGITS, METHODS, ClusterModel, ClusterRow, Component
from prepline.session import cut_lineage, held, rows_at_once

BLOCK = 128  # columns in a block of correlations
_SPACE = 6  # vectors iterated for the two that are wanted
_CELLS = 2_000_000  # numbers in a batch of rows


def vectors_of(df: DataFrame, columns: Sequence[str], out: str = "x") -> DataFrame:
    """The columns as one array."""
    return df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias(out))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
    x = flat.reshape(batch.num_rows, -1)
    if not np.isfinite(x).all():
        raise ValueError("missing or non-finite values cannot be correlated")
    return x


def _sums(rows: DataFrame, width: int, of, shape: tuple[int, ...]) -> np.ndarray:
    """``of(matrix)`` added up over all rows, by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = of(_matrix(batch)).ravel()
                total = found if total is None else total + found
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "v"])

    with rows_at_once(rows.sparkSession, max(1, _CELLS // max(width, 1))):
        found = rows.mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(int(np.prod(shape)))
    out[found["at"].to_numpy()] = found["v"].to_numpy()
    return out.reshape(shape)


class Standard:
    """Rows as deviations from the mean in units of the deviation; constant columns are 0 throughout."""

    def __init__(self, rows: DataFrame, width: int):
        self.rows, self.width = rows, width
        one = _sums(rows, width, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), (width + 1,))
        self.n, self.mean = int(one[0]), one[1:] / max(one[0], 1.0)
        mean = rows.sparkSession.sparkContext.broadcast(self.mean)
        squares = _sums(rows, width, lambda x: ((x - mean.value) ** 2).sum(axis=0), (width,))
        self.dev = np.sqrt(squares / max(self.n, 1))

    def of(self):
        mean, unit = self.mean, np.where(self.dev > 0, self.dev, np.inf)
        return lambda x: (x - mean) / unit


def correlation_blocks(rows: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """``i, j, size_i, size_j, values``: correlations of columns i * block + a and j * block + b, row by row, for i <= j."""
    with held(rows) as kept:
        standard = Standard(kept, width)
        z, n = standard.of(), standard.n
        starts = list(range(0, width, block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {}
            for batch in batches:
                if batch.num_rows:
                    x = z(_matrix(batch))
                    for i, a in enumerate(starts):
                        for j, b in enumerate(starts[i:], i):
                            part = x[:, a : a + block].T @ x[:, b : b + block]
                            total[i, j] = total[i, j] + part if (i, j) in total else part
            for (i, j), part in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([j]), pa.array([part.tobytes()], pa.binary())], ["i", "j", "part"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
            sizes = [min(block, width - k * block) for k in (i, j)]
            square = (sum(np.frombuffer(p) for p in group["part"]) / max(n, 1)).reshape(sizes)
            if i == j:
                np.fill_diagonal(square, 1.0)
            return pd.DataFrame([{"i": i, "j": j, "size_i": sizes[0], "size_j": sizes[1], "values": square.ravel()}])

        with rows_at_once(rows.sparkSession, max(1, _CELLS // max(width, 1))):
            parts = kept.mapInArrow(run, "i bigint, j bigint, part binary")
            out = parts.groupBy("i", "j").applyInPandas(add, "i bigint, j bigint, size_i bigint, size_j bigint, values array<double>")
            return cut_lineage(out)


# components ------------------------------------------------------------------------


def products(standard: Standard, members: Sequence[Sequence[int]], vectors: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Each cluster's block of correlations times its vectors, in one pass for all clusters."""
    order = np.concatenate([np.asarray(m, np.int64) for m in members])
    starts, space = np.cumsum([0, *[len(m) for m in members]])[:-1], vectors[0].shape[1]
    stacked, owner, z = np.vstack(vectors), np.repeat(np.arange(len(members)), [len(m) for m in members]), standard.of()
    sent = standard.rows.sparkSession.sparkContext.broadcast((order, starts, owner, stacked))

    def of(x: np.ndarray) -> np.ndarray:
        order, starts, owner, stacked = sent.value
        own = z(x)[:, order]
        out = np.empty((len(order), space))
        for k in range(space):
            scores = np.add.reduceat(own * stacked[:, k], starts, axis=1)
            out[:, k] = np.einsum("rc,rc->c", own, scores[:, owner])
        return out

    total = _sums(standard.rows, standard.width, of, (len(order), space)) / max(standard.n, 1)
    return [total[s : s + len(m)] for s, m in zip(starts, members)]


def leading_pairs(standard: Standard, members: Sequence[Sequence[int]], rounds: int = 200, tolerance: float = 1e-11) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two leading eigenvalues and vectors of each cluster's correlations, by power iteration on a small space."""
    rng, found = np.random.default_rng(3), [None] * len(members)
    live = {}
    for i, m in enumerate(members):
        space = min(_SPACE, len(m))
        live[i] = np.linalg.qr(rng.normal(size=(len(m), space)))[0]
    before = {i: np.zeros(2) for i in live}
    for turn in range(rounds):
        if not live:
            break
        width = max(v.shape[1] for v in live.values())
        padded = [np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in live.values()]
        images = products(standard, [members[i] for i in live], padded)
        for (i, v), image in zip(list(live.items()), images):
            image = image[:, : v.shape[1]]
            small = v.T @ image
            values, turned = np.linalg.eigh((small + small.T) / 2)
            values, turned = values[::-1], turned[:, ::-1]
            two = np.pad(values[:2], (0, max(0, 2 - len(values))))
            # a space as large as the cluster is exact at once; else the vectors must have come to rest too
            rest = image @ turned[:, :2] - (v @ turned[:, :2]) * values[:2]
            done = v.shape[1] == len(members[i]) or (np.abs(two - before[i]).max() <= tolerance * max(two[0], 1e-300) and np.abs(rest).max() < 1e-6)
            before[i] = two
            if done or turn == rounds - 1:
                vectors = v @ turned[:, :2]
                strongest = np.argmax(np.round(np.abs(vectors), _DIGITS), axis=0)
                signs = np.sign(vectors[strongest, np.arange(vectors.shape[1])])
                found[i] = np.clip(two, 0.0, None), vectors * np.where(signs == 0, 1.0, signs)
                del live[i]
            else:
                live[i] = np.linalg.qr(image)[0]
    return found


def _halves(values: np.ndarray, vectors: np.ndarray, members: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Each column joins the component it loads on more; neither side stays empty."""
    loadings = np.round((vectors[:, :2] ** 2) * values[:2], _DIGITS)
    first = loadings[:, 0] >= loadings[:, 1]
    if first.all():
        first[np.argmin(loadings[:, 0])] = False
    elif not first.any():
        first[np.argmin(loadings[:, 1])] = True
    return tuple(m for m, f in zip(members, first) if f), tuple(m for m, f in zip(members, first) if not f)


def cluster_vectors(rows: DataFrame, names: Sequence[str], method: str = "VariationProportion", hyper: float = 0.8) -> ClusterModel:
    """Clusters of the places of an array column, as ``cluster_columns`` finds those of few columns."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {METHODS}")
    names = list(names)
    with held(rows) as kept:
        standard = Standard(kept, len(names))
        moving = [i for i in range(len(names)) if standard.dev[i] > 0]
        sample = standard.n / (standard.n - 1) if standard.n > 1 else 1.0
        pairs: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray]] = {}
        halves: dict[tuple[int, ...], tuple[tuple[int, ...], tuple[int, ...]]] = {}

        def measure(m: tuple[int, ...]) -> float:
            """How much a cluster needs splitting: above 0 it does."""
            values = pairs[m][0]
            if len(m) < 2:
                return -1.0
            return hyper - round(float(values[0] / len(m)), _DIGITS) if method == "VariationProportion" else round(float(values[1]) * sample, _DIGITS) - hyper

        open_ = [tuple(range(len(names)))]
        while open_:
            for m, found in zip(open_, _pairs_with_constants(standard, open_, set(moving))):
                pairs[m] = found
            split = [m for m in open_ if measure(m) > 0]
            for m in split:
                halves[m] = _halves(*pairs[m], m)
            open_ = [h for m in split for h in halves[m]]

        clusters = [tuple(range(len(names)))]
        while True:  # the order in which the worst is split numbers the clusters
            need = [measure(m) for m in clusters]
            at = max(range(len(clusters)), key=need.__getitem__)
            if need[at] <= 0:
                break
            clusters[at], other = halves[clusters[at]]
            clusters.append(other)
        return _described(standard, names, clusters, pairs, sample)


def _pairs_with_constants(standard: Standard, clusters: Sequence[tuple[int, ...]], moving: set[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Leading pairs of clusters in which a constant column is a component of its own, of value 1."""
    plain = [tuple(c for c in m if c in moving) for m in clusters]
    solved = iter(leading_pairs(standard, [m for m in plain if m]))
    out = []
    for m, inside in zip(clusters, plain):
        values, vectors = next(solved) if inside else (np.zeros(0), np.zeros((0, 0)))
        candidates = [(v, inside, vectors[:, k]) for k, v in enumerate(values[: vectors.shape[1]])]
        candidates += [(1.0, (c,), np.ones(1)) for c in m if c not in moving]
        candidates = sorted(candidates, key=lambda x: -x[0])[:2]
        full, top = np.zeros((len(m), max(len(candidates), 1))), np.zeros(2)
        for k, (v, where, vector) in enumerate(candidates):
            top[k] = v
            full[[m.index(c) for c in where], k] = vector
        out.append((top, full))
    return out


def _described(standard: Standard, names: list[str], clusters: list[tuple[int, ...]], pairs: dict, sample: float) -> ClusterModel:
    """Correlations of every column with the component of its own and of the nearest other cluster, block of clusters by block."""
    firsts = [(float(pairs[m][0][0]), pairs[m][1][:, 0]) for m in clusters]
    width, own_at = standard.width, np.empty(standard.width, np.int64)
    for g, m in enumerate(clusters):
        own_at[list(m)] = g
    nearest, z = np.zeros(width), standard.of()
    step = max(1, _CELLS // max(width, 1))
    for start in range(0, len(clusters), step):
        part = clusters[start : start + step]
        order, starts = np.concatenate([np.array(m) for m in part]), np.cumsum([0, *[len(m) for m in part]])[:-1]
        weights = np.concatenate([firsts[start + i][1] for i in range(len(part))])
        sent = standard.rows.sparkSession.sparkContext.broadcast((order, starts, weights))

        def of(x: np.ndarray, sent=sent) -> np.ndarray:
            order, starts, weights = sent.value
            x = z(x)
            return x.T @ np.add.reduceat(x[:, order] * weights, starts, axis=1)

        along = _sums(standard.rows, width, of, (width, len(part))) / max(standard.n, 1)
        for i in range(len(part)):
            value = firsts[start + i][0]
            if value > 0:
                others = own_at != start + i
                nearest[others] = np.maximum(nearest[others], along[others, i] ** 2 / value)
    rows, parts = [], []
    for g, m in enumerate(clusters):
        value, vector = firsts[g]
        own = vector**2 * value * sample if len(m) > 1 else np.ones(1)
        far = nearest[list(m)]
        ratio = np.round((1 - own) / np.where(far < 1, 1 - far, np.nan), _DIGITS)
        chosen = int(np.nanargmin(ratio)) if len(m) > 1 and not np.isnan(ratio).all() else 0
        for i, c in enumerate(m):
            rows.append(ClusterRow(g + 1, names[c], float(own[i]), float(far[i]), None if np.isnan(ratio[i]) else float(ratio[i]), i == chosen))
        own_names = tuple(names[c] for c in m)
        parts.append(Component(g + 1, own_names, tuple(map(float, vector)), tuple(map(float, standard.mean[list(m)])), tuple(map(float, standard.dev[list(m)]))))
    return ClusterModel(tuple(rows), tuple(parts))
