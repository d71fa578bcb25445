"""Hashed byte n-grams of whole texts, a bounded sample to fit on, and linear fitting in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = 1000  # texts histogrammed at once
_PAD = b"  "


def hashed_ngrams(texts: list[bytes], dims: int, orders: tuple[int, ...] = (2, 3)) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams, a row a text; no n-gram spans two texts."""
    out = np.zeros((len(texts), dims), np.float32)
    for start in range(0, len(texts), _ROWS):
        part = texts[start : start + _ROWS]
        data = np.frombuffer(b"".join(t + _PAD for t in part), np.uint8).astype(np.uint32)
        lengths = np.fromiter(map(len, part), np.int64, len(part)) + len(_PAD)
        ends = np.cumsum(lengths)
        inside = np.ones(len(data), bool)
        inside[ends - 1] = inside[ends - 2] = False  # windows that would run into the next text
        base = np.repeat(np.arange(len(part)) * dims, lengths)[inside]
        total = np.zeros(len(part) * dims)
        gram = data.copy()
        for n in range(2, max(orders) + 1):
            gram[: len(data) - n + 1] = gram[: len(data) - n + 1] * np.uint32(0x01000193) ^ data[n - 1 :]
            if n in orders:
                mixed = (gram[inside] + np.uint32(n)) * np.uint32(0x9E3779B1)
                total += np.bincount(base + ((mixed ^ mixed >> np.uint32(15)) % np.uint32(dims)), minlength=len(total))
        table = total.reshape(len(part), dims)
        out[start : start + len(part)] = np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))
    return out


def sample_share(doc_id: str, salt: str) -> Column:
    """A uniform of the key, by which rows are chosen for fitting."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), F.col(doc_id).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def bounded_sample(rows: DataFrame, doc_id: str, group: str, per_group: int, salt: str) -> DataFrame:
    """About ``per_group`` rows of each group, chosen by a hash of the key; groups are classes, hence few."""
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    chosen = F.lit(False)
    for value, n in counts.items():
        chosen = chosen | ((F.col(group) == F.lit(value)) & (sample_share(doc_id, salt) < per_group / n))
    return rows.filter(chosen)


def fit_linear(x: np.ndarray, y: np.ndarray, loss: str, weight: np.ndarray | None = None, l2: float = 1e-4,
               rounds: int = 200) -> np.ndarray:
    """Weights and, last, the bias that minimise squared hinge (y in -1, 1) or logistic loss (y in 0..1).

    Accelerated gradient steps; the step comes from a bound on the curvature.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    weight = np.full(len(x), 1.0 / len(x)) if weight is None else weight / weight.sum()
    curve = (2.0 if loss == "hinge" else 0.25) * float((weight * (x * x).sum(axis=1)).sum()) + l2
    w = ahead = np.zeros(x.shape[1])
    for k in range(rounds):
        margin = x @ ahead
        if loss == "hinge":
            slope = -2.0 * y * np.maximum(0.0, 1.0 - y * margin)
        else:
            slope = 1.0 / (1.0 + np.exp(-margin)) - y
        step = ahead - (x.T @ (weight * slope) + l2 * ahead) / curve
        ahead, w = step + (k / (k + 3.0)) * (step - w), step
    return w
