"""Cutting an ordering into cells of bounded size.

Ranks, quantiles and lifts need a global order, but never a global sort. A
sketch of the ordering value gives cut points; each row is placed in a cell by
binary search; counting the cells says exactly how many rows come before each
one. Only rows that share a cell are ever compared with each other.

A cell is at most a small share of all rows, whatever the data: a value that
repeats has a cell of its own, and one that repeats very often is divided
further along the tie-breaking key. Cut points are plain numbers on the driver,
so placing a row is the same on every run and in every task.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL = "__cell"
ORDER = "__order"
TIE = "__tie"

_CELL_ROWS = 1 << 21  # more rows than this in an average cell call for more cells
_HEAVY = 4  # a value met at this many neighbouring cut points is divided by key
_LAST = sys.float_info.max  # stands for a missing score, so that its rows are a value like any other
_TIE_CLAMP = 1.0 - 2.0**-20


def default_cells(spark: SparkSession, least: int = 512) -> int:
    """Cells grow with the width the session shuffles at."""
    return max(least, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def descending(score: str) -> Column:
    """Ascending stand-in for a score sorted from high to low; missing comes last."""
    s = -F.col(score).cast("double")
    return F.when(s.isNull() | F.isnan(s), F.lit(_LAST)).otherwise(s)


def ascending(value: str) -> Column:
    v = F.col(value).cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(_LAST)).otherwise(v)


def tie_columns(df: DataFrame, key: str | list[str]) -> list[Column]:
    """Columns that order tied rows: the key itself if one number, else its hash and then the key."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.NumericType):
        return [F.col(keys[0])]
    return [F.xxhash64(*keys), *[F.col(k) for k in keys]]


def _splits(edges: list[float]) -> list[float]:
    return [float("-inf"), *edges, float("inf")]


def quantile_cuts(df: DataFrame, columns: list[str], n_cells: int) -> list[list[float]]:
    """Cut points of several columns from one pass; sketches of fixed size are merged."""
    probabilities = [i / n_cells for i in range(1, n_cells)]
    found = df.approxQuantile(columns, probabilities, 1.0 / (2 * n_cells))
    return [[v for v in cuts if math.isfinite(v)] for cuts in found]


def bucketize(df: DataFrame, column: str, edges: list[float], out: str) -> DataFrame:
    """Position of a value among sorted edges, by binary search in the JVM."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    placed = Bucketizer(splits=_splits(edges), inputCol=column, outputCol=out).transform(df)
    return placed.withColumn(out, F.col(out).cast("int"))


@dataclass(frozen=True)
class CellPlan:
    """Cut points for ``(order value, tie value)``; small and held on the driver."""

    edges: tuple[float, ...]
    tie_low: float = 0.0
    tie_span: float = 1.0
    tie_edges: tuple[float, ...] = ()

    def place(self, df: DataFrame, order: Column, tie: Column) -> DataFrame:
        """Add the order value and its cell. No row moves."""
        placed = bucketize(df.withColumn(ORDER, order), ORDER, list(self.edges), CELL)
        if not self.tie_edges:
            return placed
        share = (F.coalesce(tie.cast("double"), F.lit(0.0)) - F.lit(self.tie_low)) / F.lit(self.tie_span)
        share = F.greatest(F.lit(0.0), F.least(share, F.lit(_TIE_CLAMP)))
        placed = placed.withColumn(TIE, F.col(CELL) + share).drop(CELL)
        return bucketize(placed, TIE, list(self.tie_edges), CELL).drop(TIE)


def _count_and_cuts(narrow: DataFrame, n: int) -> tuple[int, list[float]]:
    """Rows and cut points from one pass."""
    probabilities = [i / n for i in range(1, n)]
    row = narrow.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(ORDER, probabilities, 2 * n).alias("cuts")).first()
    return row["n"], [v for v in row["cuts"] or [] if math.isfinite(v)]


def plan_cells(df: DataFrame, order: Column, tie: Column, n_cells: int | None = None) -> CellPlan:
    """Choose cut points so that every cell holds a small share of all rows."""
    narrow = df.select(order.alias(ORDER), tie.alias(TIE))
    n = n_cells or default_cells(df.sparkSession)
    rows, cuts = _count_and_cuts(narrow, n)
    if n_cells is None and rows > n * _CELL_ROWS:
        _, cuts = _count_and_cuts(narrow, math.ceil(rows / _CELL_ROWS))
    met = Counter(cuts)
    # [v, next float after v) holds v alone, so tied rows never share a cell with others.
    edges = sorted({e for v in met for e in (v, math.nextafter(v, math.inf))} - {math.inf})
    heavy = [v for v, times in met.items() if times >= _HEAVY]
    if not heavy:
        return CellPlan(tuple(edges))

    most = max(met[v] for v in heavy)  # as many parts as the value has cells' worth of rows
    probabilities = [i / most for i in range(1, most)]
    ties = (
        narrow.filter(F.col(ORDER).isin(heavy))
        .groupBy(ORDER)
        .agg(
            F.min(TIE).alias("low"),
            F.max(TIE).alias("high"),
            F.percentile_approx(TIE, probabilities, 4 * most).alias("cuts"),
        )
        .collect()  # at most n_cells / _HEAVY rows
    )
    low = float(min(r["low"] for r in ties))
    span = float(max(r["high"] for r in ties)) - low + 1.0
    position = {e: i + 1 for i, e in enumerate(edges)}
    tie_edges = {float(i) for i in range(1, len(edges) + 1)}
    for r in ties:
        parts = met[r[ORDER]]
        step = most / parts
        for j in range(1, parts):
            share = (float(r["cuts"][int(j * step) - 1]) - low) / span
            tie_edges.add(position[r[ORDER]] + max(0.0, min(share, _TIE_CLAMP)))
    return CellPlan(tuple(edges), low, span, tuple(sorted(tie_edges)))
