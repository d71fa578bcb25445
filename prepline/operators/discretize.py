"""Supervised binning by minimum entropy with the MDL stopping rule (Fayyad & Irani, 1993).

The rows shrink to a class histogram per distinct value. Running class counts
along it are computed once, cell by cell; every round then scores all cuts of
all open intervals of all columns in one aggregate. Only the winners, one per
open interval, reach the driver, which decides which to accept.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.catalog import INTERVAL, NOMINAL, Catalog
from prepline.functions import clean, keyed_uniform
from prepline.operators.cells import default_cells
from prepline.operators.quantiles import long_cells
from prepline.operators.sampling import SEED
from prepline.session import held

# Fixed value: prefix of binned columns.
PREFIX = "BIN_"

_GAIN_DIGITS = 12  # equal gains must compare equal whatever the order of the sums


def class_histogram(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``(var, value, n0, n1)`` for every distinct value present."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("var"), clean(df, c).cast("double").alias("value")) for c in columns
    ])
    long = df.select((F.col(target) == 1).alias("y"), F.explode(entries).alias("e")).select("y", "e.*")
    return long.filter(F.col("value").isNotNull()).groupBy("var", "value").agg(
        F.count_if(~F.col("y")).alias("n0"), F.count_if("y").alias("n1"))


def _running(df: DataFrame, columns: Sequence[str], target: str, n_cells: int) -> DataFrame:
    """``(var, value, next, c0, c1)``: classes up to and including each value, and the value after it."""
    columns = list(columns)
    rows = df.select(*[F.col(f"`{c}`") for c in columns], F.col(target).alias("__y"))
    long = long_cells(rows, columns, n_cells, "__y")
    positive = F.coalesce(F.col("__y") == 1, F.lit(False))
    counted = long.groupBy("var", "cell", "value").agg(
        F.count_if(~positive).alias("n0"), F.count_if(positive).alias("n1"))
    whole = Window.partitionBy("var").orderBy("cell")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    cells = counted.groupBy("var", "cell").agg(
        F.sum("n0").alias("m0"), F.sum("n1").alias("m1"), F.min("value").alias("first"))
    offsets = cells.select(
        "var", "cell",
        F.coalesce(F.sum("m0").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("m1").over(before), F.lit(0)).alias("b1"),
        F.lead("first").over(whole).alias("after"),
    )
    inside = Window.partitionBy("var", "cell").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return counted.join(offsets, ["var", "cell"]).select(
        "var", "value",
        F.coalesce(F.lead("value").over(inside), F.col("after")).alias("next"),
        (F.sum("n0").over(upto) + F.col("b0")).alias("c0"),
        (F.sum("n1").over(upto) + F.col("b1")).alias("c1"),
    )


def _xlog(a: Column, n: Column) -> Column:
    return F.when(a > 0, -(a / n) * F.log2(a / n)).otherwise(F.lit(0.0))


def entropy(a: Column, b: Column) -> Column:
    """Entropy in bits of two class counts."""
    n = (a + b).cast("double")
    return _xlog(a.cast("double"), n) + _xlog(b.cast("double"), n)


def _entropy(a: int, b: int) -> float:
    n = a + b
    return -sum(c / n * math.log2(c / n) for c in (a, b) if c)


@dataclass(frozen=True)
class _Interval:
    """Values above ``low`` up to ``high``, with the classes before and inside."""

    var: str
    low: float
    high: float
    before: tuple[int, int]
    inside: tuple[int, int]


def _best_cuts(running: DataFrame, open_: list[_Interval]) -> list[tuple[_Interval, dict]]:
    """The best cut of each open interval, the smallest of equals."""
    spark = running.sparkSession
    table = spark.createDataFrame(
        [(i, s.var, s.low, s.high, *s.before, *s.inside) for i, s in enumerate(open_)],
        "id int, var string, low double, high double, p0 bigint, p1 bigint, t0 bigint, t1 bigint")
    a0, a1 = F.col("c0") - F.col("p0"), F.col("c1") - F.col("p1")
    b0, b1 = F.col("t0") - a0, F.col("t1") - a1
    total = (F.col("t0") + F.col("t1")).cast("double")
    gain = entropy(F.col("t0"), F.col("t1")) - ((a0 + a1) / total) * entropy(a0, a1) - ((b0 + b1) / total) * entropy(b0, b1)
    inside = (
        (running["var"] == table["var"]) & (F.col("value") > F.col("low")) & (F.col("next") <= F.col("high")))
    scored = running.join(F.broadcast(table), inside).select(
        "id", F.round(gain, _GAIN_DIGITS).alias("gain"), "value", "next", a0.alias("a0"), a1.alias("a1"))
    best = scored.groupBy("id").agg(
        F.min(F.struct((-F.col("gain")).alias("g"), "value", "next", "a0", "a1")).alias("b"))
    return [(open_[r["id"]], r["b"].asDict()) for r in best.collect()]


def _accepted(s: _Interval, cut: dict) -> bool:
    left = (cut["a0"], cut["a1"])
    right = (s.inside[0] - left[0], s.inside[1] - left[1])
    n = sum(s.inside)
    k, k1, k2 = (sum(1 for c in part if c) for part in (s.inside, left, right))
    delta = math.log2(3**k - 2) - (k * _entropy(*s.inside) - k1 * _entropy(*left) - k2 * _entropy(*right))
    return -cut["g"] > (math.log2(n - 1) + delta) / n


def mdl_cuts(df: DataFrame, columns: Sequence[str], target: str, n_cells: int | None = None) -> dict[str, list[float]]:
    """Accepted cuts per column, rising; a column without any is absent.

    A cut is the midpoint of the neighbouring values it separates.
    """
    if not columns:
        return {}
    cuts: dict[str, list[float]] = {}
    with held(_running(df, columns, target, n_cells or default_cells(df.sparkSession, 64))) as running:
        totals = running.groupBy("var").agg(
            F.max("value").alias("high"), F.max("c0").alias("n0"), F.max("c1").alias("n1"))
        open_ = [
            _Interval(r["var"], float("-inf"), r["high"], (0, 0), (r["n0"], r["n1"]))
            for r in totals.collect() if r["n0"] and r["n1"]
        ]
        while open_:
            parts = []
            for s, cut in _best_cuts(running, open_):
                if not _accepted(s, cut):
                    continue
                cuts.setdefault(s.var, []).append((cut["value"] + cut["next"]) / 2)
                left = (cut["a0"], cut["a1"])
                right = (s.inside[0] - left[0], s.inside[1] - left[1])
                middle = (s.before[0] + left[0], s.before[1] + left[1])
                parts += [_Interval(s.var, s.low, cut["value"], s.before, left),
                          _Interval(s.var, cut["value"], s.high, middle, right)]
            open_ = [p for p in parts if p.inside[0] and p.inside[1]]  # a pure interval has nothing to gain
    return {var: sorted(found) for var, found in sorted(cuts.items())}


def first_cuts(df: DataFrame, columns: Sequence[str], target: str, n_cells: int | None = None) -> DataFrame:
    """``(var, cut, gain)``: the best single cut of each column, accepted or not."""
    running = _running(df, columns, target, n_cells or default_cells(df.sparkSession, 64))
    totals = running.groupBy("var").agg(F.max("c0").alias("t0"), F.max("c1").alias("t1"))
    a0, a1 = F.col("c0"), F.col("c1")
    b0, b1 = F.col("t0") - a0, F.col("t1") - a1
    n = (F.col("t0") + F.col("t1")).cast("double")
    gain = entropy(F.col("t0"), F.col("t1")) - ((a0 + a1) / n) * entropy(a0, a1) - ((b0 + b1) / n) * entropy(b0, b1)
    best = (
        running.filter(F.col("next").isNotNull()).join(F.broadcast(totals), "var")
        .groupBy("var").agg(F.min(F.struct(-F.round(gain, _GAIN_DIGITS), "value", "next")).alias("b"))
    )
    return best.select("var", ((F.col("b.value") + F.col("b.next")) / 2).alias("cut"), (-F.col("b.col1")).alias("gain"))


@dataclass(frozen=True)
class BinModel:
    cuts: dict[str, tuple[float, ...]]

    def labels(self) -> dict[str, list[str]]:
        """Interval names in code order; a bin holds its lower bound."""
        out = {}
        for var, cuts in self.cuts.items():
            middle = [f"[{a:g}, {b:g})" for a, b in zip(cuts, cuts[1:])]
            out[var] = [f"< {cuts[0]:g}", *middle, f">= {cuts[-1]:g}"]
        return out

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.derive(PREFIX, self.cuts, NOMINAL)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``BIN_`` codes from 0; missing stays missing. Works on any table with the columns."""
        new = []
        for var, cuts in self.cuts.items():
            value = clean(df, var).cast("double")
            code = sum(((value >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
            new.append(code.alias(PREFIX + var))
        return df.select("*", *new)

    def to_json(self) -> str:
        return json.dumps(self.cuts)

    @classmethod
    def from_json(cls, text: str) -> BinModel:
        return cls({v: tuple(c) for v, c in json.loads(text).items()})


def fit_bins(df: DataFrame, catalog: Catalog, sample: float | None = None, key: str | None = None,
             seed: int = SEED) -> BinModel:
    """Bin the interval inputs against the target; columns without an accepted cut drop out.

    ``sample`` is the share of rows to fit on, drawn by key.
    """
    if sample is not None:
        if key is None:
            raise ValueError("sampling needs the key column")
        df = df.filter(keyed_uniform(key, seed, "binning") < sample)
    cuts = mdl_cuts(df, catalog.inputs(INTERVAL), catalog.target())
    return BinModel({v: tuple(c) for v, c in cuts.items()})
