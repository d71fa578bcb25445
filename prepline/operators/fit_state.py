"""Fit state that is kept a part at a time and merged, so that a new day is one small scan.

A part's state is three small tables: how often each level occurs in each column; count, missing, least, greatest, mean and
sum of squared deviations of each number; and a quantile sketch of each number. Levels,
counts and extremes of merged states are those of the union exactly, means and deviations but for rounding, and a
quantile's rank is off by at most ``RANK_ERROR`` of the rows. States merge in any order
and any grouping. What a fit takes from a profile, ``modes``, ``level_shares``,
known or rare levels, it takes from a merged state alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.functions import clean
from prepline.operators.encode import SCALES, Scale
from prepline.operators.profile import level_profile, modes, one_row_per_column, stack
from prepline.sources import StageStore

SKETCH_SIZE = 800
RANK_ERROR = 0.01  # what the sketch's size keeps with a probability of over 99 %

LEVELS, MOMENTS, SKETCHES = "levels", "moments", "sketches"


@dataclass(frozen=True)
class FitState:
    """``levels``: var, level, n. ``moments``: var, n_rows, n, low, high, mean, m2. ``sketches``: var, sketch."""

    levels: DataFrame
    moments: DataFrame
    sketches: DataFrame

    def parts(self) -> dict[str, DataFrame]:
        return {LEVELS: self.levels, MOMENTS: self.moments, SKETCHES: self.sketches}

    # what fits read ------------------------------------------------------------------

    def modes(self) -> DataFrame:
        return modes(self.levels)

    def missing(self) -> DataFrame:
        """``(var, n_rows, n_missing, missing_share)`` of the numbers and of the columns with levels."""
        levels = self.levels.groupBy("var").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("level").isNull(), F.col("n")).otherwise(0)).alias("n_missing"))
        numbers = self.moments.select("var", "n_rows", (F.col("n_rows") - F.col("n")).alias("n_missing"))
        both = numbers.unionByName(levels.join(numbers, "var", "left_anti"))
        return both.withColumn("missing_share", F.col("n_missing") / F.nullif("n_rows", F.lit(0)))

    def scales(self, method: str | None) -> dict[str, Scale]:
        """The scales that a fit on all rows finds."""
        if method not in SCALES:
            raise ValueError(f"unknown scale {method!r}; known: {SCALES}")
        if method is None:
            return {}
        out = {}
        for r in self.moments.collect():  # one row a column
            if not r["n"]:
                out[r["var"]] = Scale(None, None)
            elif method == "Range":
                out[r["var"]] = Scale(r["low"], r["high"] - r["low"], -1.0, 2.0)
            else:
                out[r["var"]] = Scale(r["mean"], (r["m2"] / r["n"]) ** 0.5)
        return out

    def quantiles(self, probabilities: Sequence[float]) -> DataFrame:
        """``(var, prob, value)``: values of the rows, their ranks within ``RANK_ERROR``."""
        found = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities]
        return self.sketches.select("var", F.explode(F.array(*found)).alias("q")).select("var", "q.*")


def measure(df: DataFrame, numbers: Sequence[str], with_levels: Sequence[str]) -> FitState:
    """The state of one part: two passes over its rows, whatever the number of columns."""
    x = lambda c: clean(df, c).cast("double")
    found = one_row_per_column(
        df, numbers, n_rows=lambda c: F.count(F.lit(1)), n=lambda c: F.count(x(c)), low=lambda c: F.min(x(c)), high=lambda c: F.max(x(c)),
        mean=lambda c: F.avg(x(c)), var_=lambda c: F.var_pop(x(c)), sketch=lambda c: F.kll_sketch_agg_double(x(c), SKETCH_SIZE))
    moments = found.select("var", "n_rows", "n", "low", "high", F.coalesce("mean", F.lit(0.0)).alias("mean"),
                           F.coalesce(F.col("var_") * F.col("n"), F.lit(0.0)).alias("m2"))
    return FitState(level_profile(df, with_levels), moments, found.filter("n > 0").select("var", "sketch"))


def merged(states: Sequence[FitState]) -> FitState:
    """The state of all parts together; one small shuffle of what they hold."""
    levels = stack([s.levels for s in states]).groupBy("var", "level").agg(F.sum("n").alias("n"))
    every = stack([s.moments for s in states])
    n = F.sum("n")
    # sum of squared deviations from the common mean: those from the parts' means, and the parts' means from the common one
    totals = every.groupBy("var").agg(
        F.sum("n_rows").alias("n_rows"), n.alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(n, F.lit(0))).alias("mean"), F.sum("m2").alias("within"))
    spread = every.select("var", F.col("n").alias("n_i"), F.col("mean").alias("mean_i")).join(F.broadcast(totals.select("var", "mean")), "var").groupBy("var").agg(
        F.sum(F.col("n_i") * (F.col("mean_i") - F.col("mean")) ** 2).alias("between"))
    moments = totals.join(spread, "var", "left").select(
        "var", "n_rows", "n", "low", "high", F.coalesce("mean", F.lit(0.0)).alias("mean"), (F.col("within") + F.coalesce("between", F.lit(0.0))).alias("m2"))
    sketches = stack([s.sketches for s in states]).groupBy("var").agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"))
    return FitState(levels, moments, sketches)


@dataclass(frozen=True)
class StateBook:
    """States of parts under one folder: a part that is measured again replaces its old state, and nothing else is read."""

    store: StageStore

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> StateBook:
        return cls(StageStore(spark, folder))

    def put(self, part: str, state: FitState) -> None:
        for kind, table in state.parts().items():
            self.store.save(f"{part}/{kind}", table.coalesce(1))

    def get(self, part: str) -> FitState:
        return FitState(*[self.store.load(f"{part}/{kind}") for kind in (LEVELS, MOMENTS, SKETCHES)])

    def merged(self, parts: Sequence[str]) -> FitState:
        return merged([self.get(p) for p in parts])


def close_ranks(quantiles: DataFrame, df: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """Each quantile with the share of rows below and up to it, and whether the asked rank lies between them within ``error``."""
    pairs = quantiles.collect()  # one row a column and probability
    aggs = []
    for i, r in enumerate(pairs):
        x = clean(df, r["var"]).cast("double")
        aggs += [F.avg((x < r["value"]).cast("double")).alias(f"b{i}"), F.avg((x <= r["value"]).cast("double")).alias(f"u{i}")]
    found = [df.agg(*aggs[k : k + 200]) for k in range(0, len(aggs), 200)]
    row = reduce(lambda a, b: a | b, [f.first().asDict() for f in found], {})
    rows = [(r["var"], r["prob"], row[f"b{i}"] - error <= r["prob"] <= row[f"u{i}"] + error) for i, r in enumerate(pairs)]
    return df.sparkSession.createDataFrame(rows, "var string, prob double, near boolean")
