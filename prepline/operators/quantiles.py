"""Exact order statistics and interpolated quantiles of many columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepline.functions import clean
from prepline.operators.cells import default_cells, quantile_cuts
from prepline.session import cut_lineage

# The probabilities at which an interval column is described.
KNOTS = (0.0, 0.01, 0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.99, 1.0)

_CHUNK = 100


def long_cells(df: DataFrame, columns: list[str], n_cells: int, *keep: str) -> DataFrame:
    """``(keep, var, cell, value)`` for every value present; cells are cut per column."""
    wide = df.select(*keep, *[clean(df, c).cast("double").alias(c) for c in columns])
    cuts = [sorted(set(found)) or [0.0] for found in quantile_cuts(wide, columns, n_cells)]
    cells = [f"__cell_{i}" for i in range(len(columns))]
    placed = Bucketizer(
        splitsArray=[[float("-inf"), *c, float("inf")] for c in cuts],
        inputCols=columns, outputCols=cells, handleInvalid="keep",
    ).transform(wide)
    entries = [
        F.struct(F.lit(c).alias("var"), F.col(cell).cast("int").alias("cell"), F.col(f"`{c}`").alias("value"))
        for c, cell in zip(columns, cells)
    ]
    long = placed.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.*")
    return long.filter(F.col("value").isNotNull())


def _chunk_quantiles(df: DataFrame, columns: list[str], probabilities: Sequence[float], n_cells: int) -> DataFrame:
    long = long_cells(df, columns, n_cells)
    whole = Window.partitionBy("var")
    before = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = long.groupBy("var", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "var", "cell", "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    position = F.col("prob") * (F.col("total") - 1).cast("double")
    wanted = totals.withColumn("prob", F.explode(F.lit([float(p) for p in probabilities])))
    for side, at in (("low", F.floor(position)), ("high", F.ceil(position))):
        wanted = wanted.withColumn(side, at.cast("bigint"))

    def holds(at: str):
        return (F.col("before") <= F.col(at)) & (F.col(at) < F.col("before") + F.col("n"))

    # At most two cells per column and probability.
    asked = cut_lineage(
        wanted.filter(holds("low") | holds("high"))
        .withColumn("ranks", F.array_compact(F.array(
            F.when(holds("low"), F.struct("prob", F.lit("low").alias("side"), F.col("low").alias("rank"))),
            F.when(holds("high"), F.struct("prob", F.lit("high").alias("side"), F.col("high").alias("rank"))),
        )))
        .select("var", "cell", "before", "total", (position - F.floor(position)).alias("part"),
                F.explode("ranks").alias("a"))
        .select("var", "cell", "before", "total", "part", "a.*")
    )
    open_cells = asked.select("var", "cell").distinct()
    counted = long.join(F.broadcast(open_cells), ["var", "cell"], "left_semi").groupBy("var", "cell", "value").agg(
        F.count(F.lit(1)).alias("m"))
    upto = Window.partitionBy("var", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    spans = counted.withColumn("upto", F.sum("m").over(upto))
    inside = F.col("rank") - F.col("before")
    found = (
        spans.join(F.broadcast(asked), ["var", "cell"])
        .filter((F.col("upto") - F.col("m") <= inside) & (inside < F.col("upto")))
        .groupBy("var", "prob")
        .agg(
            F.max("total").alias("n"), F.max("part").alias("part"),
            F.max(F.when(F.col("side") == "low", F.col("value"))).alias("v0"),
            F.max(F.when(F.col("side") == "high", F.col("value"))).alias("v1"),
        )
    )
    value = F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")
    return found.select("var", "prob", "n", value.alias("value"))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = KNOTS,
              n_cells: int | None = None) -> DataFrame:
    """``(var, prob, n, value)``: linearly interpolated quantiles, missing ignored.

    Exact without gathering a column anywhere: cell counts locate each order
    statistic, and only the values of the cells that hold one are looked at,
    as distinct values with their counts. A column without values has no rows.
    """
    n = n_cells or default_cells(df.sparkSession, 64)
    columns = list(columns)
    parts = [_chunk_quantiles(df, columns[i:i + _CHUNK], probabilities, n) for i in range(0, len(columns), _CHUNK)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quantiles_approx(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = KNOTS,
                     accuracy: int = 10_000) -> DataFrame:
    """Same shape from one pass of fixed-size sketches; actual values, not interpolated."""
    probs = [float(p) for p in probabilities]
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.percentile_approx(clean(df, c).cast("double"), probs, accuracy).alias(f"q{i}"),
                 F.count(clean(df, c)).alias(f"n{i}")]
    entries = F.array(*[
        F.struct(F.lit(c).alias("var"), F.col(f"n{i}").alias("n"), F.col(f"q{i}").alias("q"))
        for i, c in enumerate(columns)
    ])
    return (
        df.agg(*aggs).select(F.explode(entries).alias("e")).select("e.*")
        .select("var", "n", F.posexplode("q").alias("i", "value"))
        .select("var", F.element_at(F.lit(probs), F.col("i") + 1).alias("prob"), "n", "value")
    )
