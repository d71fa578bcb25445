"""Column profiles: missing shares, level frequencies, modes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.functions import clean

_CHUNK = 200  # columns per aggregate, to stay within generated-method limits


def chunks(columns: Sequence[str], size: int = _CHUNK) -> list[list[str]]:
    columns = list(columns)
    return [columns[i:i + size] for i in range(0, len(columns), size)]


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def one_row_per_column(df: DataFrame, columns: Sequence[str], **aggregates) -> DataFrame:
    """Aggregate every column in one pass and turn the single row into ``(var, ...)`` rows."""

    def run(part: list[str]) -> DataFrame:
        aggs = [f(c).alias(f"{name}_{i}") for i, c in enumerate(part) for name, f in aggregates.items()]
        rows = F.array(*[
            F.struct(F.lit(c).alias("var"), *[F.col(f"{name}_{i}").alias(name) for name in aggregates])
            for i, c in enumerate(part)
        ])
        return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")

    return stack([run(part) for part in chunks(columns)])


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(var, n_rows, n_missing, missing_share)``; one pass, no shuffle of rows."""
    counted = one_row_per_column(
        df, df.columns if columns is None else columns,
        n_rows=lambda c: F.count(F.lit(1)),
        n_present=lambda c: F.count(clean(df, c)),
    )
    missing = F.col("n_rows") - F.col("n_present")
    return counted.select("var", "n_rows", missing.alias("n_missing"),
                          (missing / F.nullif(F.col("n_rows"), F.lit(0))).alias("missing_share"))


def long_levels(df: DataFrame, columns: Sequence[str], *keep: Column | str) -> DataFrame:
    """``(var, level)`` with levels as strings; missing is a null level."""
    entries = [F.struct(F.lit(c).alias("var"), clean(df, c).cast("string").alias("level")) for c in columns]
    return df.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.*")


def level_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var, level, n)`` of all columns with one shuffle of pre-counted levels."""
    return stack([
        long_levels(df, part).groupBy("var", "level").agg(F.count(F.lit(1)).alias("n"))
        for part in chunks(columns)
    ])


def level_shares(profile: DataFrame) -> DataFrame:
    """Add the share of rows. The totals are one row per column, joined back by broadcast."""
    totals = profile.groupBy("var").agg(F.sum("n").alias("n_rows"))
    return profile.join(F.broadcast(totals), "var").withColumn("share", F.col("n") / F.col("n_rows"))


def distinct_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return level_profile(df, columns).select("var", "level")


def modes(profile: DataFrame) -> DataFrame:
    """Most frequent level per column, missing ignored, the smallest of equals."""
    top = F.min(F.when(F.col("level").isNotNull(), F.struct(-F.col("n"), F.col("level"))))
    return profile.groupBy("var").agg(top["level"].alias("mode"))
