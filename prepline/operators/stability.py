"""How a scored model holds up from period to period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.operators.lift import DECILES, gain_grid, hits_at_depth, lift_value
from prepline.operators.rank import number_sorted

_MAX_LITERALS = 1_000  # up to so many kept periods are a list in the filter; the result is the same either way


def period_table(df: DataFrame, period: str, stride: int = 2) -> DataFrame:
    """Every ``stride``-th distinct period, the first one included, with its position. No task sees all periods."""
    distinct = df.filter(F.col(period).isNotNull()).select(F.lit(0).alias("__all"), period).distinct()
    numbered = number_sorted(distinct, "__all", period, "position").select(period, (F.col("position") + 1).alias("position"))
    return numbered.filter((F.col("position") - 1) % stride == 0)


def keep_periods(df: DataFrame, period: str, stride: int = 2) -> DataFrame:
    """Rows of every ``stride``-th period; a list of values when short, so that it reaches the scan."""
    if stride < 1:
        raise ValueError("stride must be at least 1")
    if stride == 1:
        return df.filter(F.col(period).isNotNull())
    distinct = df.filter(F.col(period).isNotNull()).select(period).distinct()
    most = _MAX_LITERALS * stride
    found = sorted(r[0] for r in distinct.limit(most + 1).collect())
    if len(found) <= most:
        return df.filter(F.col(period).isin(found[::stride]))
    return df.join(period_table(df, period, stride).select(period), period, "left_semi")


def group_periods(df: DataFrame, period: str, calendar_month: bool = False) -> DataFrame:
    """Replace the period by its month: of its year, or of any year."""
    if calendar_month:
        return df.withColumn(period, F.month(period))
    return df.withColumn(period, F.trunc(period, "month"))


def _periods(df: DataFrame, period: str, stride: int, by_month: bool, calendar_month: bool) -> DataFrame:
    if by_month or calendar_month:
        return group_periods(df, period, calendar_month).filter(F.col(period).isNotNull())
    return keep_periods(df, period, stride)


def decile_stability(df: DataFrame, label: str, score: str, period: str, key: str, stride: int = 2,
                     by_month: bool = False, calendar_month: bool = False,
                     depths: tuple[float, ...] = DECILES) -> DataFrame:
    """Lift at every decile depth, per period."""
    kept = _periods(df.select(key, label, score, period), period, stride, by_month, calendar_month)
    hits = hits_at_depth(kept, label, score, key, depths, by=[period])
    return hits.select(period, "depth", "n", "n_pos", "hits", lift_value().alias("lift"))


def lift_stability(df: DataFrame, label: str, score: str, period: str, key: str, stride: int = 2,
                   by_month: bool = False, calendar_month: bool = False) -> DataFrame:
    """One gain curve per period, at 101 even points."""
    kept = _periods(df.select(key, label, score, period), period, stride, by_month, calendar_month)
    return gain_grid(kept, label, score, key, by=[period])


def target_rate(df: DataFrame, label: str, period: str, stride: int = 2,
                by_month: bool = False, calendar_month: bool = False) -> DataFrame:
    """Share of positives per period, and as a percentage with two decimals."""
    kept = _periods(df.select(label, period), period, stride, by_month, calendar_month)
    rates = kept.groupBy(period).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("target_rate"))
    return rates.withColumn("target_pct", F.round(F.col("target_rate") * 100, 2))
