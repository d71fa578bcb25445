"""Rejecting columns that cannot help a model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.catalog import NOMINAL, ORDINAL, Catalog
from prepline.functions import clean
from prepline.operators.profile import level_profile, missing_profile, one_row_per_column

_BITS = 32_768  # positions of a one-page bitmap


def missing_screen(df: DataFrame, columns: Iterable[str] | None = None, share: float = 0.99) -> DataFrame:
    profile = missing_profile(df, None if columns is None else list(columns))
    return profile.withColumn("rejected", F.coalesce(F.col("missing_share") > share, F.lit(False)))


def missing_filter(df: DataFrame, catalog: Catalog, share: float = 0.99,
                   roles: Iterable[str] | None = None) -> Catalog:
    """Reject columns missing in more than ``share`` of the rows, whatever their role unless ``roles`` says."""
    names = _with_roles(catalog, catalog.names(), roles)
    bad = missing_screen(df, names, share).filter("rejected").select("var").collect()
    return catalog.reject(r["var"] for r in bad)


def _with_roles(catalog: Catalog, names: list[str], roles: Iterable[str] | None) -> list[str]:
    return names if roles is None else [n for n in names if catalog[n].role in set(roles)]


def level_floor(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(var, at_least)``: a number of levels each column is certain to reach.

    Levels are hashed onto a bitmap; every position taken needs a level of its
    own, so the count never exceeds the truth, and the state is one page per
    column however many levels there are. Missing counts as a level.
    """
    def bits(c: str):
        place = F.pmod(F.xxhash64(clean(df, c)), F.lit(_BITS))
        return F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)))

    return one_row_per_column(df, list(columns), at_least=bits)


def class_level_screen(df: DataFrame, columns: Iterable[str], limit: int = 200) -> DataFrame:
    """``(var, n_levels, rejected)`` with the exact number of levels, missing included."""
    counts = level_profile(df, list(columns)).groupBy("var").agg(F.count(F.lit(1)).alias("n_levels"))
    return counts.withColumn("rejected", F.col("n_levels") > limit)


def class_level_approx(df: DataFrame, columns: Iterable[str], rsd: float = 0.02) -> DataFrame:
    """``(var, n_levels)`` estimated in one pass."""
    return one_row_per_column(
        df, list(columns),
        n_levels=lambda c: F.approx_count_distinct(clean(df, c), rsd)
        + F.max(clean(df, c).isNull().cast("bigint")),
    )


def class_level_filter(df: DataFrame, catalog: Catalog, limit: int = 200,
                       roles: Iterable[str] | None = None) -> Catalog:
    """Reject ordinal and nominal columns with more than ``limit`` levels.

    Columns proven too wide by their bitmap are rejected at once. Only the
    others, whose profile is short, are counted exactly.
    """
    names = _with_roles(catalog, catalog.names(level=(ORDINAL, NOMINAL)), roles)
    if not names:
        return catalog
    at_least = {r["var"]: r["at_least"] for r in level_floor(df, names).collect()} if limit < _BITS else {}
    bad = {n for n in names if at_least.get(n, 0) > limit}
    rest = [n for n in names if n not in bad]
    if rest:
        exact = class_level_screen(df, rest, limit).filter("rejected").select("var").collect()
        bad |= {r["var"] for r in exact}
    return catalog.reject(bad)
