"""Splitting rows into samples and folds by key, the same way on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.functions import keyed_uniform

SEED = 12345
_SPLIT, _FOLD, _CHOICE = "split", "fold", "choice"
_SLOTS = 2**12
_IN_ORDER = 1_000_000  # rows that are put in order at once


def split_draw(key: str, seed: int = SEED) -> Column:
    return keyed_uniform(key, seed, _SPLIT)


def train_test_split(df: DataFrame, key: str, train_share: float = 0.4,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    u = split_draw(key, seed)
    return df.filter(u < train_share), df.filter(u >= train_share)


def assign_sample(df: DataFrame, key: str, shares: dict[str, float] | None = None, seed: int = SEED,
                  column: str = "sample") -> DataFrame:
    """Name the sample of each row; shares add up to one and are laid end to end."""
    shares = shares or {"train": 0.4, "test": 0.1, "holdout": 0.5}
    if not math.isclose(sum(shares.values()), 1.0):
        raise ValueError("shares must add up to 1")
    u = split_draw(key, seed)
    names = list(shares)
    upto, out = 0.0, None
    for name in names[:-1]:
        upto = round(upto + shares[name], 12)
        out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
    return df.withColumn(column, F.lit(names[-1]) if out is None else out.otherwise(names[-1]))


def assign_fold(df: DataFrame, key: str, folds: int = 4, seed: int = SEED, column: str = "fold") -> DataFrame:
    return df.withColumn(column, F.floor(keyed_uniform(key, seed, _FOLD) * folds).cast("int"))


def smallest_threshold(df: DataFrame, draw: Column, key: str, size: float) -> tuple[float, object] | None:
    """The ``(draw, key)`` of the ``size``-th row in that order; None for no row, infinity for more than all.

    The draws are uniform, so equal slots are equal shares: count the slots, cut the
    slot the answer lies in again while it holds too many rows, and order only its rows.
    ``size`` is a number of rows, or a share of them if below 1.
    """
    drawn = df.select(draw.alias("u"), F.col(key).alias("k"))
    low, width, skipped, wanted = 0.0, 1.0, 0, size
    while True:
        slot = F.floor((F.col("u") - F.lit(low)) / F.lit(width) * _SLOTS).cast("int")
        inside = drawn.filter((F.col("u") >= low) & (F.col("u") < low + width)).withColumn("slot", slot)
        counts = sorted((r["slot"], r["count"]) for r in inside.groupBy("slot").count().collect())  # one row a slot
        if wanted < 1:
            wanted = math.floor(sum(n for _, n in counts) * wanted)
            if wanted < 1:
                return None
        place = None
        for at, n in counts:
            if skipped + n >= wanted:
                place = (at, n)
                break
            skipped += n
        if place is None:
            return float("inf"), None
        low, width = low + place[0] * width / _SLOTS, width / _SLOTS
        if place[1] <= _IN_ORDER or width < 2.0**-32:  # the draws have 32 bits
            break
    last = inside.filter(F.col("slot") == place[0]).orderBy("u", "k").limit(wanted - skipped)
    row = last.agg(F.max(F.struct("u", "k")).alias("t")).first()
    return row["t"]["u"], row["t"]["k"]


def exact_split(df: DataFrame, key: str, size: int | None = None, share: float | None = None,
                seed: int = SEED, column: str = "in_sample") -> DataFrame:
    """Mark exactly ``size`` rows (or ``floor(share * n)``). Applying it is a projection."""
    u = keyed_uniform(key, seed, _CHOICE)
    if size is None and share >= 1:
        return df.withColumn(column, F.lit(True))
    wanted = share if size is None else size
    limit = smallest_threshold(df, u, key, wanted) if (size is None and share > 0) or (size or 0) >= 1 else None
    if limit is None:
        return df.withColumn(column, F.lit(False))
    at, last = limit
    if math.isinf(at):
        return df.withColumn(column, F.lit(True))
    return df.withColumn(column, (u < at) | ((u == at) & (F.col(key) <= F.lit(last))))
