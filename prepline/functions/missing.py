"""One notion of missing: null. NaN is turned into null before anything is counted."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def clean(df: DataFrame, name: str) -> Column:
    """The column with NaN read as null."""
    c = F.col(f"`{name}`")
    return F.when(~F.isnan(c), c) if _is_float(df, name) else c


def clean_columns(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    wanted = set(df.columns if names is None else names)
    return df.select(*[clean(df, n).alias(n) if n in wanted else F.col(f"`{n}`") for n in df.columns])


def is_missing(df: DataFrame, name: str) -> Column:
    return clean(df, name).isNull()
