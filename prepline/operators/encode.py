"""Final preparation for model fitting: indicators, dummies, scales."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import SparseVector, Vector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepline.catalog import BINARY, INTERVAL, NOMINAL, ORDINAL, Catalog
from prepline.functions import clean
from prepline.operators.levels import INLINE, level_set, look_up
from prepline.operators.profile import distinct_levels, one_row_per_column
from prepline.operators.rank import number_sorted
from prepline.session import cut_lineage, held

SCALES = ("Range", "Z Score", None)


def yes_no(df: DataFrame, name: str) -> Column:
    """'Y' is 1 and 'N' is 0; other text is read as a number or becomes missing."""
    c = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c
    return F.when(c == "N", 0).when(c == "Y", 1).otherwise(c.try_cast("int"))


def dummies(name: str, levels: Sequence[str]) -> list[Column]:
    """A 0/1 column for every level after the first; unseen and missing are all 0."""
    c = F.col(f"`{name}`").cast("string")
    return [F.coalesce((c == v).cast("int"), F.lit(0)).alias(f"{name}_{v}") for v in levels[1:]]


def sized(n: int) -> dict:
    """What ``pyspark.ml`` reads of a vector column's size, without a name for every slot."""
    return {"ml_attr": {"num_attrs": n}}


def appended(*vectors: Vector) -> SparseVector:
    """The vectors one after another, as one."""
    at, places, values = 0, [], []
    for v in vectors:
        slots = v.indices if isinstance(v, SparseVector) else np.flatnonzero(v.toArray())
        places.append(at + np.asarray(slots, np.int64))
        values.append(v.values if isinstance(v, SparseVector) else v.toArray()[slots])
        at += len(v)
    return SparseVector(at, np.concatenate(places), np.concatenate(values))


@dataclass(frozen=True)
class LevelCodes:
    """Sorted levels without missing: literals for short lists, a table of ``(var, level, code)`` for long ones."""

    inline: dict[str, tuple[str, ...]] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)  # of the long lists
    table: DataFrame | None = None

    def entries(self, column: str) -> DataFrame:
        return self.table.filter(F.col("var") == column).select("level", F.col("code").alias("__code"))

    def add(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """The position of the value among the sorted levels; null for unseen and missing."""
        if column in self.inline:
            position = F.array_position(F.lit(list(self.inline[column])), F.col(f"`{column}`").cast("string"))
            return df.withColumn(out, F.when(position > 0, position - 1))
        return look_up(df, column, self.entries(column), "__code", self.sizes[column]).withColumnRenamed("__code", out)


def level_codes(df: DataFrame, columns: Sequence[str], inline: int = INLINE) -> LevelCodes:
    """Codes of the levels of any number of columns, of any length."""
    if not columns:
        return LevelCodes()
    with held(distinct_levels(df, columns).filter(F.col("level").isNotNull())) as levels:
        found = level_set(levels, inline)
        if not found.stored:
            return LevelCodes({c: found.inline.get(c, ()) for c in columns})
        table = number_sorted(levels.filter(F.col("var").isin(list(found.stored))).select("var", "level"), "var", "level", "code")
        table = cut_lineage(table)
    sizes = {r["var"]: r["count"] for r in table.groupBy("var").count().collect()}
    return LevelCodes({c: found.inline.get(c, ()) for c in columns if c not in sizes}, sizes, table)


@dataclass(frozen=True)
class Scale:
    """``value -> low + (value - shift) / span * width``; a constant column gets ``low``."""

    shift: float | None
    span: float | None
    low: float = 0.0
    width: float = 1.0

    def apply(self, c: Column) -> Column:
        if self.shift is None:
            return c
        span = self.span or 1.0
        return F.lit(self.low) + (c - F.lit(self.shift)) / F.lit(span) * F.lit(self.width)


def fit_scales(df: DataFrame, columns: Sequence[str], method: str | None) -> dict[str, Scale]:
    """``Range`` maps the training range to (-1, 1); ``Z Score`` uses the population deviation."""
    if method not in SCALES:
        raise ValueError(f"unknown scale {method!r}; known: {SCALES}")
    if method is None or not columns:
        return {}

    def number(c: str) -> Column:
        return clean(df, c).cast("double")

    rows = one_row_per_column(
        df, columns, low=lambda c: F.min(number(c)), high=lambda c: F.max(number(c)),
        mean=lambda c: F.avg(number(c)), dev=lambda c: F.stddev_pop(number(c)),
    ).collect()
    out = {}
    for r in rows:
        if r["low"] is None:
            out[r["var"]] = Scale(None, None)
        elif method == "Range":
            out[r["var"]] = Scale(r["low"], r["high"] - r["low"], -1.0, 2.0)
        else:
            out[r["var"]] = Scale(r["mean"], r["dev"])
    return out


@dataclass(frozen=True)
class PrepModel:
    inputs: tuple[str, ...]
    target: str
    binary: tuple[str, ...] = ()
    levels: LevelCodes = field(default_factory=LevelCodes)
    scales: dict[str, Scale] = field(default_factory=dict)
    target_scale: Scale | None = None

    def feature_names(self) -> list[str]:
        """Names in the order of the feature vector; a long list of levels is one vector, named for its column."""
        out = [c for c in self.inputs if c not in self.levels.inline and c not in self.levels.sizes]
        return out + [f"{c}_{v}" for c, vs in self.levels.inline.items() for v in vs[1:]] + [f"{c}_levels" for c in self.levels.sizes]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep``, the target, and the prepared inputs: the same columns for any table.

        A nominal column with a long list of levels becomes one sparse vector ``<name>_levels``
        with the same entries that its 0/1 columns would have.
        """
        columns = []
        for c in self.levels.sizes:
            df = self._one_hot(df, c)
        for c in self.inputs:
            if c in self.levels.inline or c in self.levels.sizes:
                continue
            value = yes_no(df, c) if c in self.binary else F.col(f"`{c}`")
            if c in self.scales:
                value = self.scales[c].apply(clean(df, c).cast("double"))
            columns.append(value.alias(c))
        for c, levels in self.levels.inline.items():
            columns += dummies(c, levels)
        columns += [F.col(f"`{c}_levels`") for c in self.levels.sizes]
        target = F.col(f"`{self.target}`")
        if self.target_scale is not None:
            target = self.target_scale.apply(target.cast("double"))
        return df.select(*keep, target.alias(self.target), *columns)

    def _one_hot(self, df: DataFrame, column: str) -> DataFrame:
        """The first level, unseen and missing have no entry."""
        n = self.levels.sizes[column] - 1
        coded = self.levels.add(df, column, "__c")
        vector = F.udf(lambda c: SparseVector(n, [c - 1], [1.0]) if c else SparseVector(n, [], []), VectorUDT())
        return coded.withColumn(f"{column}_levels", vector("__c").alias(f"{column}_levels", metadata=sized(n))).drop("__c")

    def features(self, df: DataFrame, keep: Sequence[str] = (), label: str = "label",
                 out: str = "features") -> DataFrame:
        """``keep``, the label and one vector, for ``pyspark.ml``."""
        flat = self.transform(df, keep)
        names = self.feature_names()
        safe = [f"f{i}" for i in range(len(names))]  # the assembler reads dots as nesting
        renamed = flat.select(
            *keep, F.col(f"`{self.target}`").cast("double").alias(label),
            *[(F.col(f"`{n}`") if isinstance(flat.schema[n].dataType, VectorUDT) else F.col(f"`{n}`").cast("double")).alias(s)
              for n, s in zip(names, safe)],
        )
        if not self.levels.sizes:
            return VectorAssembler(inputCols=safe, outputCol=out).transform(renamed).select(*keep, label, out)
        short, long = safe[: len(names) - len(self.levels.sizes)], safe[len(names) - len(self.levels.sizes) :]
        flat = VectorAssembler(inputCols=short, outputCol="__short").transform(renamed)
        width = len(short) + sum(n - 1 for n in self.levels.sizes.values())
        joined = F.udf(appended, VectorUDT())("__short", *long).alias(out, metadata=sized(width))
        return flat.select(*keep, label, joined)

    def tables(self) -> dict[str, DataFrame]:
        return {} if self.levels.table is None else {"codes": self.levels.table}

    def to_json(self) -> str:
        return json.dumps({
            "inputs": self.inputs, "target": self.target, "binary": self.binary, "levels": self.levels.inline,
            "sizes": self.levels.sizes, "scales": {c: asdict(v) for c, v in self.scales.items()},
            "target_scale": asdict(self.target_scale) if self.target_scale else None})

    @classmethod
    def from_json(cls, text: str, tables: dict[str, DataFrame] | None = None) -> PrepModel:
        s = json.loads(text)
        target_scale = Scale(**s["target_scale"]) if s["target_scale"] else None
        codes = LevelCodes({c: tuple(v) for c, v in s["levels"].items()}, s["sizes"], (tables or {}).get("codes"))
        return cls(tuple(s["inputs"]), s["target"], tuple(s["binary"]), codes,
                   {c: Scale(**v) for c, v in s["scales"].items()}, target_scale)


def fit_prep(train: DataFrame, catalog: Catalog, binary_to_ind: bool = True, nominal_to_dummies: bool = True,
             input_scale: str | None = "Range", target_scale: str | None = None, inline: int = INLINE) -> PrepModel:
    """``inline`` is the number of levels from which on a nominal column becomes one vector."""
    numbers = catalog.inputs((INTERVAL, ORDINAL))
    target = catalog.target()
    scaled_target = fit_scales(train, [target], target_scale).get(target)
    return PrepModel(
        inputs=tuple(catalog.inputs()),
        target=target,
        binary=tuple(catalog.inputs(BINARY)) if binary_to_ind else (),
        levels=level_codes(train, catalog.inputs(NOMINAL), inline) if nominal_to_dummies else LevelCodes(),
        scales=fit_scales(train, numbers, input_scale),
        target_scale=scaled_target,
    )
