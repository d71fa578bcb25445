"""Selecting columns by how much a tree or a forest uses them."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepline.catalog import Catalog
from prepline.operators.encode import level_codes
from prepline.operators.profile import level_profile
from prepline.operators.rank import number_sorted
from prepline.operators.trees import Forest, grow, leaf_rows
from prepline.session import held

# What a leaf of a tree without a limit of leaves holds at least; the share bounds the nodes at any size.
LEAST_SHARE, LEAST_ROWS = 0.001, 20
FOREST_DEPTH = 12  # a level is a job, and deeper ones change importances little; None takes the limit away


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var, level, code)``: sorted levels numbered from 0 within each column."""
    levels = level_profile(df, columns).filter(F.col("level").isNotNull()).select("var", "level")
    return number_sorted(levels, "var", "level", "code")


def string_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def encode_labels(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and every column as a number; text becomes its level code, which trees split by order."""
    text = string_columns(df, columns)
    codes = level_codes(df, text)
    out = df
    for i, c in enumerate(text):
        out = codes.add(out, c, f"__code_{i}")
    number = {c: f"__code_{i}" for i, c in enumerate(text)}
    return out.select(*keep, *[F.col(f"`{number.get(c, c)}`").cast("double").alias(c) for c in columns])


@dataclass(frozen=True)
class ImportanceModel:
    """``model`` holds the trees; a model read back from its state has none, as selection needs none."""

    model: Forest | None
    importance: tuple[tuple[str, float], ...]
    rejected: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps({"importance": self.importance, "rejected": self.rejected})

    @classmethod
    def from_json(cls, text: str) -> ImportanceModel:
        state = json.loads(text)
        return cls(None, tuple((v, i) for v, i in state["importance"]), tuple(state["rejected"]))

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.reject(self.rejected)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(v, i, v in self.rejected) for v, i in self.importance]
        return spark.createDataFrame(rows, "var string, importance double, rejected boolean")


def reject_by_value(table: DataFrame, limit: float) -> DataFrame:
    """Mark columns whose ``importance`` is below the limit."""
    return table.withColumn("rejected", F.col("importance") < limit)


def reject_by_percentage(table: DataFrame, share: float) -> DataFrame:
    """Keep the top ``share`` of the columns; at a zero cut-off only unused columns go.

    The table has one row per column.
    """
    ranked = table.withColumns({
        "__rn": F.row_number().over(Window.orderBy(F.desc("importance"), "var")),
        "__n": F.count(F.lit(1)).over(Window.partitionBy()),
    })
    nth = F.max(F.when(F.col("__rn") == F.ceil(F.col("__n") * F.lit(float(share))), F.col("importance")))
    cut = ranked.withColumn("__cut", nth.over(Window.partitionBy()))
    rejected = F.when(F.col("__cut") == 0, F.col("importance") == 0).otherwise(F.col("importance") < F.col("__cut"))
    return cut.withColumn("rejected", rejected).drop("__rn", "__n", "__cut")


REJECT = {"value": reject_by_value, "percentage": reject_by_percentage}


def rejected(spark: SparkSession, importance: Sequence[tuple[str, float]], limit: float | None, method: str | None) -> tuple[str, ...]:
    """Columns that a rule rejects, given their importance."""
    if method is None:
        return ()
    if limit is None:
        raise ValueError("rejecting needs a limit")
    if method not in REJECT:
        raise ValueError(f"unknown method {method!r}; known: {sorted(REJECT)}")
    table = spark.createDataFrame(list(importance), "var string, importance double")
    out = {r["var"] for r in REJECT[method](table, limit).filter("rejected").collect()}  # one row a column
    return tuple(v for v, _ in importance if v in out)


def encoded_inputs(df: DataFrame, catalog: Catalog, key: str | None) -> DataFrame:
    """The inputs as numbers, with ``__key`` and ``__label``."""
    columns, target = catalog.inputs(), catalog.target()
    named = F.col(key) if key else F.xxhash64(*columns)
    return encode_labels(df.withColumns({"__label": F.col(target).cast("double"), "__key": named}), columns, ["__key", "__label"])


def recounted_importance(df: DataFrame, catalog: Catalog, forest: Forest, key: str) -> list[tuple[str, float]]:
    """Importance from a fresh count of the rows in every leaf, summed up towards the roots."""
    rows = leaf_rows(encoded_inputs(df, catalog, key), forest, "__label", "__key")
    counts = rows.groupBy("t", "leaf").agg(F.sum(F.when(F.col("y") == 0, F.col("often")).otherwise(0)).alias("n0"),
                                           F.sum(F.when(F.col("y") == 1, F.col("often")).otherwise(0)).alias("n1"))
    leaves = {(r["t"], r["leaf"]): (r["n0"], r["n1"]) for r in counts.collect()}  # one row a leaf

    def bits(n: tuple[float, float]) -> float:
        return sum(-x * math.log2(x / sum(n)) for x in n if x)

    total = dict.fromkeys(forest.names, 0.0)
    for tree in forest.trees:
        below, gains = {}, dict.fromkeys(forest.names, 0.0)
        for at in reversed(range(len(tree.columns))):  # children come after their parent
            if tree.columns[at] < 0:
                below[at] = tuple(n * w for n, w in zip(leaves.get((tree.number, at), (0, 0)), forest.weights))
            else:
                low, high = below[tree.left[at]], below[tree.right[at]]
                below[at] = tuple(a + b for a, b in zip(low, high))
                gains[forest.names[tree.columns[at]]] += bits(below[at]) - bits(low) - bits(high)
        if sum(gains.values()) > 0:
            total = {v: t + gains[v] / sum(gains.values()) for v, t in total.items()}
    whole = sum(total.values())
    return [(v, t / whole if whole else 0.0) for v, t in total.items()]


def _fit(df: DataFrame, catalog: Catalog, limit: float | None, method: str | None, key: str | None, **options) -> ImportanceModel:
    with held(encoded_inputs(df, catalog, key)) as rows:
        forest = grow(rows, catalog.inputs(), "__label", "__key", **options)
    importance = forest.importance()
    return ImportanceModel(forest, importance, rejected(df.sparkSession, importance, limit, method))


def tree_selection(df: DataFrame, catalog: Catalog, limit: float | None = None, method: str | None = None, key: str | None = None,
                   most_leaves: int | None = None, least_share: float = LEAST_SHARE, least_rows: int = LEAST_ROWS, **options) -> ImportanceModel:
    """One entropy tree, grown best first. ``method`` is 'value', 'percentage' or None for no rejection.

    ``most_leaves`` limits its leaves, ``class_weight`` weighs the classes; no limit holds for its depth.
    """
    return _fit(df, catalog, limit, method, key, most_leaves=most_leaves, least_share=least_share, least_rows=least_rows, **options)


def forest_selection(df: DataFrame, catalog: Catalog, limit: float | None = None, method: str | None = None, key: str | None = None,
                     trees: int = 10, least_share: float = LEAST_SHARE, least_rows: int = LEAST_ROWS,
                     max_depth: int | None = FOREST_DEPTH, start: Forest | None = None, **options) -> ImportanceModel:
    """Trees on keyed bootstrap draws, each node choosing among the root of the number of columns.

    With ``start`` the forest goes on from a saved one by ``trees`` more. Draws follow ``key``; without one,
    rows with equal inputs share them.
    """
    width = len(catalog.inputs())
    return _fit(df, catalog, limit, method, key, trees=trees, bootstrap=True, columns=max(1, math.isqrt(width)), least_share=least_share,
                least_rows=least_rows, max_depth=max_depth, start=start, **options)
