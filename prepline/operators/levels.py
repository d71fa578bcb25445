"""Rare levels, and levels that training never saw.

A fitted list of levels is kept as literals while it is short. A longer one
stays a table, and rows are looked up in it by a join: a broadcast up to a counted
size, and from there on a shuffle whose hot levels are spread by a salt.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.catalog import NOMINAL, Catalog
from prepline.operators.profile import distinct_levels, level_profile, level_shares, modes
from prepline.session import cut_lineage, held

# Prefixes of derived columns and the name of the pooled level.
BIN_PREFIX, REP_PREFIX, OTHER = "BIN_", "REP_", "_OTHER_"

INLINE = 1_000
BROADCAST_LEVELS = 20_000  # up to so many entries, counted when they were fitted, a list is sent to every task
SALTS = 16  # parts a hot level is spread over, whatever the session shuffles to: the copies of a list grow with the list alone


@dataclass(frozen=True)
class LevelSet:
    """Levels per column: literals for short lists, one table for the rest."""

    inline: dict[str, tuple[str | None, ...]]
    table: DataFrame | None = None
    stored: tuple[str, ...] = ()
    sizes: dict[str, int] = field(default_factory=dict)  # of the stored lists, where they are known

    @property
    def names(self) -> list[str]:
        return sorted([*self.inline, *self.stored])

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(var, level) for var, levels in self.inline.items() for level in levels]
        short = spark.createDataFrame(rows, "var string, level string")
        return short if self.table is None else short.unionByName(self.table)

    def state(self) -> dict:
        """What fits in a line of text; the long lists are in ``tables``."""
        return {"inline": self.inline, "stored": self.stored, "sizes": self.sizes}

    def tables(self) -> dict[str, DataFrame]:
        return {} if self.table is None else {"levels": self.table}

    @classmethod
    def from_state(cls, state: dict, tables: dict[str, DataFrame] | None = None) -> LevelSet:
        if state["stored"] and not (tables or {}).get("levels"):
            raise ValueError(f"the lists of {state['stored']} are in a table that was not given")
        return cls({v: tuple(ls) for v, ls in state["inline"].items()}, (tables or {}).get("levels"), tuple(state["stored"]),
                   state.get("sizes", {}))

    def mark(self, df: DataFrame, flags: dict[str, str]) -> DataFrame:
        """Add a boolean per column: is its value one of the fitted levels?"""
        short = {c: f for c, f in flags.items() if c in self.inline}
        out = df.withColumns({f: member(F.col(f"`{c}`"), self.inline[c]) for c, f in short.items()}) if short else df
        for column, flag in flags.items():
            if column in self.stored:
                out = self._lookup(out, column, flag)
        return out

    def _lookup(self, df: DataFrame, column: str, flag: str) -> DataFrame:
        levels = self.table.filter(F.col("var") == column).select("level", F.lit(True).alias("__hit"))
        joined = look_up(df, column, levels, "__hit", self.sizes.get(column))
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__hit", F.lit(False)).alias(flag))


def look_up(df: DataFrame, column: str, table: DataFrame, value: str, n: int | None = None) -> DataFrame:
    """Add ``value`` from a table of ``(level, value)`` with ``n`` entries.

    A table counted as small is broadcast as it is. Else rows of a hot level are spread over salted copies of its entry, and
    both sides are shuffled: Spark takes the copies for as small as the list and would collect them on the driver.
    """
    entries = table.select(F.col("level").alias("__level"), value)
    same = F.col(f"`{column}`").cast("string").eqNullSafe(F.col("__level"))
    if n is not None and n <= BROADCAST_LEVELS:
        return df.join(F.broadcast(entries), same, "left").drop("__level")
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)).cast("int"))
    copies = entries.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return salted.join(copies, same & (F.col("__salt") == F.col("__s")), "left").drop("__salt", "__level", "__s")


def member(column: Column, levels: Sequence[str | None]) -> Column:
    """Null-safe membership: a null is a member only if null is a level."""
    present = [v for v in levels if v is not None]
    inside = F.coalesce(column.cast("string").isin(present), F.lit(False)) if present else F.lit(False)
    return (inside | column.isNull()) if None in levels else inside


def level_set(levels: DataFrame, inline: int = INLINE) -> LevelSet:
    """Fit from ``(var, level)`` rows, one per level; the sizes are counted before anything is fetched.

    The rows are read more than once, so callers hold them.
    """
    sizes = {r["var"]: r["n"] for r in levels.groupBy("var").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = [v for v, n in sizes.items() if n <= inline]
    long = [v for v, n in sizes.items() if n > inline]
    found: dict[str, list[str | None]] = {v: [] for v in short}
    if short:
        for r in levels.filter(F.col("var").isin(short)).collect():
            found[r["var"]].append(r["level"])
    table = cut_lineage(levels.filter(F.col("var").isin(long)).select("var", "level")) if long else None
    ordered = {v: tuple(sorted(ls, key=lambda x: (x is None, x))) for v, ls in sorted(found.items())}
    return LevelSet(ordered, table, tuple(sorted(long)), {v: sizes[v] for v in sorted(long)})


def rare_levels(df: DataFrame, columns: Sequence[str], threshold: float = 0.001) -> DataFrame:
    """``(var, level, n, share)`` of levels below the threshold, for columns with two or more of them."""
    rare = level_shares(level_profile(df, columns)).filter(F.col("share") < threshold)
    counted = rare.groupBy("var").agg(F.count(F.lit(1)).alias("n_rare")).filter("n_rare >= 2")
    return rare.join(F.broadcast(counted), "var").select("var", "level", "n", "share")


@dataclass(frozen=True)
class GroupModel:
    levels: LevelSet

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.derive(BIN_PREFIX, self.levels.names, NOMINAL)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``BIN_`` columns. Levels that training never saw stay as they are."""
        names = self.levels.names
        flags = {c: f"__rare_{c}" for c in names}
        marked = self.levels.mark(df, flags)
        new = [F.when(F.col(f"`{flags[c]}`"), OTHER).otherwise(F.col(f"`{c}`").cast("string")).alias(BIN_PREFIX + c) for c in names]
        return marked.select(*[F.col(f"`{c}`") for c in df.columns], *new)

    def params(self, spark: SparkSession) -> DataFrame:
        return self.levels.to_df(spark)

    def to_json(self) -> str:
        return json.dumps({"levels": self.levels.state()})

    def tables(self) -> dict[str, DataFrame]:
        return self.levels.tables()

    @classmethod
    def from_json(cls, text: str, tables: dict[str, DataFrame] | None = None) -> GroupModel:
        return cls(LevelSet.from_state(json.loads(text)["levels"], tables))


def fit_group_rare(df: DataFrame, catalog: Catalog, threshold: float = 0.001) -> GroupModel:
    columns = catalog.inputs(NOMINAL)
    if not columns:
        return GroupModel(LevelSet({}))
    with held(rare_levels(df, columns, threshold)) as rare:
        return GroupModel(level_set(rare.select("var", "level")))


@dataclass(frozen=True)
class ReplaceModel:
    levels: LevelSet
    mode: dict[str, str | None] = field(default_factory=dict)

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.derive(REP_PREFIX, self.levels.names, NOMINAL)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``REP_`` columns: the value if training saw it, else the training mode."""
        names = self.levels.names
        flags = {c: f"__seen_{c}" for c in names}
        marked = self.levels.mark(df, flags)
        new = [
            F.when(F.col(f"`{flags[c]}`"), F.col(f"`{c}`").cast("string")).otherwise(F.lit(self.mode.get(c))).alias(REP_PREFIX + c)
            for c in names
        ]
        return marked.select(*[F.col(f"`{c}`") for c in df.columns], *new)

    def params(self, spark: SparkSession) -> DataFrame:
        modes_ = spark.createDataFrame(list(self.mode.items()), "var string, mode string")
        return self.levels.to_df(spark).join(F.broadcast(modes_), "var")

    def to_json(self) -> str:
        return json.dumps({"levels": self.levels.state(), "mode": self.mode})

    def tables(self) -> dict[str, DataFrame]:
        return self.levels.tables()

    @classmethod
    def from_json(cls, text: str, tables: dict[str, DataFrame] | None = None) -> ReplaceModel:
        state = json.loads(text)
        return cls(LevelSet.from_state(state["levels"], tables), state["mode"])


def fit_replace(df: DataFrame, catalog: Catalog, method: str = "Mode") -> ReplaceModel:
    if method != "Mode":
        raise ValueError(f"unknown method {method!r}; known: Mode")
    columns = catalog.inputs(NOMINAL)
    if not columns:
        return ReplaceModel(LevelSet({}))
    with held(level_profile(df, columns)) as profile:
        found = {r["var"]: r["mode"] for r in modes(profile).collect()}
        return ReplaceModel(level_set(profile.select("var", "level")), found)


def new_levels(test: DataFrame, model: ReplaceModel) -> DataFrame:
    """``(var, level)`` present in ``test`` and unknown to the model.

    Levels are made distinct before they are compared, so no hot level meets the join.
    """
    spark = test.sparkSession
    found = distinct_levels(test, model.levels.names)
    known = model.levels.to_df(spark)
    same = (found["var"] == known["var"]) & found["level"].eqNullSafe(known["level"])
    return found.join(known, same, "left_anti")
