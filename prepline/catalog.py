"""The variable catalog: which column plays which role, at which level."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Role and level names.
INPUT, TARGET, REJECTED = "INPUT", "TARGET", "REJECTED"
INTERVAL, ORDINAL, NOMINAL, BINARY = "INTERVAL", "ORDINAL", "NOMINAL", "BINARY"

CATALOG_SCHEMA = "name string, role string, level string, pos int, parent string"


@dataclass(frozen=True)
class Variable:
    name: str
    role: str
    level: str
    parent: str | None = None


@dataclass(frozen=True)
class Catalog:
    """Immutable and ordered. Every change returns a new catalog."""

    variables: tuple[Variable, ...]

    @classmethod
    def of(cls, rows: Iterable[tuple[str, str, str]]) -> Catalog:
        return cls(tuple(Variable(*row) for row in rows))

    def __contains__(self, name: str) -> bool:
        return any(v.name == name for v in self.variables)

    def __getitem__(self, name: str) -> Variable:
        for v in self.variables:
            if v.name == name:
                return v
        raise KeyError(name)

    def names(self, role: str | None = None, level: str | Iterable[str] | None = None) -> list[str]:
        levels = None if level is None else {level} if isinstance(level, str) else set(level)
        return [
            v.name
            for v in self.variables
            if (role is None or v.role == role) and (levels is None or v.level in levels)
        ]

    def inputs(self, level: str | Iterable[str] | None = None) -> list[str]:
        return self.names(INPUT, level)

    def target(self) -> str:
        found = self.names(TARGET)
        if len(found) != 1:
            raise ValueError(f"the catalog must hold exactly one TARGET column, found {found}")
        return found[0]

    def reject(self, names: Iterable[str]) -> Catalog:
        gone = set(names)
        missing = gone - {v.name for v in self.variables}
        if missing:
            raise ValueError(f"not in the catalog: {sorted(missing)}")
        return Catalog(tuple(replace(v, role=REJECTED) if v.name in gone else v for v in self.variables))

    def derive(self, prefix: str, names: Iterable[str], level: str | None = None) -> Catalog:
        """Reject ``names`` and add ``prefix + name`` as inputs in their place."""
        names = list(names)
        added = tuple(Variable(prefix + n, INPUT, level or self[n].level, parent=n) for n in names)
        clash = [v.name for v in added if v.name in self]
        if clash:
            raise ValueError(f"derived columns exist already: {clash}")
        return Catalog(self.reject(names).variables + added)

    def select(self, df: DataFrame, role: str = INPUT, level: str | Iterable[str] | None = None,
               keep: Iterable[str] = ()) -> DataFrame:
        return df.select(*keep, *self.names(role, level))

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(v.name, v.role, v.level, i, v.parent) for i, v in enumerate(self.variables)]
        return spark.createDataFrame(rows, CATALOG_SCHEMA)

    @classmethod
    def from_df(cls, df: DataFrame) -> Catalog:
        """One row per column of a table, so collecting it is bounded by the schema."""
        rows = df.orderBy("pos").collect()
        has_parent = "parent" in df.columns
        return cls(tuple(Variable(r["name"], r["role"], r["level"], r["parent"] if has_parent else None) for r in rows))

    def to_json(self) -> str:
        return json.dumps([asdict(v) for v in self.variables])

    @classmethod
    def from_json(cls, text: str) -> Catalog:
        return cls(tuple(Variable(**v) for v in json.loads(text)))


def role_table(
    df: DataFrame,
    reference: DataFrame,
    model: str,
    reject_interval: Iterable[str] = (),
    reject_binary: Iterable[str] = ("_build_ind", "_score_ind"),
    target_binary: Iterable[str] = ("_target_ind",),
) -> DataFrame:
    """Role and level of every column of ``df`` as ``(name, role, level, pos)``.

    A column named by one of the lists, alone or behind the model name, takes
    that list's role. Every other column takes the most frequent ``ROLE_NM``
    and, independently, the most frequent ``LEVEL_NM`` of the reference rows
    whose ``ALIAS_NM`` is its name; equal counts go to the first in alphabet.
    """
    spark = df.sparkSession
    columns = spark.createDataFrame(list(enumerate(df.columns)), "pos int, name string")
    name = F.lower(F.trim("name"))

    def listed(suffixes: Iterable[str]) -> Column:
        stem = model.lower().strip()
        wanted = [s.lower().strip() for s in suffixes]
        return name.isin(wanted + [stem + s for s in wanted]) if wanted else F.lit(False)

    def majority(column: str, alias: str) -> DataFrame:
        votes = known.groupBy("ALIAS_NM", column).agg(F.count(F.lit(1)).alias("n"))
        return votes.groupBy("ALIAS_NM").agg(F.min(F.struct(-F.col("n"), F.col(column)))[column].alias(alias))

    known = reference.filter(F.col("ALIAS_NM").isin(df.columns)).select("ALIAS_NM", "ROLE_NM", "LEVEL_NM")
    ref = majority("ROLE_NM", "ref_role").join(majority("LEVEL_NM", "ref_level"), "ALIAS_NM")
    cts, rej, tar = listed(reject_interval), listed(reject_binary), listed(target_binary)
    role = F.when(cts | rej, REJECTED).when(tar, TARGET).otherwise(F.col("ref_role"))
    level = F.when(cts, INTERVAL).when(rej | tar, BINARY).otherwise(F.col("ref_level"))
    return (
        columns.join(ref, columns["name"] == ref["ALIAS_NM"], "left")
        .select("name", role.alias("role"), level.alias("level"), "pos")
    )


def assign_roles(df: DataFrame, reference: DataFrame, model: str, **lists) -> Catalog:
    catalog = Catalog.from_df(role_table(df, reference, model, **lists))
    unknown = [v.name for v in catalog.variables if v.role is None or v.level is None]
    if unknown:
        raise ValueError(f"columns without a reference row: {unknown}")
    return catalog
