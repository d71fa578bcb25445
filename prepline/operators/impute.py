"""Imputation: parameters from one look at the training rows, then a projection."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.catalog import BINARY, INTERVAL, NOMINAL, ORDINAL, Catalog
from prepline.functions import clean, is_missing, keyed_uniform
from prepline.operators.profile import level_profile, modes
from prepline.operators.quantiles import KNOTS, quantiles, quantiles_approx
from prepline.operators.sampling import SEED

# Prefix of imputed columns and the constant fills.
PREFIX = "IMP_"
MISSING_LEVEL = "Missing"
ZERO = 0

METHODS = {INTERVAL: ("Distn",), ORDINAL: ("Zero",), NOMINAL: ("Missing",), BINARY: ("Mode",)}
_ORDER = (INTERVAL, ORDINAL, NOMINAL, BINARY)


@dataclass(frozen=True)
class Fill:
    var: str
    level: str
    value: str | int | None = None
    knots: tuple[float, ...] | None = None


@dataclass(frozen=True)
class ImputeModel:
    """``draw='probability'`` picks a quantile segment with its probability;
    ``draw='literal'`` compares the draw with the knot values themselves."""

    fills: tuple[Fill, ...]
    key: str
    seed: int = SEED
    draw: str = "probability"

    def catalog(self, catalog: Catalog) -> Catalog:
        return catalog.derive(PREFIX, [f.var for f in self.fills])

    def transform(self, df: DataFrame, keep: str | Sequence[str] = "all") -> DataFrame:
        """Add ``IMP_`` columns; ``keep='derived'`` returns the key and the new columns only.

        The two draws of an interval column are made once, and only for rows
        that need them. No row moves.
        """
        drawn = [f for f in self.fills if f.knots]
        draws = [
            F.when(is_missing(df, f.var), keyed_uniform(self.key, self.seed, f"{f.var}:{i}")).alias(f"__u{i}_{f.var}")
            for f in drawn for i in (1, 2)
        ]
        kept = df.columns if keep == "all" else [self.key] if keep == "derived" else list(keep)
        staged = df.select("*", *draws).select("*", *[self._segment(f).alias(f"__s_{f.var}") for f in drawn])
        return staged.select(*[F.col(f"`{c}`") for c in kept],
                             *[self._filled(staged, f).alias(PREFIX + f.var) for f in self.fills])

    def _filled(self, df: DataFrame, fill: Fill) -> Column:
        column = clean(df, fill.var)
        if fill.level == NOMINAL:  # codes become text, else the fill would not fit among them
            return F.coalesce(column.cast("string"), F.lit(fill.value))
        if fill.knots:
            return F.coalesce(column, self._within(fill))
        if fill.value is None:
            return column
        return F.coalesce(column, F.lit(fill.value).cast(df.schema[fill.var].dataType))

    def _segment(self, fill: Fill) -> Column:
        """Number of the quantile segment the first draw falls in, from 1."""
        limits = KNOTS if self.draw == "probability" else fill.knots
        above = [f"int(`__u1_{fill.var}` > {float(v)!r}D)" for v in limits[1:-1]]
        return F.expr(" + ".join(["1", *above]))

    def _within(self, fill: Fill) -> Column:
        """The second draw, spread over the segment."""
        u, segment = F.col(f"`__u2_{fill.var}`"), F.col(f"`__s_{fill.var}`")
        knots = F.lit([float(k) for k in fill.knots])
        low, high = F.element_at(knots, segment), F.element_at(knots, segment + 1)
        return low + (high - low) * u

    def params(self, spark: SparkSession) -> DataFrame:
        rows = [(f.var, f.level, None if f.value is None else str(f.value), list(f.knots) if f.knots else None)
                for f in self.fills]
        return spark.createDataFrame(rows, "var string, kind string, fill string, knots array<double>")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> ImputeModel:
        state = json.loads(text)
        fills = tuple(
            Fill(f["var"], f["level"], f["value"], tuple(f["knots"]) if f["knots"] else None) for f in state.pop("fills")
        )
        return cls(fills=fills, **state)


def knot_params(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, tuple[float, ...]]:
    """Fifteen numbers per column; a column without values is absent."""
    if not columns:
        return {}
    table = quantiles(df, columns) if exact else quantiles_approx(df, columns)
    found: dict[str, dict[float, float]] = {}
    for row in table.collect():
        if row["value"] is not None:
            found.setdefault(row["var"], {})[row["prob"]] = row["value"]
    return {var: tuple(at[p] for p in KNOTS) for var, at in found.items()}


def fit_impute(df: DataFrame, catalog: Catalog, key: str, interval_method: str = "Distn",
               ordinal_method: str = "Zero", nominal_method: str = "Missing", binary_method: str = "Mode",
               exact: bool = True, seed: int = SEED, draw: str = "probability") -> ImputeModel:
    """Fit fills for every input column.

    A column that is missing throughout gets no fill and stays missing.
    """
    chosen = {INTERVAL: interval_method, ORDINAL: ordinal_method, NOMINAL: nominal_method, BINARY: binary_method}
    for level, method in chosen.items():
        if method not in METHODS[level]:
            raise ValueError(f"unknown method {method!r} for {level}; known: {METHODS[level]}")
    if draw not in ("probability", "literal"):
        raise ValueError(f"unknown draw {draw!r}")
    names = {level: catalog.inputs(level) for level in _ORDER}
    knots = knot_params(df, names[INTERVAL], exact)
    binary = names[BINARY]
    mode = {r["var"]: r["mode"] for r in modes(level_profile(df, binary)).collect()} if binary else {}
    fills = (
        *(Fill(c, INTERVAL, knots=knots.get(c)) for c in names[INTERVAL]),
        *(Fill(c, ORDINAL, value=ZERO) for c in names[ORDINAL]),
        *(Fill(c, NOMINAL, value=MISSING_LEVEL) for c in names[NOMINAL]),
        *(Fill(c, BINARY, value=mode.get(c)) for c in binary),
    )
    return ImputeModel(fills, key, seed, draw)
