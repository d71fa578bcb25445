"""The whole preparation: fit on training rows, apply anywhere."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame

from prepline.catalog import Catalog
from prepline.operators.cluster import ClusterModel, fit_clusters
from prepline.operators.importance import ImportanceModel, forest_selection
from prepline.operators.impute import ImputeModel, fit_impute
from prepline.operators.levels import GroupModel, ReplaceModel, fit_group_rare, fit_replace
from prepline.operators.sampling import SEED
from prepline.operators.screen import class_level_filter, missing_filter
from prepline.session import held


@dataclass(frozen=True)
class Preparation:
    """Fitted steps in the order they run, and the catalog that results."""

    impute: ImputeModel
    group: GroupModel
    replace: ReplaceModel
    catalog: Catalog
    importance: ImportanceModel | None = None
    clusters: ClusterModel | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Impute, pool rare levels, replace unseen ones. No row moves."""
        return self.replace.transform(self.group.transform(self.impute.transform(df)))

    def tables(self) -> dict[str, DataFrame]:
        return {f"{step}.{name}": table for step, model in (("group", self.group), ("replace", self.replace))
                for name, table in model.tables().items()}

    def to_json(self) -> str:
        steps = {"impute": self.impute, "group": self.group, "replace": self.replace, "catalog": self.catalog,
                 "importance": self.importance, "clusters": self.clusters}
        return json.dumps({name: None if model is None else model.to_json() for name, model in steps.items()})

    @classmethod
    def from_json(cls, text: str, tables: dict[str, DataFrame] | None = None) -> Preparation:
        s = json.loads(text)

        def own(step: str) -> dict[str, DataFrame]:
            return {name.split(".", 1)[1]: table for name, table in (tables or {}).items() if name.startswith(f"{step}.")}

        return cls(
            ImputeModel.from_json(s["impute"]), GroupModel.from_json(s["group"], own("group")),
            ReplaceModel.from_json(s["replace"], own("replace")), Catalog.from_json(s["catalog"]),
            ImportanceModel.from_json(s["importance"]) if s["importance"] else None,
            ClusterModel.from_json(s["clusters"]) if s["clusters"] else None)


def fit_preparation(train: DataFrame, catalog: Catalog, key: str, level_limit: int = 200,
                    missing_share: float = 0.99, rare_share: float = 0.001, forest: bool = True,
                    forest_limit: float = 0.001, cluster: bool = True, hyper: float = 0.8,
                    exact: bool = True, seed: int = SEED, **forest_options) -> Preparation:
    """Screen, impute, select by forest, cluster, pool rare levels, list known levels.

    Steps that learn from derived columns read the training rows through the
    projections fitted so far, so nothing is written between the steps.
    """
    needed = [key, *catalog.names("TARGET"), *catalog.inputs()]
    with held(train.select(*dict.fromkeys(needed))) as rows:
        catalog = class_level_filter(rows, catalog, level_limit, roles=["INPUT"])
        catalog = missing_filter(rows, catalog, missing_share, roles=["INPUT"])
        impute = fit_impute(rows, catalog, key, exact=exact, seed=seed)
        catalog = impute.catalog(catalog)
        imputed = impute.transform(rows)

        importance = clusters = None
        if forest:
            importance = forest_selection(imputed, catalog, forest_limit, "value", key=key, seed=seed, **forest_options)
            catalog = importance.catalog(catalog)
        if cluster:
            clusters = fit_clusters(imputed, catalog)
            catalog = clusters.catalog(catalog)

        group = fit_group_rare(imputed, catalog, rare_share)
        catalog = group.catalog(catalog)
        grouped = group.transform(imputed)
        replace = fit_replace(grouped, catalog)
        catalog = replace.catalog(catalog)
    return Preparation(impute, group, replace, catalog, importance, clusters)
