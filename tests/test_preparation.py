"""Queries of the whole preparation run every step of it."""

from pyspark.sql import functions as F

from prepline.operators.encode import fit_prep
from prepline.operators.sampling import train_test_split
from prepline.plans import queries
from prepline.plans.observations import marked_obs
from tests.conftest import SMALL


def test_prepared_rows_hold_only_what_forest_and_clusters_select(spark, monkeypatch):
    """A constant column falls to the forest, one of two equal columns to the clusters; the rest stays, nominals too."""
    def halves(spark, folder):
        obs = marked_obs(spark, folder).withColumn("acctbal", F.lit(1.0)).withColumn("sum_qty", F.col("max_price"))
        return train_test_split(obs, queries.KEY)

    monkeypatch.setattr(queries, "_marked_halves", halves)
    train, test = queries.prep_train(spark, SMALL), queries.prep_apply(spark, SMALL)
    assert train.columns == test.columns
    assert "IMP_acctbal" not in train.columns and len({"IMP_sum_qty", "IMP_max_price"} & set(train.columns)) == 1
    assert {"IMP_total_price", "IMP_planted", "REP_IMP_nation", "REP_IMP_segment"} <= set(train.columns)


def test_model_stability_keeps_nominal_inputs(spark, monkeypatch):
    used = []
    monkeypatch.setattr(queries, "fit_prep", lambda df, catalog, **o: used.extend(catalog.inputs()) or fit_prep(df, catalog, **o))
    queries.model_stability(spark, SMALL)
    assert {"REP_IMP_nation", "REP_IMP_segment"} <= set(used)
