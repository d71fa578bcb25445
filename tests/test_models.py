"""Searches on small tables."""

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from prepline.operators.impute import ImputeModel, fit_impute
from prepline.operators.lift import hits_at_depth, lift_value
from prepline.operators.search import (
    hashed_features, logit_model, logit_search, net, net_cv, net_tries, net_validation, scored,
)
from prepline.catalog import Catalog
from prepline.sources import StageStore, database_options, extract, jdbc_options, read_table, write_csv


@pytest.fixture(scope="module")
def halves(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    raw = spark.range(800).select(
        F.col("id").alias("k"), ((F.col("id") % 4) == 0).cast("double").alias("label"),
        ((F.col("id") % 4 == 0).cast("double") + noise).alias("a"), noise.alias("b"))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(raw).select("k", "label", "features").cache()
    return df.filter("k % 2 = 0"), df.filter("k < 400")


def test_logit_search(halves):
    train, test = halves
    found = logit_search(train, test, "k", c_grid=(-2, 2, 3), thresholds=(0.3, 1.0, 71), max_iter=50)
    assert len(found.scores) == 3 and found.model_score == max(found.scores)
    assert found.best_c == found.cs[found.scores.index(found.model_score)]
    hits = hits_at_depth(found.predictions, "label", "p1", "k", [0.1]).select(lift_value().alias("l")).first()
    assert hits["l"] == pytest.approx(found.model_score)
    assert found.threshold_score > 0.75
    assert sum(r["n"] for r in found.confusion.collect()) == test.count()
    with pytest.raises(ValueError):
        logit_search(train, test, "k", metric="accuracy")


def test_random_score_has_lift_one(spark):
    df = spark.range(20_000).select("id", (F.xxhash64("id") % 10 == 0).cast("int").alias("y"), F.rand(3).alias("p1"))
    row = hits_at_depth(df, "y", "p1", "id", [0.5]).select(lift_value().alias("l")).first()
    assert row["l"] == pytest.approx(1.0, abs=0.1)


def test_nets(halves):
    train, test = halves
    found = net_validation(train, test, "k", n_models=2, space={"epochs": [5, 20]})
    assert len(found.models) == len(found.scores) == 2 and found.best() in (0, 1)
    tries = net_tries(train, test, "k", epochs=(5, 10, 5), tries=2, layer_units=(2,))
    assert [(s["epochs"], s["seed"]) for s in tries.settings] == [(5, 12345), (5, 12346), (10, 12345), (10, 12346)]
    cv = net_cv(train, "k", folds=2, n_models=1, space={"epochs": [5]})
    assert len(cv.avgMetrics) == 1 and len(cv.fold_scores) == 2
    wider = net_cv(train, "k", folds=2, search="Grid Search", space={"epochs": [5], "layer_units": [(2,), (4, 3)]})
    assert len(wider.avgMetrics) == 2 and wider.bestModel.getLayers()[1] in (2, 4)
    assert sum(r["n"] for r in found.confusion.collect()) == test.count() == found.predictions.count()
    weights = [net(2, learning_rate=r, epochs=5).fit(train).weights.toArray() for r in (0.001, 0.3)]
    assert abs(weights[0] - weights[1]).max() > 1e-4
    with pytest.raises(ValueError):
        net(2, learning_rate=0.1, solver="l-bfgs")
    with pytest.raises(ValueError):
        net(0)
    with pytest.raises(ValueError):
        net_cv(train, "k", search="By Hand")


def test_hashed_features(spark):
    df = spark.createDataFrame([(1, "u", 2.0), (2, "v", 3.0)], "k bigint, c string, x double")
    rows = hashed_features(df, ["c"], ["x"], ["k"]).orderBy("k").collect()
    assert rows[0]["features"].size == 251 and rows[0]["features"][250] == 2.0
    assert rows[0]["features"].numNonzeros() == 2


def test_stages_states_and_models(spark, halves, tmp_path):
    store = StageStore(spark, str(tmp_path))
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id bigint, x double")
    assert sorted(store.save("rows", df).collect()) == sorted(df.collect())
    model = fit_impute(df, Catalog.of([("x", "INPUT", "INTERVAL")]), "id")
    store.save_state("impute", model)
    assert store.load_state("impute", ImputeModel) == model
    with pytest.raises(ValueError):
        store.load_state("impute", Catalog)
    train, test = halves
    fitted = logit_model(1.0, 400).fit(train)
    store.save_model("logit", fitted)
    again = store.load_model("logit", LogisticRegressionModel)
    assert scored(again, test, ["k"]).collect() == scored(fitted, test, ["k"]).collect()


def test_sources(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    write_csv(df, str(tmp_path / "csv"))
    assert sorted(read_table(spark, str(tmp_path / "csv"), "csv", schema="i int, s string").collect()) == sorted(df.collect())
    for fmt in ("orc", "json", "parquet"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert read_table(spark, str(tmp_path / fmt), fmt, columns=["s"]).columns == ["s"]
    with pytest.raises(ValueError):
        read_table(spark, "x", "sas")
    assert extract(spark, "SELECT max(i) AS m FROM {t}", t=df).first()["m"] == 2
    monkeypatch.setenv("DB_USER", "u")
    monkeypatch.delenv("DB_PASSWORD", raising=False)
    options = jdbc_options("jdbc:x", table="t", column="id", lower=0, upper=9, partitions=3)
    assert options == {"url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0",
                       "upperBound": "9", "numPartitions": "3", "user": "u"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    assert database_options(None, options) == options and "query" not in options
    assert database_options("SELECT 1", {"url": "jdbc:x"}) == {"url": "jdbc:x", "query": "SELECT 1"}
    with pytest.raises(ValueError):
        database_options("SELECT 1", options)
