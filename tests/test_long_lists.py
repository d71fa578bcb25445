"""Long lists of levels: the look-up never collects their copies, and vectors over them stay sparse."""

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from prepline.catalog import Catalog
from prepline.operators.encode import fit_prep
from prepline.operators.levels import ReplaceModel, level_set, look_up


@pytest.fixture(scope="module")
def rows(spark):
    """Two thousand rows of fifty levels, half of them of one level, and some missing."""
    level = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 25 == 1, None).otherwise(F.concat(F.lit("L"), F.col("id") % 49))
    return spark.range(2000).select(F.col("id").alias("k"), level.alias("c"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_list_are_not_broadcast(spark, rows):
    table = rows.select(F.col("c").alias("level")).distinct().withColumn("v", F.lit(True))
    found = look_up(rows, "c", table, "v")
    assert "Broadcast" not in plan(found)
    assert found.count() == 2000 and found.filter("v").count() == 2000


def test_long_list_of_known_levels_is_exact(spark, rows):
    known = rows.filter("k < 60").select(F.lit("c").alias("var"), F.col("c").alias("level")).distinct().persist()
    model = ReplaceModel(level_set(known, inline=2), {"c": "mode"})
    expected = {r["level"] for r in known.collect()}
    for r in model.transform(rows).collect():
        assert r["REP_c"] == (r["c"] if r["c"] in expected else "mode")
    known.unpersist()


def test_long_vectors_carry_no_names_and_stay_sparse(spark):
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") * 0.5).alias("x"),
                                  F.concat(F.lit("L"), F.col("id") % 20 + 10).alias("c"))
    catalog = Catalog.of([("y", "TARGET", "BINARY"), ("x", "INPUT", "INTERVAL"), ("c", "INPUT", "NOMINAL")])
    short, long = (fit_prep(rows, catalog, inline=n).features(rows, ["k"]) for n in (1000, 5))
    assert long.schema["features"].metadata == {"ml_attr": {"num_attrs": 20}}
    found = {r["k"]: r["features"] for r in long.collect()}
    assert all(isinstance(v, SparseVector) for v in found.values())
    assert found == {r["k"]: r["features"] for r in short.collect()}


def test_counted_lists_are_sent_without_copies(spark, rows):
    table = rows.select(F.col("c").alias("level")).distinct().withColumn("v", F.lit(True))
    found = look_up(rows, "c", table, "v", 50)
    assert "Broadcast" in plan(found) and "sequence" not in plan(found) and "explode" not in plan(found)
    assert found.count() == 2000 and found.filter("v").count() == 2000
