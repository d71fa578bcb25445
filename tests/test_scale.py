"""Results do not depend on layout or skew, and plans stay the ones that scale."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepline.catalog import Catalog
from prepline.operators.cells import CELL, descending, plan_cells
from prepline.operators.cluster import cluster_columns, split_columns
from prepline.operators.discretize import BinModel, fit_bins, mdl_cuts
from prepline.operators.importance import forest_selection, number_sorted, tree_selection
from prepline.operators.lift import DECILES, gain_grid, hits_at_depth
from prepline.operators.quantiles import KNOTS, quantiles
from prepline.operators.rank import rank_rows
from prepline.operators.stability import lift_stability
from prepline.plans.flow import fit_preparation
from prepline.plans.observations import LABEL, order_catalog, order_obs, scored_orders


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third with one score."""
    rows = 6000
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({
        "k": rng.permutation(rows),
        "g": np.where(rng.random(rows) < 0.34, 0, rng.integers(1, 9, rows)),
        "p1": np.where(rng.random(rows) < 0.34, 0.25, rng.random(rows).round(3)),
        "y": (rng.random(rows) < 0.2).astype(int),
    })
    return frame, spark.createDataFrame(frame, "k bigint, g int, p1 double, y int").repartition(8)


def brute_ranks(frame):
    ordered = frame.sort_values(["p1", "k"], ascending=[False, True])
    return ordered.assign(rank=ordered.groupby("g").cumcount() + 1, cum=ordered.groupby("g")["y"].cumsum())


def test_ranks_under_skew(skewed):
    frame, df = skewed
    expected = brute_ranks(frame).set_index("k")[["rank", "cum"]].to_dict("index")
    for parts in (1, 7):
        found = rank_rows(df.repartition(parts), "p1", "k", by=["g"], label="y").collect()
        assert len(found) == len(frame)
        assert all((r["rank"], r["cum_pos"]) == tuple(expected[r["k"]].values()) for r in found)


def test_cells_stay_small_under_skew(skewed):
    _, df = skewed
    plan = plan_cells(df, descending("p1"), F.col("k"), 64)
    largest = plan.place(df, descending("p1"), F.col("k")).groupBy(CELL).count().agg(F.max("count")).first()[0]
    assert largest <= 6000 * 4 / 64


def test_hits_under_skew(skewed):
    frame, df = skewed
    ranked = brute_ranks(frame)
    found = {(r["g"], r["depth"]): r["hits"] for r in hits_at_depth(df, "y", "p1", "k", DECILES, by=["g"]).collect()}
    for g, part in ranked.groupby("g"):
        for depth in DECILES:
            top = part[part["rank"] <= math.ceil(len(part) * depth)]
            assert found[g, depth] == top["y"].sum()


def test_text_keys(spark, skewed):
    _, df = skewed
    named = df.withColumn("name", F.concat(F.lit("n"), F.col("k").cast("string")))
    ranks = [r["rank"] for r in rank_rows(named, "p1", "name").collect()]
    assert sorted(ranks) == list(range(1, 6001))


def test_gain_grid_under_skew(skewed):
    frame, df = skewed
    found = {(r["g"], r["step"]): r["y"] for r in lift_stability(
        df.withColumnRenamed("g", "period"), "y", "p1", "period", "k", stride=1).withColumnRenamed("period", "g").collect()}
    for g, part in brute_ranks(frame).groupby("g"):
        ranks = part.sort_values("rank").loc[lambda d: d["y"] == 1, "rank"].to_numpy()
        n, p = len(part), len(ranks)
        x = np.concatenate([[0.0], (ranks[:-1] + ranks[1:] - 1) / (2 * n), [1.0]])
        expected = np.interp(np.arange(101) / 100, x, np.arange(p + 1) / p)
        assert [found[g, s] for s in range(101)] == pytest.approx(list(expected))


def test_quantiles_under_skew(skewed):
    frame, df = skewed
    found = {(r["var"], r["prob"]): r["value"] for r in quantiles(df, ["p1", "k"], KNOTS, n_cells=16).collect()}
    for c, p in itertools.product(["p1", "k"], KNOTS):
        assert found[c, p] == pytest.approx(frame[c].quantile(p))


# --- binning against brute force ----------------------------------------------------


def brute_cuts(values, labels):
    def h(part):
        n = len(part)
        return -sum(c / n * math.log2(c / n) for c in np.bincount(part, minlength=2) if c)

    order = np.argsort(values, kind="stable")
    v, y = values[order], labels[order]
    n = len(v)
    best = None
    for i in range(1, n):
        if v[i - 1] == v[i]:
            continue
        gain = round(h(y) - i / n * h(y[:i]) - (n - i) / n * h(y[i:]), 12)
        if best is None or gain > best[0]:
            best = (gain, i)
    if best is None:
        return []
    gain, i = best
    k, k1, k2 = (len(set(part)) for part in (y, y[:i], y[i:]))
    bound = (math.log2(n - 1) + math.log2(3**k - 2) - (k * h(y) - k1 * h(y[:i]) - k2 * h(y[i:]))) / n
    if gain <= bound:
        return []
    return brute_cuts(v[:i], y[:i]) + [(v[i - 1] + v[i]) / 2] + brute_cuts(v[i:], y[i:])


def test_entropy_cuts_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.random(1500).round(3)
    chance = np.select([x < 0.2, x < 0.45, x < 0.5, x < 0.8], [0.1, 0.8, 0.05, 0.5], 0.95)
    y = (rng.random(1500) < chance).astype(int)
    noise = rng.random(1500).round(2)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "noise": noise, "y": y}))
    found = mdl_cuts(df, ["x", "noise"], "y")
    assert found.get("x") == pytest.approx(brute_cuts(x, y))
    assert len(found["x"]) >= 4
    assert found.get("noise", []) == pytest.approx(brute_cuts(noise, y))


def test_bins_apply_to_any_table(spark):
    catalog = Catalog.of([("x", "INPUT", "INTERVAL"), ("y", "TARGET", "BINARY")])
    train = spark.createDataFrame([(float(i), int(i >= 50)) for i in range(100)], "x double, y int")
    model = fit_bins(train, catalog)
    assert model.cuts == {"x": (49.5,)} and model.labels() == {"x": ["< 49.5", ">= 49.5"]}
    test = spark.createDataFrame([(49.4,), (49.5,), (None,), (1e9,)], "x double")
    assert [r["BIN_x"] for r in model.transform(test).collect()] == [0, 1, None, 1]
    assert BinModel.from_json(model.to_json()) == model
    pure = train.withColumn("y", F.lit(1))
    assert fit_bins(pure, catalog).cuts == {}
    assert fit_bins(train.withColumn("id", F.monotonically_increasing_id()), catalog, sample=0.5, key="id").cuts


# --- clusters and selection ---------------------------------------------------------


def test_two_blocks_make_two_clusters(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=400), rng.normal(size=400)
    data = {f"a{i}": a + rng.normal(size=400) * 0.1 for i in range(4)}
    data |= {f"b{i}": b + rng.normal(size=400) * 0.1 for i in range(2)}
    df = spark.createDataFrame(pd.DataFrame(data))
    for method, hyper in (("VariationProportion", 0.8), ("MaxEigenvalue", 1.0)):
        model = cluster_columns(df, list(data), method, hyper)
        groups = {frozenset(r.var for r in model.rows if r.cluster == c) for c in {r.cluster for r in model.rows}}
        assert groups == {frozenset(["a0", "a1", "a2", "a3"]), frozenset(["b0", "b1"])}
        assert len(model.selected()) == 2
    assert model.scores(df).columns == ["PC1_1", "PC1_2"]


def test_single_cluster_and_singletons(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9)], "a double, b double")
    model = cluster_columns(df, ["a", "b"])
    assert {r.cluster for r in model.rows} == {1} and len(model.selected()) == 1
    assert cluster_columns(df, ["a"]).selected() == ["a"]
    with pytest.raises(ValueError):
        split_columns(np.eye(2), "Other", 1.0, 10)


def test_numbering_spreads_large_groups(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "big").otherwise("small").alias("g"), F.format_string("%05d", "id").alias("v"))
    found = number_sorted(df.repartition(5), "g", "v", "n").collect()
    assert all(r["n"] == int(r["v"]) - (0 if r["g"] == "big" else 4000) for r in found) and len(found) == 5000


def test_planted_column_is_most_important(spark):
    df = spark.range(600).select(
        (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.col("id") % 3 * 0.1).alias("signal"),
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("noise"))
    catalog = Catalog.of([("signal", "INPUT", "INTERVAL"), ("noise", "INPUT", "NOMINAL"), ("y", "TARGET", "BINARY")])
    tree = tree_selection(df, catalog, 0.1, "value", max_depth=4)
    assert tree.rejected == ("noise",) and tree.catalog(catalog).inputs() == ["signal"]
    forest = forest_selection(df, catalog, 0.5, "percentage", max_depth=4)
    assert dict(forest.importance)["signal"] > dict(forest.importance)["noise"] and forest.rejected == ("noise",)


# --- plans --------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_applying_a_preparation_moves_no_rows(spark, folder, tmp_path):
    order_obs(spark, folder).write.parquet(str(tmp_path / "obs"))
    obs = spark.read.parquet(str(tmp_path / "obs"))
    prep = fit_preparation(obs, order_catalog(), "obs_id", max_depth=4, trees=3)
    scored = prep.transform(obs).select("obs_id", *prep.catalog.inputs())
    text = plan_of(scored)
    assert "Exchange" not in text and "Python" not in text
    assert "cust_code" not in text.split("ReadSchema")[1]
    assert scored.count() == obs.count()


def test_streams_take_the_same_steps(spark, folder, tmp_path):
    from prepline.streaming import write_prepared

    order_obs(spark, folder).repartition(3).write.parquet(str(tmp_path / "in"))
    obs = spark.read.parquet(str(tmp_path / "in"))
    prep = fit_preparation(obs, order_catalog(), "obs_id", forest=False, cluster=False)
    stream = spark.readStream.schema(obs.schema).parquet(str(tmp_path / "in"))
    write_prepared(stream, prep, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(found.collect(), key=str) == sorted(prep.transform(obs).collect(), key=str)


def test_lift_reads_three_columns_and_orders_only_open_cells(spark, folder):
    obs = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("p1"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    text = plan_of(hits_at_depth(obs, "y", "p1", "o_orderkey", [0.1]))
    assert "o_custkey" not in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_gain_grid_ignores_layout(spark, folder):
    df = scored_orders(spark, folder)
    one, many = (gain_grid(df.repartition(n), LABEL, "p1", "obs_id").orderBy("step").collect() for n in (1, 5))
    assert one == many
