"""Merged fit states, ranges that follow the data, pipelines, many columns, streams."""

import datetime

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from prepline import ml
from prepline.operators.cluster import cluster_columns, correlation_matrix
from prepline.operators.encode import fit_scales
from prepline.operators.fit_state import StateBook, close_ranks, measure, merged
from prepline.operators.lift import LiftEvaluator
from prepline.operators.profile import level_profile, modes
from prepline.operators.stability import decile_stability
from prepline.operators.wide import cluster_vectors, correlation_blocks, vectors_of
from prepline.plans.flow import fit_preparation
from prepline.plans.observations import LABEL, event_obs, order_catalog, order_obs
from prepline.sources import range_predicates
from prepline.streaming.stability import cell_counts, closed_counts, decile_report, gain_report, rate_report, score_cells, write_counts

NUMBERS, NAMED = ["total_price", "acctbal", "mostly_missing"], ["segment", "nation"]


@pytest.fixture(scope="module")
def obs(spark, folder):
    return order_obs(spark, folder).cache()


# fit states ------------------------------------------------------------------------


def test_merged_state_is_the_state_of_the_union(spark, obs, tmp_path):
    book = StateBook.at(spark, str(tmp_path))
    slices = [obs.filter(F.col("obs_id") % 5 == i) for i in range(4)] + [obs.filter((F.col("obs_id") % 5 == 4)), obs.limit(0)]
    for i, part in enumerate(slices):
        book.put(f"p{i}", measure(part, NUMBERS, NAMED))
    found, whole = book.merged([f"p{i}" for i in range(len(slices))]), measure(obs, NUMBERS, NAMED)
    assert sorted(found.levels.collect(), key=str) == sorted(level_profile(obs, NAMED).collect(), key=str)
    assert sorted(found.modes().collect()) == sorted(modes(level_profile(obs, NAMED)).collect())
    a, b = ({r["var"]: r for r in s.moments.collect()} for s in (found, whole))
    for v in NUMBERS:
        assert [a[v][c] for c in ("n_rows", "n", "low", "high")] == [b[v][c] for c in ("n_rows", "n", "low", "high")]
        assert a[v]["mean"] == pytest.approx(b[v]["mean"]) and a[v]["m2"] == pytest.approx(b[v]["m2"], rel=1e-9)
    for method in ("Range", "Z Score", None):
        expected, scales = fit_scales(obs, NUMBERS, method), found.scales(method)
        assert set(expected) == set(scales)
        for v in expected:
            assert (scales[v].shift, scales[v].span) == pytest.approx((expected[v].shift, expected[v].span), rel=1e-9)
    near = close_ranks(found.quantiles([0.0, 0.01, 0.25, 0.5, 0.99, 1.0]), obs).collect()
    assert len(near) == 6 * len(NUMBERS) and all(r["near"] for r in near)
    shares = {r["var"]: r["missing_share"] for r in found.missing().collect()}
    assert shares["acctbal"] == pytest.approx(obs.filter("acctbal IS NULL").count() / obs.count()) and set(shares) == {*NUMBERS, *NAMED}


def test_states_merge_in_any_grouping_and_a_part_can_be_measured_again(spark, obs, tmp_path):
    parts = [measure(obs.filter(F.col("obs_id") % 3 == i), NUMBERS, NAMED) for i in range(3)]
    left, right = merged([merged(parts[:2]), parts[2]]), merged(parts[::-1])
    assert sorted(left.levels.collect(), key=str) == sorted(right.levels.collect(), key=str)
    assert [r["n"] for r in left.moments.orderBy("var").collect()] == [r["n"] for r in right.moments.orderBy("var").collect()]
    book = StateBook.at(spark, str(tmp_path))
    book.put("day", parts[0])
    book.put("day", parts[1])
    assert sorted(book.get("day").levels.collect(), key=str) == sorted(parts[1].levels.collect(), key=str)
    empty = measure(obs.limit(0), NUMBERS, NAMED)
    assert merged([empty]).scales("Range")["acctbal"].shift is None and merged([empty]).quantiles([0.5]).count() == 0


# ranges ----------------------------------------------------------------------------


@pytest.mark.parametrize("column, tie", [("acctbal", None), ("period_dt", None), ("obs_id", None), ("n_lines", "obs_id"), ("heavy", "signed"), ("heavy", None), ("none", None)])
@pytest.mark.parametrize("parts", [1, 4, 9])
def test_every_row_is_in_one_range(obs, column, tie, parts):
    rows = obs.withColumns({"heavy": F.when(F.col("obs_id") % 3 > 0, F.lit(-5.0)).otherwise(F.col("acctbal")),
                            "signed": F.when(F.col("obs_id") % 11 > 0, F.col("obs_id") - 700), "none": F.lit(None).cast("int")}).cache()
    found = range_predicates(rows, column, parts, tie)
    sizes = rows.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(found)]).first()
    held_by = sum((F.when(F.expr(p), 1).otherwise(0) for p in found), F.lit(0))
    assert rows.filter(held_by != 1).count() == 0 and sum(sizes) == rows.count()
    if column in ("acctbal", "obs_id") and parts > 1:
        assert max(sizes[:-1]) <= 1.3 * rows.count() / parts + 5
    if column == "heavy" and tie and parts == 9:
        assert max(sizes) <= rows.count() / 4
    with pytest.raises(ValueError):
        range_predicates(rows, column, 0)


# pipelines -------------------------------------------------------------------------


def test_a_saved_pipeline_gives_equal_rows(spark, obs, tmp_path):
    stages = [ml.PrepareInputs(catalog=order_catalog().to_json(), key="obs_id", forest=False), ml.EncodeInputs(keep=["obs_id"]),
              LogisticRegression(maxIter=5, regParam=0.01)]
    fitted = Pipeline(stages=stages).fit(obs)
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    rows = lambda m: sorted((r["obs_id"], r["features"], r["probability"]) for r in m.transform(obs).select("obs_id", "features", "probability").collect())
    assert [r[:1] + tuple(map(tuple, r[1:])) for r in rows(fitted)] == [r[:1] + tuple(map(tuple, r[1:])) for r in rows(again)]
    assert fitted.stages[0].state == fit_preparation(obs, order_catalog(), "obs_id", forest=False)
    Pipeline(stages=stages).write().overwrite().save(str(tmp_path / "plain"))
    loaded = Pipeline.load(str(tmp_path / "plain")).getStages()
    assert loaded[0].getOrDefault("forest") is False and loaded[1].getOrDefault("keep") == ["obs_id"]


def test_the_preparation_is_tuned_inside_a_cross_validator(obs):
    prepare, encode = ml.PrepareInputs(catalog=order_catalog().to_json(), key="obs_id", forest=False, cluster=False), ml.EncodeInputs(keep=["obs_id"])
    learner = LogisticRegression(maxIter=5, regParam=0.01)
    grid = ParamGridBuilder().addGrid(prepare.rareShare, [0.001, 0.05]).addGrid(encode.inputScale, ["Range", "None"]).build()
    found = CrossValidator(estimator=Pipeline(stages=[prepare, encode, learner]), estimatorParamMaps=grid, numFolds=2, seed=3,
                           evaluator=LiftEvaluator(key="obs_id", depth=0.2)).fit(obs)
    assert len(found.avgMetrics) == 4 and max(found.avgMetrics) > 1.5
    assert found.bestModel.transform(obs).count() == obs.count()
    with pytest.raises(ValueError):
        encode.fit(obs)


# many columns ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def groups(spark):
    """24 columns in four correlated groups, two near-copies, and one constant column."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 4))
    x = np.hstack([base[:, [i % 4]] * (1 + i) + rng.normal(size=(400, 1)) * (0.2 + 0.1 * (i % 5)) for i in range(24)] + [np.full((400, 1), 3.0)])
    names = [f"c{i}" for i in range(25)]
    return spark.createDataFrame(x.tolist(), names).cache(), names


@pytest.mark.parametrize("method, hyper", [("VariationProportion", 0.8), ("VariationProportion", 0.97), ("MaxEigenvalue", 0.7)])
def test_power_iteration_finds_the_clusters_of_the_matrix(groups, method, hyper):
    df, names = groups
    few, many = cluster_columns(df, names, method, hyper), cluster_vectors(vectors_of(df, names), names, method, hyper)
    assert [(r.cluster, r.var, r.selected) for r in many.rows] == [(r.cluster, r.var, r.selected) for r in few.rows]
    for a, b in zip(many.rows, few.rows):
        assert (a.r2_own, a.r2_next) == pytest.approx((b.r2_own, b.r2_next), abs=1e-6)
    assert [p.variables for p in many.components] == [p.variables for p in few.components]
    for a, b in zip(many.components, few.components):
        assert a.weights == pytest.approx(b.weights, abs=1e-5)


@pytest.mark.parametrize("block", [4, 7, 64])
def test_blocks_are_the_matrix(groups, block):
    df, names = groups
    out = np.zeros((25, 25))
    for r in correlation_blocks(vectors_of(df.repartition(5), names), 25, block).collect():
        part = np.array(r["values"]).reshape(r["size_i"], r["size_j"])
        out[r["i"] * block : r["i"] * block + r["size_i"], r["j"] * block : r["j"] * block + r["size_j"]] = part
        out[r["j"] * block : r["j"] * block + r["size_j"], r["i"] * block : r["i"] * block + r["size_i"]] = part.T
    assert out == pytest.approx(correlation_matrix(df, names), abs=1e-9)


def test_twenty_thousand_columns(spark):
    width = 20_000
    rows = spark.range(60).repartition(4).select(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda c: (
        F.sin(F.col("id") * (1 + c % 3)) + 0.01 * F.cos(F.col("id") * 7.3 + c))).alias("x"))
    model = cluster_vectors(rows, [f"c{i}" for i in range(width)], hyper=0.9)
    by = {}
    for r in model.rows:
        by.setdefault(r.cluster, set()).add(int(r.var[1:]) % 3)
    assert len(by) == 3 and all(len(v) == 1 for v in by.values()) and len(model.rows) == width


def test_missing_values_are_refused(spark):
    with pytest.raises(Exception, match="cannot be correlated"):
        cluster_vectors(vectors_of(spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double"), ["a", "b"]), ["a", "b"])


# streams ---------------------------------------------------------------------------


def test_closed_periods_equal_the_batch_report(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").alias("k"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "purchase").cast("int").alias("y"),
        (((F.col("event_id") * 7919) % 1000) / 1000).alias("p1")).cache()
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    span = (last - first).total_seconds() / 3
    for i in range(3):  # each slice holds some rows of the end of the one before
        late = F.when(F.col("k") % 5 == 0, 3 * 3600).otherwise(0)
        own = F.least(F.floor((F.unix_timestamp("ts") - F.lit(int(first.timestamp())) + late) / span), F.lit(2)) == i
        events.filter(own).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    far = spark.createDataFrame([(-1, last + datetime.timedelta(days=9), 0, 0.5)], events.schema)
    far.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    plan = score_cells(events, "p1", "k")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    args = ("y", "p1", "ts", plan, "1 day")
    write_counts(stream, *args, "6 hours", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found, batch = closed_counts(spark, str(tmp_path / "out")).cache(), cell_counts(events, *args).cache()
    assert sorted(found.collect()) == sorted(batch.collect())
    for report in (decile_report, gain_report, rate_report):
        assert sorted(map(str, report(found).collect())) == sorted(map(str, report(batch).collect()))
    write_counts(stream, *args, "6 hours", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()  # nothing new
    assert closed_counts(spark, str(tmp_path / "out")).count() == batch.count()
    exact = {(r["period_dt"], r["depth"]): r["hits"] for r in decile_stability(event_obs(spark, folder), "ev_target_ind", "p1", "period_dt", "obs_id", stride=1).collect()}
    for r in decile_report(found).withColumn("d", F.to_date("period")).collect():
        assert abs(r["hits"] - exact[r["d"], r["depth"]]) <= 2


def test_reports_of_awkward_counts(spark):
    day = datetime.datetime(2024, 1, 1)
    counts = spark.createDataFrame([(day, 0, 4, 4), (day, 3, 6, 0), (day + datetime.timedelta(days=1), 2, 5, 0)], "period timestamp, __cell int, n bigint, n_pos bigint")
    rows = {(r["period"], r["depth"]): (r["hits"], r["lift"]) for r in decile_report(counts).collect()}
    assert rows[day, 0.4] == (4.0, 2.5) and rows[day, 0.1] == (1.0, 2.5) and rows[day, 1.0] == (4.0, 1.0)
    assert rows[day + datetime.timedelta(days=1), 0.5][1] is None
    gains = {r["step"]: r["y"] for r in gain_report(counts).collect()}
    assert len(gains) == 101 and gains[0] == 0 and gains[40] == 1 == gains[100] and gains[20] == pytest.approx(0.5)
    assert decile_report(counts.limit(0)).count() == 0
