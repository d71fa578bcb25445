"""Hand-computed answers at the edges."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from prepline.catalog import Catalog, assign_roles
from prepline.operators.encode import fit_prep, fit_scales
from prepline.operators.impute import ImputeModel, fit_impute
from prepline.operators.importance import reject_by_percentage, reject_by_value
from prepline.operators.levels import GroupModel, ReplaceModel, fit_group_rare, fit_replace, new_levels
from prepline.operators.lift import cum_lift, gain_curve, gain_grid, gain_midpoints, lift
from prepline.operators.profile import level_profile, missing_profile, modes
from prepline.operators.quantiles import quantiles
from prepline.operators.sampling import assign_sample, exact_split
from prepline.operators.screen import class_level_filter, missing_filter
from prepline.operators.search import grid, sample_settings, top_settings
from prepline.operators.stability import decile_stability, keep_periods, period_table, target_rate
from prepline.operators.thresholds import (
    best_threshold, classification_report, confusion_matrix, fbeta, hard_auc, hard_average_precision, kappa,
    label_at, threshold_sweep,
)


def one_column(spark, kind, *values):
    return spark.createDataFrame(list(enumerate(values)), f"id bigint, x {kind}")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


# --- catalog ---------------------------------------------------------------------


def test_catalog_changes_make_new_catalogs():
    first = Catalog.of([("a", "INPUT", "INTERVAL"), ("y", "TARGET", "BINARY")])
    second = first.derive("IMP_", ["a"])
    assert first.inputs() == ["a"]
    assert second.inputs() == ["IMP_a"] and second["a"].role == "REJECTED" and second["IMP_a"].parent == "a"
    assert Catalog.from_json(second.to_json()) == second
    with pytest.raises(ValueError):
        second.derive("IMP_", ["a"])
    with pytest.raises(ValueError):
        first.reject(["nowhere"])
    with pytest.raises(ValueError):
        first.reject(["y"]).target()


def test_roles_by_list_then_majority(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, m_target_ind int, M_SCORE_IND int, cts int")
    ref = spark.createDataFrame(
        [("a", "INPUT", "ORDINAL"), ("a", "INPUT", "NOMINAL"), ("a", "REJECTED", "NOMINAL"),
         ("A", "TARGET", "BINARY"), ("cts", "INPUT", "NOMINAL")],
        "ALIAS_NM string, ROLE_NM string, LEVEL_NM string")
    found = assign_roles(df, ref, "m", reject_interval=["cts "])
    assert [(v.name, v.role, v.level) for v in found.variables] == [
        ("a", "INPUT", "NOMINAL"), ("m_target_ind", "TARGET", "BINARY"),
        ("M_SCORE_IND", "REJECTED", "BINARY"), ("cts", "REJECTED", "INTERVAL")]
    with pytest.raises(ValueError, match="a"):
        assign_roles(df, ref.filter("ALIAS_NM = 'cts'"), "m")


# --- profiles --------------------------------------------------------------------


def test_mode_takes_smallest_of_equals_and_ignores_missing(spark):
    df = one_column(spark, "string", "b", "a", None, None, None, "b", "a")
    assert as_dict(modes(level_profile(df, ["x"])), "var", "mode") == {"x": "a"}
    empty = one_column(spark, "string", None, None)
    assert as_dict(modes(level_profile(empty, ["x"])), "var", "mode") == {"x": None}


def test_quantiles_interpolate(spark):
    df = one_column(spark, "double", 1.0, 2.0, None, 4.0, 10.0, float("nan"))
    found = as_dict(quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]), "prob", "value")
    assert found == pytest.approx({0.0: 1.0, 0.25: 1.75, 0.5: 3.0, 0.9: 8.2, 1.0: 10.0})
    assert as_dict(quantiles(one_column(spark, "double", 7.0), ["x"], [0.3]), "prob", "value") == {0.3: 7.0}
    assert quantiles(one_column(spark, "double", None, None), ["x"]).count() == 0


def test_nan_counts_as_missing(spark):
    df = one_column(spark, "double", 1.0, None, float("nan"), 2.0)
    assert as_dict(missing_profile(df, ["x"]), "var", "missing_share") == {"x": 0.5}


def test_screens_are_strict_and_count_missing_as_a_level(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1.0, None), (2.0, "a")], "x double, c string")
    catalog = Catalog.of([("x", "INPUT", "INTERVAL"), ("c", "INPUT", "NOMINAL")])
    assert missing_filter(df, catalog, 0.5).inputs() == ["x", "c"]
    assert missing_filter(df, catalog, 0.49).inputs() == ["c"]
    assert class_level_filter(df, catalog, 3).inputs() == ["x", "c"]
    assert class_level_filter(df, catalog, 2).inputs() == ["x"]


def test_class_level_filter_around_the_limit(spark):
    df = spark.range(1000).select(*[(F.col("id") % n).cast("string").alias(f"c{n}") for n in (199, 200, 201, 1000)])
    catalog = Catalog.of([(c, "INPUT", "NOMINAL") for c in df.columns])
    assert class_level_filter(df, catalog, 200).inputs() == ["c199", "c200"]


# --- imputation ------------------------------------------------------------------


def impute_catalog():
    return Catalog.of([("i", "INPUT", "INTERVAL"), ("e", "INPUT", "INTERVAL"), ("o", "INPUT", "ORDINAL"),
                       ("n", "INPUT", "NOMINAL"), ("b", "INPUT", "BINARY")])


def test_impute_fills_and_round_trips(spark):
    rows = [(1, 1.0, None, 3, "u", "Y"), (2, None, None, None, None, None), (3, 5.0, None, 1, "v", "Y")]
    df = spark.createDataFrame(rows, "id bigint, i double, e double, o int, n string, b string")
    model = fit_impute(df, impute_catalog(), "id")
    row = model.transform(df).filter("id = 2").first()
    assert 1.0 <= row["IMP_i"] <= 5.0
    assert (row["IMP_e"], row["IMP_o"], row["IMP_n"], row["IMP_b"]) == (None, 0, "Missing", "Y")
    assert model.catalog(impute_catalog()).inputs() == ["IMP_i", "IMP_e", "IMP_o", "IMP_n", "IMP_b"]
    again = ImputeModel.from_json(model.to_json())
    assert again.transform(df).collect() == model.transform(df).collect()
    assert model.transform(df, keep="derived").columns == ["id", "IMP_i", "IMP_e", "IMP_o", "IMP_n", "IMP_b"]
    with pytest.raises(ValueError, match="unknown method"):
        fit_impute(df, impute_catalog(), "id", interval_method="Mean")


# --- levels ----------------------------------------------------------------------


def nominal(*names):
    return Catalog.of([(n, "INPUT", "NOMINAL") for n in names])


def test_one_rare_level_is_left_alone_and_null_can_be_rare(spark):
    common = ["a"] * 6
    two = spark.createDataFrame([(v,) for v in [*common, "r", None]], "x string")
    one = spark.createDataFrame([(v,) for v in [*common, "r"]], "x string")
    model = fit_group_rare(two, nominal("x"), 0.2)
    assert model.levels.inline == {"x": ("r", None)}
    assert fit_group_rare(one, nominal("x"), 0.2).levels.names == []
    test = one_column(spark, "string", "a", "r", None, "new")
    assert as_dict(model.transform(test), "id", "BIN_x") == {0: "a", 1: "_OTHER_", 2: "_OTHER_", 3: "new"}
    assert GroupModel.from_json(model.to_json()) == model


def test_unseen_level_becomes_the_mode(spark):
    train = one_column(spark, "string", "a", "a", "b")
    test = one_column(spark, "string", "a", "b", "c", None)
    model = fit_replace(train, nominal("x"))
    assert as_dict(model.transform(test), "id", "REP_x") == {0: "a", 1: "b", 2: "a", 3: "a"}
    assert {r["level"] for r in new_levels(test, model).collect()} == {"c", None}
    with_null = fit_replace(one_column(spark, "string", "a", None), nominal("x"))
    assert as_dict(with_null.transform(test), "id", "REP_x")[3] is None
    assert ReplaceModel.from_json(model.to_json()) == model


def test_long_level_lists_are_joined(spark):
    train = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("v"), F.col("id").cast("string"))).alias("x"))
    model = fit_replace(train, nominal("x"))
    assert model.levels.stored == ("x",)
    test = one_column(spark, "string", "hot", "v1", "v2", None, *["hot"] * 50)
    found = as_dict(model.transform(test), "id", "REP_x")
    assert (found[0], found[1], found[2], found[3], len(found)) == ("hot", "v1", "hot", "hot", 54)
    again = ReplaceModel.from_json(model.to_json(), model.tables())
    assert as_dict(again.transform(test), "id", "REP_x") == found
    with pytest.raises(ValueError, match="table"):
        ReplaceModel.from_json(model.to_json())


def test_long_level_lists_become_one_vector(spark):
    train = spark.range(1500).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("x"), F.lit(1).alias("y"))
    model = fit_prep(train, Catalog.of([("x", "INPUT", "NOMINAL"), ("y", "TARGET", "BINARY")]))
    rows = one_column(spark, "string", "v0000", "v0001", "v1499", "other", None).withColumn("y", F.lit(0))
    found = {r["id"]: r["x_levels"] for r in model.transform(rows, ["id"]).collect()}
    assert {len(v) for v in found.values()} == {1499}
    assert {i: v.indices.tolist() for i, v in found.items()} == {0: [], 1: [0], 2: [1498], 3: [], 4: []}
    again = type(model).from_json(model.to_json(), model.tables())
    assert {r["id"]: r["features"] for r in again.features(rows, ["id"]).collect()} == found


def test_missing_scores_are_labelled_zero(spark):
    rows = spark.createDataFrame([(1, 1, 0.9), (2, 0, None), (3, 1, float("nan")), (4, 0, 0.2)], "id bigint, y int, p1 double")
    sweep = threshold_sweep(rows, "y", 1 - F.col("p1"), [0.5, 0.9, 1.0]).orderBy("j").collect()
    assert [(r["tp"], r["fp"], r["fn"], r["tn"]) for r in sweep] == [(1, 0, 1, 2), (1, 1, 1, 1), (1, 1, 1, 1)]
    labelled = rows.withColumn("z", label_at(1 - F.col("p1"), 0.5))
    assert sum(r["n"] for r in confusion_matrix(labelled, "y", "z").collect()) == 4


def test_nominal_codes_become_text(spark):
    catalog = Catalog.of([("x", "INPUT", "NOMINAL")])
    train = one_column(spark, "int", 3, 3, None, *range(100, 2200))
    filled = fit_impute(train, catalog, "id").transform(train)
    assert as_dict(filled, "id", "IMP_x")[2] == "Missing" and as_dict(filled, "id", "IMP_x")[0] == "3"
    pooled = fit_group_rare(train, catalog, 0.0008).transform(train)
    assert as_dict(pooled, "id", "BIN_x")[0] == "3" and as_dict(pooled, "id", "BIN_x")[5] == "_OTHER_"
    replaced = fit_replace(train, catalog).transform(one_column(spark, "int", 3, 7))
    assert as_dict(replaced, "id", "REP_x") == {0: "3", 1: "3"}


# --- encoding --------------------------------------------------------------------


def test_dummies_follow_training_levels(spark):
    catalog = Catalog.of([("x", "INPUT", "NOMINAL"), ("y", "TARGET", "BINARY")])
    train = spark.createDataFrame([("b", 1), ("a", 0), ("c d", 0), (None, 1)], "x string, y int")
    test = spark.createDataFrame([("z", 1), ("b", 0), (None, 0)], "x string, y int")
    out = fit_prep(train, catalog).transform(test)
    assert out.columns == ["y", "x_b", "x_c d"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 0)]


def test_yes_no_and_scales(spark):
    catalog = Catalog.of([("f", "INPUT", "BINARY"), ("i", "INPUT", "INTERVAL"), ("k", "INPUT", "INTERVAL"),
                          ("y", "TARGET", "BINARY")])
    train = spark.createDataFrame([("Y", 0.0, 3.0, 1), ("N", 10.0, 3.0, 0)], "f string, i double, k double, y int")
    test = spark.createDataFrame([("?", 20.0, 4.0, 1)], train.schema)
    model = fit_prep(train, catalog)
    assert tuple(model.transform(test).first()) == (1, None, 3.0, 1.0)
    assert [r["f"] for r in model.transform(train).collect()] == [1, 0]
    assert type(model).from_json(model.to_json()) == model
    z = fit_scales(train, ["i", "k"], "Z Score")
    assert (z["i"].shift, z["i"].span, z["k"].span) == (5.0, 5.0, 0.0)
    with pytest.raises(ValueError):
        fit_scales(train, ["i"], "Log")


# --- lift and gain ---------------------------------------------------------------


def scores(spark, rows):
    return spark.createDataFrame(rows, "id bigint, y int, p1 double")


def test_lift_divides_by_depth_not_by_rows_taken(spark):
    df = scores(spark, [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7), (4, 0, 0.1), (5, 0, 0.1)])
    assert lift(df, "y", "p1", "id", 0.3).first()["lift"] == pytest.approx(1 / (2 * 0.3))  # ceil(1.5) = 2 rows
    assert cum_lift(df, "y", "p1", "id", 0.6).first()["cum_lift"] == 1.0
    assert lift(df, "y", "p1", "id", 1.0).first()["lift"] == 1.0


def test_ties_go_by_key_and_missing_scores_come_last(spark):
    df = scores(spark, [(3, 1, 0.5), (1, 0, 0.5), (2, 1, 0.5), (0, 1, None), (4, 0, float("nan"))])
    found = lift(df, "y", "p1", "id", 0.4).first()
    assert found["hits"] == 1
    assert lift(df, "y", "p1", "id", 0.6).first()["hits"] == 2


def test_no_positives_gives_null(spark):
    df = scores(spark, [(1, 0, 0.5), (2, 0, 0.4)])
    assert lift(df, "y", "p1", "id").first()["lift"] is None
    assert gain_grid(df, "y", "p1", "id").count() == 0
    assert [r["gain"] for r in gain_curve(df, "y", "p1", "id").orderBy("rank").collect()] == [0.0, None, None]


def test_gain_plateaus(spark):
    df = scores(spark, [(i, int(i in (2, 5)), 1 - i / 10) for i in range(1, 9)])  # ranks 2 and 5 of 8
    found = [(r["x"], r["gain"]) for r in gain_midpoints(df, "y", "p1", "id").orderBy("k").collect()]
    assert found == [(0.0, 0.0), (6 / 16, 0.5), (1.0, 1.0)]
    curve = as_dict(gain_grid(df, "y", "p1", "id", steps=8), "step", "y")
    assert len(curve) == 9 and curve[0] == 0 and curve[8] == 1 and curve[3] == pytest.approx(0.5)
    single = scores(spark, [(1, 0, 0.9), (2, 1, 0.8)])
    assert as_dict(gain_grid(single, "y", "p1", "id", steps=4), "x", "y") == {k / 4: k / 4 for k in range(5)}


# --- periods ---------------------------------------------------------------------


def periods(spark):
    day = datetime.date
    rows = [(1, 1, 0.9, day(2020, 1, 5)), (2, 0, 0.8, day(2020, 2, 5)), (3, 0, 0.7, day(2020, 3, 5)),
            (4, 1, 0.6, day(2021, 1, 6)), (5, 0, 0.5, day(2021, 1, 6)), (6, 0, 0.4, None)]
    return spark.createDataFrame(rows, "id bigint, y int, p1 double, d date")


def test_stride_keeps_the_first_period(spark):
    df = periods(spark)
    assert [r["d"].month for r in period_table(df, "d", 2).orderBy("d").collect()] == [1, 3]
    assert keep_periods(df, "d", 1).count() == 5
    assert {r["id"] for r in keep_periods(df, "d", 3).collect()} == {1, 4, 5}


def test_months_of_different_years_merge_only_on_request(spark):
    df = periods(spark)
    by_month = as_dict(target_rate(df, "y", "d", by_month=True), "d", "n")
    assert by_month[datetime.date(2021, 1, 1)] == 2 and len(by_month) == 4
    merged = as_dict(target_rate(df, "y", "d", calendar_month=True), "d", "target_pct")
    assert merged == {1: 66.67, 2: 0.0, 3: 0.0}
    found = decile_stability(df, "y", "p1", "d", "id", calendar_month=True).filter("d = 1 and depth = 1.0").first()
    assert (found["n"], found["lift"]) == (3, 1.0)


# --- thresholds ------------------------------------------------------------------


def test_sweep_is_strict_and_metrics_match_definitions(spark):
    df = scores(spark, [(1, 1, 0.75), (2, 0, 0.75), (3, 1, 0.5), (4, 0, 0.25)])
    sweep = threshold_sweep(df, "y", 1 - F.col("p1"), [0.1, 0.25, 0.3, 0.6])
    table = sweep.select("*", fbeta().alias("f"), kappa().alias("k"), hard_auc().alias("a"),
                         hard_average_precision().alias("ap")).orderBy("j").collect()
    assert [(r["tp"], r["fp"], r["fn"], r["tn"]) for r in table] == [(0, 0, 2, 2), (0, 0, 2, 2), (1, 1, 1, 1), (2, 1, 0, 1)]
    assert [r["f"] for r in table] == pytest.approx([0, 0, 0.5, 0.8])
    assert [r["k"] for r in table] == pytest.approx([0, 0, 0, 0.5])
    assert [r["a"] for r in table] == pytest.approx([0.5, 0.5, 0.5, 0.75])
    assert [r["ap"] for r in table] == pytest.approx([0.5, 0.5, 0.5, 2 / 3])
    assert best_threshold(sweep, "roc_auc_score").first()["j"] == 3
    assert best_threshold(sweep.filter("j < 2"), "fbeta_score").first()["j"] == 0
    with pytest.raises(ValueError):
        best_threshold(sweep, "accuracy")


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, z int")
    assert {(r["label"], r["predicted"]): r["n"] for r in confusion_matrix(df, "y", "z").collect()} == {
        (0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    rows = {r["row"]: r for r in classification_report(df, "y", "z").collect()}
    assert rows["1"]["recall"] == 0.5 and rows["0"]["precision"] == pytest.approx(2 / 3)
    assert rows["accuracy"]["f1"] == 0.75 and rows["macro avg"]["support"] == 4


# --- selection and search ----------------------------------------------------------


def test_importance_cut_offs(spark):
    table = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2), ("d", 0.0)], "var string, importance double")
    assert as_dict(reject_by_value(table, 0.3), "var", "rejected") == {"a": False, "b": False, "c": True, "d": True}
    assert as_dict(reject_by_percentage(table, 0.5), "var", "rejected") == {"a": False, "b": False, "c": True, "d": True}
    assert as_dict(reject_by_percentage(table, 1.0), "var", "rejected") == {"a": False, "b": False, "c": False, "d": True}


def test_settings():
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert len(grid(space)) == 6 and grid(space)[0] == {"a": 1, "b": "x"}
    some = sample_settings(space, 4)
    assert len({tuple(s.items()) for s in some}) == 4 and some == sample_settings(space, 4)
    assert len(sample_settings(space, 99)) == 6


def test_top_settings_keeps_equals(spark):
    table = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0), (3, 0.5), (4, None)], "setting int, score double")
    assert {r["setting"] for r in top_settings(table, 2).collect()} == {1, 2}


# --- samples ---------------------------------------------------------------------


def test_samples_have_their_shares_and_ignore_layout(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    one = as_dict(assign_sample(df.repartition(1), "k"), "k", "sample")
    many = as_dict(assign_sample(df.repartition(7), "k"), "k", "sample")
    assert one == many
    assert sum(v == "test" for v in one.values()) / 20_000 == pytest.approx(0.1, abs=0.01)


@pytest.mark.parametrize("size", [0, 1, 777, 2000, 5000])
def test_exact_split_is_exact(spark, size):
    df = spark.range(2000).withColumnRenamed("id", "k")
    assert exact_split(df, "k", size=size).filter("in_sample").count() == min(size, 2000)
    assert math.floor(2000 * 0.4) == exact_split(df, "k", share=0.4).filter("in_sample").count()
