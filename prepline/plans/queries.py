"""Every operator as a query over the tables of a folder.

Each entry takes ``(spark, folder)`` and returns a frame. Results that depend on
the order of additions are rounded so that engines agree; ratios of counts are not.
"""

from __future__ import annotations

import datetime
import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepline.catalog import INPUT, INTERVAL, ORDINAL, Catalog, role_table
from prepline.functions import keyed_uniform, log_grid
from prepline.operators import search
from prepline.operators.cluster import cluster_columns, correlation_matrix, correlation_table
from prepline.operators.discretize import class_histogram, first_cuts, fit_bins, mdl_cuts
from prepline.operators.encode import fit_prep
from prepline.operators.importance import (
    encoded_inputs, forest_selection, label_codes, recounted_importance, reject_by_percentage, reject_by_value, tree_selection,
)
from prepline.operators.fit_state import FitState, StateBook, close_ranks, measure
from prepline.operators.impute import ImputeModel, fit_impute
from prepline.operators.levels import ReplaceModel, fit_group_rare, fit_replace, level_set, new_levels, rare_levels
from prepline.operators.lift import cum_lift, gain_curve, gain_grid, gain_midpoints, hits_at_depth, lift_value
from prepline.operators.logit_path import chances, design
from prepline.operators.profile import distinct_levels, level_profile, missing_profile, modes, one_row_per_column
from prepline.operators.net import NetModel
from prepline.operators.quantiles import KNOTS, quantiles, quantiles_approx
from prepline.operators.rank import rank_rows
from prepline.operators.sampling import assign_fold, assign_sample, exact_split, train_test_split
from prepline.operators.screen import class_level_approx, class_level_filter, class_level_screen, missing_filter
from prepline.operators.stability import decile_stability, lift_stability, period_table, target_rate
from prepline.operators.thresholds import (
    classification_report, confusion_matrix, fbeta, hard_auc, hard_average_precision, kappa, label_at, threshold_sweep,
)
from prepline.operators.trees import Forest, leaf_rows, out_of_bag_score
from prepline.plans.flow import Preparation, fit_preparation
from prepline.plans.observations import (
    LABEL, MODEL, event_obs, marked_catalog, marked_obs, order_catalog, order_obs, order_reference, scored_orders, wide_embeddings,
)
from prepline.session import held, shared_folder
from prepline.sources import StageStore, extract, range_predicates, read_table
from prepline.streaming.stability import closed_counts, decile_report, gain_report, rate_report, score_cells, write_counts

KEY, PERIOD, SCORE = "obs_id", "period_dt", "p1"
INTERVALS = ["total_price", "acctbal", "sum_qty", "max_price", "mostly_missing", "planted"]
ORDINALS = ["prio_rank", "n_lines"]
NOMINALS = ["segment", "nation", "cust_code"]
BINARIES = ["rich_flag"]
LIFT_DEPTHS = (0.05, 0.1, 0.15, 0.2, 0.25)
THRESHOLDS = [0.7 + 0.3 * j / 999 for j in range(1000)]
EXTRACT = "SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS top FROM {orders} GROUP BY o_orderpriority"
WEIGHTS = (0.0, 0.25, 0.5, 0.75, 1.0)
LEVEL_LIMIT = 100

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_q")] = fn
    return fn


def r6(c: str | Column) -> Column:
    """Six decimals, and no negative zero."""
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(F.col(f"`{n}`")) for n in names})


def _catalog(*names: str) -> Catalog:
    """The order catalog with only the named inputs left as inputs."""
    catalog = order_catalog()
    return catalog.reject(n for n in catalog.inputs() if n not in names)


def _stored_obs(spark: SparkSession, folder: str) -> DataFrame:
    """The joined table, held by column for fits that read it several times, a few columns each.

    Spark keeps one copy of the same plan, whichever query asks first; lost parts come from the plan again.
    """
    return order_obs(spark, folder).persist(StorageLevel.MEMORY_AND_DISK)


def _dealt(rows: DataFrame, folder: str) -> DataFrame:
    """The same rows; dealt to all cores by key where the orders come in fewer pieces, for searches that read them many times."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    pieces = rows.sparkSession.read.parquet(f"{folder}/orders.parquet").rdd.getNumPartitions()
    return rows if pieces >= cores else rows.repartition(cores, KEY).persist(StorageLevel.MEMORY_AND_DISK)


def _halves(spark: SparkSession, folder: str, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    rows = _stored_obs(spark, folder)
    return train_test_split(_dealt(rows, folder) if dealt else rows, KEY)


def _screened(rows: DataFrame) -> Catalog:
    """The inputs that pass the screens: few levels, not mostly missing."""
    catalog = class_level_filter(rows, order_catalog(), LEVEL_LIMIT, roles=[INPUT])
    return missing_filter(rows, catalog, 0.99, roles=[INPUT])


# --- sources --------------------------------------------------------------------


@query
def scan_obs(spark, folder):
    return order_obs(spark, folder)


@query
def extract_query(spark, folder):
    return extract(spark, EXTRACT, orders=read_table(spark, f"{folder}/orders.parquet"))


def _store(spark) -> StageStore:
    return StageStore(spark, f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}")


@query
def stage_checkpoint(spark, folder):
    return _store(spark).save("scored", scored_orders(spark, folder))


@query
def model_roundtrip(spark, folder):
    train, test = _vectors(spark, folder)
    model = search.logit_model(1.0, train.count()).fit(train)
    store = _store(spark)
    store.save_model("logit", model)
    again = store.load_model("logit", LogisticRegressionModel)
    first = search.scored(model, test, [KEY, "features"]).withColumnRenamed("p1", "first")
    both = search.scored(again, first, [KEY, "first"])
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("first") == F.col("p1")).alias("n_equal"))


@query
def extract_ranges(spark, folder):
    """The order table read in ranges that follow a column with gaps: every row with the number of predicates that hold it."""
    obs = _stored_obs(spark, folder)
    parts = range_predicates(obs.select("acctbal", KEY), "acctbal", 7)
    held_by = sum((F.when(F.expr(p), 1).otherwise(0) for p in parts[1:]), F.when(F.expr(parts[0]), 1).otherwise(0))
    sizes = obs.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(parts[:-1])], F.count("acctbal").alias("n")).first()
    even = max(sizes[f"p{i}"] for i in range(len(parts) - 1)) <= 1.2 * sizes["n"] / 7 + 20
    return obs.select(KEY, held_by.alias("held_by"), F.expr(parts[-1]).alias("in_gap"), F.lit(even).alias("even"))


# --- fit state ------------------------------------------------------------------


def _monthly_state(spark, folder) -> tuple[DataFrame, FitState]:
    """The order table measured a year at a time, saved, read back and merged; and the table."""
    obs = _stored_obs(spark, folder)
    book = StateBook.at(spark, f"{shared_folder(spark)}/states-{uuid.uuid4().hex}")
    years = [r[0] for r in obs.select(F.year(PERIOD)).distinct().collect()]  # one row a year
    for year in years:
        book.put(f"year={year}", measure(obs.filter(F.year(PERIOD) == year), INTERVALS, [*ORDINALS, *NOMINALS, *BINARIES]))
    return obs, book.merged([f"year={y}" for y in years])


@query
def merged_levels(spark, folder):
    return _monthly_state(spark, folder)[1].levels


@query
def merged_moments(spark, folder):
    moments = _monthly_state(spark, folder)[1].moments
    deviation = F.sqrt(F.col("m2") / F.nullif("n", F.lit(0)))
    return moments.select("var", "n_rows", "n", "low", "high", r6("mean").alias("mean"), F.round(deviation, 4).alias("deviation"))


@query
def merged_quantiles(spark, folder):
    """Quantiles of merged sketches: that each has the rank asked for, within the bound."""
    obs, state = _monthly_state(spark, folder)
    return close_ranks(state.quantiles(KNOTS), obs)


# --- catalog --------------------------------------------------------------------


@query
def set_role(spark, folder):
    return role_table(order_obs(spark, folder), order_reference(spark, folder), MODEL)


@query
def select_inputs(spark, folder):
    return order_catalog().select(order_obs(spark, folder), INPUT, (INTERVAL, ORDINAL), keep=[KEY])


# --- samples --------------------------------------------------------------------


@query
def split_train_test(spark, folder):
    train, test = train_test_split(scored_orders(spark, folder), KEY)
    return train.select(KEY, F.lit("train").alias("sample")).unionByName(test.select(KEY, F.lit("test").alias("sample")))


@query
def split_three_way(spark, folder):
    return assign_sample(scored_orders(spark, folder), KEY).select(KEY, "sample")


@query
def split_exact(spark, folder):
    return exact_split(scored_orders(spark, folder), KEY, share=0.4).select(KEY, "in_sample")


@query
def kfold_assign(spark, folder):
    return assign_fold(scored_orders(spark, folder), KEY, folds=4).select(KEY, "fold")


@query
def keyed_uniform_q(spark, folder):
    return event_obs(spark, folder).select(KEY, keyed_uniform(KEY, 12345, "draw").alias("u"))


# --- profiles and screens ---------------------------------------------------------


@query
def missing_profile_q(spark, folder):
    return missing_profile(order_obs(spark, folder))


@query
def missing_percent_filter(spark, folder):
    kept = missing_filter(order_obs(spark, folder), order_catalog(), 0.99)
    return kept.to_df(spark).select("name", "role", "level")


@query
def class_level_filter_q(spark, folder):
    kept = class_level_filter(_stored_obs(spark, folder), order_catalog(), 200)
    return kept.to_df(spark).select("name", "role", "level")


@query
def class_level_counts(spark, folder):
    return class_level_screen(order_obs(spark, folder), [*ORDINALS, *NOMINALS], 200)


@query
def class_level_filter_approx(spark, folder):
    """The estimates hold their bound against the exact counts."""
    columns = [*ORDINALS, *NOMINALS]
    found = class_level_approx(order_obs(spark, folder), columns, 0.02).withColumnRenamed("n_levels", "estimate")
    exact = class_level_screen(order_obs(spark, folder), columns, 200)
    near = F.abs(F.col("estimate") - F.col("n_levels")) <= 0.1 * F.col("n_levels") + 1  # five deviations
    return exact.join(found, "var").select("var", "n_levels", near.alias("near"))


@query
def level_profile_q(spark, folder):
    return level_profile(order_obs(spark, folder), [*ORDINALS, *NOMINALS, *BINARIES])


@query
def distinct_levels_q(spark, folder):
    return distinct_levels(order_obs(spark, folder), [*NOMINALS, *BINARIES])


@query
def column_modes(spark, folder):
    return modes(level_profile(order_obs(spark, folder), [*NOMINALS, *BINARIES]))


@query
def quantile_knots(spark, folder):
    return rounded(quantiles(_stored_obs(spark, folder), INTERVALS), "value")


@query
def quantile_knots_approx(spark, folder):
    """Each estimate lies between the order statistics within one in 1000 of its place."""
    obs = order_obs(spark, folder)
    found = quantiles_approx(obs, INTERVALS)
    values = F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).alias("x")) for c in INTERVALS])
    long = obs.select(F.explode(values).alias("e")).select("e.*").filter(F.col("x").isNotNull())
    placed = long.join(F.broadcast(found), "var").groupBy("var", "prob", "n").agg(  # one row a column and probability
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto"))
    place = F.col("prob") * F.col("n")
    slack = 0.001 * F.col("n") + 1
    return placed.select("var", "prob", "n", ((F.col("below") <= place + slack) & (F.col("upto") >= place - slack)).alias("near"))


# --- imputation -------------------------------------------------------------------


def _imputed(model: ImputeModel, df: DataFrame) -> DataFrame:
    out = model.transform(df, keep="derived")
    return rounded(out, *[f"IMP_{f.var}" for f in model.fills if f.level == INTERVAL])


@query
def impute_train(spark, folder):
    train, _ = _halves(spark, folder)
    return _imputed(fit_impute(train, _screened(train), KEY), train)


@query
def impute_test(spark, folder):
    train, test = _halves(spark, folder)
    return _imputed(fit_impute(train, _screened(train), KEY), test)


@query
def impute_params(spark, folder):
    train, _ = _halves(spark, folder)
    params = fit_impute(train, _screened(train), KEY).params(spark)
    long = params.select("var", "kind", "fill", F.posexplode_outer("knots").alias("pos", "knot"))
    return rounded(long, "knot")


@query
def impute_interval_distn(spark, folder):
    obs = _stored_obs(spark, folder)
    return _imputed(fit_impute(obs, _catalog("acctbal", "sum_qty", "max_price"), KEY), obs)


@query
def impute_interval_literal(spark, folder):
    obs = _stored_obs(spark, folder)
    return _imputed(fit_impute(obs, _catalog("acctbal", "sum_qty", "max_price"), KEY, draw="literal"), obs)


@query
def impute_constant(spark, folder):
    obs = _stored_obs(spark, folder)
    return fit_impute(obs, _catalog("segment", "prio_rank", "n_lines"), KEY).transform(obs, keep="derived")


@query
def impute_binary_mode(spark, folder):
    obs = _stored_obs(spark, folder)
    return fit_impute(obs, _catalog("rich_flag"), KEY).transform(obs, keep="derived")


@query
def impute_int_nominal(spark, folder):
    obs = order_obs(spark, folder).select(KEY, "prio_rank")
    catalog = Catalog.of([("prio_rank", INPUT, "NOMINAL")])
    return fit_impute(obs, catalog, KEY).transform(obs, keep="derived")


# --- levels -----------------------------------------------------------------------


@query
def group_rare_int(spark, folder):
    """Codes as levels: every 500th order has one of seven rare ones."""
    code = F.when(F.col(KEY) % 500 == 1, 100 + F.col(KEY) % 7).otherwise(F.col("prio_rank")).cast("int")
    obs = order_obs(spark, folder).select(KEY, code.alias("code"))
    model = fit_group_rare(obs, Catalog.of([("code", INPUT, "NOMINAL")]), 0.005)
    return model.transform(obs).select(KEY, "BIN_code")


@query
def levels_roundtrip(spark, folder):
    """A list too long for literals, saved with its model and read back."""
    train, test = _halves(spark, folder)
    with held(level_profile(train, ["cust_code"]).select("var", "level")) as levels:
        model = ReplaceModel(level_set(levels, inline=10), {"cust_code": "none"})
    store = _store(spark)
    store.save_state("replace", model)
    return store.load_state("replace", ReplaceModel).transform(test).select(KEY, "REP_cust_code")



@query
def rare_levels_q(spark, folder):
    return rare_levels(order_obs(spark, folder), NOMINALS)


@query
def group_rare_train(spark, folder):
    train, _ = _halves(spark, folder)
    return fit_group_rare(train, _catalog("nation", "segment")).transform(train).select(KEY, "BIN_nation")


@query
def group_rare_test(spark, folder):
    train, test = _halves(spark, folder)
    return fit_group_rare(train, _catalog("nation", "cust_code")).transform(test).select(
        KEY, "BIN_nation", "BIN_cust_code")


@query
def replacement_params(spark, folder):
    train, _ = _halves(spark, folder)
    return fit_replace(train, _catalog(*NOMINALS)).params(spark)


@query
def replacement_train(spark, folder):
    train, _ = _halves(spark, folder)
    names = [f"REP_{c}" for c in NOMINALS]
    return fit_replace(train, _catalog(*NOMINALS)).transform(train).select(KEY, *names)


@query
def replacement_test(spark, folder):
    train, test = _halves(spark, folder)
    names = [f"REP_{c}" for c in NOMINALS]
    return fit_replace(train, _catalog(*NOMINALS)).transform(test).select(KEY, *names)


@query
def new_levels_q(spark, folder):
    train, test = _halves(spark, folder)
    return new_levels(test, fit_replace(train, _catalog(*NOMINALS)))


# --- binning ----------------------------------------------------------------------

BINNED = ["total_price", "acctbal", "sum_qty", "max_price", "planted"]


@query
def class_histogram_q(spark, folder):
    return class_histogram(order_obs(spark, folder), BINNED, LABEL)


@query
def best_entropy_cut(spark, folder):
    return rounded(first_cuts(_stored_obs(spark, folder), BINNED, LABEL), "cut", "gain")


@query
def mdl_cuts_q(spark, folder):
    cuts = mdl_cuts(_stored_obs(spark, folder), BINNED, LABEL)
    rows = [(var, i, cut) for var, found in cuts.items() for i, cut in enumerate(found)]
    return rounded(spark.createDataFrame(rows, "var string, pos int, cut double"), "cut")


@query
def bin_apply(spark, folder):
    train, test = _halves(spark, folder)
    return fit_bins(train, _catalog("total_price", "planted")).transform(test).select(KEY, "BIN_planted")


@query
def bin_then_group(spark, folder):
    """Bins of the training rows, of which those with under a quarter of the rows are pooled."""
    train, test = _halves(spark, folder)
    catalog = _catalog("planted")
    bins = fit_bins(train, catalog)
    binned = bins.transform(train)
    group = fit_group_rare(binned, bins.catalog(catalog), 0.25)
    out = group.transform(bins.transform(test))
    shown = F.col("BIN_BIN_planted") if "BIN_BIN_planted" in out.columns else F.col("BIN_planted").cast("string")
    return out.select(KEY, shown.alias("bin"))


# --- clusters ---------------------------------------------------------------------

EMBEDDED = [f"e{i}" for i in range(64)]


@query
def corr_matrix(spark, folder):
    return rounded(correlation_table(wide_embeddings(spark, folder), EMBEDDED), "corr")


@query
def cluster_assign(spark, folder):
    """Each column's shares against the correlations with the component scores of all rows."""
    df = wide_embeddings(spark, folder)
    model = cluster_columns(df, EMBEDDED, hyper=0.3)
    scores = model.scores(df, EMBEDDED)
    parts = [p.cluster for p in model.components]
    names = [*EMBEDDED, *[f"PC1_{p}" for p in parts]]
    found = correlation_matrix(scores, names)
    corr = {(v, p): found[i, len(EMBEDDED) + j] for i, v in enumerate(EMBEDDED) for j, p in enumerate(parts)}
    n = df.count()
    sample = n / (n - 1)
    rows = []
    for r in model.rows:
        alone = sum(x.cluster == r.cluster for x in model.rows) == 1
        own = 1.0 if alone else corr[r.var, r.cluster] ** 2 * sample
        nearest = max((corr[r.var, p] ** 2 for p in parts if p != r.cluster), default=0.0)
        rows.append((r.var, bool(abs(own - r.r2_own) < 1e-6), bool(abs(nearest - r.r2_next) < 1e-6)))
    return spark.createDataFrame(rows, "var string, own_ok boolean, next_ok boolean")


@query
def cluster_best_vars(spark, folder):
    """One column a cluster is kept, and none of its cluster has a lower ratio."""
    model = cluster_columns(wide_embeddings(spark, folder), EMBEDDED, "MaxEigenvalue", 1.5)
    table = model.to_df(spark)
    kept = table.filter("selected").select("cluster", F.col("ratio").alias("kept_ratio"))
    clusters = table.groupBy("cluster").agg(F.min("ratio").alias("least"), F.count(F.lit(1)).alias("n"))
    joined = clusters.join(kept, "cluster", "left")
    return joined.agg(F.sum("n").alias("n_columns"), F.count_if(F.col("kept_ratio") > F.col("least")).alias("n_wrong"),
                      (F.count("kept_ratio") - F.countDistinct("cluster")).alias("n_surplus"))


@query
def cluster_component_score(spark, folder):
    obs = _stored_obs(spark, folder).fillna(0.0, ["sum_qty", "max_price"])
    model = cluster_columns(obs, ["sum_qty", "max_price"], hyper=0.5)
    return rounded(model.scores(obs, [KEY]), "PC1_1")


# --- selection --------------------------------------------------------------------


@query
def label_encode(spark, folder):
    return label_codes(order_obs(spark, folder), [*NOMINALS, *BINARIES])


def _imputed_train(spark, folder) -> tuple[DataFrame, Catalog]:
    train, _ = _halves(spark, folder)
    catalog = _screened(train)
    model = fit_impute(train, catalog, KEY)
    return model.transform(train), model.catalog(catalog)


def _importance_rows(train: DataFrame, catalog: Catalog, model, wrong: Callable[[float], bool]) -> DataFrame:
    """Every column with its rejection, and whether its importance follows from a recount of the rows in all leaves."""
    recount = dict(recounted_importance(train, catalog, model.model, KEY))
    rows = [(v, v in model.rejected, abs(i - recount[v]) < 1e-9, (v in model.rejected) == wrong(i)) for v, i in model.importance]
    return train.sparkSession.createDataFrame(rows, "var string, rejected boolean, importance_ok boolean, rule_ok boolean").drop("rejected")


@query
def tree_importance(spark, folder):
    train, catalog = _imputed_train(spark, folder)
    found = tree_selection(train, catalog, 0.01, "value", KEY)
    return _importance_rows(train, catalog, found, lambda i: i < 0.01)


@query
def rf_importance(spark, folder):
    train, catalog = _imputed_train(spark, folder)
    found = forest_selection(train, catalog, 0.6, "percentage", KEY)
    cut = sorted((i for _, i in found.importance), reverse=True)[math.ceil(0.6 * len(found.importance)) - 1]
    return _importance_rows(train, catalog, found, lambda i: i == 0 if cut == 0 else i < cut)


@query
def tree_importance_long(spark, folder):
    """Selection among all inputs, of which one has a level for every customer."""
    train, _ = _halves(spark, folder)
    catalog = missing_filter(train, order_catalog(), 0.99, roles=[INPUT])
    model = fit_impute(train, catalog, KEY)
    train, catalog = model.transform(train), model.catalog(catalog)
    found = tree_selection(train, catalog, 0.01, "value", KEY)
    return _importance_rows(train, catalog, found, lambda i: i < 0.01)


@query
def tree_best_first(spark, folder):
    """A tree of at most twelve leaves with classes of equal weight: each training row, and whether its leaf holds the rows it says."""
    train, catalog = _imputed_train(spark, folder)
    forest = tree_selection(train, catalog, key=KEY, most_leaves=12, least_share=0.0, class_weight="balanced").model
    (tree,) = forest.trees
    with held(leaf_rows(encoded_inputs(train, catalog, KEY), forest, "__label", "__key")) as rows:
        counts = rows.groupBy("leaf").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
        right = {r["leaf"]: (r["n0"], r["n1"]) == tree.counts[r["leaf"]] for r in counts.collect()}  # a row a leaf
        return rows.select(F.col("__key").alias(KEY), F.col("leaf").isin([x for x, ok in right.items() if ok]).alias("leaf_ok"),
                           F.lit(len(right) == tree.leaves() <= 12).alias("leaves_ok"))


@query
def forest_out_of_bag(spark, folder):
    """Rows that some tree of the forest did not see, and whether the score is a recount of them tree by tree."""
    train, catalog = _imputed_train(spark, folder)
    forest = forest_selection(train, catalog, key=KEY, trees=5).model
    numbers = encoded_inputs(train, catalog, KEY)
    score = out_of_bag_score(numbers, forest, "__label", "__key").first()
    votes = leaf_rows(numbers, forest, "__label", "__key").filter("often = 0")
    chance = F.lit([[float(n1) / max(n0 + n1, 1) for n0, n1 in t.counts] for t in forest.trees])
    rows = votes.withColumn("p", chance[F.col("t").cast("int")][F.col("leaf").cast("int")]).groupBy("__key", "y").agg(F.avg("p").alias("p"))
    right = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("p") > 0.5).cast("int") == F.col("y")).alias("r")).first()
    return numbers.select(F.col("__key").alias(KEY), F.lit(score["n_rows"] == right["n"]).alias("rows_ok"), F.lit(score["n_right"] == right["r"]).alias("score_ok"),
                          F.lit(score["score"] > 0.6).alias("learns"))


@query
def forest_warm_start(spark, folder):
    """A forest of two trees that goes on by one is the forest of three: one row a column."""
    train, catalog = _imputed_train(spark, folder)
    whole = forest_selection(train, catalog, key=KEY, trees=3).model
    first = forest_selection(train, catalog, key=KEY, trees=2).model
    again = forest_selection(train, catalog, key=KEY, trees=1, start=Forest.from_json(first.to_json())).model
    rows = [(v, again.trees == whole.trees, i == j) for (v, i), (_, j) in zip(again.importance(), whole.importance())]
    return spark.createDataFrame(rows, "var string, trees_same boolean, importance_same boolean")


CORRELATED = ["total_price", "planted", "p1", "ord_f_score_ind", "obs_id"]


def _importance_table(spark, folder) -> DataFrame:
    """Strength of each column's linear relation to the target, as importance."""
    obs = order_obs(spark, folder)
    y = F.col(LABEL).cast("double")

    def strength(c: str) -> Column:
        x = F.col(c).cast("double")
        spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
        return F.round(F.coalesce(F.abs(F.covar_pop(x, y) / spread), F.lit(0.0)), 6)

    return one_row_per_column(obs, CORRELATED, importance=strength)


@query
def reject_by_value_q(spark, folder):
    return reject_by_value(_importance_table(spark, folder), 0.01)


@query
def reject_by_percentage_q(spark, folder):
    return reject_by_percentage(_importance_table(spark, folder), 0.4)


# --- final preparation --------------------------------------------------------------


@query
def final_prep(spark, folder):
    train, test = _halves(spark, folder)
    model = fit_prep(train, _screened(train), input_scale="Range")
    return rounded(model.transform(test, [KEY]), "total_price", "acctbal", "sum_qty", "max_price", "planted",
                   "prio_rank", "n_lines")


@query
def binary_to_ind(spark, folder):
    obs = _stored_obs(spark, folder)
    return fit_prep(obs, _catalog("rich_flag")).transform(obs, [KEY])


@query
def one_hot(spark, folder):
    train, test = _halves(spark, folder)
    return fit_prep(train, _catalog("segment")).transform(test, [KEY])


@query
def one_hot_long(spark, folder):
    """The place of the 1 in the vector of a column with a level for every customer."""
    train, test = _halves(spark, folder)
    vectors = fit_prep(train, _catalog("cust_code"), inline=100).transform(test, [KEY])
    entry = F.udf(lambda v: (len(v), next((int(i) for i, x in zip(v.indices, v.values) if x == 1.0), None)), "width int, place bigint")
    return vectors.select(KEY, entry("cust_code_levels").alias("e")).select(KEY, "e.*")  # never a number for every customer


@query
def scale_range(spark, folder):
    train, test = _halves(spark, folder)
    out = fit_prep(train, _catalog(*BINNED, *ORDINALS), input_scale="Range").transform(test, [KEY])
    return rounded(out, *BINNED, *ORDINALS)


@query
def scale_zscore(spark, folder):
    train, test = _halves(spark, folder)
    out = fit_prep(train, _catalog(*BINNED, *ORDINALS), input_scale="Z Score").transform(test, [KEY])
    return rounded(out, *BINNED, *ORDINALS)


@query
def scale_target(spark, folder):
    train, test = _halves(spark, folder)
    catalog = _catalog("total_price")
    by_range = fit_prep(train, catalog, input_scale=None, target_scale="Range")
    by_score = fit_prep(train, catalog, input_scale=None, target_scale="Z Score")
    first = by_range.transform(test, [KEY, F.col(LABEL).alias("y")]).select(KEY, "y", F.col(LABEL).alias("ranged"))
    scored = by_score.target_scale.apply(F.col("y").cast("double")).alias("zscored")
    return rounded(first.select(KEY, "ranged", scored), "ranged", "zscored")


# --- ranks, lift, gain --------------------------------------------------------------


@query
def global_rank(spark, folder):
    return rank_rows(scored_orders(spark, folder), SCORE, KEY, label=LABEL).select(
        KEY, F.col("rank").cast("bigint").alias("rank"), F.col("cum_pos").cast("bigint").alias("cum_pos"))


def _gappy(spark, folder) -> DataFrame:
    """Scored orders of which a fifth has no score and a seventh a score that is no number."""
    gap = F.when(F.col(KEY) % 5 == 0, F.lit(None)).when(F.col(KEY) % 7 == 0, F.lit(float("nan"))).otherwise(F.col(SCORE))
    return scored_orders(spark, folder).withColumn(SCORE, gap)


@query
def global_rank_missing(spark, folder):
    return rank_rows(_gappy(spark, folder), SCORE, KEY, label=LABEL).select(
        KEY, F.col("rank").cast("bigint").alias("rank"), F.col("cum_pos").cast("bigint").alias("cum_pos"))


@query
def lift_at_depth(spark, folder):
    hits = hits_at_depth(scored_orders(spark, folder), LABEL, SCORE, KEY, LIFT_DEPTHS)
    return hits.select("depth", "hits", lift_value().alias("lift"))


@query
def cum_lift_at_depth(spark, folder):
    return cum_lift(scored_orders(spark, folder), LABEL, SCORE, KEY, 0.2, by=[PERIOD]).drop("n_pos")


@query
def gain_curve_q(spark, folder):
    return gain_curve(scored_orders(spark, folder), LABEL, SCORE, KEY, by=[PERIOD])


@query
def gain_midpoints_q(spark, folder):
    return gain_midpoints(scored_orders(spark, folder), LABEL, SCORE, KEY)


@query
def gain_curve_grid(spark, folder):
    return gain_grid(event_obs(spark, folder), "ev_target_ind", SCORE, KEY)


@query
def period_stride(spark, folder):
    return period_table(event_obs(spark, folder), PERIOD, 2).select(PERIOD, F.col("position").cast("int"))


@query
def group_by_month(spark, folder):
    out = target_rate(scored_orders(spark, folder), LABEL, PERIOD, calendar_month=True)
    return rounded(out.withColumnRenamed(PERIOD, "month"), "target_rate")


@query
def lift_stability_q(spark, folder):
    return lift_stability(scored_orders(spark, folder), LABEL, SCORE, PERIOD, KEY)


@query
def decile_stability_q(spark, folder):
    return decile_stability(scored_orders(spark, folder), LABEL, SCORE, PERIOD, KEY)


@query
def decile_stability_events(spark, folder):
    return decile_stability(event_obs(spark, folder), "ev_target_ind", SCORE, PERIOD, KEY, by_month=True)


@query
def target_rate_q(spark, folder):
    return rounded(target_rate(event_obs(spark, folder), "ev_target_ind", PERIOD), "target_rate")


# --- thresholds ---------------------------------------------------------------------


def _sweep(spark, folder) -> DataFrame:
    return threshold_sweep(scored_orders(spark, folder), LABEL, 1 - F.col(SCORE), THRESHOLDS)


@query
def threshold_sweep_q(spark, folder):
    return _sweep(spark, folder)


@query
def threshold_sweep_missing(spark, folder):
    return threshold_sweep(_gappy(spark, folder), LABEL, 1 - F.col(SCORE), THRESHOLDS)


@query
def confusion_matrix_missing(spark, folder):
    labelled = _gappy(spark, folder).withColumn("predicted", label_at(1 - F.col(SCORE), 0.75))
    return confusion_matrix(labelled, LABEL, "predicted")


@query
def fbeta_by_threshold(spark, folder):
    return _sweep(spark, folder).select("j", r6(fbeta(1.0)).alias("f1"), r6(fbeta(2.0)).alias("f2"))


@query
def kappa_by_threshold(spark, folder):
    return _sweep(spark, folder).select("j", r6(kappa()).alias("kappa"))


@query
def auc_by_threshold(spark, folder):
    return _sweep(spark, folder).select("j", r6(hard_auc()).alias("auc"))


@query
def ap_by_threshold(spark, folder):
    return _sweep(spark, folder).select("j", r6(hard_average_precision()).alias("ap"))


def _labelled(spark, folder) -> DataFrame:
    return scored_orders(spark, folder).withColumn("predicted", label_at(1 - F.col(SCORE), 0.75))


@query
def confusion_matrix_q(spark, folder):
    return confusion_matrix(_labelled(spark, folder), LABEL, "predicted")


@query
def classification_report_q(spark, folder):
    return rounded(classification_report(_labelled(spark, folder), LABEL, "predicted"), "precision", "recall", "f1")


# --- search -------------------------------------------------------------------------


def _blends(spark, folder) -> tuple[DataFrame, list[str]]:
    """Five scores per order: blends of the score and an unrelated number."""
    other = ((F.col(KEY) * 31) % 1000).cast("double") / F.lit(1000.0)
    names = [f"s{i}" for i in range(len(WEIGHTS))]
    scores = [(F.lit(w) * F.col(SCORE) + F.lit(1 - w) * other).alias(n) for w, n in zip(WEIGHTS, names)]
    return scored_orders(spark, folder).select(KEY, LABEL, *scores), names


def _blend_scores(spark, folder) -> DataFrame:
    wide, names = _blends(spark, folder)
    return search.score_by_setting(wide, names, LABEL, KEY, "lift", 0.1)


@query
def best_params(spark, folder):
    return search.best_setting(_blend_scores(spark, folder))


@query
def top_models(spark, folder):
    return search.top_settings(_blend_scores(spark, folder), 3)


@query
def param_grid(spark, folder):
    """The strengths a logit search tries on the training rows, as Spark's parameter."""
    train, _ = train_test_split(scored_orders(spark, folder), KEY)
    steps = F.array(*[F.struct(F.lit(i).alias("setting"), F.lit(c).alias("c")) for i, c in enumerate(log_grid(-4, 4, 50))])
    rows = train.agg(F.count(F.lit(1)).alias("n")).select("n", F.explode(steps).alias("s")).select("n", "s.*")
    return rows.select("setting", F.round("c", 6).alias("c"), F.round(1 / (F.col("c") * F.col("n")), 9).alias("reg_param"))


@query
def param_grid_cross(spark, folder):
    """Every pair of settings with the gradient steps it takes on the training rows."""
    train, _ = train_test_split(scored_orders(spark, folder), KEY)
    space = search.grid({"epochs": range(100, 300, 50), "batch_size": (64, 128, 256)})
    pairs = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in one.items()]) for one in space])
    rows = train.agg(F.count(F.lit(1)).alias("n")).select("n", F.explode(pairs).alias("s")).select("n", "s.*")
    batches = F.ceil(F.col("n") / F.col("batch_size")).cast("bigint")
    return rows.select("epochs", "batch_size", (batches * F.col("epochs")).alias("steps"))


def _vectors(spark, folder, scale: str | None = "Range", dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test vectors of the imputed order table."""
    train, test = _halves(spark, folder, dealt)
    catalog = _screened(train)
    model = fit_impute(train, catalog, KEY)
    catalog = model.catalog(catalog)
    train, test = model.transform(train), model.transform(test)
    prep = fit_prep(train, catalog, input_scale=scale)
    return prep.features(train, [KEY]), prep.features(test, [KEY])


@query
def logit_validation(spark, folder):
    """Every strength: that its fit leaves no slope of the penalised loss, and that weaker penalties allow larger weights."""
    train, test = _vectors(spark, folder)
    found = search.logit_search(train, test, KEY)
    norms = [sum(w * w for w in m.coefficients) for m in found.models]
    grows = [i == 0 or norms[i] >= norms[i - 1] * (1 - 1e-6) for i in range(len(norms))]
    flat = [s < 1e-3 for s in _slopes(train, found.models, found.cs)]
    rows = [(i, round(c, 6), f, g, found.scans <= 60) for i, (c, f, g) in enumerate(zip(found.cs, flat, grows))]
    return spark.createDataFrame(rows, "setting int, c double, flat boolean, grows boolean, scans_ok boolean")


def _slopes(train: DataFrame, models, cs) -> list[float]:
    """For each fit the largest derivative of the mean loss plus the ridge penalty, in units of its column, whose mean size divides it."""
    weights = np.array([[*m.coefficients, m.intercept] for m in models])
    width = weights.shape[1]

    def run(batches):
        total = 0.0
        for batch in batches:
            x = design(batch.column(1), width - 1)
            e = chances(x, weights) - batch.column(0).to_numpy(zero_copy_only=False)[:, None]
            total = total + np.concatenate([[len(x)], np.abs(x).sum(axis=0), (e.T @ x).ravel()])
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    rows = train.select(F.col("label").cast("double"), vector_to_array("features"))
    found = rows.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    sums = found.sort_values("place")["value"].to_numpy()  # one pass; rows, sizes, slopes
    n, size, slope = sums[0], sums[1 : width + 1], sums[width + 1 :].reshape(weights.shape)
    penalty = np.column_stack([weights[:, :-1], np.zeros(len(weights))]) / (np.array(cs)[:, None] * n)
    return np.abs((slope / n + penalty) / (1.0 + size / n)).max(axis=1).tolist()


@query
def score_output(spark, folder):
    """Probabilities against the logistic function of the fitted weights, labels against the threshold."""
    train, test = _vectors(spark, folder)
    model = search.logit_model(1.0, train.count()).fit(train)
    out = search.scored(model, test, [KEY, "features"]).withColumn("predicted", label_at(1 - F.col("p1"), 0.7))
    weights = F.lit([float(w) for w in model.coefficients])
    margin = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    expected = 1 / (1 + F.exp(-(margin + F.lit(float(model.intercept)))))
    return out.select(KEY, (F.abs(F.col("p1") - expected) < 1e-9).alias("p1_ok"),
                      (F.col("predicted") == (1 - F.col("p1") < 0.7).cast("int")).alias("label_ok"))


@query
def mlp_score(spark, folder):
    """Probabilities against a forward pass through the fitted weights."""
    train, test = _vectors(spark, folder)
    width = int(train.schema["features"].metadata["ml_attr"]["num_attrs"])
    model = search.net(width).fit(train)
    out = search.scored(model, test, [KEY, "features"])
    return out.select(KEY, (F.abs(F.col("p1") - _forward(model)) < 1e-9).alias("p1_ok"))


def _forward(model) -> Column:
    """The chance of class 1 from the weights: logistic units, and the two outputs normalised."""
    sizes, weights = model.getLayers(), [float(w) for w in model.weights]
    values = [vector_to_array("features")[i] for i in range(sizes[0])]
    at = 0
    for depth, (n, m) in enumerate(zip(sizes, sizes[1:])):
        sums = []
        for j in range(m):  # a layer is stored column by column, its offsets last
            terms = [F.lit(weights[at + i * m + j]) * values[i] for i in range(n)] + [F.lit(weights[at + n * m + j])]
            sums.append(sum(terms[1:], terms[0]))
        at += (n + 1) * m
        values = sums if depth == len(sizes) - 2 else [1 / (1 + F.exp(-s)) for s in sums]
    return 1 / (1 + F.exp(values[0] - values[1]))


def _net_forward(model, features: str = "features", codes: str = "codes") -> Column:
    """The chance of class 1 from a net's state, layer by layer."""
    spec, state = model.spec, model.spec.unpack(np.array(model.vector))
    tables = [[F.lit(state[f"e{c}"][:, d].tolist()) for d in range(spec.embed_dim)] for c in range(spec.embed)]
    values = [t[F.col(codes)[c]] for c, table in enumerate(tables) for t in table]
    values += [vector_to_array(features)[i] for i in range(spec.n_inputs)]
    last = len(spec.sizes) - 2
    for i in range(last + 1):
        sums = []
        for j in range(spec.sizes[i + 1]):
            terms = [F.lit(float(w)) * v for w, v in zip(state[f"w{i}"][:, j], values)]
            z = sum(terms[1:], terms[0])
            if spec.batch_norm:
                z = (z - F.lit(float(state[f"mean{i}"][j]))) / F.lit(float(np.sqrt(state[f"var{i}"][j] + 1e-3))) * F.lit(float(state[f"g{i}"][j]))
            z = z + F.lit(float(state[f"b{i}"][j]))
            sums.append(1 / (1 + F.exp(-z)) if i == last else F.greatest(z, F.lit(0.0)))
        values = sums
    return values[0]


def _net_rows(found, test: DataFrame, least_score: float) -> DataFrame:
    """Every row predicted: the probability against a forward pass of the best net, its class, and that the best net has learnt."""
    best = found.models[found.best()]
    both = found.predictions.join(test.select(KEY, _net_forward(best).alias("expected")), KEY)  # rows move without their vectors
    return both.select(KEY, (F.abs(F.col("p1") - F.col("expected")) < 1e-9).alias("p1_ok"),
                       (F.col("predicted") == (F.col("p1") > 0.5).cast("int")).alias("label_ok"), F.lit(found.scores[found.best()] > least_score).alias("learns"))


def _cv_rows(spark, found, least_score: float) -> DataFrame:
    """Every setting: folds measured, its mean, and that the best setting has learnt."""
    rows = [(i, len([s for s in scores if s is not None]), abs(sum(scores) / len(scores) - mean) < 1e-12, found.avgMetrics[found.best()] > least_score)
            for i, (scores, mean) in enumerate(zip(zip(*found.fold_scores), found.avgMetrics))]
    return spark.createDataFrame(rows, "setting int, folds int, mean_ok boolean, learns boolean")


@query
def mlp_cv(spark, folder):
    """Random settings over four folds, nets with dropout and batch normalisation."""
    train, _ = _vectors(spark, folder, dealt=True)
    return _cv_rows(spark, search.net_cv(train, KEY), 1.5)


@query
def mlp_validation(spark, folder):
    train, test = _vectors(spark, folder, dealt=True)
    return _net_rows(search.net_validation(train, test, KEY), test, 1.5)


@query
def mlp_tries(spark, folder):
    """Nets that learn an embedding of each hashed category, measured after every hundred epochs of five starts."""
    train, test = _halves(spark, folder, dealt=True)
    catalog = _screened(train)
    model = fit_impute(train, catalog, KEY)
    scales = fit_prep(model.transform(train), model.catalog(catalog), input_scale="Range")
    nominal = ["IMP_segment", "IMP_nation"]
    numeric = [f"IMP_{c}" for c in (*BINNED, *ORDINALS)]

    def vectors(df):
        rows = model.transform(df)
        ready = scales.transform(rows, [KEY, F.col(LABEL).cast("double").alias("label"), *[F.col(c).alias(f"raw_{c}") for c in nominal]])
        return search.bucketed(ready, [f"raw_{c}" for c in nominal], numeric, [KEY, "label"])

    test = vectors(test)
    return _net_rows(search.net_tries(vectors(train), test, KEY, codes="codes"), test, 1.5)


@query
def hash_bucket(spark, folder):
    """Each row: its bucket lies in range, and its level has no other; how evenly buckets fill is left to the hash."""
    coded = order_obs(spark, folder).select(KEY, "cust_code", search.hash_bucket("cust_code").alias("bucket"))
    levels = coded.groupBy("cust_code").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    return coded.join(levels, "cust_code").select(KEY, "cust_code", F.col("bucket").between(0, search.HASH_BUCKETS - 1).alias("in_range"),
                                                  (F.col("a") == F.col("b")).alias("one_bucket"))


@query
def hash_bucket_md5(spark, folder):
    return order_obs(spark, folder).select(KEY, search.md5_bucket("cust_code").alias("bucket"))


# --- the whole preparation ------------------------------------------------------------


def _marked_halves(spark, folder, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    rows = marked_obs(spark, folder).persist(StorageLevel.MEMORY_AND_DISK)
    return train_test_split(_dealt(rows, folder) if dealt else rows, KEY)


def _fit_marked(train: DataFrame) -> Preparation:
    """Only columns that no tree splits by fall to the forest."""
    return fit_preparation(train, marked_catalog(), KEY, forest_limit=1e-6)


def _prepared(spark, folder, dealt: bool = False) -> tuple[Preparation, DataFrame, DataFrame]:
    """The whole preparation of a table with a column that the forest must reject and one that the clusters must."""
    train, test = _marked_halves(spark, folder, dealt=True) if dealt else _marked_halves(spark, folder)
    return _fit_marked(train), train, test


def _inputs_of(prep: Preparation, df: DataFrame) -> DataFrame:
    names = prep.catalog.inputs()
    floats = [n for n in names if prep.catalog[n].level == INTERVAL]
    return rounded(prep.transform(df).select(KEY, *names), *floats)


@query
def prep_train(spark, folder):
    prep, train, _ = _prepared(spark, folder)
    return _inputs_of(prep, train)


@query
def prep_apply(spark, folder):
    prep, _, test = _prepared(spark, folder)
    return _inputs_of(prep, test)


@query
def prep_catalog(spark, folder):
    """Every variable after the full preparation: what it is derived from, its role, and the step that rejected it."""
    train, _ = _marked_halves(spark, folder)
    prep = _fit_marked(train)
    forest, clusters = set(prep.importance.rejected), {r.var for r in prep.clusters.rows if not r.selected}
    rows = [(v.name, v.role, v.level, "forest" if v.name in forest else "clusters" if v.name in clusters else None) for v in prep.catalog.variables]
    return spark.createDataFrame(rows, "name string, role string, level string, rejected_by string")


@query
def prep_roundtrip(spark, folder):
    """The full preparation saved and read back gives the same rows."""
    train, test = _marked_halves(spark, folder)
    prep = _fit_marked(train)
    store = _store(spark)
    store.save_state("prep", prep)
    again = store.load_state("prep", Preparation)
    names = prep.catalog.inputs()
    first = prep.transform(test).select(KEY, F.xxhash64(*names).alias("a"))
    second = again.transform(test).select(KEY, F.xxhash64(*again.catalog.inputs()).alias("b"))
    return first.join(second, KEY).select(KEY, (F.col("a") == F.col("b")).alias("same"))


@query
def model_stability(spark, folder):
    """Decile stability of a fitted model's scores: each period's hits against a plain count."""
    prep, train, test = _prepared(spark, folder)
    fitted = fit_prep(prep.transform(train), prep.catalog)
    model = search.logit_model(1.0, train.count()).fit(fitted.features(prep.transform(train), [KEY]))
    both = search.scored(model, fitted.features(prep.transform(test), [KEY, PERIOD]), [KEY, PERIOD, "label"])
    with held(both.withColumn("label", F.col("label").cast("int"))) as rows:
        report = decile_stability(rows, "label", "p1", PERIOD, KEY, stride=1)
        ranked = rows.select(PERIOD, "label", F.row_number().over(
            Window.partitionBy(PERIOD).orderBy(F.desc("p1"), KEY)).alias("r"), F.count(F.lit(1)).over(Window.partitionBy(PERIOD)).alias("n"))
        plain = ranked.join(F.broadcast(report.select(PERIOD, "depth", "hits")), PERIOD).groupBy(PERIOD, "depth").agg(
            F.first("hits").alias("hits"), F.sum(F.when(F.col("r") <= F.ceil(F.col("n") * F.col("depth")), F.col("label")).otherwise(0)).alias("count"))
        facts = [tuple(r) for r in plain.select(PERIOD, "depth", (F.col("hits") == F.col("count")).alias("hits_ok")).collect()]  # ten rows a period
    return spark.createDataFrame(facts, "period_dt date, depth double, hits_ok boolean")


def _arm(spark, folder, scale: str | None, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    prep, train, test = _prepared(spark, folder, dealt)
    catalog = prep.catalog
    fitted = fit_prep(prep.transform(train), catalog, input_scale=scale)
    return fitted.features(prep.transform(train), [KEY]), fitted.features(prep.transform(test), [KEY])


@query
def logit_arm(spark, folder):
    """The logit arm in full, on raw scales: every row predicted, its probability and label, and that no slope is left at the best strength."""
    train, test = _arm(spark, folder, None)
    found = search.logit_search(train, test, KEY, c_grid=(-3, 2, 10), metric="cumulative lift", depth=0.15)
    flat = _slopes(train, [found.model], [found.best_c])[0] < 1e-3
    weights = F.lit([float(w) for w in found.model.coefficients])
    margin = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda a, b: a * b), F.lit(float(found.model.intercept)), lambda s, v: s + v)
    rows = found.predictions.join(test.select(KEY, (1 / (1 + F.exp(-margin))).alias("expected")), KEY)  # rows move without their vectors
    return rows.select(KEY, (F.abs(F.col("p1") - F.col("expected")) < 1e-9).alias("p1_ok"),
                       (F.col("predicted") == (1 - F.col("p1") < found.threshold).cast("int")).alias("label_ok"), F.lit(flat).alias("flat"))


# The spaces the flow searches.
CV_SPACE = {"epochs": tuple(range(50, 250, 50)), "dropout": (0.3, 0.4, 0.5),
            "learning_rate": tuple(round(v, 6) for v in log_grid(-3, -1, 50))}
VALIDATION_SPACE = {"learning_rate": tuple(round(v, 6) for v in log_grid(-4, -1, 50)), "dropout": (0.3, 0.4, 0.5, 0.6),
                    "epochs": (5, 10, 20, 25, 30, 40, 50)}


@query
def nn_arm_cv(spark, folder):
    """The cross validation of the net arm over the flow's space."""
    train, _ = _arm(spark, folder, "Range", dealt=True)
    return _cv_rows(spark, search.net_cv(train, KEY, metric="cumulative lift", depth=0.15, space=CV_SPACE), 0.2)


@query
def nn_arm(spark, folder):
    """The net arm: twenty nets over the flow's space, the five best saved and read back, every row predicted by the best."""
    train, test = _arm(spark, folder, "Range")
    found = search.net_validation(train, test, KEY, metric="cumulative lift", depth=0.15, n_models=20, space=VALIDATION_SPACE)
    store, top = _store(spark), found.top(5)
    for i, model in enumerate(top):
        store.save_state(f"net-{i}", model)
    same = len(top) >= 5 and all(store.load_state(f"net-{i}", NetModel) == m for i, m in enumerate(top))
    return _net_rows(found, test, 0.2).withColumn("saved", F.lit(same))


# --- streams ----------------------------------------------------------------------------


def _streamed_counts(spark, folder) -> DataFrame:
    """Counts by day and cell of the events, which arrive in slices, some of them late; two rows far ahead close the last day."""
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").alias(KEY), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "purchase").cast("int").alias("label"),
        (((F.col("event_id") * 7919) % 1000).cast("double") / F.lit(1000.0)).alias(SCORE))
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    hours = (last - first).total_seconds() / 3600 / 4 + 1
    late = F.when(F.col(KEY) % 7 == 0, 6).otherwise(0)  # a seventh arrives six hours late
    slice_ = F.least(F.floor((F.unix_timestamp("ts") - F.lit(int(first.timestamp())) + late * 3600) / (hours * 3600)), F.lit(3))
    sliced = events.withColumn("slice", slice_).persist()
    for i in range(4):
        sliced.filter(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(f"{place}/in")
    far = spark.createDataFrame([(-1, last + datetime.timedelta(days=30), 0, 0.0)], "obs_id bigint, ts timestamp, label int, p1 double")
    far.select(F.col(KEY), "ts", "label", SCORE).coalesce(1).write.mode("append").parquet(f"{place}/in")
    plan = score_cells(sliced, SCORE, KEY)
    sliced.unpersist()
    stream = spark.readStream.schema(far.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
    write_counts(stream, "label", SCORE, "ts", plan, "1 day", "12 hours", f"{place}/out", f"{place}/state").awaitTermination()
    return closed_counts(spark, f"{place}/out")


@query
def stream_target_rate(spark, folder):
    return rate_report(_streamed_counts(spark, folder)).select(F.to_date("period").alias(PERIOD), "n", "n_pos", "target_rate")


@query
def stream_decile_stability(spark, folder):
    """Each closed day and depth: its hits against the exact report, within the positives of one cell of the scores."""
    report = decile_report(_streamed_counts(spark, folder)).withColumn(PERIOD, F.to_date("period"))
    exact = decile_stability(event_obs(spark, folder), "ev_target_ind", SCORE, PERIOD, KEY, stride=1)
    both = exact.select(PERIOD, "depth", "n", "n_pos", F.col("hits").alias("__hits")).join(
        report.select(PERIOD, "depth", F.col("n").alias("__n"), F.col("n_pos").alias("__p"), "hits"), [PERIOD, "depth"], "left")
    near = F.abs(F.col("hits") - F.col("__hits")) <= F.greatest(F.lit(2.0), 0.02 * F.col("n"))
    return both.select(PERIOD, "depth", "n", "n_pos", ((F.col("n") == F.col("__n")) & (F.col("n_pos") == F.col("__p"))).alias("counts_ok"), near.alias("near"))


@query
def stream_lift_stability(spark, folder):
    """Each closed day with positives: points of its gain curve, that it runs from 0 to 1, and never falls."""
    report = gain_report(_streamed_counts(spark, folder)).withColumn(PERIOD, F.to_date("period"))
    along = Window.partitionBy(PERIOD).orderBy("step")
    steps = report.withColumn("up", F.col("y") >= F.coalesce(F.lag("y").over(along), F.lit(0.0)))
    return steps.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("points"), F.min("y").alias("first"), F.max("y").alias("last"), F.bool_and("up").alias("rises"))
