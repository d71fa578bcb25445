"""Logits of many strengths, mini-batch nets and trees against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prepline.functions import log_grid
from prepline.operators import trees
from prepline.operators.logit_path import LogitModel, block_sums, fit_path, score_path
from prepline.operators.net import NetModel, NetSpec, Run, fit_nets, score_nets, uniforms
from prepline.operators.search import bucketed, net_cv, net_tries, net_validation


@pytest.fixture(scope="module")
def vectors(spark):
    """Two informative numbers, one on a scale of its own, and noise; the label is a noisy threshold."""
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(10_000)) / 10_000
    raw = spark.range(3000).select(F.col("id").alias("k"), u(1).alias("a"), (u(2) * 1e5).alias("b"), u(3).alias("c"), u(4).alias("e"))
    raw = raw.withColumn("label", (F.col("a") + F.col("b") / 1e5 + 0.6 * F.col("e") > 1.3).cast("double"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(raw).select("k", "label", "features", "a", "b", "c").cache()


# logits ----------------------------------------------------------------------------


def test_sums_are_the_derivatives_of_the_loss():
    rng = np.random.default_rng(1)
    x, y, w = np.column_stack([rng.normal(size=(50, 3)), np.ones(50)]), rng.integers(0, 2, 50).astype(float), rng.normal(size=(2, 4))
    n, loss, *rest = block_sums(x, y, w)[1]
    slope, upper = np.array(rest[:4]), np.array(rest[4:])
    step = 1e-6 * np.eye(4)
    at = lambda v: block_sums(x, y, v[None])[0]
    assert n == 50 and slope == pytest.approx([(at(w[1] + s)[1] - at(w[1] - s)[1]) / 2e-6 for s in step], rel=1e-6)
    bend = np.array([(at(w[1] + s)[2:6] - at(w[1] - s)[2:6]) / 2e-6 for s in step])
    assert upper == pytest.approx(bend[np.triu_indices(4)], rel=1e-5)


def test_one_scan_serves_every_strength(vectors):
    rows = vectors.select("label", vector_to_array("features").alias("x"))
    few, many = (fit_path(rows, "label", "x", log_grid(-4, 4, n), 3) for n in (3, 50))
    assert few.scans == many.scans < 25 and all(many.settled)
    assert few.models[0].coefficients == pytest.approx(many.models[0].coefficients, rel=1e-6)
    n = vectors.count()
    for c, model in list(zip(log_grid(-4, 4, 50), many.models))[::12]:
        learner = LogisticRegression(regParam=1 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=500, tol=1e-12)
        scaled = VectorAssembler(inputCols=["a", "s", "c"], outputCol="features").transform(
            vectors.drop("features").withColumn("s", F.col("b") * 1.0))
        plain = learner.fit(scaled)
        assert model.intercept == pytest.approx(plain.intercept, rel=2e-3, abs=1e-4)
        assert np.array(model.coefficients) * [1, 1e5, 1] == pytest.approx(np.array(plain.coefficients) * [1, 1e5, 1], rel=5e-3, abs=1e-3)


def test_probabilities_agree_in_both_engines(vectors):
    model = LogitModel((0.5, 2e-5, 0.0), -1.0)
    arrays = vectors.select("k", "features", vector_to_array("features").alias("x"))
    wide, (name,) = score_path(arrays, "x", [model], ["k"])
    both = wide.join(vectors.select("k", model.probability().alias("p")), "k").collect()
    assert all(r[name] == pytest.approx(r["p"], abs=1e-12) for r in both) and LogitModel.from_json(model.to_json()) == model
    long = LogitModel((0.0,) * 150 + (1.0,), 0.25)
    row = vectors.sparkSession.range(1).select(F.array_repeat(F.lit(2.0), 151).alias("x"))
    from pyspark.ml.functions import array_to_vector
    assert row.select(long.probability("v")) if "v" in row.columns else row.withColumn("v", array_to_vector("x")).select(
        long.probability("v").alias("p")).first()["p"] == pytest.approx(1 / (1 + math.exp(-2.25)))


def test_labels_of_one_class_and_missing_labels(vectors):
    rows = vectors.select(F.when(F.col("k") < 10, None).otherwise(1.0).alias("label"), vector_to_array("features").alias("x"))
    path = fit_path(rows, "label", "x", [1.0], 3, max_scans=15)
    assert all(map(math.isfinite, (*path.models[0].coefficients, path.models[0].intercept)))


# nets ------------------------------------------------------------------------------


@pytest.mark.parametrize("options", [
    {"batch_norm": False}, {"batch_norm": True}, {"activation": "tanh", "l2": 0.1}, {"activation": "sigmoid", "l1": 0.05, "dropout": 0.4},
    {"embed": 2, "buckets": 7, "embed_dim": 3, "activation": "tanh"}, {"layer_units": (4,), "dropout": 0.5, "batch_norm": False},
])
def test_slopes_equal_a_finite_difference(options):
    spec = NetSpec(3, **{"layer_units": (4, 3), "seed": 3, **options})
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)), rng.integers(0, 2, 40).astype(float)
    codes, keys = rng.integers(0, 7, (40, spec.embed)), np.arange(40, dtype=np.uint64)
    vector, masks = spec.start(), spec.masks(keys, 5)
    for name in spec.trained:  # away from the kinks and ties of the start
        vector[spec.places[name]] += rng.normal(0, 0.3, spec.places[name].stop - spec.places[name].start)
    _, slopes, _ = spec.loss_and_slopes(spec.unpack(vector), x, codes, y, masks)
    for name in spec.trained:
        for j in range(spec.places[name].start, spec.places[name].stop, 3):
            up, down = vector.copy(), vector.copy()
            up[j] += 1e-6
            down[j] -= 1e-6
            loss = [spec.loss_and_slopes(spec.unpack(v), x, codes, y, masks)[0] for v in (up, down)]
            assert slopes[name].ravel()[j - spec.places[name].start] == pytest.approx((loss[0] - loss[1]) / 2e-6, rel=1e-4, abs=1e-7), name


def test_dropout_keeps_the_share_and_depends_on_key_and_step():
    spec, keys = NetSpec(2, layer_units=(50,), dropout=0.3), np.arange(2000, dtype=np.uint64)
    (mask,), (other,) = spec.masks(keys, 1), spec.masks(keys, 2)
    assert (mask > 0).mean() == pytest.approx(0.7, abs=0.01) and mask.mean() == pytest.approx(1.0, abs=0.02)
    assert (mask != other).any() and (spec.masks(keys[::-1].copy(), 1)[0][::-1] == mask).all()
    assert uniforms(keys, 1, 2).mean() == pytest.approx(0.5, abs=0.02)


def test_reruns_agree_on_another_layout(vectors):
    runs = [Run(NetSpec(3, dropout=0.3, batch_size=64), (2, 5)), Run(NetSpec(3, optimizer="sgd", learning_rate=0.1, batch_norm=False), (3,))]
    first = fit_nets(vectors, "k", "label", runs, shard_rows=500, sync=2)
    again = fit_nets(vectors.repartition(11, "c").sortWithinPartitions("a"), "k", "label", runs, shard_rows=500, sync=2)
    assert first == again and [[m.epochs for m in r] for r in first] == [[2, 5], [3]]
    assert NetModel.from_json(first[0][0].to_json()) == first[0][0]


def test_one_shard_is_plain_mini_batch_descent(vectors):
    spec = NetSpec(3, dropout=0.2, batch_size=128)
    ((net,),) = fit_nets(vectors, "k", "label", [Run(spec, (4,))], shard_rows=10_000, sync=1)
    rows = vectors.select(F.xxhash64("k").alias("h"), "label", vector_to_array("features").alias("x")).toPandas().sort_values("h")
    x, y, keys = np.stack(rows["x"]), rows["label"].to_numpy(), rows["h"].to_numpy().view(np.uint64)
    vector = spec.train(spec.start(), x, np.zeros((len(y), 0), int), y, keys, 0, 4)
    assert np.array(net.vector) == pytest.approx(vector, rel=1e-6, abs=1e-9)  # a mean over one shard may round


def test_averages_over_shards_weigh_rows_and_only_buckets_that_occur(spark):
    """Two shards, one epoch: the state is the mean of theirs, an embedding's row the mean over shards that hold its bucket."""
    rows = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 2).cast("double").alias("label"),
                                  F.when(F.col("id") % 10 == 3, "rare").otherwise(F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("c"), F.col("id").alias("x"))
    table = bucketed(rows, ["c"], ["x"], ["k", "label"], buckets=9)
    spec = NetSpec(1, layer_units=(2,), batch_norm=False, embed=1, buckets=9, embed_dim=2)
    ((net,),) = fit_nets(table, "k", "label", [Run(spec, (1,))], "codes", shard_rows=30, sync=1)
    local = table.select(F.xxhash64("k").alias("h"), "label", vector_to_array("features").alias("x"), "codes").toPandas().sort_values("h")
    shard = np.mod(local["h"].to_numpy(), 2)
    total, weight = np.zeros(len(net.vector)), np.zeros(len(net.vector))
    for s in (0, 1):
        own = local[shard == s]
        codes = np.stack(own["codes"])
        out = spec.train(spec.start(), np.stack(own["x"]), codes, own["label"].to_numpy(), own["h"].to_numpy().view(np.uint64), 0, 1)
        w = np.full(len(out), float(len(own)))
        for name in ("e0", "m_e0", "v_e0"):
            w[spec.places[name]] = np.repeat(np.bincount(codes[:, 0], minlength=9), 2)
        total, weight = total + out * w, weight + w
    expected = np.where(weight > 0, total / np.maximum(weight, 1), spec.start())
    assert np.array(net.vector) == pytest.approx(expected, rel=1e-9, abs=1e-12)
    unseen = np.flatnonzero(np.bincount(np.stack(local["codes"])[:, 0], minlength=9) == 0)
    assert len(unseen) and (spec.unpack(np.array(net.vector))["e0"][unseen] == spec.unpack(spec.start())["e0"][unseen]).all()


def test_nets_learn_and_searches_take_dropout(vectors):
    train, test = vectors.filter("k % 2 = 0"), vectors.filter("k % 2 = 1")
    found = net_validation(train, test, "k", n_models=3, space={"learning_rate": [0.01, 0.03], "dropout": [0.0, 0.3], "epochs": [5, 40]}, layer_units=(8, 4), batch_size=32)
    assert max(found.scores) > 1.7 and {s["dropout"] for s in found.settings} <= {0.0, 0.3} and 1 <= len(found.top(2)) <= 3
    cv = net_cv(train, "k", folds=3, search="Grid Search", space={"epochs": [4], "dropout": [0.1, 0.5]}, batch_size=64)
    assert len(cv.fold_scores) == 3 and cv.bestModel.spec.dropout == cv.settings[cv.best()]["dropout"]
    with pytest.raises(ValueError):
        NetSpec(3, dropout=1.0)
    with pytest.raises(ValueError):
        NetSpec(3, layer_units=())


def test_embeddings_learn_what_one_number_cannot(spark):
    u = F.pmod(F.xxhash64("id"), F.lit(1000))
    rows = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("level "), (u % 20).cast("string")).alias("c"), (u / 1000).alias("x"),
                                    ((u % 20).isin(1, 4, 9, 16)).cast("double").alias("label"))
    table = bucketed(rows, ["c"], ["x"], ["k", "label"])
    found = net_tries(table.filter("k % 2 = 0"), table.filter("k % 2 = 1"), "k", depth=0.2, epochs=(20, 40, 20), tries=2, codes="codes", learning_rate=0.02)
    assert max(found.scores) > 4.5 and len(found.models) == 4  # of 5
    (p,) = score_nets(table, [found.models[0]], ["k"], codes="codes")[0].groupBy(F.lit(1)).agg(F.min("p1_0").alias("p")).select("p").first()
    assert 0 <= p <= 1


# trees -----------------------------------------------------------------------------


def entropy(n):
    return sum(-x * math.log2(x / sum(n)) for x in n if x)


def brute_tree(cells, y, weights, most_leaves=None, least=1):
    """Best first, by trying every cut of every column at every leaf."""
    def best(rows):
        top, n = None, [weights[0] * (y[rows] == 0).sum(), weights[1] * (y[rows] == 1).sum()]
        for c in range(cells.shape[1]):
            for cut in np.unique(cells[rows, c]):
                low = rows[cells[rows, c] <= cut]
                if least <= len(low) <= len(rows) - least:
                    a = [weights[0] * (y[low] == 0).sum(), weights[1] * (y[low] == 1).sum()]
                    gain = entropy(n) - entropy(a) - entropy([p - q for p, q in zip(n, a)])
                    if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                        top = (gain, c, cut)
        return top

    leaves = [("", np.arange(len(y)), best(np.arange(len(y))))]
    splits = {}
    while most_leaves is None or len(leaves) < most_leaves:
        able = [x for x in leaves if x[2]]
        if not able:
            break
        path, rows, (gain, c, cut) = max(able, key=lambda x: x[2][0])
        splits[path] = (c, int(cut), gain)
        leaves = [x for x in leaves if x[0] != path]
        for side, own in (("l", rows[cells[rows, c] <= cut]), ("r", rows[cells[rows, c] > cut])):
            leaves.append((path + side, own, best(own)))
    return splits, {p: tuple(rows.tolist()) for p, rows, _ in leaves}


def splits_of(tree):
    out, todo = {}, [(0, "")]
    while todo:
        at, path = todo.pop()
        if tree.columns[at] >= 0:
            out[path] = (tree.columns[at], tree.cells[at], tree.gains[at])
            todo += [(tree.left[at], path + "l"), (tree.right[at], path + "r")]
    return out


@pytest.mark.parametrize("options", [{"most_leaves": 9}, {"most_leaves": 6, "class_weight": "balanced"}, {"least_rows": 20},
                                     {"most_leaves": 12, "least_rows": 5, "class_weight": {0: 1.0, 1: 3.0}}])
def test_tree_equals_brute_force_row_by_row(spark, folder, options):
    from prepline.operators.sampling import train_test_split
    from prepline.plans.observations import LABEL, order_obs

    names = ["total_price", "acctbal", "planted", "n_lines", "max_price"]
    obs, _ = train_test_split(order_obs(spark, folder).select("obs_id", LABEL, *names), "obs_id")
    obs = obs.cache()
    forest = trees.grow(obs, names, LABEL, "obs_id", bins=32, **options)
    rows = obs.toPandas()
    cells = np.stack([np.searchsorted(np.array(c), rows[n].to_numpy(float)) for n, c in zip(names, forest.cuts)], axis=1)
    expected, leaves = brute_tree(cells, rows[LABEL].to_numpy(), forest.weights, options.get("most_leaves"), options.get("least_rows", 1))
    (tree,) = forest.trees
    found = splits_of(tree)
    assert {p: s[:2] for p, s in found.items()} == {p: s[:2] for p, s in expected.items()}
    assert [found[p][2] for p in expected] == pytest.approx([s[2] for s in expected.values()], rel=1e-9)
    leaf = {r["__key"]: r["leaf"] for r in trees.leaf_rows(obs, forest, LABEL, "obs_id").collect()}
    by_leaf = {}
    for key, at in leaf.items():
        by_leaf.setdefault(at, set()).add(key)
    assert sorted(map(sorted, by_leaf.values())) == sorted(sorted(rows["obs_id"].iloc[list(own)]) for own in leaves.values())


@pytest.fixture(scope="module")
def forest(vectors):
    return trees.grow(vectors, ["a", "b", "c"], "label", "k", trees=4, bootstrap=True, columns=2, least_share=0.01, bins=64)


def test_out_of_bag_score_is_a_recount_of_the_draws(vectors, forest):
    rows = vectors.select("k", F.xxhash64("k").alias("h"), "label", "a", "b", "c").toPandas()
    h = rows["h"].to_numpy().view(np.uint64)
    cells = np.stack([np.searchsorted(np.array(c), rows[n]) for n, c in zip("abc", forest.cuts)], axis=1)
    right = seen = 0
    for i in range(len(rows)):
        votes = []
        for tree in forest.trees:
            if trees.multiplicities(h[i : i + 1], tree.number, forest.seed)[0] == 0:
                at = 0
                while tree.columns[at] >= 0:
                    at = tree.left[at] if cells[i, tree.columns[at]] <= tree.cells[at] else tree.right[at]
                votes.append(tree.counts[at][1] / sum(tree.counts[at]))
        if votes:
            seen += 1
            right += (sum(votes) / len(votes) > 0.5) == (rows["label"].iloc[i] == 1)
    score = trees.out_of_bag_score(vectors, forest, "label", "k").first()
    assert (score["n_rows"], score["n_right"]) == (seen, right) and score["score"] > 0.8
    assert 0.3 < np.mean(trees.multiplicities(h, 0, 1) == 0) < 0.43 and np.mean(trees.multiplicities(h, 0, 1)) == pytest.approx(1.0, abs=0.1)


def test_a_saved_forest_goes_on(vectors, forest):
    args = {"label": "label", "key": "k", "bootstrap": True, "columns": 2, "least_share": 0.01, "bins": 64}
    first = trees.grow(vectors, ["a", "b", "c"], trees=1, **args)
    again = trees.grow(vectors, ["a", "b", "c"], trees=3, start=trees.Forest.from_json(first.to_json()), **args)
    assert again == forest
    assert trees.grow(vectors, ["a", "b", "c"], trees=4, **args) == forest


def test_every_leaf_holds_its_share_and_importance_finds_the_signal(forest, vectors):
    for tree in forest.trees:
        assert min(sum(n) for n, c in zip(tree.counts, tree.columns) if c < 0) >= 30
    importance = dict(forest.importance())
    assert sum(importance.values()) == pytest.approx(1.0) and importance["c"] == min(importance.values())
    chances = trees.with_chances(vectors, forest, "label", "k")
    right = chances.agg(F.avg(((F.col("p1") > 0.5).cast("int") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.85


def test_awkward_tables(spark):
    rows = spark.createDataFrame([(1, 0, None, 1.0), (2, 1, float("nan"), 1.0), (3, None, 2.0, 1.0), (4, 1, 5.0, 1.0)], "k int, y int, a double, b double")
    forest = trees.grow(rows, ["a", "b"], "y", "k")
    assert sum(forest.trees[0].counts[0]) == 3 and forest.trees[0].leaves() >= 1
    assert trees.grow(rows.limit(0), ["a"], "y", "k").trees[0].leaves() == 1
    with pytest.raises(ValueError):
        trees.grow(rows, ["a"], "y", "k", class_weight="heavy")
    with pytest.raises(ValueError):
        trees.grow(rows, ["a"], "y", "k", most_leaves=1)


@pytest.mark.parametrize("options", [{"max_depth": 5}, {"most_leaves": 12, "max_depth": 5}])
def test_a_job_looks_at_a_whole_level(spark, monkeypatch, options):
    jobs, looked = [], trees.best_splits
    monkeypatch.setattr(trees, "best_splits", lambda *a, **k: jobs.append(1) or looked(*a, **k))
    rows = spark.range(4000).selectExpr("id AS key", "hash(id) % 997 AS a", "hash(id, 1) % 991 AS b", "CAST(hash(id) % 997 + hash(id, 2) % 900 > 0 AS INT) AS y")
    grown = trees.grow(rows, ["a", "b"], "y", "key", trees=3, bootstrap=True, least_rows=20, **options)
    assert len(jobs) <= 5
    assert all(t.leaves() > 4 and t.leaves() <= options.get("most_leaves", 32) for t in grown.trees)
