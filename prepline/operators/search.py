"""Fitting classifiers over parameter settings and choosing by lift.

All settings are fitted together: one scan of the rows serves every strength of a logit, and one
job an epoch, or a few, every net. All fitted models then score
the validation rows in a single pass, and one grouped lift job, with the
setting as the group, measures every model at once.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.functions import linear_grid, log_grid
from prepline.operators.lift import hits_at_depth, model_metric
from prepline.operators.logit_path import WIDEST, LogitModel, fit_path, score_path
from prepline.operators.net import NetModel, Run, fit_nets, score_nets, spec_of
from prepline.operators.sampling import SEED, assign_fold
from prepline.operators.thresholds import (
    best_threshold, classification_report, confusion_matrix, label_at, threshold_sweep,
)
from prepline.session import held


def grid(space: dict[str, Sequence]) -> list[dict]:
    """Every combination of the listed values, in the order given."""
    names = list(space)
    return [dict(zip(names, values)) for values in itertools.product(*space.values())]


def sample_settings(space: dict[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different combinations, or all when there are fewer."""
    every = grid(space)
    return every if n >= len(every) else random.Random(seed).sample(every, n)


def settings(space: dict[str, Sequence], how: str, n: int, seed: int = SEED) -> list[dict]:
    if how not in ("Random Search", "Grid Search"):
        raise ValueError(f"unknown search {how!r}")
    return grid(space) if how == "Grid Search" else sample_settings(space, n, seed)


def score_by_setting(wide: DataFrame, scores: Sequence[str], label: str, key: str, metric: str,
                     depth: float) -> DataFrame:
    """``(setting, score)`` for every score column; settings without positives score null."""
    entries = F.array(*[F.struct(F.lit(i).alias("setting"), F.col(c).alias("p1")) for i, c in enumerate(scores)])
    long = wide.select(key, label, F.explode(entries).alias("e")).select(key, label, "e.*")
    return hits_at_depth(long, label, "p1", key, [depth], by=["setting"]).select(
        "setting", model_metric(metric).alias("score"))


def best_setting(scores: DataFrame) -> DataFrame:
    """Top score, the earliest setting of equals."""
    return scores.orderBy(F.desc_nulls_last("score"), "setting").limit(1)


def top_settings(scores: DataFrame, n: int = 5) -> DataFrame:
    """Settings whose competition rank by score is within ``n``; one row per model."""
    ranked = scores.withColumn("rank", F.rank().over(Window.orderBy(F.desc_nulls_last("score"))))
    return ranked.filter(F.col("rank") <= n)


def _fit_all(fit: Callable, todo: Sequence, parallelism: int) -> list:
    with ThreadPool(min(parallelism, max(len(todo), 1))) as pool:
        return pool.map(fit, todo)


def _score_all(test: DataFrame, models: Sequence, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"p1_{i}" for i in range(len(models))]
    out = test
    for name, model in zip(names, models):
        quiet = model.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"v_{name}")
        out = quiet.transform(out).withColumn(name, vector_to_array(f"v_{name}")[1]).drop(f"v_{name}")
    return out.select(*keep, *names), names


def _measure(train_scores: DataFrame, names: Sequence[str], label: str, key: str, metric: str,
             depth: float) -> list[float | None]:
    rows = score_by_setting(train_scores, names, label, key, metric, depth).collect()  # one row per model
    found = {r["setting"]: r["score"] for r in rows}
    return [found.get(i) for i in range(len(names))]


def _first_best(scores: Sequence[float | None]) -> int:
    known = [i for i, s in enumerate(scores) if s is not None]
    if not known:
        raise ValueError("no setting could be scored: the validation rows hold no positives")
    return max(known, key=lambda i: (scores[i], -i))


def scored(model, df: DataFrame, keep: Sequence[str], codes: str | None = None) -> DataFrame:
    """``keep`` and the probability of class 1."""
    if isinstance(model, LogitModel):
        return df.select(*keep, model.probability().alias("p1"))
    if isinstance(model, NetModel):
        return score_nets(df, [model], keep, codes=codes if model.spec.embed else None)[0].withColumnRenamed("p1_0", "p1")
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias("p1"))


@dataclass(frozen=True)
class LogitResult:
    model: object
    cs: tuple[float, ...]
    scores: tuple[float | None, ...]
    best_c: float
    model_score: float
    threshold: float
    threshold_score: float
    confusion: DataFrame
    report: DataFrame
    predictions: DataFrame
    models: tuple = ()
    scans: int | None = None  # of the training rows, for all strengths together

    def table(self) -> DataFrame:
        spark = self.predictions.sparkSession
        rows = [(i, c, s, c == self.best_c) for i, (c, s) in enumerate(zip(self.cs, self.scores))]
        return spark.createDataFrame(rows, "setting int, c double, score double, best boolean")


def logit_model(c: float, n_rows: int, max_iter: int = 100) -> LogisticRegression:
    """Ridge logit with inverse strength ``c`` on the summed loss and a free intercept."""
    return LogisticRegression(regParam=1.0 / (c * n_rows), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter)


def logit_search(train: DataFrame, test: DataFrame, key: str, label: str = "label",
                 c_grid: tuple[float, float, int] = (-4, 4, 50), metric: str = "lift",
                 threshold_by: str = "fbeta_score", thresholds: tuple[float, float, int] = (0.7, 1.0, 1000),
                 depth: float = 0.1, beta: float = 1.0, parallelism: int = 4, max_iter: int = 100) -> LogitResult:
    """Search the strength by lift on ``test``, then the threshold by a yes/no metric.

    Both tables hold ``key``, the label and a ``features`` vector.
    """
    model_metric(metric)
    cs, width, scans = log_grid(*c_grid), _width(train), None
    arrays = [label, vector_to_array("features").alias("__x")]
    with held(train.select(*arrays) if width <= WIDEST else train.select(label, "features")) as rows:
        if width <= WIDEST:
            path = fit_path(rows, label, "__x", cs, width, max_iter)
            models, scans = path.models, path.scans
            wide, names = score_path(test.select(key, *arrays), "__x", models, [key, label])  # read once, for the scores are held
        else:  # curvatures would be too large to gather
            n_rows = rows.count()
            models = _fit_all(lambda c: logit_model(c, n_rows, max_iter).setLabelCol(label).fit(rows), cs, parallelism)
            wide, names = _score_all(test.select(key, label, "features"), models, [key, label])
        with held(wide) as measured:  # else every pass would apply all models again
            scores = _measure(measured, names, label, key, metric, depth)
            at = _first_best(scores)
            sweep = threshold_sweep(measured, label, 1 - F.col(names[at]), linear_grid(*thresholds))
            cut = best_threshold(sweep, threshold_by, beta).first()
    predictions = scored(models[at], test, [key, label]).withColumn("predicted", label_at(1 - F.col("p1"), cut["threshold"]))
    return LogitResult(
        models[at], tuple(cs), tuple(scores), cs[at], scores[at], cut["threshold"], cut["score"],
        confusion_matrix(predictions, label, "predicted"), classification_report(predictions, label, "predicted"),
        predictions, tuple(models), scans)


# --- neural classifier ---------------------------------------------------------

# The parameters a random search draws from.
NET_SPACE = {"learning_rate": tuple(round(v, 6) for v in log_grid(-3, -1, 50)), "epochs": tuple(range(100, 300, 50)),
             "dropout": (0.3, 0.4, 0.5, 0.6)}


def net(n_inputs: int, layer_units: Sequence[int] = (3, 2), epochs: int = 100, learning_rate: float | None = None,
        batch_size: int = 256, solver: str | None = None, seed: int = SEED, label: str = "label",
        tol: float = 1e-6) -> MultilayerPerceptronClassifier:
    """Feed-forward net with the given hidden layers and two outputs.

    A learning rate calls for gradient descent, the solver that has one; without it, L-BFGS
    chooses its steps itself. ``batch_size`` is the number of rows computed on at once: it
    changes the speed, not the model, as every step sees all rows.
    """
    if not layer_units or n_inputs < 1:
        raise ValueError("a net needs inputs and at least one hidden layer")
    solver = solver or ("l-bfgs" if learning_rate is None else "gd")
    if learning_rate is not None and solver != "gd":
        raise ValueError(f"solver {solver!r} has no learning rate")
    learner = MultilayerPerceptronClassifier(
        layers=[n_inputs, *layer_units, 2], maxIter=epochs, blockSize=batch_size, solver=solver, seed=seed,
        labelCol=label, tol=tol)
    return learner if learning_rate is None else learner.setStepSize(learning_rate)


def _width(df: DataFrame) -> int:
    return int(df.schema["features"].metadata["ml_attr"]["num_attrs"])


def _fit_settings(rows: DataFrame, key: str, label: str, chosen: Sequence[dict], folds: Sequence[int | None], codes: str | None,
                  sync: int | None = None) -> list[list[NetModel]]:
    """A net for every fold left out (None: all rows) and every setting; settings that differ only in epochs are one run."""
    embed = rows.select(F.size(codes)).first()[0] if codes else 0
    specs = [spec_of(_width(rows), **({"embed": embed} if embed else {}), **one) for one in chosen]
    runs: dict = {}
    for fold in folds:
        for spec, epochs in specs:
            runs.setdefault((spec, fold), set()).add(epochs)
    todo = [Run(spec, tuple(sorted(epochs)), fold) for (spec, fold), epochs in runs.items()]
    fitted = fit_nets(rows, key, label, todo, codes, "fold" if list(folds) != [None] else None, **({"sync": sync} if sync else {}))
    found = {(r.spec, r.without_fold, e): m for r, models in zip(todo, fitted) for e, m in zip(r.epochs, models)}
    return [[found[spec, fold, epochs] for spec, epochs in specs] for fold in folds]


@dataclass(frozen=True)
class NetSearch:
    """Mean score of every setting over the folds, and the best setting fitted on all rows."""

    settings: tuple[dict, ...]
    fold_scores: tuple[tuple[float | None, ...], ...]  # a tuple a fold
    avgMetrics: tuple[float | None, ...]
    bestModel: NetModel

    def best(self) -> int:
        return _first_best(self.avgMetrics)


def net_cv(train: DataFrame, key: str, label: str = "label", metric: str = "lift", depth: float = 0.1,
           search: str = "Random Search", folds: int = 4, n_models: int = 10,
           space: dict[str, Sequence] | None = None, seed: int = SEED, codes: str | None = None, **fixed) -> NetSearch:
    """Cross validation over folds drawn by key, so that a re-run compares the same rows.

    A setting may name any argument of a net. All settings of all folds are fitted
    together; each fold is measured by one lift job. ``codes`` names a column of buckets to embed.
    """
    model_metric(metric)
    if folds < 2 or n_models < 1:
        raise ValueError("folds must be at least 2 and n_models at least 1")
    chosen = [{"seed": seed, **fixed, **one} for one in settings(space or NET_SPACE, search, n_models, seed)]
    columns, scores = [key, label, "features", *([codes] if codes else [])], []
    with held(assign_fold(train.select(*columns), key, folds)) as rows:
        fitted = _fit_settings(rows, key, label, chosen, range(folds), codes)
        for fold, models in enumerate(fitted):
            wide, names = score_nets(rows.filter(F.col("fold") == fold), models, [key, label], codes=codes)
            with held(wide) as measured:
                scores.append(tuple(_measure(measured, names, label, key, metric, depth)))
        found = [[s[i] for s in scores if s[i] is not None] for i in range(len(chosen))]
        means = tuple(sum(v) / len(v) if v else None for v in found)
        ((model,),) = _fit_settings(rows, key, label, [chosen[_first_best(means)]], [None], codes)
    return NetSearch(tuple(chosen), tuple(scores), means, model)


@dataclass(frozen=True)
class NetResult:
    models: tuple[NetModel, ...]
    settings: tuple[dict, ...]
    scores: tuple[float | None, ...]
    predictions: DataFrame  # of the best model: key, label, p1, predicted
    confusion: DataFrame
    report: DataFrame

    def best(self) -> int:
        return _first_best(self.scores)

    def top(self, n: int = 5) -> list[NetModel]:
        """Nets whose competition rank by score is within ``n``, to be saved."""
        known = [s for s in self.scores if s is not None]
        return [m for m, s in zip(self.models, self.scores) if s is not None and sum(o > s for o in known) < n]


def net_validation(train: DataFrame, test: DataFrame, key: str, label: str = "label", metric: str = "lift",
                   depth: float = 0.1, search: str = "Random Search", n_models: int = 20,
                   space: dict[str, Sequence] | None = None, seed: int = SEED, codes: str | None = None, **fixed) -> NetResult:
    """Fit every setting once and score it on ``test``; all models, and what the best one predicts, are returned."""
    model_metric(metric)
    chosen = [{"seed": seed, **fixed, **one} for one in settings(space or NET_SPACE, search, n_models, seed)]
    columns = ["features", *([codes] if codes else [])]
    with held(train.select(key, label, *columns)) as rows, held(test.select(key, label, *columns)) as valid:
        (models,) = _fit_settings(rows, key, label, chosen, [None], codes)
        wide, names = score_nets(valid, models, [key, label], codes=codes)
        with held(wide) as measured:
            scores = _measure(measured, names, label, key, metric, depth)
    best = models[_first_best(scores)]
    predictions = scored(best, test, [key, label], codes).withColumn("predicted", (F.col("p1") > 0.5).cast("int"))
    return NetResult(tuple(models), tuple(chosen), tuple(scores), predictions,
                     confusion_matrix(predictions, label, "predicted"),
                     classification_report(predictions, label, "predicted"))


def net_tries(train: DataFrame, test: DataFrame, key: str, label: str = "label", metric: str = "lift",
              depth: float = 0.1, epochs: tuple[int, int, int] = (100, 1000, 100), tries: int = 5,
              seed: int = SEED, codes: str | None = None, **fixed) -> NetResult:
    """Every number of epochs, several random starts each; ``best`` keeps the first of equals.

    The numbers of epochs of one start are one run, measured on the way.
    """
    space = {"epochs": list(range(epochs[0], epochs[1] + 1, epochs[2])), "seed": [seed + i for i in range(tries)]}
    return net_validation(train, test, key, label, metric, depth, "Grid Search", 0, space, codes=codes, **fixed)


# --- hashed categories ---------------------------------------------------------

HASH_BUCKETS = 250  # fixed value: buckets a category is hashed into


def hash_bucket(column: str, buckets: int = HASH_BUCKETS) -> Column:
    """Bucket of a category by the JVM's 32-bit hash."""
    return F.pmod(F.hash(F.col(column)), F.lit(buckets))


def md5_bucket(column: str, buckets: int = HASH_BUCKETS) -> Column:
    """Bucket of a category that any engine can reproduce."""
    head = F.substring(F.md5(F.col(column)), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def bucketed(df: DataFrame, nominal: Sequence[str], numeric: Sequence[str], keep: Sequence[str] = (),
             buckets: int = HASH_BUCKETS, codes: str = "codes", out: str = "features") -> DataFrame:
    """``keep``, the bucket of every category for a net to embed, and a vector of the numbers."""
    from pyspark.ml.feature import VectorAssembler

    numbers = [f"__n{i}" for i in range(len(numeric))]
    placed = df.select(*keep, F.array(*[hash_bucket(c, buckets) for c in nominal]).cast("array<int>").alias(codes),
                       *[F.col(f"`{c}`").cast("double").alias(s) for c, s in zip(numeric, numbers)])
    return VectorAssembler(inputCols=numbers, outputCol=out).transform(placed).select(*keep, codes, out)


def hashed_features(df: DataFrame, nominal: Sequence[str], numeric: Sequence[str], keep: Sequence[str] = (),
                    buckets: int = HASH_BUCKETS, out: str = "features") -> DataFrame:
    """``keep`` and a vector: one 0/1 slot per bucket and category, then the numbers."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    slots = [f"__h{i}" for i in range(len(nominal))]
    numbers = [f"__n{i}" for i in range(len(numeric))]
    placed = df.select(
        *keep,
        *[hash_bucket(c, buckets).cast("double").alias(s) for c, s in zip(nominal, slots)],
        *[F.col(f"`{c}`").cast("double").alias(s) for c, s in zip(numeric, numbers)],
    )
    coded = [f"{s}_v" for s in slots]
    if slots:
        sizes = placed.sparkSession.range(buckets).select(*[F.col("id").cast("double").alias(s) for s in slots])
        placed = OneHotEncoder(inputCols=slots, outputCols=coded, dropLast=False).fit(sizes).transform(placed)
    return VectorAssembler(inputCols=[*coded, *numbers], outputCol=out).transform(placed).select(*keep, out)
