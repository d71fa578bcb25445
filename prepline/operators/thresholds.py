"""All decision thresholds in one pass.

A row is labelled 1 at every threshold above its probability of class 0, so
counting rows by the number of thresholds they do not exceed is enough: running
sums over those counts give the confusion matrix at each threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.operators.cells import bucketize


def threshold_sweep(df: DataFrame, label: str, p0: Column, thresholds: Sequence[float]) -> DataFrame:
    """``(j, threshold, tp, fp, fn, tn)`` for each threshold, label 1 iff ``p0 < threshold``.

    ``thresholds`` must rise. Rows leave the map side as at most two counts per threshold.
    """
    steps = [float(t) for t in thresholds]
    if any(b <= a for a, b in zip(steps, steps[1:])):
        raise ValueError("thresholds must be strictly increasing")
    scored = df.select((F.col(label) == 1).alias("y"), present_or_last(p0).alias("__p0"))
    counted = bucketize(scored, "__p0", steps, "b").groupBy("b").agg(
        F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    # Give every threshold a row; row b is reached by thresholds j >= b.
    spark = df.sparkSession
    grid = spark.createDataFrame([(j, t) for j, t in enumerate(steps)], "j int, threshold double")
    upto = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = counted.join(grid, counted["b"] == grid["j"], "full").select(
        F.coalesce("j", "b").alias("j"), "threshold",
        F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    sums = filled.select(
        "j", "threshold",
        F.sum("pos").over(upto).alias("tp"), F.sum("neg").over(upto).alias("fp"),
        F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"),
    )
    return sums.filter(F.col("threshold").isNotNull()).select(
        "j", "threshold", "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"))


def present_or_last(p0: Column) -> Column:
    """A missing probability lies past every threshold, so its row is labelled 0."""
    p0 = p0.cast("double")
    return F.when(p0.isNull() | F.isnan(p0), F.lit(float("inf"))).otherwise(p0)


def _ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def fbeta(beta: float = 1.0) -> Column:
    """0 where precision and recall leave it undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    b2 = F.lit(float(beta) ** 2)
    return F.coalesce(_ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp), F.lit(0.0))


def kappa() -> Column:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    observed = _ratio(tp + tn, n)
    expected = _ratio((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    return _ratio(observed - expected, 1 - expected)


def hard_auc() -> Column:
    """Area under the curve of a yes/no score: the mean of both class recalls."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2


def hard_average_precision() -> Column:
    """Average precision of a yes/no score."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, base = _ratio(tp, tp + fn), _ratio(tp + fn, tp + fp + fn + tn)
    return recall * F.coalesce(_ratio(tp, tp + fp), F.lit(0.0)) + (1 - recall) * base


def threshold_metric(name: str, beta: float = 1.0) -> Column:
    known = {
        "fbeta_score": lambda: fbeta(beta), "cohen_kappa_score": kappa,
        "roc_auc_score": hard_auc, "average_precision_score": hard_average_precision,
    }
    if name not in known:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(known)}")
    return known[name]()


def best_threshold(sweep: DataFrame, metric: str, beta: float = 1.0) -> DataFrame:
    """The single best row of a sweep, the earliest of equals."""
    scored = sweep.withColumn("score", threshold_metric(metric, beta))
    return scored.orderBy(F.desc_nulls_last("score"), "j").limit(1)


def label_at(p0: Column, threshold: float) -> Column:
    """1 below the threshold; 0 elsewhere, also for a missing probability."""
    return (present_or_last(p0) < F.lit(float(threshold))).cast("int")


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """``(label, predicted, n)`` with all four cells."""
    cells = df.agg(*[
        F.count_if((F.col(label) == y) & (F.col(predicted) == p)).alias(f"n{y}{p}") for y in (0, 1) for p in (0, 1)
    ])
    rows = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(f"n{y}{p}").alias("n"))
        for y in (0, 1) for p in (0, 1)
    ])
    return cells.select(F.explode(rows).alias("r")).select("r.*")


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    n = {(y, p): F.count_if((F.col(label) == y) & (F.col(predicted) == p)).cast("double") for y in (0, 1) for p in (0, 1)}
    counts = df.agg(*[c.alias(f"n{y}{p}") for (y, p), c in n.items()])

    def cell(y: int, p: int) -> Column:
        return F.col(f"n{y}{p}")

    def scores(c: int) -> tuple[Column, Column, Column, Column]:
        o = 1 - c
        zero = F.lit(0.0)
        precision = F.coalesce(_ratio(cell(c, c), cell(c, c) + cell(o, c)), zero)
        recall = F.coalesce(_ratio(cell(c, c), cell(c, c) + cell(c, o)), zero)
        f1 = F.coalesce(_ratio(2 * cell(c, c), 2 * cell(c, c) + cell(o, c) + cell(c, o)), zero)
        return precision, recall, f1, cell(c, c) + cell(c, o)

    zero_class, one_class = scores(0), scores(1)
    support = zero_class[3] + one_class[3]
    accuracy = _ratio(cell(0, 0) + cell(1, 1), support)
    macro = tuple((a + b) / 2 for a, b in zip(zero_class[:3], one_class[:3]))
    weighted = tuple(_ratio(a * zero_class[3] + b * one_class[3], support) for a, b in zip(zero_class[:3], one_class[:3]))
    lines = {
        "0": zero_class, "1": one_class,
        "accuracy": (accuracy, accuracy, accuracy, support),
        "macro avg": (*macro, support), "weighted avg": (*weighted, support),
    }
    rows = F.array(*[
        F.struct(F.lit(name).alias("row"), v[0].alias("precision"), v[1].alias("recall"), v[2].alias("f1"),
                 v[3].cast("bigint").alias("support"))
        for name, v in lines.items()
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
