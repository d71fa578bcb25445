"""Mixing sources to target weights.

Sizes are added up per source. Sources in code point order (a missing source last)
weigh 5, 2, 1, 5, ... and share a budget of words; a target stops at ``cap`` times
its source, and the excess is shared again by weight until no target is above.
The solution has a closed form: with sources ordered by cap over weight, those
before some position sit at their cap and the others at one common level.

A source is then repeated ``target / size`` times: each document is emitted
``floor(rate)`` times, plus one copy with the probability of the remaining
fraction. The draw is a hash of the document, so reruns agree. Among ``TRIALS``
seeds, the one whose words come nearest to the target is used for the source.

Cases: a missing text has size 0 and is emitted like any other document; repeated
rows share their draw; a source without words has target 0 and is emitted not at
all; an empty table gives an empty result. Names of the operator's own columns
start with ``__mix``, other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.llm.text import attach, stored, whole, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
TRIALS = 64
_SPAN = 2**32


def draw_seeds(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two 32-bit numbers of a document, from which every trial makes its uniform."""
    digest = F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.col(text)))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    return part(1), part(9)


def uniform(trial: Column | int) -> Column:
    trial = F.lit(trial) if isinstance(trial, int) else trial
    return F.pmod(F.col("__mix_a") + trial.cast("bigint") * F.col("__mix_b"), F.lit(_SPAN)) / F.lit(float(_SPAN))


def copies(rate: Column, trial: Column | int) -> Column:
    whole_part = F.floor(rate)
    return whole_part + F.when(uniform(trial) < rate - whole_part, 1).otherwise(0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """``__mix_source, __mix_size`` with target and rate. One row a source, numbered in one task."""
    by_name = Window.orderBy(F.col("__mix_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ratio = F.lit(cap) * F.col("__mix_size") / F.col("__mix_w")
    order = Window.orderBy("__mix_ratio", F.col("__mix_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    table = sizes.withColumn("__mix_w", weight).withColumn("__mix_ratio", ratio)
    capped = F.lit(cap) * F.coalesce(F.sum("__mix_size").over(before), F.lit(0))
    budget = F.lit(share) * F.sum("__mix_size").over(everything)
    table = table.withColumn("__mix_level", (budget - capped) / F.sum("__mix_w").over(onward))
    fits = F.when(F.col("__mix_level") <= F.col("__mix_ratio"), F.col("__mix_ratio"))
    # levels fall along the order once they fit, so the first that fits is the common one
    level = F.min(F.when(fits.isNotNull(), F.struct(fits.alias("r"), F.col("__mix_level").alias("l")))).over(everything)
    target = F.least(F.lit(cap) * F.col("__mix_size"), F.col("__mix_w") * level["l"])
    return table.select(
        "__mix_source", "__mix_size", target.alias("__mix_target"),
        F.when(F.col("__mix_size") > 0, target / F.col("__mix_size")).otherwise(0.0).alias("__mix_rate"),
    )


def mixing_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                trials: int = TRIALS, **targets) -> DataFrame:
    """One row a source: size, target, rate and the chosen seed."""
    a, b = draw_seeds(doc_id, text)
    narrow = stored(docs.select(
        F.col(source).alias("__mix_source"), word_count(whole(text)).alias("__mix_n"), a.alias("__mix_a"), b.alias("__mix_b"),
    ), "mix")
    sizes = narrow.groupBy("__mix_source").agg(F.sum("__mix_n").alias("__mix_size"))
    plan = stored(source_targets(sizes, **targets), "mix-targets")
    right = plan.withColumnRenamed("__mix_source", "__mix_key")
    rated = attach(narrow, right, F.col("__mix_source").eqNullSafe(F.col("__mix_key")), "inner")
    taken = [F.sum(F.col("__mix_n") * copies(F.col("__mix_rate"), t)).alias(f"__mix_t{t}") for t in range(trials)]
    sums = rated.groupBy("__mix_source").agg(F.first("__mix_target").alias("__mix_target"), *taken)
    miss = [F.struct(F.abs(F.col(f"__mix_t{t}") - F.col("__mix_target")), F.lit(t).alias("trial")) for t in range(trials)]
    best = sums.select(F.col("__mix_source").alias("__mix_key"), F.array_min(F.array(*miss))["trial"].alias("__mix_trial"))
    return stored(
        plan.join(best, F.col("__mix_source").eqNullSafe(F.col("__mix_key"))).drop("__mix_key"), "mix-plan"
    )


def with_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Every row with the plan of its source, its size ``__mix_n`` and its number of copies ``__mix_copies``."""
    plan = mixing_plan(docs, doc_id, text, source, **options).withColumnRenamed("__mix_source", "__mix_key")
    a, b = draw_seeds(doc_id, text)
    joined = attach(docs, plan, F.col(source).eqNullSafe(F.col("__mix_key")), "inner")
    return joined.withColumns({"__mix_a": a, "__mix_b": b, "__mix_n": word_count(whole(text))}).withColumn(
        "__mix_copies", copies(F.col("__mix_rate"), F.col("__mix_trial")).cast("int")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixture: the documents' own columns, each row as often as it is taken."""
    placed = with_copies(docs, doc_id, text, source, **options).filter(F.col("__mix_copies") > 0)
    return placed.withColumn("__mix_i", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)
