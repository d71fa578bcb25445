"""Stability reports on a stream of scored rows.

Scores fall into cells fixed beforehand, as from the training scores. The state of an open
period is its counts by cell: rows and positives. Rows that come late, but before the watermark has
passed their period, are added to it; once it has passed, the period's counts are written, once, and its report can be read.
A report needs the counts only, so the same function serves a finished table.

Within the cell that a depth ends in, positives count by their share: hits are exact
where a depth ends at a cell's edge, and off by less than the positives of one cell elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prepline.operators.cells import CELL, CellPlan, bucketize, descending, plan_cells, tie_columns
from prepline.operators.lift import DECILES

PERIOD = "period"


def score_cells(scores: DataFrame, score: str, key: str, n_cells: int = 512) -> CellPlan:
    """Cells for later periods from the scores of a finished table; ties keep a cell of their own."""
    plan = plan_cells(scores, descending(score), tie_columns(scores, key)[0], n_cells)
    return CellPlan(plan.edges)


def _placed(rows: DataFrame, score: str, plan: CellPlan) -> DataFrame:
    return bucketize(rows.withColumn("__s", descending(score)), "__s", list(plan.edges), CELL).drop("__s")


def cell_counts(rows: DataFrame, label: str, score: str, at: str, plan: CellPlan, width: str, delay: str | None = None) -> DataFrame:
    """``period, __cell, n, n_pos`` for windows of ``width`` of the time ``at``; on a stream with a watermark of ``delay``."""
    if delay is not None:
        rows = rows.withWatermark(at, delay)
    counted = _placed(rows, score, plan).groupBy(F.window(at, width).alias("w"), CELL).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"))
    return counted.select(F.col("w.start").alias(PERIOD), CELL, "n", "n_pos")


COUNTS = T.StructType([T.StructField(PERIOD, T.TimestampType()), T.StructField(CELL, T.IntegerType()),
                       T.StructField("n", T.LongType()), T.StructField("n_pos", T.LongType())])


def _append(batch: DataFrame, number: int, folder: str) -> None:
    """A batch that runs again after a failure replaces what it wrote."""
    batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")


def write_counts(stream: DataFrame, label: str, score: str, at: str, plan: CellPlan, width: str, delay: str, folder: str,
                 checkpoint: str) -> StreamingQuery:
    """Write the counts of each period as it closes."""
    counts = cell_counts(stream, label, score, at, plan, width, delay)
    return (counts.writeStream.outputMode("append").foreachBatch(partial(_append, folder=folder))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def closed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all periods that have closed."""
    return spark.read.schema(COUNTS).parquet(folder).select(*COUNTS.names)


def _running(counts: DataFrame) -> DataFrame:
    group = Window.partitionBy(PERIOD)
    before = group.orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    return counts.select(PERIOD, CELL, "n", "n_pos", total("n", before).alias("n0"), total("n_pos", before).alias("p0"),
                         total("n", group).alias("n_all"), total("n_pos", group).alias("p_all"))


def _inside(k: Column) -> Column:
    """Positives up to place ``k``, which lies in this cell."""
    return F.col("p0") + F.col("n_pos") * (k - F.col("n0")) / F.col("n")


def decile_report(counts: DataFrame, depths: Sequence[float] = DECILES) -> DataFrame:
    """Hits and lift at every depth, per period."""
    asked = _running(counts).withColumn("depth", F.explode(F.lit([float(d) for d in depths])))
    k = F.ceil(F.col("n_all").cast("double") * F.col("depth")).cast("bigint")
    ends = asked.withColumn("k", k).filter((F.col("n0") < F.col("k")) & (F.col("k") <= F.col("n0") + F.col("n")))
    hits = ends.withColumn("hits", _inside(F.col("k")))
    lift = F.col("hits") / F.nullif(F.col("p_all") * F.col("depth"), F.lit(0.0))
    return hits.select(PERIOD, "depth", F.col("n_all").alias("n"), F.col("p_all").alias("n_pos"), "hits", lift.alias("lift"))


def gain_report(counts: DataFrame, steps: int = 100) -> DataFrame:
    """Captured share of the positives at even points of the rows, per period with positives."""
    asked = _running(counts).filter("p_all > 0").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    k = F.col("step") * F.col("n_all") / F.lit(float(steps))
    first = (F.col("step") == 0) & (F.col("n0") == 0)
    here = asked.withColumn("k", k).filter(first | ((F.col("n0") < F.col("k")) & (F.col("k") <= F.col("n0") + F.col("n"))))
    return here.select(PERIOD, "step", (F.col("step") / F.lit(float(steps))).alias("x"), (_inside(F.col("k")) / F.col("p_all")).alias("y"))


def rate_report(counts: DataFrame) -> DataFrame:
    """Rows, positives and the share of positives, per period."""
    return counts.groupBy(PERIOD).agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")).withColumn("target_rate", F.col("n_pos") / F.col("n"))
