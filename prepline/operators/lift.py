"""Lift, captured response and gain curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.operators.cells import CELL
from prepline.operators.rank import (
    N, N_ALL, N_BEFORE, POS, POS_ALL, POS_BEFORE, cell_totals, grouped_rows, in_cell, place_by_score, rank_with_totals,
)
from prepline.session import cut_lineage

# The ten depths of a decile report.
DECILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)

_BROADCAST_ROWS = 200_000


def hits_at_depth(df: DataFrame, label: str, score: str, key: str | list[str],
                  depths: Sequence[float], by: Sequence[str] = (),
                  n_cells: int | None = None) -> DataFrame:
    """Positives among the top ``ceil(n * depth)`` rows of each group, for every depth.

    The cell counts settle all cells but the one each depth ends in. Only the
    rows of those cells, where positives and negatives mix, are put in order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    placed = place_by_score(grouped_rows(df.select(*by, label, score, *keys), by), score, key, n_cells)
    totals = cell_totals(placed, label, by)
    wanted = totals.withColumn("depth", F.explode(F.lit([float(d) for d in depths])))
    k = F.ceil(F.col(N_ALL).cast("double") * F.col("depth")).cast("bigint")
    ends = cut_lineage(  # one row per group and depth
        wanted.withColumn("k", k)
        .filter((F.col(N_BEFORE) < F.col("k")) & (F.col("k") <= F.col(N_BEFORE) + F.col(N)))
        .withColumn("take", F.col("k") - F.col(N_BEFORE))
    )
    plain = (
        F.when(F.col(POS) == 0, F.lit(0))
        .when(F.col("take") == F.col(N), F.col(POS))
        .when(F.col(POS) == F.col(N), F.col("take"))
    )
    open_cells = (
        ends.filter(plain.isNull()).groupBy(*by, CELL)
        .agg(F.collect_list(F.struct("depth", "take")).alias("asked"))  # one entry per depth
    )
    small = ends.count() <= _BROADCAST_ROWS
    within = (
        placed.join(F.broadcast(open_cells) if small else open_cells, [*by, CELL])
        .withColumn("rn", F.row_number().over(in_cell(df, key, by)))
        .filter(F.col(label) == 1)
        .select(*by, F.explode(F.filter("asked", lambda a: a["take"] >= F.col("rn"))).alias("a"))
        .groupBy(*by, F.col("a.depth").alias("depth"))
        .agg(F.count(F.lit(1)).alias("found"))
    )
    settled = ends.select(*by, "depth", "k", F.col(N_ALL).alias("n"), F.col(POS_ALL).alias("n_pos"),
                          F.col(POS_BEFORE), plain.alias("plain"))
    hits = F.col(POS_BEFORE) + F.coalesce("plain", "found", F.lit(0))
    return settled.join(within, [*by, "depth"], "left").select(
        *by, "depth", "k", "n", "n_pos", hits.cast("bigint").alias("hits")
    )


def lift_value() -> Column:
    """Lift from a row of ``hits_at_depth``; null where a group has no positives."""
    return F.col("hits") / F.nullif(F.col("n_pos") * F.col("depth"), F.lit(0.0))


def captured_value() -> Column:
    return F.col("hits") / F.nullif(F.col("n_pos").cast("double"), F.lit(0.0))


def lift(df: DataFrame, label: str, score: str, key: str | list[str], depth: float = 0.1,
         by: Sequence[str] = ()) -> DataFrame:
    return hits_at_depth(df, label, score, key, [depth], by).select(
        *by, "depth", "hits", "n_pos", lift_value().alias("lift"))


def cum_lift(df: DataFrame, label: str, score: str, key: str | list[str], depth: float = 0.2,
             by: Sequence[str] = ()) -> DataFrame:
    return hits_at_depth(df, label, score, key, [depth], by).select(
        *by, "depth", "hits", "n_pos", captured_value().alias("cum_lift"))


METRICS = {"lift": lift_value, "cumulative lift": captured_value}


def model_metric(name: str) -> Column:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(METRICS)}")
    return METRICS[name]()


# --- gain curves -------------------------------------------------------------


def gain_curve(df: DataFrame, label: str, score: str, key: str | list[str],
               by: Sequence[str] = ()) -> DataFrame:
    """Share of rows against share of positives after every row, from (0, 0)."""
    ranked = rank_with_totals(df, score, key, by, label)
    gain = F.col("cum_pos") / F.nullif(F.col(POS_ALL).cast("double"), F.lit(0.0))
    point = F.struct(F.col("rank").alias("rank"), (F.col("rank") / F.col(N_ALL)).alias("x"), gain.alias("gain"))
    start = F.struct(F.lit(0).cast("bigint").alias("rank"), F.lit(0.0).alias("x"), F.lit(0.0).alias("gain"))
    points = F.when(F.col("rank") == 1, F.array(start, point)).otherwise(F.array(point))
    return ranked.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def _positives(df: DataFrame, label: str, score: str, key: str | list[str], by: Sequence[str]) -> DataFrame:
    """Every positive with its number ``k``, its rank, and the ranks of the next two in its cell.

    ``i`` counts the positives of the cell, ``last`` marks the two at its end,
    whose followers lie in later cells.
    """
    window = in_cell(df, key, by)
    i = F.col("cum_pos") - F.col(POS_BEFORE)
    return (
        rank_with_totals(df, score, key, by, label)
        .filter(F.col(label) == 1)
        .withColumns({"r1": F.lead("rank", 1).over(window), "r2": F.lead("rank", 2).over(window)})
        .select(*by, F.col("cum_pos").alias("k"), F.col("rank").alias("r"), "r1", "r2",
                F.col(N_ALL).alias("n"), F.col(POS_ALL).alias("p"),
                i.alias("i"), (i > F.col(POS) - 2).alias("last"))
    )


def _across_cells(positives: DataFrame, by: Sequence[str]) -> DataFrame:
    """Give the last positives of each cell their followers.

    The first and last two of every cell are enough for that: a handful of rows
    per cell, whatever the size of the group.
    """
    along = Window.partitionBy(*by).orderBy("k")
    seams = (
        positives.filter(F.col("last") | (F.col("i") <= 2))
        .withColumns({"r1": F.lead("r", 1).over(along), "r2": F.lead("r", 2).over(along)})
        .filter("last")
    )
    return positives.filter(~F.col("last")).unionByName(seams)


def gain_midpoints(df: DataFrame, label: str, score: str, key: str | list[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Each distinct gain at the middle of its plateau; the ends are (0, 0) and (1, 1)."""
    middle = F.when(F.col("k") == F.col("p"), F.lit(1.0)).otherwise(
        (F.col("r") + F.col("r1") - 1) / (2 * F.col("n")))
    point = F.struct(F.col("k").alias("k"), middle.alias("x"), (F.col("k") / F.col("p")).alias("gain"))
    start = F.struct(F.lit(0).cast("bigint").alias("k"), F.lit(0.0).alias("x"), F.lit(0.0).alias("gain"))
    points = F.when(F.col("k") == 1, F.array(start, point)).otherwise(F.array(point))
    positives = _across_cells(_positives(df, label, score, key, by), by)
    return positives.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def _lines(steps: int) -> Column:
    """Lines of the curve that begin at a positive and cover a grid point, as an array.

    Abscissas stay integers, in units of 1 / 2n.
    """
    n, p, k = F.col("n"), F.col("p"), F.col("k")
    mid, next_mid = F.col("r") + F.col("r1") - 1, F.col("r1") + F.col("r2") - 1

    def line(at: Column, a: Column, b: Column) -> Column:
        start = F.ceil(a * F.lit(steps) / (2 * n)).cast("int")
        stop = F.when(b == 2 * n, F.lit(steps)).otherwise(F.ceil(b * F.lit(steps) / (2 * n)).cast("int") - 1)
        return F.struct(at.cast("bigint").alias("k"), a.cast("bigint").alias("a"), b.cast("bigint").alias("b"),
                        start.alias("start"), stop.alias("stop"))

    first = line(F.lit(0), F.lit(0), F.when(p == 1, 2 * n).otherwise(mid))
    inner = line(k, mid, F.when(k + 1 == p, 2 * n).otherwise(next_mid))
    both = F.array_compact(F.array(F.when(k == 1, first), F.when(k < p, inner)))
    return F.filter(both, lambda s: s["start"] <= s["stop"])


def gain_grid(df: DataFrame, label: str, score: str, key: str | list[str],
              by: Sequence[str] = (), steps: int = 100) -> DataFrame:
    """The gain curve through the plateau middles, read off at ``steps + 1`` even points.

    Each line lists the grid points it covers, so no join is needed; and only
    lines that cover one, or might once their followers are known, are kept.
    """
    positives = _positives(df, label, score, key, by)
    few = cut_lineage(positives.filter(F.col("last") | (F.col("i") <= 2) | (F.size(_lines(steps)) > 0)))
    lines = _across_cells(few, by).select(*by, "n", "p", F.explode(_lines(steps)).alias("s"))
    a, b = F.col("s.a"), F.col("s.b")
    share = (2 * F.col("n") * F.col("g") / F.lit(float(steps)) - a) / (b - a)
    return (
        lines.withColumn("g", F.explode(F.sequence("s.start", "s.stop")))
        .select(*by, F.col("g").alias("step"), (F.col("g") / F.lit(float(steps))).alias("x"),
                ((F.col("s.k") + share) / F.col("p")).alias("y"))
    )


class LiftEvaluator(Evaluator):
    """Model metric for ``CrossValidator``: lift or captured response at a depth."""

    @keyword_only
    def __init__(self, *, metric: str = "lift", depth: float = 0.1, label: str = "label",
                 key: str = "key", probability: str = "probability"):
        super().__init__()
        model_metric(metric)
        self.metric, self.depth, self.label, self.key, self.probability = metric, depth, label, key, probability

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(self.label, self.key, vector_to_array(self.probability)[1].alias("p1"))
        row = hits_at_depth(scored, self.label, "p1", self.key, [self.depth]).select(
            model_metric(self.metric).alias("m")).first()
        return float("nan") if row is None or row["m"] is None else float(row["m"])

    def isLargerBetter(self) -> bool:
        return True
