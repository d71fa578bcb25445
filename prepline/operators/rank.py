"""Exact ranks over tables of any length, overall or within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from prepline.operators.cells import CELL, ORDER, CellPlan, descending, plan_cells, tie_columns
from prepline.session import cut_lineage

N, POS = "__n", "__pos"
N_BEFORE, POS_BEFORE = "__n_before", "__pos_before"
N_ALL, POS_ALL = "__n_all", "__pos_all"


def grouped_rows(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that belong to a group."""
    for column in by:
        df = df.filter(F.col(column).isNotNull())
    return df


def place_by_score(df: DataFrame, score: str, key: str | list[str], n_cells: int | None = None,
                   plan: CellPlan | None = None) -> DataFrame:
    """Cells for the order *score from high to low, then key*."""
    tie = tie_columns(df, key)[0]
    plan = plan or plan_cells(df, descending(score), tie, n_cells)
    return plan.place(df, descending(score), tie)


def cell_totals(placed: DataFrame, label: str | None, by: Sequence[str] = ()) -> DataFrame:
    """Rows and positives per cell, before the cell, and in the whole group.

    Counting combines on the map side, so a group holding most of the rows
    reaches the window as no more rows than there are cells.
    """
    positive = F.lit(0) if label is None else F.when(F.col(label) == 1, 1).otherwise(0)
    sizes = placed.groupBy(*by, CELL).agg(
        F.count(F.lit(1)).alias(N), F.sum(positive).cast("bigint").alias(POS)
    )
    group = Window.partitionBy(*by)
    before = group.orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *by, CELL, N, POS,
        F.coalesce(F.sum(N).over(before), F.lit(0)).alias(N_BEFORE),
        F.coalesce(F.sum(POS).over(before), F.lit(0)).alias(POS_BEFORE),
        F.sum(N).over(group).alias(N_ALL),
        F.sum(POS).over(group).alias(POS_ALL),
    )


def in_cell(df: DataFrame, key: str | list[str], by: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*by, CELL).orderBy(F.col(ORDER), *tie_columns(df, key))


def rank_with_totals(df: DataFrame, score: str, key: str | list[str], by: Sequence[str] = (),
                     label: str | None = None, n_cells: int | None = None,
                     rank: str = "rank") -> DataFrame:
    """``rank_rows`` with the cell bookkeeping still attached, for operators that go on within cells."""
    placed = place_by_score(grouped_rows(df, by), score, key, n_cells)
    totals = cell_totals(placed, label, by)
    window = in_cell(df, key, by)
    joined = placed.join(totals, [*by, CELL])
    out = joined.withColumn(rank, F.row_number().over(window) + F.col(N_BEFORE))
    if label is not None:
        positive = F.when(F.col(label) == 1, 1).otherwise(0)
        running = window.rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("cum_pos", F.sum(positive).over(running) + F.col(POS_BEFORE))
    return out


def rank_rows(df: DataFrame, score: str, key: str | list[str], by: Sequence[str] = (),
              label: str | None = None, n_cells: int | None = None, rank: str = "rank") -> DataFrame:
    """Add the 1-based rank by score (high first, ties by key) within each group.

    With ``label`` also ``cum_pos``, the positives up to and including the row.
    One shuffle, on (group, cell); a group of any size is spread over its cells.
    Rows whose group value is null belong to no group and are not ranked.
    """
    ranked = rank_with_totals(df, score, key, by, label, n_cells, rank)
    extra = [rank] + (["cum_pos"] if label is not None else [])
    return ranked.select(*df.columns, *extra)


def number_sorted(df: DataFrame, group: str, order: str, number: str) -> DataFrame:
    """Number the rows of each group from 0 in order; ``(group, order)`` is unique.

    The rows are cut into ranges over both columns, so a group of any size is
    spread out. Their places are stored once; how many rows come before each
    range then takes one row per range and group.
    """
    place = F.monotonically_increasing_id()
    placed = cut_lineage(
        df.repartitionByRange(group, order).sortWithinPartitions(group, order)
        .withColumn("__place", place).withColumn("__range", F.shiftright("__place", 33)))
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(group, "__range").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n")).select(
        group, "__range", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    code = (F.col("__place") - F.col("__first") + F.col("__before")).cast("int")
    return placed.join(F.broadcast(ranges), [group, "__range"]).select(*df.columns, code.alias(number))
