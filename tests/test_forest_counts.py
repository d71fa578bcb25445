"""Counting a level of a forest and correlating columns: no Python object a row, no sort of the rows, and no third look at them."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prepline.operators import trees
from prepline.operators.cluster import correlation_matrix


def test_cells_are_packed_and_read_in_place():
    cells = np.random.default_rng(1).integers(0, 256, (300_000, 9)).astype(np.uint8)
    began = time.perf_counter()
    packed = trees._binary(cells)
    found = trees._cells(packed, 9)
    took = time.perf_counter() - began
    began = time.perf_counter()
    plain = pa.array([c.tobytes() for c in cells], pa.binary())
    assert took < (time.perf_counter() - began) / 5
    assert packed.equals(plain) and (found == cells).all()
    assert (trees._cells(packed.slice(17, 40), 9) == cells[17:57]).all()


@pytest.mark.parametrize("size", [50, 100_000])
def test_sums_by_code(size):
    rng = np.random.default_rng(2)
    codes, often = rng.integers(0, size, 5000), rng.integers(1, 4, 5000)
    hits = often * rng.integers(0, 2, 5000)
    code, n, n1 = trees._by_code(codes, often, hits, size)
    known = np.unique(codes)
    assert (code == known).all() and n.tolist() == [often[codes == c].sum() for c in known] and n1.tolist() == [hits[codes == c].sum() for c in known]


def test_correlations_take_two_passes(spark):
    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    rows = spark.range(3000, numPartitions=3).select((F.xxhash64("id") % 1000).cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                                                     F.lit(7.5).alias("c")).mapInArrow(count, "a double, b double, c double")
    found = correlation_matrix(rows, ["a", "b", "c"])
    assert met.value == 6000
    x = np.array(rows.collect())[:, :2]
    assert np.allclose(found[:2, :2], np.corrcoef(x.T), atol=1e-12) and found[2].tolist() == [0, 0, 1]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_values_are_not_correlated(spark, bad):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, bad), (3.0, 1.0)], "a double, b double")
    with pytest.raises(Exception):
        correlation_matrix(rows, ["a", "b"])
