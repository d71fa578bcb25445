"""The slopes of many fits come from one pass over the training rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from prepline.operators.logit_path import LogitModel
from prepline.plans.queries import _slopes


def test_slopes_read_each_row_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(3000).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") * 0.001).alias("a"), F.sin("id").alias("b"))
    table = rows.toPandas()
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.mapInArrow(counted, rows.schema))
    models, cs = [LogitModel((0.3, -0.2), 0.1), LogitModel((1.0, 2.0), -1.0)], [0.5, 2.0]
    found = _slopes(train, models, cs)
    assert read.value == 3000
    x, y = np.column_stack([table[["a", "b"]], np.ones(3000)]), table["label"].to_numpy()
    for got, model, c in zip(found, models, cs):
        w = np.array([*model.coefficients, model.intercept])
        slope = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / 3000 + np.array([*w[:-1], 0]) / (c * 3000)
        assert got == pytest.approx(np.abs(slope / (1 + np.abs(x).mean(axis=0))).max(), rel=1e-9)
