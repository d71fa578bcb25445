"""Nets of several shards and folds take their steps together, for less than one shard after the other, and are the nets of each shard alone."""

import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from prepline.operators import net
from prepline.operators.net import NetSpec, Part, Run, fit_nets, train_parts, train_stack


def shard(n, seed, width=5, embed=0):
    rng = np.random.default_rng(seed)
    x, keys, codes = rng.normal(size=(n, width)), rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(seed, seed + 9, (n, embed)).astype(np.int32)
    return x, codes, (x[:, 0] + rng.normal(size=n) > 0).astype(float), keys


def seconds(f):
    took = []
    for _ in range(5):
        began = time.perf_counter()
        f()
        took.append(time.perf_counter() - began)
    return min(took)


@pytest.mark.parametrize("options", [{}, {"batch_norm": False}, {"activation": "tanh", "layer_units": (4,)}, {"layer_units": (1,), "dropout": 0.3},
                                     {"embed": 2, "buckets": 20, "embed_dim": 3}, {"embed": 1, "buckets": 20, "optimizer": "sgd"}])
def test_parts_equal_each_alone(options):
    base = NetSpec(5, batch_size=64, **options)
    parts = []
    for k, n in enumerate((300, 700, 40, 640)):
        data = shard(n, k, embed=base.embed)
        for fold in (None, 0, 1):
            rows = None if fold is None else np.flatnonzero(np.arange(n) % 3 != fold)
            specs = [replace(base, learning_rate=0.01 * (i + 1), l2=0.01 * i) for i in range(1 + (fold == 1))]
            parts.append(Part(specs, [s.start() + 0.01 * k for s in specs], *data, rows))
    found = dict(train_parts(parts, 1, 3))
    assert sorted(found) == list(range(len(parts)))
    for p, part in enumerate(parts):
        own = slice(None) if part.rows is None else part.rows
        alone = train_stack(part.specs, part.vectors, part.x[own], part.codes[own], part.y[own], part.keys[own], 1, 3)
        assert (alone == found[p]).all()
        plain = part.specs[-1].train(part.vectors[-1], part.x[own], part.codes[own], part.y[own], part.keys[own], 1, 3)
        assert found[p][-1] == pytest.approx(plain, rel=1e-6, abs=1e-9)


def test_one_net_on_eight_shards_costs_less_than_one_by_one():
    data, spec = [shard(4096, k, 10) for k in range(8)], NetSpec(10, dropout=0.3)
    parts = [Part([spec], [spec.start()], *d) for d in data]
    together = seconds(lambda: list(train_parts(parts, 0, 1)))
    single = seconds(lambda: [train_stack([spec], [spec.start()], *d, 0, 1) for d in data])
    print("ratio", together / single)
    assert together < 0.75 * single


def test_folds_cost_less_together_than_one_by_one():
    data, specs = shard(8192, 3, 10), [NetSpec(10, dropout=0.3 + 0.1 * (i % 3), learning_rate=0.001 * (i + 1)) for i in range(10)]
    rows = [np.flatnonzero(np.arange(8192) % 4 != fold) for fold in range(4)]
    starts = [s.start() for s in specs]
    together = seconds(lambda: list(train_parts([Part(specs, starts, *data, r) for r in rows], 0, 1)))
    single = seconds(lambda: [list(train_parts([Part(specs, starts, *data, r)], 0, 1)) for r in rows])
    print("ratio", together / single)
    assert together < 0.9 * single


@pytest.mark.parametrize(("embed", "dropout", "nets", "most"), [(2, 0.0, 5, 1.0), (0, 0.4, 20, 0.92)])
def test_a_stack_costs_less_than_one_plain_net(embed, dropout, nets, most):
    x, codes, y, keys = shard(8192, 3, 10, embed)
    specs = [NetSpec(10, embed=embed, dropout=dropout, seed=i if embed else 1, learning_rate=0.001 * (i + 1)) for i in range(nets)]
    starts = [s.start() for s in specs]
    stack = seconds(lambda: train_stack(specs, starts, x, codes, y, keys, 0, 2))
    one = seconds(lambda: specs[0].train(starts[0], x, codes, y, keys, 0, 2))
    print("ratio", stack / one)
    assert stack < most * one


def test_shards_are_dealt_in_whole_rounds_of_tasks(spark, monkeypatch):
    """Thirty shards and one net: as many tasks as there are cores, each with several shards, and the same net as with a task a shard."""
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("double").alias("label"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    table, run = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).cache(), Run(NetSpec(2, batch_size=32), (2,))
    packs, train = [], net.train_runs
    monkeypatch.setattr(net, "train_runs", lambda packed, *rest: packs.append(packed.rdd.glom().map(len).collect()) or train(packed, *rest))
    found = fit_nets(table, "k", "label", [run], shard_rows=100, sync=1)
    monkeypatch.setattr(net, "STACK_BYTES", 1)
    assert found == fit_nets(table, "k", "label", [run], shard_rows=100, sync=1)
    tasks = spark.sparkContext.defaultParallelism
    assert sorted(packs[0]) == sorted((k + 1) * 30 // tasks - k * 30 // tasks for k in range(tasks)) and len(packs[1]) == 30


@pytest.mark.parametrize("halves", ["_halves", "_marked_halves"])
def test_searches_read_their_rows_with_all_cores(spark, folder, halves):
    """A table of one small file is dealt to all cores, with the same rows."""
    from prepline.plans import queries

    plain, dealt = getattr(queries, halves)(spark, folder), getattr(queries, halves)(spark, folder, dealt=True)
    for a, b in zip(plain, dealt):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
        assert b.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
