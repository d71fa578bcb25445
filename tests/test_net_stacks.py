"""Nets trained in a stack are the nets trained one by one."""

import time
from dataclasses import replace

import numpy as np
import pytest

from prepline.operators.net import NetSpec, Run, stacks, train_stack


def table(n=700, width=5, embed=0):
    rng = np.random.default_rng(5)
    x, keys = rng.normal(size=(n, width)), rng.integers(0, 2**63, n).astype(np.uint64)
    codes = rng.integers(0, 9, (n, embed)).astype(np.int32)
    return x, codes, (x[:, 0] + rng.normal(size=n) > 0).astype(float), keys


@pytest.mark.parametrize("options", [{}, {"batch_norm": False}, {"optimizer": "sgd"}, {"activation": "tanh", "layer_units": (4,)},
                                     {"embed": 2, "buckets": 11, "embed_dim": 3}, {"embed": 1, "buckets": 11, "optimizer": "sgd"}])
def test_stack_equals_one_by_one(options):
    base = NetSpec(5, batch_size=64, **options)
    specs = [replace(base, dropout=d, learning_rate=r, seed=s, l2=p) for d, r, s, p in ((0.0, 0.01, 1, 0.0), (0.4, 0.03, 1, 0.01), (0.3, 0.01, 2, 0.0))]
    x, codes, y, keys = table(embed=base.embed)
    starts = [s.start() for s in specs]
    found = train_stack(specs, starts, x, codes, y, keys, 2, 5)
    for spec, start, out in zip(specs, starts, found):
        assert out == pytest.approx(spec.train(start, x, codes, y, keys, 2, 5), rel=1e-6, abs=1e-9)
        (alone,) = train_stack([spec], [start], x, codes, y, keys, 2, 5)
        assert (alone == out).all()  # a net does not depend on its neighbours


def test_copies_share_all_nets_evenly():
    open_ = {i: (Run(NetSpec(5, learning_rate=0.01 * (i + 1)), (1,), i % 4), np.zeros(1)) for i in range(40)}
    dealt = [[i for _, own in stacks(open_, 3, copy) for i, _, _ in own] for copy in range(3)]
    assert sorted(i for own in dealt for i in own) == list(range(40)) and max(map(len, dealt)) <= 14


def test_twenty_nets_cost_few_times_one():
    x, codes, y, keys = table(4000)
    specs = [NetSpec(5, dropout=0.3, learning_rate=0.001 * (i + 1)) for i in range(20)]
    starts = [s.start() for s in specs]

    def seconds(f):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            f()
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(lambda: train_stack(specs, starts, x, codes, y, keys, 0, 2)) < 8 * seconds(lambda: specs[0].train(starts[0], x, codes, y, keys, 0, 2))
