"""A step of many nets costs little more than a step of one, as what is done to a unit runs along the rows of the batch."""

import time

import numpy as np
import pytest

from prepline.operators.net import NetSpec, train_stack


def seconds(f):
    took = []
    for _ in range(5):
        began = time.perf_counter()
        f()
        took.append(time.perf_counter() - began)
    return min(took)


@pytest.mark.parametrize(("embed", "dropout", "nets", "most"), [(2, 0.0, 5, 1.5), (0, 0.4, 20, 1.7)])
def test_cost_of_a_stack(embed, dropout, nets, most):
    n, rng = 8192, np.random.default_rng(3)
    x, keys, y = rng.random((n, 10)), rng.integers(0, 2**63, n).astype(np.uint64), (rng.random(n) < 0.5).astype(float)
    codes = rng.integers(0, 30, (n, embed)).astype(np.int32)
    specs = [NetSpec(10, embed=embed, dropout=dropout, seed=i if embed else 1, learning_rate=0.001 * (i + 1)) for i in range(nets)]
    starts = [s.start() for s in specs]
    stack = seconds(lambda: train_stack(specs, starts, x, codes, y, keys, 0, 2))
    one = seconds(lambda: specs[0].train(starts[0], x, codes, y, keys, 0, 2))
    print("ratio", stack / one)
    assert stack < most * one
