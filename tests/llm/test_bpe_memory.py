"""What encoding holds at once follows the size of a matrix, not the number of pieces."""

import tracemalloc

import pytest

from prepline.llm import bpe

pytest.importorskip("regex")


def test_matrices_stay_small_however_many_pieces():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257}
    encoder = bpe.Encoder(ranks, r"\w+")
    pieces = [b"abab%08d" % i for i in range(300_000)]
    tracemalloc.start()
    try:
        out = encoder.encode_pieces(pieces)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert all(len(ids) == 4 * 9 for ids in out)
    assert (peak - held) < 100e6
