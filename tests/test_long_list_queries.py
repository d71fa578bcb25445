"""Queries with a long list of levels: the list is met by a shuffle, never collected, and the rows are those of a broadcast."""

import pytest

from prepline.operators import levels
from prepline.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["levels_roundtrip", "replacement_test", "replacement_train"])
def test_long_list_is_shuffled(spark, monkeypatch, name):
    expected = {tuple(r) for r in QUERIES[name](spark, FOLDER).collect()}
    monkeypatch.setattr(levels, "BROADCAST_LEVELS", 100)
    found = QUERIES[name](spark, FOLDER)
    joins = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "__level" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    rows = found.collect()
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected
