"""Every query with a SQL statement gives that statement's result."""

import pytest

import __spark_entry__ as entry
from prepline.plans.oracles import ORACLES
from tests.compare import connect, differences
from tests.conftest import FULL, SMALL

# Their columns are levels that the smallest tables do not all hold.
NEEDS_FULL = {"final_prep", "group_rare_test", "group_rare_train", "mdl_cuts", "prep_apply", "prep_catalog", "prep_roundtrip",
              "prep_train"}
# Searches at full size take minutes; test_models runs them on small tables, tests.compare as they are.
SEARCHES = {"logit_arm", "logit_validation", "mlp_cv", "mlp_tries", "mlp_validation", "nn_arm"}


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


@pytest.fixture(scope="module")
def full():
    return connect(FULL)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SEARCHES))
def test_equals_sql(spark, small, full, name):
    folder, con = (FULL, full) if name in NEEDS_FULL else (SMALL, small)
    found = entry.queries()[name](spark, folder)
    assert differences(found, con, entry.oracle_sql()[name]) is None


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
