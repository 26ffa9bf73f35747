import os
import sys

import pytest

from conftest import SF01

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_harness import compare  # noqa: E402
from tessera.plans.queries import QUERIES  # noqa: E402

ROWS_ONLY = {"training_samples", "rf_pipeline"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "NDVI" in df.columns


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(o) | ROWS_ONLY >= set(QUERIES) and not set(o) & ROWS_ONLY


@pytest.mark.parametrize("name", sorted(set(E.queries()) & set(E.oracle_sql())))
def test_oracle_agreement(spark, name):
    res = compare(spark, SF01, [name], verbose=True)[name]
    assert res == "OK", res
