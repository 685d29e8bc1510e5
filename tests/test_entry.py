"""Driver contract: entry runs, every query has an oracle, and all agree with DuckDB."""

import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from kestrel.plans.oracle import ORACLE  # noqa: E402
from kestrel.plans.queries import QUERIES  # noqa: E402


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["n", "bigram"] and len(rows) > 0
    ns = [r.n for r in rows]
    assert ns == sorted(ns, reverse=True) and len(set(ns)) <= 10


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    from check_oracle import duck as make

    return make(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from check_oracle import compare

    res = compare(spark, duck, name, SF_SMALL)
    assert res["ok"], res
