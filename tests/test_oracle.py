"""Every registered query against its DuckDB twin on the smallest test scale."""

import pytest

import __spark_entry__ as E
from releaseflow.plans import ORACLES, QUERIES
from tools.oracle_check import compare

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res.startswith("OK") or res.startswith("no-oracle"), res


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 13
    assert df.columns == ["release_name", "source", "n_releases", "mean_abs_surprise_pct",
                          "max_abs_surprise_pct", "surprise_std", "n_beats", "n_misses"]
