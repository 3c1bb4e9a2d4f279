"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from oracle_check import compare, duck  # noqa: E402

from sparksignal.catalog import ORACLE, QUERIES  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, n = compare(spark, con, name, SF)
    assert not problems, problems
    if name in ORACLE:
        assert n >= 0
