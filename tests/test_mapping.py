"""The logical inputs reach every branch of the operators: shown on the oracle SQL's results."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from oracle_check import duck  # noqa: E402

from sparksignal.catalog import ORACLE  # noqa: E402
from sparksignal.oracle_sql import compose  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("query, column, at_least", [
    ("stance_daily", "favor_count > 0", 1), ("stance_daily", "against_count > 0", 1),
    ("stance_daily", "favor_ratio > 0.5", 1), ("stance_daily", "favor_ratio < 0.5", 1),
    ("json_listing", "sentiment_compound > 0", 1), ("json_listing", "sentiment_compound < 0", 1),
    ("ceasefire", "ceasefire", 1), ("ceasefire", "NOT ceasefire", 1),
    ("feature_table", "favor_ratio <> 0.5", 1), ("feature_table", "war_sentiment_avg <> 0", 1),
])
def test_branch_is_reached(con, query, column, at_least):
    n = con.sql(f"SELECT count(*) FROM ({ORACLE[query]}) WHERE {column}").fetchall()[0][0]
    assert n >= at_least


def test_credible_and_other_sources_occur(con):
    n, credible = con.sql(compose(
        "SELECT count(*), count_if(source LIKE '%Reuters') FROM landed_news")).fetchall()[0]
    assert 0 < credible < n


def test_every_document_and_event_is_read(con):
    for cte, table in [("landed_news", "documents"), ("landed_statements", "documents"),
                       ("landed_conflict", "documents"), ("landed_tension", "documents"),
                       ("posts", "events")]:
        got = con.sql(compose(f"SELECT count(DISTINCT src_id) FROM {cte}")).fetchall()[0][0]
        key = "doc_id" if table == "documents" else "event_id"
        assert got == con.sql(f"SELECT count(DISTINCT {key}) FROM {table}").fetchall()[0][0]
