"""The driver contract of __spark_entry__.py."""

from __future__ import annotations

import __spark_entry__ as entry_mod


def test_entry_runs_on_smallest_tables(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:6] == ["date", "open", "high", "low", "close", "volume"]


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 55
    assert all(s.lstrip().upper().startswith(("WITH", "SELECT")) for s in o.values())
