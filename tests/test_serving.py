"""The serving tables: texts are read, scored and moved once, whatever the number of tables made of them."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from sparksignal import catalog
from sparksignal.functions import sentiment
from sparksignal.plans.materialize import materialize
from sparksignal.session import scratch_path
from sparksignal.sources import sinks, views

DOCS = [  # id, text, lang, source: copies, ids that come twice, nulls
    (1, "A great  deal, auf nicht", "en", "s1"), (2401, "A great deal,\nauf nicht", "en", "s1"), (2401, "bad war, no sich", "de", "s1"),
    (2402, "bad war, no sich", "de", "s1"), (2402, "bad war, no sich", "de", "s1"), (4, None, "en", "s2"), (2404, None, "en", "s2"),
    (5, "", "en", None), (6, "stupid con", None, "s3"), (None, "great", "en", "s1"), (None, None, None, None), (7, "  no \t NO  ", "fr", "s2")]


@pytest.fixture(scope="module")
def tables(spark):
    root = scratch_path(spark, "given")
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string").write.parquet(f"{root}/documents.parquet")
    orders = [(i, dt.datetime(1995, 1, 1) + dt.timedelta(days=i // 2), 100.0 + i % 7) for i in range(80)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_totalprice double").write.parquet(f"{root}/orders.parquet")
    events = [(i, i % 5, ["purchase", "error", "view"][i % 3], json.dumps({"k": i % 100})) for i in range(60)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, props string").write.parquet(f"{root}/events.parquet")
    return root


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_serving_tables_come_from_one_set_of_cleaned_rows(spark, tables, monkeypatch):
    loaded, load = {}, sinks.load_serving_table

    def seen(df, root, view):
        loaded[view] = df
        return load(df, root, view)

    monkeypatch.setattr(sinks, "load_serving_table", seen)
    counts = {r.table_name: r.n_rows for r in catalog.QUERIES["serving_tables"](spark, tables).collect()}
    for view, source in (("statements", "statements"), ("conflict_news", "conflict_news"), ("tension", "tension_news")):
        df = loaded[f"serving_{view}"]
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp" not in p and "RLIKE" not in p and "Join" not in p and "Exchange" not in p, view
        assert not any("documents.parquet" in f for f in df.inputFiles()), view
        want = views.cleaned(spark, tables, source)
        assert df.dtypes == want.dtypes and _rows(df) == _rows(want) and counts[view] == want.count() > 0, view


@pytest.mark.parametrize("source", ["news", "statements", "conflict_news", "tension_news"])
def test_shared_rows_give_every_source(spark, tables, source):
    shared = materialize(views.cleaned_documents(spark, tables))
    for columns in (None, ["sentiment_compound"]):
        got = views.cleaned(spark, tables, source, columns, shared)
        want = views.cleaned(spark, tables, source, columns)
        assert got.dtypes == want.dtypes and _rows(got) == _rows(want)


def test_shared_rows_give_the_articles_and_features(spark, tables):
    shared = materialize(views.cleaned_documents(spark, tables))
    assert _rows(views.articles(spark, tables, shared)) == _rows(views.articles(spark, tables))
    got = catalog.features_df(spark, tables, shared)
    assert not any("documents.parquet" in f for f in got.inputFiles())
    digits = lambda df: _rows(catalog.present(df))
    assert digits(got) == digits(catalog.features_df(spark, tables))


def test_only_words_of_the_lexicon_are_looked_up(spark):
    df = spark.createDataFrame([("good bad Bad other",), ("other",), ("",), (None,)], "t string")
    for lexicon, want in (({}, [0.0, 0.0, 0.0, 0.0]), ({"good": 1.5, "bad": -2.5}, [-0.6705, 0.0, 0.0, 0.0]),
                          ({"good": 1.5, "bad": -2.5, **{f"w{c}": 1.0 for c in "abcdefghijklm"}}, [-0.6705, 0.0, 0.0, 0.0])):
        out = df.select(sentiment.lexicon_compound("t", lexicon).alias("s"))
        assert [r.s for r in out.collect()] == want
    assert "filter(" in out._jdf.queryExecution().optimizedPlan().toString()
