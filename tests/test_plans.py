"""Plan-shape checks: pushdown, pruning, map-side combine, no cross joins."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from sparksignal.functions import sentiment
from sparksignal.operators import clean, series
from sparksignal.plans import features
from sparksignal.sources import views

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_columns_reach_the_scan(spark):
    p = plan(views.landed_news(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in p


def test_lexicon_score_is_narrow(spark):
    docs = spark.createDataFrame([(1, "best day")], "doc_id long, text string")
    p = plan(docs.select("doc_id", sentiment.lexicon_compound("text")))
    assert "Exchange" not in p and "Generate" not in p


def test_dedup_combines_map_side(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 2)], "k int, v string, o int")
    p = plan(clean.keep_first(df, ["k"], ["o"]))
    # a partial aggregate below the shuffle, the final one above it
    assert "partial_min_by" in p and "Exchange" in p and "Window" not in p


def test_minmax_has_no_cross_join_or_global_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, i), float(i)) for i in range(1, 5)],
                               "date date, v double")
    p = plan(series.minmax_scale(df, [("v", "s")]))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Window" not in p and "Subquery" in p


def test_last_n_is_a_top_k(spark):
    df = spark.range(100).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"),
                                                        F.col("id").cast("int")))
    assert "TakeOrderedAndProject" in plan(features.last_n(df, 30))


def test_daily_aggregate_is_partial_before_shuffle(spark):
    p = plan(views.prices(spark, SF))
    assert p.count("HashAggregate") >= 2 and "partial_min_by" in p


def test_feature_table_scans_each_source_once(spark):
    from sparksignal import catalog

    p = plan(catalog.features_df(spark, SF))
    scans = [line for line in p.splitlines() if line.startswith("Location:")]
    for table in ("events", "documents"):
        assert sum(f"{table}.parquet" in line for line in scans) == 1, table
    assert not any("orders.parquet" in line for line in scans)  # the day-grain prices are written once before
    assert "CartesianProduct" not in p


def test_feature_table_keeps_texts_out_of_keys_and_sorts(spark):
    from sparksignal import catalog

    p = plan(views.articles(spark, SF))
    assert "SortAggregate" not in p and "Sort " not in p and p.count("HashAggregate") >= 2
    keys = [line for line in p.splitlines() if line.startswith(("Keys", "Functions", "Arguments: hashpartitioning"))]
    assert keys and not any("summary" in k or "text#" in k for k in keys)
    p = plan(catalog.features_df(spark, SF))
    assert "SortAggregate" not in p


def test_late_rows_sort_and_group_no_text(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "id long, title string, body string")
    p = plan(clean.keep_first_rows(df, ["title"], "id"))
    assert "SortAggregate" not in p and "partial_min(id" in p
    for line in p.splitlines():
        if line.startswith(("Keys", "Functions", "Arguments: hashpartitioning", "Left keys", "Right keys")):
            assert "title" not in line and "body" not in line, line


def test_windows_of_one_series_run_in_many_tasks(spark):
    from sparksignal import catalog

    for df in (features.price_features(views.prices(spark, SF)), catalog.features_df(spark, SF)):
        main = plan(df).split("===== Subqueries =====")[0]
        assert "Window" in main and "SinglePartition" not in main


def test_scaling_per_series_has_no_window(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    assert "Window" not in plan(series.minmax_scale(df, [("v", "s")], partition_by=["k"]))
