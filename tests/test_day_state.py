"""Incremental day state and newest headlines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparksignal.plans import day_state, features, models, reports
from sparksignal.session import scratch_path
from sparksignal.sources import versioned

DAY = dt.date(2024, 3, 1)


def _articles(spark, n, score=0.0):
    rows = [(DAY + dt.timedelta(days=i // 3), ("Reuters", "x", None)[i % 3], f"t{i}", (i % 7 - 3) / 10 + score) for i in range(n)]
    return spark.createDataFrame(rows, "date date, source string, title string, sentiment_compound double")


def _rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_merged_state_equals_a_rebuild(spark):
    root, a = scratch_path(spark, "state"), _articles(spark, 300)
    first, last = DAY, DAY + dt.timedelta(days=100)
    for back in (3, 2, 1, 0):
        day_state.refresh(spark, root, a, F.lit(last - dt.timedelta(days=back)))
    merged = versioned.read(spark, root)
    kept = a.where(F.col("date") >= F.lit(last - dt.timedelta(days=93)))
    assert merged.agg(F.min("date")).first()[0] == max(first, last - dt.timedelta(days=93))
    assert _rows(merged) == _rows(features.side_sums(kept).select(merged.columns))
    assert _rows(day_state.sides(spark, root)) == _rows(features.article_sides(kept))


def test_a_pull_replaces_its_window_and_reads_no_more(spark):
    root, as_of = scratch_path(spark, "state"), F.lit(DAY + dt.timedelta(days=20))
    day_state.refresh(spark, root, _articles(spark, 60), as_of)
    late = _articles(spark, 54, score=0.5)  # other scores; the last two days have lost rows
    day_state.refresh(spark, root, late, as_of)
    got = {(r["date"], r["side"]): r for r in versioned.read(spark, root).collect()}
    fresh = {(r["date"], r["side"]): r for r in features.side_sums(late).collect()}
    old = {(r["date"], r["side"]): r for r in features.side_sums(_articles(spark, 60)).collect()}
    start = DAY + dt.timedelta(days=18)
    assert {k for k in got if k[0] >= start} == {k for k in fresh if k[0] >= start}
    for k, r in got.items():
        assert abs(r["vw"] - (fresh if k[0] >= start else old)[k]["vw"]) < 1e-9


def test_day_state_of_an_empty_source(spark):
    root = scratch_path(spark, "state")
    assert day_state.refresh(spark, root, _articles(spark, 3).limit(0), F.lit(DAY)) == 0
    assert day_state.sides(spark, root).count() == 0


def test_headline_lists(spark):
    rows = [(DAY + dt.timedelta(days=i // 4), "ab"[i % 2], f"t{i:02d}", (0.2, -0.2, 0.0)[i % 3]) for i in range(20)] + [(None, "a", None, None)]
    df = spark.createDataFrame(rows, "date date, source string, title string, sentiment_compound double")
    assert reports.headline_lists(df, 3).first()["headlines"] == ["[negative] t16", "[positive] t18", "[neutral] t17"]
    by = {r["source"]: r["headlines"] for r in reports.headline_lists(df, 2, by=["source"], tie_break=("title",)).collect()}
    assert by == {"a": ["[negative] t16", "[positive] t18"], "b": ["[neutral] t17", "[negative] t19"]}
    assert reports.headline_lists(df.limit(0), 3).first()["headlines"] == []


def test_grouped_headlines_filter_ranks_before_the_exchange(spark):
    from test_plans import plan

    df = spark.createDataFrame([(DAY, "a", "t", 0.1)], "date date, source string, title string, sentiment_compound double")
    p = plan(reports.headline_lists(df, 2, by=["source"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_report_carries_headlines(spark):
    t = _articles(spark, 12).withColumn("escalation", F.lit("neutral")).withColumn("iran_spillover", F.lit("False"))
    report = models.tension_report(t, headlines=reports.headline_lists(t, 5))
    assert len(report.first()["headlines"].split("\n")) == 5
    assert models.tension_report(t).columns == report.columns[:-1]
