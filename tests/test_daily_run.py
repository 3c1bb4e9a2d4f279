"""End-to-end daily batch over CSV files landed from the driver tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.plans import daily_run, models, quality
from sparksignal.session import scratch_path
from sparksignal.sources import files, sinks, versioned, views

SF = "/root/testdata/sf0.001"


def _land(spark, landing):
    frames = {"prices": views.prices(spark, SF),
              **{s: views.LANDED[s](spark, SF).drop("src_id") for s in views.LANDED}}
    for source, df in frames.items():
        out = df.withColumn("date", F.col("date").cast("string"))
        for day in ("2024-01-30", "2024-01-31"):  # a full re-landing on the second day
            sinks.land_csv(out.withColumn("ingest_date", F.lit(day)), f"{landing}/{source}")
    return frames


def test_daily_run_end_to_end(spark):
    root = scratch_path(spark, "daily")
    frames = _land(spark, f"{root}/landing")
    written = daily_run.run(spark, f"{root}/landing", f"{root}/warehouse")
    n_days = frames["prices"].count()
    assert written["clean/prices"] == n_days
    assert written["features"] == n_days and written["daily_summary"] == n_days
    assert written["signals"] == n_days and written["exit_index"] == n_days
    assert written["evaluation"] == 1
    assert written["tension_batches"] == 2  # one per landing day
    assert written["bronze/prices"] == 2 * n_days

    def read(name):
        return versioned.read(spark, f"{root}/warehouse/{name}")

    assert {r.status for r in read("quality/volume_gate").collect()} == {"proceed"}
    assert {r.status for r in read("quality/landing").collect()} == {"OK"}
    assert spark.table("serving_daily_summary_30d").count() == 30
    assert read("quality/file_spans").where("source = 'prices'").agg({"n_rows": "sum"}).first()[0] == 2 * n_days
    assert read("clean/posts").count() == views.cleaned(spark, SF, "posts").count()
    assert read("clean/news").count() == views.cleaned(spark, SF, "news").count()
    assert read("model_metrics").count() == 1
    # the next run refreshes every table and keeps one document a day
    again = daily_run.run(spark, f"{root}/landing", f"{root}/warehouse")
    assert again == written


def _prices(spark, n):
    return spark.createDataFrame([(f"2024-01-{i + 1:02d}", 1.0, 2.0, 0.5, 1.0 + i, 5, "2024-02-01") for i in range(n)],
                                 "date string, open double, high double, low double, close double, volume long, ingest_date string")


def test_too_few_rows_end_the_run_before_features(spark):
    root = scratch_path(spark, "daily")
    sinks.land_csv(_prices(spark, 9), f"{root}/landing/prices")
    written = daily_run.run(spark, f"{root}/landing", f"{root}/warehouse")
    assert written["clean/prices"] == 9 and "features" not in written
    gate = versioned.read(spark, f"{root}/warehouse/quality/volume_gate").collect()
    assert {(r.total_rows, r.status) for r in gate} == {(9, "low_data")} and len(gate) == 6
    assert {r.source: r.status for r in versioned.read(spark, f"{root}/warehouse/quality/landing").collect()}["posts"] == "MISSING"
    with pytest.raises(FileNotFoundError, match="features"):
        daily_run.predict_publish(spark, f"{root}/warehouse")


def test_absent_sources_give_defaults(spark):
    root = scratch_path(spark, "daily")
    sinks.land_csv(_prices(spark, 12), f"{root}/landing/prices")
    written = daily_run.run(spark, f"{root}/landing", f"{root}/warehouse")
    assert written["features"] == 12 and written["exit_index"] == 12 and written["clean/posts"] == 0
    feats = versioned.read(spark, f"{root}/warehouse/features")
    assert {(r.favor_ratio, r.war_article_count, r.news_sentiment) for r in feats.collect()} == {(0.5, 0, 0.0)}
    assert written["model_test_predictions"] == 0 and written["evaluation"] == 0
    assert spark.table("serving_tension").columns[:3] == ["date", "source", "title"]


def test_pressure_needs_two_days(spark):
    one = spark.createDataFrame([], schemas.FEATURES).unionByName(
        spark.createDataFrame([(dt.date(2024, 1, 1), *[1.0] * 4, 5, *[0.1] * 8, 1, 1, 0, 1.0, 0.1, 0.1, 0)], schemas.FEATURES))
    two = one.unionByName(one.withColumn("date", F.date_add("date", 1)))
    assert [models.pressure_index(quality.require_rows(f, models.PRESSURE_MIN_ROWS)).count() for f in (one, two)] == [0, 2]


def test_an_empty_pull_lands_a_header(spark):
    root = scratch_path(spark, "landing")
    assert sinks.land_csv(_prices(spark, 3), f"{root}/prices") == 3
    assert sinks.land_csv(_prices(spark, 0), f"{root}/prices", empty_day="2024-02-02") == 0
    report = quality.landing_report(spark, root, ["prices", "news"]).collect()
    assert {r.source: (r.n_files > 1, r.status) for r in report} == {"prices": (True, "OK"), "news": (False, "MISSING")}
    assert files.read_landed_csv(spark, f"{root}/prices", "prices").count() == 3
    header = spark.read.text(f"{root}/prices/ingest_date=2024-02-02").collect()
    assert [r.value for r in header] == ["date,open,high,low,close,volume"]
