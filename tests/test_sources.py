"""Sources, sinks, gates and streaming on small hand-made inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.plans import quality
from sparksignal.session import scratch_path
from sparksignal.sources import files, sinks
from sparksignal.streaming import landing


def _news(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_NEWS)


def test_csv_landing_roundtrip_keeps_html_and_newlines(spark):
    summary = '<p class="x">Oil "rises"</p>\nsecond line, with comma'
    df = _news(spark, [("2024-01-02", "bbc", "Title", "Tue, 02 Jan 2024", summary, -0.25)])
    root = scratch_path(spark, "t1")
    sinks.land_csv(df.withColumn("ingest_date", F.lit("2024-01-02")), root)
    back = files.read_landed_csv(spark, root, "news").collect()
    assert len(back) == 1
    assert back[0].summary == summary and back[0].sentiment_compound == -0.25


def test_missing_landing_folder_is_empty_typed_frame(spark):
    df = files.read_landed_csv(spark, "/nonexistent/landing/news", "news")
    assert df.count() == 0 and "sentiment_compound" in df.columns


def test_feed_xml_description_fallback(spark):
    root = scratch_path(spark, "feed")
    items = spark.createDataFrame(
        [("A - Reuters", None, "desc only", "Tue, 02 Jan 2024 10:00:00 +0000"),
         ("B", "has summary", "ignored", None)],
        "title string, summary string, description string, pubDate string")
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(root)
    got = {r.title: r for r in files.read_feed_xml(spark, root).collect()}
    assert got["A - Reuters"].summary == "desc only"
    assert got["B"].summary == "has summary" and got["B"].published == ""


def test_listing_json_explodes_children(spark):
    root = scratch_path(spark, "listing")
    doc = ('{"kind": "Listing", "data": {"after": null, "children": ['
           '{"kind": "t3", "data": {"subreddit": "oil", "title": "x", "selftext": "", '
           '"score": 5, "created_utc": 1717459200.0}},'
           '{"kind": "t3", "data": {"subreddit": "oil", "title": "y", "score": 1, '
           '"created_utc": 0}}]}}')
    spark.createDataFrame([(doc,)], "value string").write.text(root)
    posts = files.read_listings(spark, root).orderBy("title").collect()
    assert [p.title for p in posts] == ["x", "y"] and posts[0].score == 5


def test_price_frame_normalisation(spark):
    df = spark.createDataFrame([("2024-01-05 00:00:00", 1.0, 2.0, 0.5, 1.5, 10, 0.0)],
                               "Datetime string, Open double, High double, Low double, "
                               "Close double, Volume long, Dividends double")
    out = files.normalise_price_frame(df)
    assert out.columns == ["date", "open", "high", "low", "close", "volume"]
    assert out.first().date == dt.date(2024, 1, 5)


def test_incremental_window_overlap_when_target_has_rows(spark):
    src = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 31)], "date date")
    as_of = F.lit("2024-01-31").cast("date")
    assert files.incremental_window(src, src, as_of).count() == 2
    assert files.incremental_window(src, src.limit(0), as_of).count() == 30


def test_write_parquet_counts_from_the_write(spark):
    df = spark.range(17).withColumnRenamed("id", "x")
    assert sinks.write_parquet(df, scratch_path(spark, "k1")) == 17


def test_serving_table_kept_on_empty_input(spark):
    path = scratch_path(spark, "serving")
    sinks.load_serving_table(spark.range(3), path, "serving_test")
    kept = sinks.load_serving_table(spark.range(0), path, "serving_test")
    assert kept.count() == 3 and spark.table("serving_test").count() == 3


def test_keyed_upsert_keeps_newest_version(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, version int")
    new = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "k int, v string, version int")
    got = {r.k: r.v for r in sinks.keyed_upsert(cur, new, ["k"]).collect()}
    assert got == {1: "a", 2: "B", 3: "C"}


def test_require_rows_and_volume_gate(spark):
    small = spark.range(5)
    assert quality.require_rows(small, 20).count() == 0
    assert quality.require_rows(small, 5).count() == 5
    gate = {r.source: r for r in quality.volume_gate({"a": small, "b": spark.range(4)})
            .collect()}
    assert gate["a"].total_rows == 9 and gate["a"].status == "low_data"


def test_landing_report_marks_missing(spark):
    root = scratch_path(spark, "landing")
    df = _news(spark, [("2024-01-02", "bbc", "T", "", "s", 0.1)])
    sinks.land_csv(df.withColumn("ingest_date", F.lit("2024-01-02")), f"{root}/news")
    rep = {r.source: r for r in quality.landing_report(spark, root, ["news", "prices"]).collect()}
    assert rep["news"].status == "OK" and rep["news"].bytes > 0
    assert rep["prices"].status == "MISSING" and rep["prices"].n_files == 0


def test_stream_ingest_relanded_day_dedups(spark):
    root = scratch_path(spark, "stream")
    day1 = _news(spark, [("2024-01-02", "bbc", "T", "", "old", 0.1),
                         ("2024-01-02", "cnbc", "U", "", "u", 0.2)])
    day2 = _news(spark, [("2024-01-02", "bbc", "T", "", "new", 0.3)])
    sinks.land_csv(day1.withColumn("ingest_date", F.lit("2024-01-02")), f"{root}/landing")
    landing.ingest(spark, f"{root}/landing", f"{root}/bronze", "news",
                   checkpoint=f"{root}/ckpt")
    sinks.land_csv(day2.withColumn("ingest_date", F.lit("2024-01-03")), f"{root}/landing")
    landing.ingest(spark, f"{root}/landing", f"{root}/bronze", "news",
                   checkpoint=f"{root}/ckpt")
    got = {r.source: r.summary for r in landing.clean_from_bronze(
        spark, f"{root}/bronze", "news").collect()}
    assert got == {"bbc": "new", "cnbc": "u"}
    assert spark.read.parquet(f"{root}/bronze").count() == 3  # second run read only the new file


def _feed(spark, name, rows):
    from sparksignal.plans import feeds as feeds_mod

    root = scratch_path(spark, f"feed-{name}")
    df = spark.createDataFrame(rows, "title string, description string, pubDate string")
    df.coalesce(1).write.format("xml").option("rootTag", "channel").option("rowTag", "item") \
        .save(root)
    return files.read_feed_xml(spark, root), feeds_mod


def test_statement_feeds_dedup_within_and_across(spark):
    stamp = "Tue, 02 Jan 2024 10:00:00 +0000"
    a, feeds_mod = _feed(spark, "qa", [("Oil up - Reuters", "crude rises", stamp),
                                       ("oil up - reuters", "copy", stamp),
                                       ("Strike on port - AP", "missile attack", stamp)])
    b, _ = _feed(spark, "qb", [("Oil up - Bloomberg", "again", stamp),
                               ("New tariff", "ban talk", stamp)])
    out = feeds_mod.statements([feeds_mod.Feed("q_a", a), feeds_mod.Feed("q_b", b)],
                               F.lit("2024-01-31").cast("date"))
    got = {(r.query, r.source, r.title): r.topic_tags for r in out.collect()}
    assert got == {("q_a", "Reuters", "Oil up"): "oil",
                   ("q_a", "AP", "Strike on port"): "war",
                   ("q_b", "q_b", "New tariff"): "sanctions"}


def test_filtered_feed_and_tension_flags(spark):
    stamp = "Wed, 03 Jan 2024 09:00:00 +0800"
    w, feeds_mod = _feed(spark, "world", [("Taiwan drills", "PLA exercises near the strait", stamp),
                                          ("Football", "cup final", stamp)])
    out = feeds_mod.tension_news([feeds_mod.Feed("world", w, kind="filtered",
                                                 pattern=feeds_mod.text.TENSION_FILTER,
                                                 source="world")],
                                 F.lit("2024-01-31").cast("date")).collect()
    assert len(out) == 1 and out[0].source == "world" and out[0].date == dt.date(2024, 1, 3)
    assert out[0].iran_spillover == "False" and out[0].escalation == "neutral"


def test_preferred_columns_first(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "volume long, close double, note string, "
                                                     "open double")
    out = files.with_columns_order(df, ["date", "open", "high", "low", "close", "volume"])
    assert out.columns == ["open", "close", "volume", "note"]
