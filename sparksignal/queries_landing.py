"""Queries of the landing, refresh and feed paths (registered with ``sparksignal.catalog``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksignal import catalog as c
from sparksignal import schemas
from sparksignal.oracle_sql import rx, tags_sql
from sparksignal.plans import classifier, daily_run, day_state, feeds, quality
from sparksignal.plans import features as feat
from sparksignal.plans.materialize import materialize
from sparksignal.session import scratch_path
from sparksignal.sources import documents, sinks, views

register, present, r6 = c.register, c.present, c.r6


# --- documents as a merge-on-read log -------------------------------------------
@register("prediction_log", """
SELECT date, prediction, prediction_numeric, round(confidence, 10) AS confidence FROM (
  SELECT date, prediction, prediction_numeric, confidence, 1 AS run FROM predictions
  UNION ALL
  SELECT p.date, CASE WHEN p.prediction_numeric = 1 THEN 'Down' ELSE 'Up' END, 1 - p.prediction_numeric,
         round(1.0 - p.confidence, 4), 2
  FROM predictions p JOIN features f ON f.date = p.date
  WHERE p.prediction_numeric != f.price_direction)
QUALIFY row_number() OVER (PARTITION BY date ORDER BY run DESC) = 1""")
def q_prediction_log(spark, sf_dir):
    """Three runs into the same months, the third a correction; compacted, and read newest per date."""
    p = materialize(views.predictions(spark, sf_dir))
    f = c.features_df(spark, sf_dir).select("date", "price_direction")
    wrong = p.join(f, "date").where(F.col("prediction_numeric") != F.col("price_direction"))
    fixed = wrong.select(
        "date", F.when(F.col("prediction_numeric") == 1, "Down").otherwise("Up").alias("prediction"),
        (F.lit(1) - F.col("prediction_numeric")).alias("prediction_numeric"), F.round(F.lit(1.0) - F.col("confidence"), 4).alias("confidence"))
    root, late = scratch_path(spark, "log"), F.dayofmonth("date") > 20
    documents.append(p.where(~late), root, "prediction")
    documents.append(p.where(late), root, "prediction")
    documents.compact(spark, root)
    documents.append(fixed, root, "prediction")
    back = documents.read(spark, root, schemas.PREDICTION)
    return present(back.withColumn("date", F.to_date("date")))


# --- absent sources --------------------------------------------------------------
@register("feature_table_sparse", f"""
SELECT p.date, {r6('open', 'high', 'low', 'close', 'rolling_avg_7d')}, volume,
       round(coalesce(price_delta, 0.0), 10) AS price_delta, price_direction,
       round(coalesce(r.reddit_sentiment_avg, 0.0), 10) AS reddit_sentiment_avg,
       round(coalesce(r.sentiment_rolling_3d, 0.0), 10) AS sentiment_rolling_3d,
       0.0::DOUBLE AS news_sentiment, 0.0::DOUBLE AS trump_sentiment_avg, 0.0::DOUBLE AS trump_sentiment_rolling_3d,
       0.0::DOUBLE AS war_sentiment_avg, 0::BIGINT AS war_article_count, 0::BIGINT AS favor_count,
       0::BIGINT AS against_count, 0.5::DOUBLE AS favor_ratio,
       round(coalesce(b.base_war_sentiment, 0.0), 10) AS base_war_sentiment,
       round(coalesce(b.base_sentiment_rolling_7d, 0.0), 10) AS base_sentiment_rolling_7d
FROM price_feat p LEFT JOIN posts_daily r ON r.date = p.date LEFT JOIN base_daily b ON b.date = p.date""")
def q_feature_table_sparse(spark, sf_dir):
    """The feature table while no news-like source has landed: typed defaults (P5, S3)."""
    posts = views.post_values(spark, sf_dir)
    return present(feat.feature_table(materialize(views.prices(spark, sf_dir)), posts, segment=F.col("segment")))


# --- incremental pulls into a stored day state --------------------------------------
_STATE_DAYS = """SELECT * FROM {table} WHERE date < (SELECT max(date) + 1 FROM news)
                   AND date >= (SELECT max(date) + 1 FROM news) - 92"""


@register("incremental_state", f"""
WITH n AS ({_STATE_DAYS.format(table='news_daily')}),
s AS ({_STATE_DAYS.format(table='statements_daily')}),
k AS ({_STATE_DAYS.format(table='conflict_daily')})
SELECT n.date, round(n.news_sentiment, 10) AS news_sentiment, round(s.trump_sentiment_avg, 10) AS trump_sentiment_avg,
       round(avg(s.trump_sentiment_avg) OVER (ORDER BY s.date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4)
         AS trump_sentiment_rolling_3d,
       round(k.war_sentiment_avg, 10) AS war_sentiment_avg, k.war_article_count, k.favor_count, k.against_count,
       round(k.favor_ratio, 10) AS favor_ratio
FROM n JOIN s ON s.date = n.date JOIN k ON k.date = n.date""")
def q_incremental_state(spark, sf_dir):
    """Day state after a 90-day backfill and two daily pulls of 2 days each: equal to a rebuild of the 92 days."""
    a = materialize(views.articles(spark, sf_dir))
    end, root = F.date_add(a.agg(F.max("date")).scalar(), 1), scratch_path(spark, "day-state")
    for back in (2, 1, 0):
        day_state.refresh(spark, root, a, F.date_sub(end, back))
    return present(day_state.sides(spark, root))


# --- re-landed files -----------------------------------------------------------------
@register("relanded_csv", """
SELECT date, source, sha256(title) AS title_sha256, round(CASE WHEN src_id % 3 = 0 THEN -sentiment_compound ELSE sentiment_compound END, 10) AS sentiment_compound
FROM (SELECT * FROM news)""")
def q_relanded_csv(spark, sf_dir):
    """News landed as CSV, a third of them again the next day with another score: the newest landing wins."""
    d = views.cleaned(spark, sf_dir, "news")
    first = d.withColumn("ingest_date", F.lit("2024-01-30"))
    again = d.where(F.col("src_id") % 3 == 0).withColumn("sentiment_compound", -F.col("sentiment_compound") + F.lit(0.0))
    rows = first.unionByName(again.withColumn("ingest_date", F.lit("2024-01-31")))
    raw = rows.select(F.col("date").cast("string").alias("date"), *schemas.RAW["news"].fieldNames()[1:], "ingest_date")
    root = scratch_path(spark, "relanding")
    sinks.land_csv(raw, f"{root}/news")
    out = daily_run.clean_bronze(materialize(daily_run.bronze(spark, root, "news")), "news")
    digest = F.sha2(F.col("title").cast("binary"), 256).alias("title_sha256")
    return present(out.select("date", "source", digest, "sentiment_compound"))


# --- feeds -----------------------------------------------------------------------------
_FEED_COLS = "date, source, title, published_date, summary, round(sentiment_compound, 10) AS sentiment_compound"
TITLE_MAX, SUMMARY_MAX = 500, 1000  # fixed values: stored lengths that the reference cuts to


@register("statements_feed", f"""{c._FEED_SQL},
named AS (SELECT s.*, i.raw_title FROM scored s JOIN items i ON i.feed_ord = s.feed_ord AND i.doc_id = s.doc_id WHERE s.feed_ord < 2),
inside AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY feed_ord, lower(trim(raw_title)) ORDER BY doc_id) = 1)
SELECT {_FEED_COLS}, CASE WHEN feed_ord = 0 THEN 'wire_a' ELSE 'wire_b' END AS query,
       {tags_sql("title || ' ' || summary", views.VIEW_STATEMENT_TOPICS)} AS topic_tags
FROM inside QUALIFY row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY feed_ord, doc_id) = 1""")
def q_statements_feed(spark, sf_dir):
    """Statement feeds: repeats dropped inside each feed by raw title, then across feeds; topic tags."""
    both = c.view_feeds(spark, sf_dir)[:2]
    return present(feeds.statements(both, F.lit(c.AS_OF).cast("date"), topics=views.VIEW_STATEMENT_TOPICS))


@register("tension_feed", f"""{c._FEED_SQL}
SELECT date, source, substr(title, 1, {TITLE_MAX}) AS title, published_date, substr(summary, 1, {SUMMARY_MAX}) AS summary,
       round(sentiment_compound, 10) AS sentiment_compound,
       CASE WHEN sentiment_compound < -0.1 THEN 'escalation' WHEN sentiment_compound > 0.1 THEN 'de-escalation'
            ELSE 'neutral' END AS escalation,
       CASE WHEN regexp_matches(title || ' ' || summary, {rx(views.VIEW_SPILLOVER)}) THEN 'True' ELSE 'False' END AS iran_spillover
FROM scored
QUALIFY row_number() OVER (PARTITION BY lower(trim(substr(title, 1, {TITLE_MAX}))) ORDER BY feed_ord, doc_id) = 1""")
def q_tension_feed(spark, sf_dir):
    """Tension feeds with stored lengths cut, scores and flags on whole texts."""
    rows = feeds.tension_news(c.view_feeds(spark, sf_dir), F.lit(c.AS_OF).cast("date"), spillover=views.VIEW_SPILLOVER,
                              title_max=TITLE_MAX, summary_max=SUMMARY_MAX)
    return present(rows)


@register("business_news", f"""
WITH items AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN 'wire_a' ELSE 'wire_b' END AS source, {c._HEAD_SQL} || ' - ' || source AS title,
         text AS summary, {c._STAMP_SQL} AS published FROM documents WHERE lang IN ('en', 'de')),
valence AS (
  SELECT t.doc_id, sum(l.valence) AS vs
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(title || ' ' || summary), '[a-z]+')) AS token FROM items) t
  JOIN lexicon l ON l.token = t.token GROUP BY t.doc_id)
SELECT TRY_CAST(try_strptime(regexp_extract(published, '(\\d{{1,2}} [A-Za-z]{{3}} \\d{{4}})', 1), '%d %b %Y') AS DATE) AS date,
       source, title, published AS published_date, summary,
       round(round(coalesce(v.vs, 0.0) / sqrt(coalesce(v.vs, 0.0) * coalesce(v.vs, 0.0) + 15.0), 4), 10) AS sentiment_compound
FROM items i LEFT JOIN valence v ON v.doc_id = i.doc_id""")
def q_business_news(spark, sf_dir):
    """Plain business feeds: every entry, the feed's name as source, no dedup."""
    plain = [feeds.Feed(f.name, f.entries, kind="plain") for f in c.view_feeds(spark, sf_dir)[:2]]
    return present(feeds.business_news(plain, F.lit(c.AS_OF).cast("date")))


# --- the forest's newest prediction ----------------------------------------------------------
_LATEST = ", ".join(f"round({x}::DOUBLE, 4) AS {x}" for x in classifier.FEATURE_COLS)


@register("rf_latest", f"""
SELECT date, {_LATEST}, true AS valid_class, true AS valid_confidence
FROM features ORDER BY date DESC LIMIT 1""")
def q_rf_latest(spark, sf_dir):
    """The prediction document of the newest day: its feature values, a class and a probability over one half (M9)."""
    f = materialize(c.features_df(spark, sf_dir))
    train, _ = classifier.split_chronological(f)
    p = classifier.latest_prediction(classifier.train(train), f)
    named = F.when(F.col("prediction_numeric") == 1, "Up").when(F.col("prediction_numeric") == 0, "Down")
    return p.select("date", "features.*", (F.col("prediction") == named).alias("valid_class"),
                    F.col("confidence").between(0.5, 1.0).alias("valid_confidence"))


# --- landing validation ------------------------------------------------------------------------
@register("landing_status", """
SELECT 'posts' AS source, CASE WHEN (SELECT count(*) FROM landed_posts) > 0 THEN 'OK' ELSE 'MISSING' END AS status
UNION ALL SELECT 'news', CASE WHEN (SELECT count(*) FROM landed_news) > 0 THEN 'OK' ELSE 'MISSING' END
UNION ALL SELECT 'prices', CASE WHEN (SELECT count(*) FROM prices) > 0 THEN 'OK' ELSE 'MISSING' END
UNION ALL SELECT 'statements', 'MISSING' UNION ALL SELECT 'conflict_news', 'MISSING' UNION ALL SELECT 'tension_news', 'MISSING'""")
def q_landing_status(spark, sf_dir):
    """Which of the six expected sources have landed: three have, three have not (Q1)."""
    root = scratch_path(spark, "landing")
    frames = {"prices": views.prices(spark, sf_dir), "posts": views.landed_posts(spark, sf_dir), "news": views.landed_news(spark, sf_dir)}
    for source, rows in frames.items():
        raw = rows.select(F.col("date").cast("string").alias("date"), *schemas.RAW[source].fieldNames()[1:])
        sinks.land_csv(raw.withColumn("ingest_date", F.lit("2024-01-31")), f"{root}/{source}")
    return quality.landing_report(spark, root, daily_run.SOURCES).select("source", "status")
