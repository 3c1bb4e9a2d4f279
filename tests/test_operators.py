"""Operator-level tests on inline frames (values, not only counts), one per trap."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal import schemas
from sparksignal.functions import classify, sentiment, text
from sparksignal.operators import clean, daily, series
from sparksignal.plans import evaluation, features, models, signals


def test_drop_null_date_and_nan_close(spark):
    rows = [("2024-01-01", 1.0, 2.0, 0.5, 1.5, 10), (None, 1.0, 2.0, 0.5, 1.5, 10),
            ("2024-01-03", 1.0, 2.0, 0.5, float("nan"), 10), ("2024-01-04", 1.0, 2.0, 0.5, 1.6, 10)]
    df = spark.createDataFrame(rows, schemas.RAW_PRICES)
    out = clean.drop_incomplete(clean.normalise(df), schemas.REQUIRED["prices"])
    assert sorted(r.date.day for r in out.collect()) == [1, 4]
    assert out.columns == ["date", "open", "high", "low", "close", "volume"]


def test_bad_date_becomes_null_not_error(spark):
    df = spark.createDataFrame([("2024-01-02",), ("not-a-date",), ("2024-13-40",)], "date string")
    vals = [r.date for r in clean.normalise(df).collect()]
    assert vals == [dt.date(2024, 1, 2), None, None]


def test_dedup_keeps_newest_file(spark):
    rows = [("2024-01-01", 1.0, 1.0, 1.0, 10.0, 1, "2024-01-02.csv"),
            ("2024-01-01", 1.0, 1.0, 1.0, 11.0, 1, "2024-01-03.csv"),
            ("2024-01-02", 1.0, 1.0, 1.0, 12.0, 1, "2024-01-03.csv")]
    df = spark.createDataFrame(rows, T.StructType([*schemas.RAW_PRICES.fields, T.StructField("file_name", T.StringType())]))
    out = clean.clean_source(df, "prices", ["file_name"], descending=True)
    got = {r.date.day: r.close for r in out.collect()}
    assert got == {1: 11.0, 2: 12.0}


def test_first_seen_across_feeds(spark):
    rows = [("A title ", 0, 1), ("a TITLE", 1, 0), ("Other", 1, 1), ("other", 0, 5)]
    df = spark.createDataFrame(rows, "title string, feed_ord int, entry_ord int")
    out = clean.first_seen(df).orderBy("feed_ord", "entry_ord").collect()
    assert [(r.title, r.feed_ord, r.entry_ord) for r in out] == [("A title ", 0, 1),
                                                                 ("other", 0, 5)]


def test_rolling_delta_label(sample_prices):
    out = features.price_features(sample_prices).orderBy("date").collect()
    roll = [r.rolling_avg_7d for r in out]
    expect = [71 + (i + 1) / 2 if i <= 7 else 68 + i for i in range(1, 11)]
    assert roll == expect
    assert out[0].price_delta is None and all(r.price_delta == 1.0 for r in out[1:])
    assert [r.price_direction for r in out] == [1] * 9 + [0]  # last day is 0 (T4)


def test_null_last_label_option(sample_prices):
    out = features.price_features(sample_prices, null_last_label=True).orderBy("date").collect()
    assert out[-1].price_direction is None and out[0].price_direction == 1


def test_feature_table_defaults_when_sources_absent(sample_prices):
    f = features.feature_table(sample_prices)
    assert f.columns == features.FEATURE_COLUMNS
    assert dict(f.dtypes)["favor_count"] == "bigint"
    r = f.orderBy("date").first()
    assert r.favor_ratio == 0.5 and r.news_sentiment == 0.0 and r.price_delta == 0.0


def test_left_join_fills(spark, sample_prices):
    posts = spark.createDataFrame(
        [(dt.date(2024, 1, 3), "a", "base", "t", 1, 0.5, "war"),
         (dt.date(2024, 1, 3), "b", "general", "u", 1, 0.1, "oil")],
        "date date, subreddit string, subreddit_group string, title string, score int, "
        "sentiment_compound double, topic string")
    f = features.feature_table(sample_prices, posts=posts).orderBy("date").collect()
    assert len(f) == 10
    assert f[2].reddit_sentiment_avg == 0.3 and f[0].reddit_sentiment_avg == 0.0
    assert f[2].base_war_sentiment == 0.5 and f[2].base_sentiment_rolling_7d == 0.5


def test_weighted_mean_and_favor_ratio(spark):
    rows = [(dt.date(2024, 1, 1), "Reuters", 0.4, "favor"), (dt.date(2024, 1, 1), "blog", -0.2,
                                                              "against"),
            (dt.date(2024, 1, 2), "x", 0.0, "neutral")]
    df = spark.createDataFrame(rows, "date date, source string, sentiment_compound double, "
                                     "stance string")
    out = {r.date.day: r for r in daily.stance_daily(df).collect()}
    assert math.isclose(out[1].war_sentiment_avg, (0.4 * 1.25 - 0.2) / 2.25)
    assert out[1].favor_ratio == 0.5 and out[1].war_article_count == 2
    assert out[2].favor_ratio == 0.5 and out[2].favor_count == 0


def test_topic_tags_order_and_default(spark):
    df = spark.createDataFrame([("Crude oil after Iran strike",), ("nothing here",)], "t string")
    got = [r[0] for r in df.select(text.topic_tags("t", text.STATEMENT_TOPICS)).collect()]
    assert got == ["oil,iran,war", "general"]


def test_source_split_shapes(spark):
    df = spark.createDataFrame([("Headline - Reuters",), ("A - B - Wire",), ("No source",)],
                               "t string")
    got = df.select(text.split_source("t"), text.strip_source("t")).collect()
    assert [tuple(r) for r in got] == [("Reuters", "Headline"), ("Wire", "A - B"),
                                       ("unknown", "No source")]


def test_rfc822_dates_use_stamp_day(spark):
    df = spark.createDataFrame([("Tue, 03 Jun 2025 23:10:00 -0400",), ("1 Feb 2024 01:00 +0900",),
                                ("garbage",), (None,)], "s string")
    fb = F.lit("2024-01-31").cast("date")
    got = [r[0] for r in df.select(text.rfc822_date("s", fb)).collect()]
    assert got == [dt.date(2025, 6, 3), dt.date(2024, 2, 1), dt.date(2024, 1, 31),
                   dt.date(2024, 1, 31)]


def test_epoch_date_zero_falls_back(spark):
    df = spark.createDataFrame([(1717459200.0,), (0.0,)], "s double")
    got = [r[0] for r in df.select(text.epoch_date("s", F.lit("2024-01-31").cast("date")))
           .collect()]
    assert got == [dt.date(2024, 6, 4), dt.date(2024, 1, 31)]


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(0.05,), (0.0501,), (-0.05,), (-0.1,), (-0.1001,)], "x double")
    got = df.select(classify.stance("x"), classify.escalation("x")).collect()
    assert [r[0] for r in got] == ["neutral", "favor", "neutral", "against", "against"]
    assert [r[1] for r in got] == ["neutral", "neutral", "neutral", "neutral", "escalation"]


def test_lexicon_narrow_equals_join(spark):
    df = spark.createDataFrame([(1, "The best day, no war."), (2, ""), (3, None),
                                (4, "stupid stupid idiot")], "id long, text string")
    narrow = {r.id: r.c for r in df.select("id", sentiment.lexicon_compound("text").alias("c"))
              .collect()}
    joined = {r.doc_id: r.compound for r in sentiment.lexicon_join_scores(
        df.withColumnRenamed("id", "doc_id"), "doc_id", "text",
        sentiment.lexicon_frame(spark), broadcast_lexicon=True).collect()}
    assert narrow == joined
    s = 3.2 - 1.2 - 2.9
    assert narrow[1] == round(s / math.sqrt(s * s + 15), 4) and narrow[2] == 0.0


def test_minmax_constant_column_gives_positive_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, i), 0.3, float(i)) for i in range(1, 4)],
                               "date date, c double, v double")
    out = series.minmax_scale(df, [("c", "sc"), ("v", "sv")], negate=["sc", "sv"])
    rows = out.orderBy("date").collect()
    assert all(r.sc == 0.0 and math.copysign(1, r.sc) == 1.0 for r in rows)
    assert [r.sv for r in rows] == [1.0, 0.0, -1.0]


def _summary(spark, vals):
    rows = [(dt.date(2024, 1, i + 1), 70.0 + i, *v) for i, v in enumerate(vals)]
    return spark.createDataFrame(
        rows, "date date, avg_price double, avg_price_delta double, avg_news_sentiment double, "
              "avg_reddit_sentiment double, avg_trump_sentiment double, avg_war_sentiment double,"
              " favor_ratio double, price_direction int")


def test_reasons_ties_keep_declared_order(spark):
    s = _summary(spark, [(0.0,) * 6 + (1,)] * 3)  # every signal constant -> all zero
    out = signals.build_signals(s).orderBy("date").collect()
    assert all(r.reason == "Price Momentum ↓ + News Sentiment ↓" for r in out)
    assert all(r.signal == "HOLD" and r.correct is None for r in out)
    summ = signals.signal_summary(signals.build_signals(s)).first()
    assert summ.accuracy == 0.0 and summ.n_trades == 0 and summ.n_hold == 3


def test_backtest_uses_next_row_label(spark):
    s = _summary(spark, [(1.0, 0.5, 0.5, 0.5, -0.5, 0.2, 1), (-1.0, -0.5, -0.5, -0.5, 0.5, 0.9, 0),
                         (1.0, 0.5, 0.5, 0.5, -0.5, 0.2, 1)])
    out = signals.build_signals(s).orderBy("date").collect()
    assert [r.signal for r in out] == ["BUY", "SELL", "BUY"]
    assert [r.next_day_direction for r in out] == [0, 1, None]
    assert [r.correct for r in out] == [0.0, 0.0, None]


def test_pressure_previous_zero_means_unknown(spark):
    rows = [(dt.date(2024, 1, 1), 0.0, 0.5, 0.0), (dt.date(2024, 1, 2), -0.2, 0.5, 0.0)]
    df = spark.createDataFrame(rows, "date date, base_sentiment_rolling_7d double, "
                                     "favor_ratio double, war_sentiment_avg double")
    out = models.pressure_index(df).orderBy("date").collect()
    # day 2: prev == 0.0 -> trend term 0.5
    expect = round(0.35 * 0.7 + 0.30 * 0.5 + 0.20 * 0.5 + 0.15 * 0.5, 4)
    assert out[1].pressure_index == expect
    assert out[1].exit_probability == round(1 / (1 + math.exp(-(expect - 0.5) * 6)), 4)
    assert out[1].base_sentiment_trend == "declining"


def test_missing_actual_is_cross_and_pending(spark):
    preds = spark.createDataFrame([(dt.date(2024, 1, 1), "Up", 1, 0.7),
                                   (dt.date(2024, 1, 9), "Down", 0, 0.6)],
                                  "date date, prediction string, prediction_numeric int, "
                                  "confidence double")
    actual = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "date date, price_direction int")
    hist = {r.date.day: r.correct for r in evaluation.prediction_history(preds, actual).collect()}
    assert hist == {1: "✓", 9: "✗"}
    ev = {r.pred_date.day: (r.status, r.actual) for r in evaluation.evaluate(preds, actual)
          .collect()}
    assert ev == {1: ("correct", "Up"), 9: ("pending", "pending")}


def test_tension_probability_is_clipped(spark):
    rows = [(dt.date(2024, 1, 1), "t", -0.9, "escalation", "True")] * 3
    df = spark.createDataFrame(rows, "date date, title string, sentiment_compound double, "
                                     "escalation string, iran_spillover string")
    p = models.tension_days(df).first().war_probability
    assert math.isclose(p, 0.2 + 0.3 + 0.9 * 0.15 + 0.1 + 3 / 200)


def test_series_run_per_symbol(spark):
    rows = [("A", dt.date(2024, 1, d), float(d)) for d in range(1, 6)] + \
           [("B", dt.date(2024, 1, d), float(10 * d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    out = series.rolling_mean(df, "close", 3, "r", partition_by=["symbol"])
    out = series.next_day_label(out, partition_by=["symbol"])
    got = {(r.symbol, r.date.day): (r.r, r.price_direction) for r in out.collect()}
    assert got[("A", 3)] == (2.0, 1) and got[("B", 3)] == (20.0, 1)
    assert got[("A", 5)][1] == 0 and got[("B", 5)][1] == 0  # each series ends with 0


def test_rolling_counts_source_rows_not_calendar_days(spark, sample_prices):
    # statements exist on days 1, 5 and 9 only: the 3-row mean on day 9 spans all three
    rows = [(dt.date(2024, 1, d), "s", f"t{d}", v) for d, v in ((1, 0.3), (5, 0.6), (9, 0.9))]
    st = spark.createDataFrame(rows, "date date, source string, title string, "
                                     "sentiment_compound double")
    f = {r.date.day: r for r in features.feature_table(sample_prices, statements=st).collect()}
    assert math.isclose(f[9].trump_sentiment_rolling_3d, 0.6)
    assert f[8].trump_sentiment_rolling_3d == 0.0  # no statement that day -> filled 0.0 (T7)


@pytest.mark.parametrize("values", [
    [], [1.0], [2.0, 1.0], [3.0] * 700 + [float(i % 37) for i in range(900)],
    [(i * 7919 % 1009) / 8.0 for i in range(1009)]])
def test_quantiles_are_exact(spark, values):
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = daily.quantiles(df, "x", shares, ranges=16).first()["quantiles"]
    ordered = sorted(values)

    def at(share):
        place = share * (len(ordered) - 1)
        low, high = math.floor(place), math.ceil(place)
        return ordered[low] + (ordered[high] - ordered[low]) * (place - low)

    assert got == ([pytest.approx(at(s)) for s in shares] if values else [None] * len(shares))


def test_minmax_scale_per_series(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 10.0), ("b", 30.0), ("b", 20.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, x double")
    got = series.minmax_scale(df, [("x", "s")], partition_by=["symbol"]).collect()
    assert {(r["symbol"], r["x"]): r["s"] for r in got} == {
        ("a", 1.0): -1.0, ("a", 3.0): 1.0, ("b", 10.0): -1.0, ("b", 30.0): 1.0, ("b", 20.0): 0.0,
        (None, 5.0): 0.0}


def test_feature_table_keeps_series_apart(spark):
    rows = [(s, dt.date(2024, 1, d), c) for s, cs in (("a", [1.0, 2.0, 1.0]), ("b", [9.0, 8.0, 9.5]))
            for d, c in enumerate(cs, 1)]
    prices = spark.createDataFrame(rows, "symbol string, date date, close double").selectExpr(
        "symbol", "date", "close AS open", "close AS high", "close AS low", "close", "1L AS volume")
    got = features.feature_table(prices, partition_by=["symbol"]).orderBy("symbol", "date").collect()
    assert [(r["symbol"], r["price_delta"], r["price_direction"]) for r in got] == [
        ("a", 0.0, 1), ("a", 1.0, 0), ("a", -1.0, 0), ("b", 0.0, 0), ("b", -1.0, 1), ("b", 1.5, 0)]


def test_late_rows_keep_the_first_of_each_whole_key(spark):
    same = "t" * 3000
    rows = [(1, 5, same + "a", "x"), (2, 5, same + "b", "y"), (3, 5, same + "a", "z"),  # equal prefix and length
            (4, None, same + "a", "n"), (5, None, same + "a", "m"), (6, 5, None, "o"), (7, 5, "", "p"), (8, 51, "", "q"), (9, 5, "1", "r")]
    df = spark.createDataFrame(rows, "id long, day int, title string, body string").repartition(3)
    first = clean.keep_first_rows(df, ["day", "title"], "id")
    assert first.columns == df.columns
    assert sorted(r["id"] for r in first.collect()) == [1, 2, 4, 6, 7, 8, 9]
    last = clean.keep_first_rows(df, ["day", "title"], "id", descending=True)
    assert sorted(r["body"] for r in last.collect()) == ["m", "o", "p", "q", "r", "y", "z"]
    by_body = clean.keep_first_rows(df, ["day", "title"], "id", order=["body"], descending=True)
    assert sorted(r["id"] for r in by_body.collect()) == [2, 3, 4, 6, 7, 8, 9]
    assert clean.keep_first_rows(df.limit(0), ["day", "title"], "id").count() == 0


def test_first_values_equal_first_rows(spark):
    rows = [(i, i % 3, f"t{i % 4}", float(i) if i % 5 else None, i % 2 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, day int, title string, v double, flag boolean").repartition(4)
    want = sorted(map(str, clean.keep_first(df, ["day", "title"], ["id"]).select("day", "title", "v", "flag", "id").collect()))
    got = clean.keep_first_values(df, ["day", "title"], "id", ["v", "flag"])
    assert sorted(map(str, got.collect())) == want


def test_stacked_sides_equal_the_separate_ones(spark):
    rows = [(dt.date(2024, 1, 1 + i % 9), s, f"t{i}", (i % 7 - 3) / 10.0, kind) for i, (s, kind) in enumerate(
        [("Reuters", "n"), ("x", "s"), ("bloomberg wire", "c"), (None, "n"), ("y", "c")] * 12)]
    df = spark.createDataFrame(rows, "date date, source string, title string, sentiment_compound double, kind string")
    got = features.article_sides(df, F.col("kind") != "s", F.col("kind") != "n", F.col("kind") == "c")
    news, statements = df.where("kind <> 's'"), df.where("kind <> 'n'")
    conflict = df.where("kind = 'c'").withColumn("stance", classify.stance("sentiment_compound"))
    want = (features.news_daily(news).join(features.statements_daily(statements), "date", "full")
            .join(features.conflict_daily(conflict), "date", "full"))
    def key(f):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in f.select(want.columns).collect())

    assert key(got) == key(want)


def test_long_lexicons_score_like_the_join(spark):
    words = {f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}": (i % 9 - 4) / 2 for i in range(3000)}
    texts = [" ".join(list(words)[i::97]) + " the of and " * i for i in range(40)] + [None, "", "the the", "WAAA waaa it's"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, "waba")], "doc_id long, text string")
    lex = sentiment.lexicon_frame(spark, words)
    join = {r["doc_id"]: r for r in sentiment.lexicon_join_scores(docs, "doc_id", "text", lex).collect()}
    cast = {r["doc_id"]: r for r in sentiment.lexicon_join_scores(docs, "doc_id", "text", lex, True).collect()}
    assert join.keys() == cast.keys() == set(range(len(texts)))
    for i, r in join.items():
        assert (r["n_tokens"], r["n_hits"]) == (cast[i]["n_tokens"], cast[i]["n_hits"])
        assert r["compound"] == pytest.approx(cast[i]["compound"], abs=1e-9)
        plain = [w for w in __import__("re").findall("[a-z]+", ((texts[i] or "") + (" waba" if i == 3 else "")).lower())]
        assert (r["n_tokens"], r["n_hits"]) == (len(plain), sum(w in words for w in plain))
    narrow = {r["doc_id"]: r["c"] for r in docs.where("doc_id <> 3").select("doc_id", sentiment.lexicon_compound("text", words).alias("c")).collect()}
    assert all(narrow[i] == pytest.approx(join[i]["compound"], abs=1e-4) for i in narrow)


def test_stop_words_never_reach_the_exchange(spark):
    docs = spark.createDataFrame([(i, "the of and a to in " * 200 + "good") for i in range(50)], "doc_id long, text string")
    rows = sentiment.lexicon_candidates(docs, "doc_id", "text", sentiment.lexicon_frame(spark))
    assert 100 <= rows.count() <= 110  # a count and "good" for each document, 60,000 stop words gone
    assert sentiment.lexicon_join_scores(docs.limit(0), "doc_id", "text", sentiment.lexicon_frame(spark)).count() == 0
