"""Registry of named queries over the driver tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Every query reads the given tables (through ``sources.views``) so its work
grows with them.  Double columns are presented rounded to 10 decimals
(``present``) so that engines summing in different orders agree bit for bit;
the oracle SQL rounds them the way Spark does (half-up on the decimal form).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.functions import classify, sentiment, text
from sparksignal.operators import clean, daily
from sparksignal.oracle_sql import cases_sql, compose, line_sql, pct_sql, rx, sround, tags_sql
from sparksignal.plans import classifier, models, quality, reports, signals
from sparksignal.plans import evaluation as ev
from sparksignal.plans import features as feat
from sparksignal.plans.materialize import materialize
from sparksignal.session import scratch_path
from sparksignal.sources import files, sinks, views
from sparksignal.streaming import landing as stream_landing

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
PRESENT_DIGITS = 10


def _spark_rounding(sql: str, digits: int = PRESENT_DIGITS) -> str:
    """Rewrite every ``round(x, d)`` as Spark rounds a double: HALF_UP on its decimal form.

    DuckDB's ``round`` scales the binary value: it can differ from Spark on
    decimal half-way values (e.g. a mean of two 4-digit scores) and is off by an
    ulp for large magnitudes at many digits; the decimal form agrees with Spark.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 5, -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg, dig = sql[j + 6:comma], sql[comma + 1:k].strip()
        out.append(sql[i:j])
        if dig.isdigit():
            out.append(sround(_spark_rounding(arg, digits), int(dig)))
        else:
            out.append("round(" + _spark_rounding(arg, digits) + "," + sql[comma + 1:k] + ")")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _spark_rounding(compose(sql))
        return fn
    return deco


def present(df: DataFrame, digits: int = PRESENT_DIGITS) -> DataFrame:
    """Round every DOUBLE column (presentation only)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, {PRESENT_DIGITS}) AS {c.split('.')[-1]}" for c in cols)


def _narrow(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Cleaned source with only the columns the daily plans read (no texts in the dedup)."""
    return views.narrow(spark, sf_dir, source)


def _sources(spark: SparkSession, sf_dir: str, shared: DataFrame | None = None) -> dict:
    """What ``feature_table`` reads besides the prices: one scan of the posts, one of the articles (or of stored ``shared`` rows)."""
    return {"posts": views.post_values(spark, sf_dir), "articles": views.articles(spark, sf_dir, shared), "segment": F.col("segment")}


def features_df(spark: SparkSession, sf_dir: str, shared: DataFrame | None = None) -> DataFrame:
    # day-grain rows that the block numbering reads twice
    return feat.feature_table(materialize(views.prices(spark, sf_dir)), **_sources(spark, sf_dir, shared))


def summary_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.daily_summary(features_df(spark, sf_dir))


# --- W1-W3 --------------------------------------------------------------------
@register("price_features", f"""
SELECT date, {r6('open', 'high', 'low', 'close')}, volume,
       {r6('rolling_avg_7d', 'price_delta')}, price_direction
FROM price_feat""")
def q_price_features(spark, sf_dir):
    return present(feat.price_features(materialize(views.prices(spark, sf_dir))))


# --- M1 -----------------------------------------------------------------------
_FEATURE_DOUBLES = ["open", "high", "low", "close", "rolling_avg_7d", "price_delta",
                    "reddit_sentiment_avg", "sentiment_rolling_3d", "news_sentiment",
                    "trump_sentiment_avg", "trump_sentiment_rolling_3d", "war_sentiment_avg",
                    "favor_ratio", "base_war_sentiment", "base_sentiment_rolling_7d"]


@register("feature_table", f"""
SELECT date, {r6(*_FEATURE_DOUBLES)}, volume, war_article_count, favor_count, against_count,
       price_direction
FROM features""")
def q_feature_table(spark, sf_dir):
    return present(features_df(spark, sf_dir))


# --- A6 -----------------------------------------------------------------------
@register("daily_summary", "SELECT * FROM daily_sum")
def q_daily_summary(spark, sf_dir):
    return present(summary_df(spark, sf_dir))


# --- K3 / O3 ------------------------------------------------------------------
@register("last_30", "SELECT * FROM daily_sum ORDER BY date DESC LIMIT 30")
def q_last_30(spark, sf_dir):
    return present(feat.last_n(summary_df(spark, sf_dir), 30))


# =============================================================================
# Clean layer and row-local text functions
# =============================================================================

# Test wiring for the text queries (words that occur in the generated documents).
DOC_TOPICS = [
    ("quality", r"\b(best|license)\b"),
    ("toxic", r"\b(stupid|idiot|moron|loser|trash|pathetic|worthless)\b"),
    ("common", r"\b(the|der|de|la)\b"),
]
DOC_FILTER = r"\b(pas|avec|best|license)\b"
AS_OF = "2024-01-31"


def _head(c: str = "text"):
    return F.trim(F.regexp_replace(c, r"\s+", " "))


_HEAD_SQL = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@register("clean_prices", """
SELECT * FROM (
  SELECT TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS date,
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low, o_totalprice AS close,
         o_custkey AS volume, o_orderkey AS src_id
  FROM orders)
WHERE date IS NOT NULL AND close IS NOT NULL AND NOT isnan(close)
QUALIFY row_number() OVER (PARTITION BY date ORDER BY src_id DESC) = 1""")
def q_clean_prices(spark, sf_dir):
    """Every order is a landed price row; the newest pull (highest key) wins per day."""
    o = views.table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    landed = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                      p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"),
                      F.col("o_custkey").alias("volume"), F.col("o_orderkey").alias("src_id"))
    return present(clean.clean_source(landed, "prices", ["src_id"], descending=True))


@register("dedup_first_seen", f"""
SELECT feed_ord, entry_ord, source, title FROM (
  SELECT CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 4 END
           AS feed_ord, doc_id AS entry_ord, source, {_HEAD_SQL} AS title FROM documents)
QUALIFY row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY feed_ord, entry_ord) = 1""")
def q_dedup_first_seen(spark, sf_dir):
    """Language feeds in order, other languages last, from one scan; first-seen title wins
    across feeds (V1, D2)."""
    lang = F.col("lang")
    feed = F.coalesce(*[F.when(lang == name, F.lit(i))
                        for i, name in enumerate(("en", "de", "fr", "es"))], F.lit(4))
    u = views.table(spark, sf_dir, "documents").select(
        feed.alias("feed_ord"), F.col("doc_id").alias("entry_ord"), "source", _head().alias("title"))
    return clean.first_seen(u).select("feed_ord", "entry_ord", "source", "title")


@register("dedup_within_feed", f"""
SELECT lang, doc_id, title FROM (SELECT lang, doc_id, {_HEAD_SQL} AS title FROM documents)
QUALIFY row_number() OVER (PARTITION BY lang, lower(trim(title)) ORDER BY doc_id) = 1""")
def q_dedup_within_feed(spark, sf_dir):
    """First-seen dedup inside each feed (language) on the raw title (D3)."""
    d = views.table(spark, sf_dir, "documents").select("lang", "doc_id", _head().alias("title"))
    return clean.first_seen(d, order=["doc_id"], within=["lang"]).select("lang", "doc_id",
                                                                          "title")


@register("topic_tags", f"""
SELECT doc_id,
       {tags_sql('text', text.STATEMENT_TOPICS)} AS tags_reference,
       {tags_sql('text', DOC_TOPICS)} AS tags,
       coalesce(regexp_matches(text, {rx(text.SPILLOVER_PATTERN)}), false) AS spillover,
       coalesce(regexp_matches(text, {rx(DOC_FILTER)}), false) AS flagged
FROM documents""")
def q_topic_tags(spark, sf_dir):
    """Multi-label tags (reference and test topic sets) and keyword flags on whole texts."""
    d = views.table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        text.topic_tags("text", text.STATEMENT_TOPICS).alias("tags_reference"),
        text.topic_tags("text", DOC_TOPICS).alias("tags"),
        text.keyword_flag("text", text.SPILLOVER_PATTERN).alias("spillover"),
        text.keyword_flag("text", DOC_FILTER).alias("flagged"),
    )


_RAW_TITLE_SQL = (f"(CASE doc_id % 3 WHEN 0 THEN {_HEAD_SQL} || ' - ' || source "
                  f"WHEN 1 THEN {_HEAD_SQL} || ' - Wire - ' || source ELSE {_HEAD_SQL} END)")


@register("source_split", f"""
SELECT doc_id, raw_title,
       CASE WHEN contains(raw_title, ' - ') THEN trim(string_split(raw_title, ' - ')[-1])
            ELSE 'unknown' END AS source,
       CASE WHEN contains(raw_title, ' - ')
            THEN trim(regexp_replace(raw_title, '(?s)^(.*) - .*$', '\\1'))
            ELSE raw_title END AS title
FROM (SELECT doc_id, {_RAW_TITLE_SQL} AS raw_title FROM documents)""")
def q_source_split(spark, sf_dir):
    """Headlines with zero, one and two " - ": source after the last one, title before it."""
    d = views.table(spark, sf_dir, "documents")
    h, src = _head(), F.col("source")
    raw = (F.when(F.col("doc_id") % 3 == 0, F.concat(h, F.lit(" - "), src))
           .when(F.col("doc_id") % 3 == 1, F.concat(h, F.lit(" - Wire - "), src)).otherwise(h))
    t = d.select("doc_id", raw.alias("raw_title"))
    return t.select("doc_id", "raw_title", text.split_source("raw_title").alias("source"),
                    text.strip_source("raw_title").alias("title"))


@register("stance_classify", """
SELECT doc_id, compound,
       CASE WHEN compound > 0.05 THEN 'favor' WHEN compound < -0.05 THEN 'against'
            ELSE 'neutral' END AS stance,
       CASE WHEN compound > 0.1 THEN 'de-escalation' WHEN compound < -0.1 THEN 'escalation'
            ELSE 'neutral' END AS escalation,
       CASE WHEN compound > 0.05 THEN 'positive' WHEN compound < -0.05 THEN 'negative'
            ELSE 'neutral' END AS badge
FROM doc_scores""")
def q_stance_classify(spark, sf_dir):
    """Lexicon compound of every whole document and its three-way labels."""
    d = views.table(spark, sf_dir, "documents")
    s = d.select("doc_id", sentiment.lexicon_compound("text").alias("compound"))
    return present(s.select("doc_id", "compound", classify.stance("compound").alias("stance"),
                            classify.escalation("compound").alias("escalation"),
                            classify.badge("compound").alias("badge")))


@register("keyword_filter", f"""
SELECT doc_id, lang, source FROM documents
WHERE coalesce(regexp_matches(text, {rx(DOC_FILTER)}), false)""")
def q_keyword_filter(spark, sf_dir):
    """Keep documents whose whole text matches the relevance pattern."""
    d = views.table(spark, sf_dir, "documents")
    return d.where(text.keyword_flag("text", DOC_FILTER)).select("doc_id", "lang", "source")


@register("rfc822_dates", f"""
SELECT doc_id,
       CASE doc_id % 8
         WHEN 0 THEN strftime(d, '%a, %d %b %Y') || ' 08:15:00 +0000'
         WHEN 1 THEN strftime(d, '%-d %b %Y') || ' 23:10:00 -0400'
         WHEN 2 THEN 'not a date'
         WHEN 3 THEN strftime(d, '%d %b %y') || ' 08:15:00 GMT'
         WHEN 4 THEN strftime(d, '%A, %d-%b-%y') || ' 08:15:00 GMT'
         WHEN 5 THEN strftime(d, '%d %B %Y') || ' 08:15:00 +0200'
         WHEN 6 THEN lower(strftime(d, '%d %b %Y')) || ' 08:15' END AS stamp,
       CASE WHEN doc_id % 8 IN (2, 7) THEN DATE '{AS_OF}' ELSE d END AS day
FROM (SELECT doc_id, DATE '1995-01-01' + CAST(doc_id % 2400 AS INTEGER) AS d FROM documents)""")
def q_rfc822_dates(spark, sf_dir):
    """Feed stamps in every RFC-822 form, with offsets, junk and nulls -> calendar day,
    fallback ``as_of`` (F6, T18)."""
    day = F.date_add(F.lit(views.EPOCH).cast("date"), (F.col("doc_id") % views.N_DAYS).cast("int"))
    forms = [("EEE, dd MMM yyyy", " 08:15:00 +0000"), ("d MMM yyyy", " 23:10:00 -0400"), None,
             ("dd MMM yy", " 08:15:00 GMT"), ("EEEE, dd-MMM-yy", " 08:15:00 GMT"),
             ("dd MMMM yyyy", " 08:15:00 +0200"), ("dd MMM yyyy", " 08:15")]
    stamp = F.when(F.col("doc_id") % 8 == 2, F.lit("not a date"))
    for i, form in enumerate(forms):
        if form:
            written = F.concat(F.date_format(day, form[0]), F.lit(form[1]))
            stamp = stamp.when(F.col("doc_id") % 8 == i, F.lower(written) if i == 6 else written)
    s = views.table(spark, sf_dir, "documents").select("doc_id", stamp.alias("stamp"))
    return s.select("doc_id", "stamp",
                    text.rfc822_date("stamp", F.lit(AS_OF).cast("date")).alias("day"))


ORACLE_LEXICON = """
SELECT d.doc_id, count(t.token) AS n_tokens, count(l.valence) AS n_hits,
       round(coalesce(sum(l.valence), 0.0), 10) AS valence_sum,
       round(coalesce(sum(l.valence), 0.0)
             / sqrt(coalesce(sum(l.valence), 0.0) * coalesce(sum(l.valence), 0.0) + 15.0), 4)
         AS compound
FROM documents d
LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS token
           FROM documents) t ON t.doc_id = d.doc_id
LEFT JOIN lexicon l ON l.token = t.token
GROUP BY d.doc_id"""


@register("lexicon_sentiment", ORACLE_LEXICON)
def q_lexicon_sentiment(spark, sf_dir):
    """Token x lexicon join over whole documents, aggregated per document."""
    d = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    lex = sentiment.lexicon_frame(spark)  # fixed word list: size known, safe to broadcast
    return present(sentiment.lexicon_join_scores(d, "doc_id", "text", lex,
                                                 broadcast_lexicon=True))


@register("lexicon_table_sentiment", ORACLE_LEXICON)
def q_lexicon_table_sentiment(spark, sf_dir):
    """The same with the lexicon as a table of unknown size: a Bloom filter before the exchange."""
    d = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return present(sentiment.lexicon_join_scores(d, "doc_id", "text", sentiment.lexicon_frame(spark)))


# =============================================================================
# Daily aggregates and rolling windows
# =============================================================================
@register("daily_sentiment_rolling", f"""
SELECT date, {r6('reddit_sentiment_avg', 'sentiment_rolling_3d')} FROM posts_daily""")
def q_daily_sentiment_rolling(spark, sf_dir):
    return present(feat.posts_daily(_narrow(spark, sf_dir, "posts")))


@register("statements_rolling", f"""
SELECT date, {r6('trump_sentiment_avg', 'trump_sentiment_rolling_3d')} FROM statements_daily""")
def q_statements_rolling(spark, sf_dir):
    return present(feat.statements_daily(_narrow(spark, sf_dir, "statements")))


@register("base_segment_rolling", f"""
SELECT date, {r6('base_war_sentiment', 'base_sentiment_rolling_7d')} FROM base_daily""")
def q_base_segment_rolling(spark, sf_dir):
    return present(feat.base_segment_daily(_narrow(spark, sf_dir, "posts")))


@register("weighted_news", f"SELECT date, {r6('news_sentiment')} FROM news_daily")
def q_weighted_news(spark, sf_dir):
    return present(feat.news_daily(_narrow(spark, sf_dir, "news")))


@register("stance_daily", f"""
SELECT date, {r6('war_sentiment_avg')}, war_article_count, favor_count, against_count,
       {r6('favor_ratio')} FROM conflict_daily""")
def q_stance_daily(spark, sf_dir):
    return present(feat.conflict_daily(_narrow(spark, sf_dir, "conflict_news")))


@register("tension_daily", f"""
SELECT date, article_count, {r6('avg_sentiment', 'escalation_pct', 'iran_pct',
                                'war_probability')} FROM tension_days""")
def q_tension_daily(spark, sf_dir):
    return present(models.tension_days(_narrow(spark, sf_dir, "tension_news")))


@register("tension_batch", """
SELECT n_articles, round(avg_sentiment, 10) AS avg_sentiment,
       round(escalation_ratio, 10) AS escalation_ratio, round(iran_pct, 10) AS iran_pct,
       round(greatest(0.05::DOUBLE, least(0.95::DOUBLE,
         0.20::DOUBLE + escalation_ratio * 0.30::DOUBLE - avg_sentiment * 0.15::DOUBLE
         + iran_pct * 0.10::DOUBLE + least(n_articles / 200.0::DOUBLE, 0.15::DOUBLE))), 10)
         AS war_probability
FROM (SELECT count(*) AS n_articles, avg(sentiment_compound) AS avg_sentiment,
             count_if(escalation = 'escalation') / count(*) AS escalation_ratio,
             avg(CASE WHEN lower(iran_spillover) = 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
               AS iran_pct
      FROM tension)""")
def q_tension_batch(spark, sf_dir):
    return present(models.tension_batch(_narrow(spark, sf_dir, "tension_news")))


ORACLE_TENSION_REPORT = """
WITH td AS (
  SELECT *, row_number() OVER w AS idx,
         avg(war_probability) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent,
         avg(war_probability) OVER (w ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING) AS before,
         first_value(war_probability) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS first_p
  FROM tension_days WINDOW w AS (ORDER BY date)),
latest AS (
  SELECT date AS latest_date, war_probability AS latest_probability,
         CASE WHEN idx >= 6 THEN recent - before WHEN idx >= 2 THEN war_probability - first_p
              ELSE 0.0 END AS trend_delta
  FROM td ORDER BY date DESC LIMIT 1),
tot AS (
  SELECT count(*) AS n_total, count_if(escalation = 'escalation') AS n_escalation,
         CAST(sum(CASE WHEN lower(iran_spillover) = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS iran_n,
         avg(sentiment_compound) AS avg_sentiment
  FROM tension)
SELECT latest_date, round(latest_probability, 10) AS latest_probability,
       CASE WHEN latest_probability >= 0.75 THEN 6 WHEN latest_probability >= 0.55 THEN 12
            WHEN latest_probability >= 0.35 THEN 24 ELSE 36 END AS months_ahead,
       strftime(date_trunc('quarter', latest_date + to_months(
         CASE WHEN latest_probability >= 0.75 THEN 6 WHEN latest_probability >= 0.55 THEN 12
              WHEN latest_probability >= 0.35 THEN 24 ELSE 36 END)), '%B %Y') AS estimated_window,
       CASE WHEN latest_probability >= 0.60 THEN 'HIGH' WHEN latest_probability >= 0.35
            THEN 'MODERATE' ELSE 'LOW' END AS risk,
       round(trend_delta, 10) AS trend_delta,
       CASE WHEN trend_delta > 0.02 THEN 'rising' WHEN trend_delta < -0.02 THEN 'falling'
            ELSE 'stable' END AS trend,
       CAST(n_total AS BIGINT) AS n_total, CAST(n_escalation AS BIGINT) AS n_escalation,
       round(CASE WHEN n_total > 0 THEN n_escalation / n_total ELSE 0.0 END, 10)
         AS escalation_ratio,
       iran_n, round(avg_sentiment, 10) AS avg_sentiment,
       (SELECT string_agg('[' || CASE WHEN sentiment_compound > 0.05 THEN 'positive'
                                      WHEN sentiment_compound < -0.05 THEN 'negative' ELSE 'neutral' END
                          || '] ' || coalesce(title, ''), chr(10) ORDER BY date DESC, source, src_id)
        FROM (SELECT * FROM tension ORDER BY date DESC, source, src_id LIMIT 5)) AS headlines
FROM latest, tot"""


@register("tension_report", ORACLE_TENSION_REPORT)
def q_tension_report(spark, sf_dir):
    rows = _narrow(spark, sf_dir, "tension_news")
    top = reports.headline_lists(views.newest_with_titles(spark, sf_dir, rows, 5), 5, tie_break=("source", "src_id"))
    return present(models.tension_report(rows, headlines=top))


# =============================================================================
# Index models
# =============================================================================
@register("pressure_index", "SELECT * FROM pressure")
def q_pressure_index(spark, sf_dir):
    return present(models.pressure_index(features_df(spark, sf_dir)))


@register("strike_outlook", """
SELECT date, round(1.0::DOUBLE - exit_probability, 10) AS strike_probability,
       CASE WHEN 1.0 - exit_probability >= 0.65 THEN 3 WHEN 1.0 - exit_probability >= 0.45 THEN 6
            WHEN 1.0 - exit_probability >= 0.25 THEN 12 ELSE 24 END AS months_ahead,
       strftime(date + to_months(
         CASE WHEN 1.0 - exit_probability >= 0.65 THEN 3 WHEN 1.0 - exit_probability >= 0.45
              THEN 6 WHEN 1.0 - exit_probability >= 0.25 THEN 12 ELSE 24 END), '%B %Y')
         AS estimated_window,
       CASE WHEN 1.0 - exit_probability >= 0.55 THEN 'HIGH'
            WHEN 1.0 - exit_probability >= 0.30 THEN 'MODERATE' ELSE 'LOW' END AS risk,
       pressure_index, base_sentiment_trend, favor_ratio, war_sentiment_avg
FROM pressure""")
def q_strike_outlook(spark, sf_dir):
    return present(models.strike_outlook(models.pressure_index(features_df(spark, sf_dir))))


@register("ceasefire", """
SELECT date, round(rs, 10) AS recent_war_sentiment, round(rf, 10) AS recent_favor_ratio,
       coalesce(rs > 0.15 AND rf > 0.70, false) AS ceasefire
FROM (SELECT date,
             avg(avg_war_sentiment) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
               AS rs,
             avg(favor_ratio) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rf
      FROM daily_sum)""")
def q_ceasefire(spark, sf_dir):
    return present(models.ceasefire(summary_df(spark, sf_dir)))


# =============================================================================
# Signals and backtest
# =============================================================================
def signals_df(spark, sf_dir):
    # the day-grain summary feeds the min-max scalar subquery and the main plan: cut once
    return signals.build_signals(materialize(summary_df(spark, sf_dir)))


@register("minmax_signals", f"""
SELECT date, {r6(*signals.SIGNAL_COLUMNS)} FROM sig_scored""")
def q_minmax_signals(spark, sf_dir):
    """The six min-max signals."""
    s = signals.minmax_signals(materialize(summary_df(spark, sf_dir)))
    return present(s.select("date", *signals.SIGNAL_COLUMNS))


@register("trade_signals", f"""
SELECT date, {r6('composite_score')}, signal, {r6('signal_strength')} FROM signals""")
def q_trade_signals(spark, sf_dir):
    s = signals.trade_signals(materialize(summary_df(spark, sf_dir)))
    return present(s.select("date", "composite_score", "signal", "signal_strength"))


@register("backtest", """
SELECT date, signal, CAST(next_day_direction AS INTEGER) AS next_day_direction,
       CAST(signal_numeric AS INTEGER) AS signal_numeric, correct FROM signals""")
def q_backtest(spark, sf_dir):
    return signals_df(spark, sf_dir).select("date", "signal", "next_day_direction",
                                            "signal_numeric", "correct")


# --- several price series (one per order priority) -----------------------------
SYMBOL = ("symbol",)


def symbol_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.feature_table(views.prices(spark, sf_dir, symbol="o_orderpriority"), partition_by=SYMBOL, **_sources(spark, sf_dir))


@register("series_features", f"""
SELECT symbol, date, {r6(*_FEATURE_DOUBLES)}, volume, war_article_count, favor_count,
       against_count, price_direction
FROM features_by_symbol""")
def q_series_features(spark, sf_dir):
    """The feature table with one price series per symbol."""
    return present(symbol_features(spark, sf_dir))


@register("series_pressure", f"""
SELECT symbol, date, {r6('exit_probability', 'pressure_index')}, base_sentiment_trend,
       {r6('base_sentiment_current', 'favor_ratio', 'war_sentiment_avg')}
FROM pressure_by_symbol""")
def q_series_pressure(spark, sf_dir):
    """Exit pressure per symbol."""
    return present(models.pressure_index(symbol_features(spark, sf_dir), partition_by=SYMBOL))


@register("series_signals", f"""
SELECT symbol, date, {r6('composite_score')}, signal, {r6('signal_strength')}, reason,
       CAST(next_day_direction AS INTEGER) AS next_day_direction, correct
FROM signals_by_symbol""")
def q_series_signals(spark, sf_dir):
    """Signals, backtest and reasons per symbol, each scaled by its own range."""
    s = feat.daily_summary(symbol_features(spark, sf_dir), partition_by=SYMBOL)
    s = signals.build_signals(s, partition_by=SYMBOL)
    return present(s.select("symbol", "date", "composite_score", "signal", "signal_strength", "reason",
                            "next_day_direction", "correct"))


@register("signal_reasons", "SELECT date, reason FROM signals")
def q_signal_reasons(spark, sf_dir):
    return signals_df(spark, sf_dir).select("date", "reason")


@register("signal_summary", """
SELECT CAST(count_if(signal = 'BUY') AS BIGINT) AS n_buy,
       CAST(count_if(signal = 'SELL') AS BIGINT) AS n_sell,
       CAST(count_if(signal = 'HOLD') AS BIGINT) AS n_hold, count(correct) AS n_trades,
       CAST(coalesce(sum(correct), 0.0) AS BIGINT) AS n_correct,
       round(coalesce(avg(correct), 0.0), 10) AS accuracy,
       arg_max(signal, date) AS latest_signal,
       round(arg_max(composite_score, date), 10) AS latest_score,
       arg_max(reason, date) AS latest_reason
FROM signals""")
def q_signal_summary(spark, sf_dir):
    return present(signals.signal_summary(signals_df(spark, sf_dir)))


@register("backtest_detail", f"""
SELECT date, signal, {r6('avg_price', 'composite_score', 'signal_strength')}, reason,
       CASE WHEN next_day_direction = 1 THEN 'Up ↑' WHEN next_day_direction = 0 THEN 'Down ↓'
       END AS next_day,
       CASE WHEN correct = 1.0 THEN '✓ Correct' WHEN correct = 0.0 THEN '✗ Wrong' END AS result
FROM signals ORDER BY date DESC""")
def q_backtest_detail(spark, sf_dir):
    return present(signals.backtest_detail(signals_df(spark, sf_dir)))


# =============================================================================
# Prediction evaluation
# =============================================================================
def evaluation_df(spark, sf_dir):
    return ev.evaluate(views.predictions(spark, sf_dir), features_df(spark, sf_dir))


@register("prediction_eval", "SELECT * FROM evaluation")
def q_prediction_eval(spark, sf_dir):
    return present(evaluation_df(spark, sf_dir))


@register("running_accuracy", """
SELECT pred_date, correct,
       round(avg(correct) OVER (ORDER BY pred_date ROWS BETWEEN UNBOUNDED PRECEDING
             AND CURRENT ROW), 10) AS cumulative_accuracy,
       round(avg(correct) OVER (ORDER BY pred_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 10)
         AS recent_accuracy
FROM evaluation WHERE correct IS NOT NULL""")
def q_running_accuracy(spark, sf_dir):
    return present(ev.running_accuracy(evaluation_df(spark, sf_dir)))


@register("accuracy_summary", """
SELECT count(*) AS total_evaluated, CAST(sum(correct) AS BIGINT) AS correct_count,
       round(avg(correct), 10) AS accuracy, round(arg_max(recent, pred_date), 10) AS recent_accuracy,
       (SELECT count(*) FROM evaluation WHERE correct IS NULL) AS pending
FROM (SELECT pred_date, correct,
             avg(correct) OVER (ORDER BY pred_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
               AS recent
      FROM evaluation WHERE correct IS NOT NULL)""")
def q_accuracy_summary(spark, sf_dir):
    # the day-grain evaluation feeds the main aggregate and the pending-count subquery
    return present(ev.accuracy_summary(materialize(evaluation_df(spark, sf_dir))))


@register("prediction_history", """
SELECT p.date, p.prediction,
       CASE WHEN s.price_direction = 1 THEN 'Up' WHEN s.price_direction = 0 THEN 'Down' END
         AS actual,
       round(p.confidence, 10) AS confidence,
       CASE WHEN coalesce(p.prediction_numeric = s.price_direction, false) THEN '✓' ELSE '✗' END
         AS correct
FROM predictions p LEFT JOIN daily_sum s ON s.date = p.date""")
def q_prediction_history(spark, sf_dir):
    return present(ev.prediction_history(views.predictions(spark, sf_dir),
                                         summary_df(spark, sf_dir)))


@register("classifier_metrics", """
SELECT tp, fp, fn, tn,
       round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END, 4)
         AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 4) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 4) AS recall
FROM (SELECT CAST(count_if(f.price_direction = 1 AND p.prediction_numeric = 1) AS BIGINT) AS tp,
             CAST(count_if(f.price_direction = 0 AND p.prediction_numeric = 1) AS BIGINT) AS fp,
             CAST(count_if(f.price_direction = 1 AND p.prediction_numeric = 0) AS BIGINT) AS fn,
             CAST(count_if(f.price_direction = 0 AND p.prediction_numeric = 0) AS BIGINT) AS tn
      FROM predictions p JOIN features f ON f.date = p.date)""")
def q_classifier_metrics(spark, sf_dir):
    """Confusion counts and metrics of the logged predictions against actual labels."""
    p = views.predictions(spark, sf_dir)
    f = features_df(spark, sf_dir).select("date", F.col("price_direction").alias("label"))
    scored = p.join(f, "date").select("label", F.col("prediction_numeric").alias("prediction"))
    return present(ev.classifier_metrics(scored))


@register("metric_cards", """
SELECT CASE WHEN (SELECT arg_max(prediction, date) FROM predictions) IS NULL THEN 'N/A'
            ELSE (CASE WHEN (SELECT arg_max(prediction, date) FROM predictions) = 'Up'
                       THEN '↑' ELSE '↓' END) || ' ' || (SELECT arg_max(prediction, date)
                                                         FROM predictions) END
         AS prediction_card,
       (SELECT round(CASE WHEN count(*) > 0
                          THEN count_if(f.price_direction = p.prediction_numeric) / count(*)
                          ELSE 0.0 END, 4)
        FROM predictions p JOIN features f ON f.date = p.date) AS model_accuracy,
       round(arg_max(avg_price, date), 10) AS latest_price,
       round(arg_max(favor_ratio, date), 10) AS latest_favor_ratio,
       round((SELECT arg_max(exit_probability, date) FROM pressure), 10) AS exit_pressure
FROM daily_sum""")
def q_metric_cards(spark, sf_dir):
    # features feed the main aggregate and three scalar subqueries: compute them once
    f = materialize(features_df(spark, sf_dir))
    p = views.predictions(spark, sf_dir)
    scored = p.join(f.select("date", F.col("price_direction").alias("label")), "date").select(
        "label", F.col("prediction_numeric").alias("prediction"))
    return present(ev.metric_cards(feat.daily_summary(f), p, models.pressure_index(f),
                                   ev.classifier_metrics(scored)))


# =============================================================================
# Reports, charts and read-path queries
# =============================================================================


@register("value_counts", """
SELECT topic, count(*) AS count FROM posts GROUP BY topic ORDER BY count DESC, topic LIMIT 10""")
def q_value_counts(spark, sf_dir):
    """Top-10 topic tags of the cleaned posts (A10)."""
    return daily.value_counts(_narrow(spark, sf_dir, "posts"), "topic", 10)


@register("describe", """
SELECT count(sentiment_compound) AS count, round(avg(sentiment_compound), 10) AS mean,
       round(stddev_samp(sentiment_compound), 10) AS std, round(min(sentiment_compound), 10) AS min,
       round(quantile_cont(sentiment_compound, 0.25), 10) AS p25,
       round(quantile_cont(sentiment_compound, 0.5), 10) AS p50,
       round(quantile_cont(sentiment_compound, 0.75), 10) AS p75,
       round(max(sentiment_compound), 10) AS max
FROM posts""")
def q_describe(spark, sf_dir):
    """count/mean/std/min/quartiles/max of post sentiment."""
    return present(daily.describe(_narrow(spark, sf_dir, "posts"), "sentiment_compound"))


@register("date_range_filter", """
SELECT date, round(avg_trump_sentiment, 10) AS avg_trump_sentiment,
       round(trump_sentiment_rolling_3d, 10) AS trump_sentiment_rolling_3d,
       CASE WHEN avg_trump_sentiment > 0 THEN 'positive' ELSE 'negative' END AS tone
FROM daily_sum
WHERE date BETWEEN (SELECT min(date) FROM daily_sum) AND (SELECT max(date) FROM daily_sum)
  AND abs(avg_trump_sentiment) > 0.01""")
def q_date_range_filter(spark, sf_dir):
    """Default full range (P8), then the significance filter with sign."""
    s = materialize(summary_df(spark, sf_dir))
    return present(reports.significant_statements(reports.date_range(s)))


@register("latest_rows", """
SELECT date, source, title, round(sentiment_compound, 10) AS sentiment_compound,
       CASE WHEN sentiment_compound > 0.05 THEN 'positive'
            WHEN sentiment_compound < -0.05 THEN 'negative' ELSE 'neutral' END AS badge
FROM statements ORDER BY date DESC, source, title LIMIT 50""")
def q_latest_rows(spark, sf_dir):
    """Newest 50 statements with badge."""
    return present(reports.headlines(views.cleaned(spark, sf_dir, "statements", ["sentiment_compound"]), 50))


@register("chart_series", """
SELECT date, avg_price, rolling_avg_7d, avg_price_delta,
       CASE WHEN avg_price_delta > 0 THEN 'up' WHEN avg_price_delta < 0 THEN 'down'
            ELSE 'flat' END AS delta_class,
       avg_reddit_sentiment, avg_news_sentiment, favor_count, against_count,
       avg_trump_sentiment, trump_sentiment_rolling_3d,
       abs(avg_trump_sentiment) > 0.01 AS trump_significant,
       base_war_sentiment, base_sentiment_rolling_7d
FROM daily_sum""")
def q_chart_series(spark, sf_dir):
    """Per-day dashboard series."""
    return present(reports.price_chart(summary_df(spark, sf_dir)))


@register("tension_chart", """
SELECT date, round(escalation_pct * 100, 10) AS escalation_share,
       round((1.0::DOUBLE - escalation_pct) * 100, 10) AS other_share,
       round(war_probability * 100, 10) AS probability_pct
FROM tension_days""")
def q_tension_chart(spark, sf_dir):
    """Escalation share and probability in percent."""
    return present(reports.tension_chart(models.tension_days(
        _narrow(spark, sf_dir, "tension_news"))))


@register("signal_chart", """
SELECT date, round(avg_price, 10) AS avg_price,
       round(CASE WHEN signal = 'BUY' THEN avg_price END, 10) AS buy_marker,
       round(CASE WHEN signal = 'SELL' THEN avg_price END, 10) AS sell_marker,
       round(composite_score, 10) AS composite_score,
       CASE WHEN composite_score > 0 THEN 'buy' ELSE 'sell' END AS bar_class
FROM signals""")
def q_signal_chart(spark, sf_dir):
    """Price line with BUY/SELL markers and score bars."""
    return present(reports.signal_chart(signals_df(spark, sf_dir)))


_RECENT = "arg_max(recent, date)"


@register("self_assessment", f"""
SELECT round({_RECENT}, 10) AS recent_accuracy,
       round(avg(correct), 10) AS overall_accuracy, count(*) AS n_trades,
       {line_sql(signals.RECENT_LINE, pct_sql(_RECENT), "'5'", cases_sql(
           (f"{_RECENT} >= 0.7", signals.RECENT_GOOD), (f"{_RECENT} >= 0.4", signals.RECENT_MIXED), otherwise=signals.RECENT_POOR))}
       || chr(10) || {line_sql(signals.OVERALL_LINE, pct_sql("avg(correct)"), "CAST(count(*) AS VARCHAR)")} AS assessment
FROM (SELECT date, correct,
             avg(correct) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent
      FROM signals WHERE correct IS NOT NULL)
HAVING count(*) >= 3""")
def q_self_assessment(spark, sf_dir):
    """Recent and overall backtest accuracy with the reference's bands."""
    return present(signals.self_assessment(signals_df(spark, sf_dir)))


_WINDOW_SQL = """
  SELECT * FROM prices
  WHERE date < (SELECT max(date) + 1 FROM prices) AND date >= (SELECT max(date) + 1 FROM prices) - {days}"""


@register("incremental_window", f"""
SELECT 'backfill' AS pull, * FROM ({_WINDOW_SQL.format(days=90)})
UNION ALL
SELECT 'overlap', * FROM ({_WINDOW_SQL.format(days=2)})""")
def q_incremental_window(spark, sf_dir):
    """Pull windows before ``as_of`` (day after the newest price): a 90-day backfill while nothing
    has landed, and the 2-day overlap once the earlier days have (S9)."""
    p = materialize(views.prices(spark, sf_dir))  # read five times below: compute once
    last = p.agg(F.max("date")).scalar()
    as_of, out = F.date_add(last, 1), None
    for pull, target in (("backfill", p.where(F.col("date") > last)), ("overlap", p.where(F.col("date") < last))):
        rows = files.incremental_window(p, target, as_of).select(F.lit(pull).alias("pull"), "*")
        out = rows if out is None else out.unionByName(rows)
    return present(out)


@register("volume_gate", """
SELECT source, n_rows, CAST(sum(n_rows) OVER () AS BIGINT) AS total_rows,
       CASE WHEN sum(n_rows) OVER () >= 10 THEN 'proceed' ELSE 'low_data' END AS status
FROM (SELECT 'prices' AS source, count(*) AS n_rows FROM prices
      UNION ALL SELECT 'posts', count(*) FROM posts
      UNION ALL SELECT 'news', count(*) FROM news
      UNION ALL SELECT 'statements', count(*) FROM statements
      UNION ALL SELECT 'conflict_news', count(*) FROM conflict
      UNION ALL SELECT 'tension_news', count(*) FROM tension)""")
def q_volume_gate(spark, sf_dir):
    """Cleaned rows per source, total and proceed/low-data status (Q2)."""
    counts = {"prices": views.prices(spark, sf_dir)}
    for s in ("posts", "news", "statements", "conflict_news", "tension_news"):
        counts[s] = _narrow(spark, sf_dir, s)
    out = quality.volume_gate(counts)
    return out.withColumn("total_rows", F.col("total_rows").cast("long"))


@register("keyed_upsert", """
SELECT date, prediction_numeric, round(confidence, 10) AS confidence, version FROM (
  SELECT date, prediction_numeric, confidence, 1 AS version FROM predictions
  UNION ALL
  SELECT p.date, 1 - p.prediction_numeric, round(1.0 - p.confidence, 4), 2
  FROM predictions p JOIN features f ON f.date = p.date
  WHERE p.prediction_numeric != f.price_direction)
QUALIFY row_number() OVER (PARTITION BY date ORDER BY version DESC) = 1""")
def q_keyed_upsert(spark, sf_dir):
    """Corrections (version 2) for wrong predictions upserted over the log."""
    p = materialize(views.predictions(spark, sf_dir))  # the log and its corrections read it
    f = features_df(spark, sf_dir).select("date", "price_direction")
    cur = p.select("date", "prediction_numeric", "confidence", F.lit(1).alias("version"))
    upd = (p.join(f, "date").where(F.col("prediction_numeric") != F.col("price_direction"))
           .select("date", (F.lit(1) - F.col("prediction_numeric")).alias("prediction_numeric"),
                   F.round(F.lit(1.0) - F.col("confidence"), 4).alias("confidence"),
                   F.lit(2).alias("version")))
    return present(sinks.keyed_upsert(cur, upd, ["date"]))


@register("table_counts", """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'daily_summary', count(*) FROM daily_sum""")
def q_table_counts(spark, sf_dir):
    """Row count per table."""
    return daily.table_counts({
        "orders": views.table(spark, sf_dir, "orders"),
        "events": views.table(spark, sf_dir, "events"),
        "documents": views.table(spark, sf_dir, "documents"),
        "daily_summary": summary_df(spark, sf_dir),
    })


_TENSION_LINES = ",\n".join([
    line_sql(reports.ESCALATION_LINE, pct_sql("escalation_ratio"),
             cases_sql(("escalation_ratio > 0.5", reports.ESCALATION_HIGH), otherwise=reports.ESCALATION_LOW)),
    line_sql(reports.SPILLOVER_LINE, "CAST(iran_n AS VARCHAR)",
             cases_sql(("iran_n > 5", reports.SPILLOVER_HIGH), otherwise=reports.SPILLOVER_LOW)),
    line_sql(reports.TRAJECTORY_LINE, "trend", "(printf('%+.1f', round(trend_delta * 100, 1) + 0.0::DOUBLE) || '%')",
             cases_sql(("trend_delta > 0.02", reports.TRAJECTORY_RISING), ("trend_delta < -0.02", reports.TRAJECTORY_FALLING),
                       otherwise=reports.TRAJECTORY_STABLE)),
    line_sql(reports.SENTIMENT_LINE, "printf('%.3f', round(avg_sentiment, 3))",
             cases_sql(("avg_sentiment < -0.15", reports.SENTIMENT_DEEP), ("avg_sentiment < 0", reports.SENTIMENT_MILD),
                       otherwise=reports.SENTIMENT_NEUTRAL)),
    f"CASE WHEN latest_probability >= 0.55 THEN {line_sql(reports.VOLUME_LINE, 'CAST(n_total AS VARCHAR)')} END"])


@register("tension_bullets", f"""
WITH rep AS ({ORACLE_TENSION_REPORT})
SELECT latest_date, concat_ws(chr(10), {_TENSION_LINES}) AS bullets
FROM rep""")
def q_tension_bullets(spark, sf_dir):
    """Rule-based sentences of the tension report."""
    return reports.tension_bullets(models.tension_report(
        _narrow(spark, sf_dir, "tension_news")))


# =============================================================================
# Landed files: write with the sinks, scan with the sources (round trips)
# =============================================================================

_NEWS_RAW = ["date", "source", "title", "published_date", "summary", "sentiment_compound"]


@register("csv_roundtrip", """
SELECT date, source, title, published_date, summary,
       round(sentiment_compound, 10) AS sentiment_compound FROM landed_news""")
def q_csv_roundtrip(spark, sf_dir):
    """News landed as day-stamped CSV (K2) and scanned back with the fixed schema (S1, T1):
    multi-line, quoted whole texts must survive unchanged."""
    landed = views.landed_news(spark, sf_dir)
    out = landed.select(F.col("date").cast("string").alias("date"), *_NEWS_RAW[1:],
                        F.lit(AS_OF).alias("ingest_date"))
    root = scratch_path(spark, "landing-news")
    sinks.land_csv(out, root)
    back = files.read_landed_csv(spark, root, "news")
    return present(clean.normalise(back, "date", ["title"]).select(*_NEWS_RAW))


@register("xml_feed", f"""
SELECT CASE WHEN contains(raw, ' - ') THEN trim(string_split(raw, ' - ')[-1]) ELSE 'unknown' END
         AS source,
       CASE WHEN contains(raw, ' - ') THEN trim(regexp_replace(raw, '(?s)^(.*) - .*$', '\\1'))
            ELSE raw END AS title,
       date, CAST(length(summary) AS INTEGER) AS summary_chars
FROM (SELECT title || ' - ' || source AS raw, date, summary FROM landed_news)""")
def q_xml_feed(spark, sf_dir):
    """News items written as RSS XML, scanned with rowTag=item (S6); headline split (F5),
    feed date parsed (F6)."""
    landed = views.landed_news(spark, sf_dir)
    items = landed.select(F.concat("title", F.lit(" - "), "source").alias("title"),
                          F.col("summary").alias("description"),
                          F.col("published_date").alias("pubDate"))
    root = scratch_path(spark, "feed-xml")
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(root)
    feed = files.read_feed_xml(spark, root)
    return feed.select(
        text.split_source("title").alias("source"), text.strip_source("title").alias("title"),
        text.rfc822_date("published", F.lit(AS_OF).cast("date")).alias("date"),
        F.length("summary").alias("summary_chars"))


def _epoch_seconds(ts: str):
    """Seconds since the epoch of a wall-clock (NTZ) stamp, independent of the session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    secs = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return secs.cast("double")


_VIEW_GROUPS = [(t, "base") for t in views.VIEW_BASE_TYPES] + [
    (t, "general") for t in ("click", "signup", "view")]


_LISTING_TEXT = "event_type || ' by user ' || CAST(user_id AS VARCHAR) || ' ' || CAST(value AS VARCHAR)"


@register("json_listing", f"""
WITH valence AS (
  SELECT t.event_id, sum(l.valence) AS vs
  FROM (SELECT event_id, unnest(regexp_extract_all(lower({_LISTING_TEXT}), '[a-z]+')) AS token
        FROM events) t
  JOIN post_lexicon l ON l.token = t.token GROUP BY t.event_id)
SELECT CAST(ts AS DATE) AS date, event_type AS subreddit,
       CASE WHEN event_type IN {tuple(views.VIEW_BASE_TYPES)!r} THEN 'base' ELSE 'general' END
         AS subreddit_group,
       event_type || ' by user ' || CAST(user_id AS VARCHAR) AS title,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS score,
       round(coalesce(v.vs, 0.0) / sqrt(coalesce(v.vs, 0.0) * coalesce(v.vs, 0.0) + 15.0), 4)
         AS sentiment_compound,
       {tags_sql(_LISTING_TEXT, views.VIEW_POST_TOPICS)} AS topic
FROM events e LEFT JOIN valence v ON v.event_id = e.event_id""")
def q_json_listing(spark, sf_dir):
    """Events written as post listings (pages of at most 100 children), scanned back and
    turned into post rows (S7, F7, F8, F15, F16)."""
    from sparksignal.plans import feeds as feeds_mod

    e = views.table(spark, sf_dir, "events")
    child = F.struct(F.lit("t3").alias("kind"), F.struct(
        F.col("event_type").alias("subreddit"),
        F.concat(F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"))
        .alias("title"),
        F.col("value").cast("string").alias("selftext"),
        F.get_json_object("props", "$.k").cast("int").alias("score"),
        _epoch_seconds("ts").alias("created_utc")).alias("data"))
    # a page holds at most 100 rows by construction (row ids are unique even when
    # event ids repeat), so no listing group can grow with the data
    row_id = F.monotonically_increasing_id()
    pages = (e.withColumn("_page", F.floor(row_id / 100))
             .groupBy("event_type", "_page")
             .agg(F.collect_list(child).alias("children"))
             .select(F.lit("Listing").alias("kind"),
                     F.struct(F.lit(None).cast("string").alias("after"), "children").alias("data")))
    root = scratch_path(spark, "listings")
    pages.write.json(root)
    posts = files.read_listings(spark, root)
    return present(feeds_mod.posts_from_listings(posts, F.lit(AS_OF).cast("date"),
                                                 groups=_VIEW_GROUPS,
                                                 topics=views.VIEW_POST_TOPICS,
                                                 lexicon=views.VIEW_POST_LEXICON))


@register("json_predictions", """
SELECT date, prediction, prediction_numeric, round(confidence, 10) AS confidence
FROM predictions""")
def q_json_predictions(spark, sf_dir):
    """Prediction and pressure documents written as JSON partitioned by kind/date (K4) and
    read back without the pressure kind; nested object dropped (S4)."""
    preds = views.predictions(spark, sf_dir).withColumn(
        "features", F.struct(F.col("prediction_numeric").cast("double").alias("class_value"),
                             F.col("confidence").alias("confidence")))
    pressure = models.pressure_index(features_df(spark, sf_dir))
    root = scratch_path(spark, "documents")
    sinks.write_json_documents(preds, root, "prediction")
    sinks.write_json_documents(pressure, root, "war_exit")
    schema = T.StructType([
        T.StructField("date", T.StringType()), T.StructField("prediction", T.StringType()),
        T.StructField("prediction_numeric", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("features", T.StructType([T.StructField("class_value", T.DoubleType()),
                                                T.StructField("confidence", T.DoubleType())])),
    ])
    back = files.read_json_documents(spark, root, schema)
    return present(back.select(F.to_date("date").alias("date"), "prediction",
                               "prediction_numeric", "confidence"))


@register("rf_direction")
def q_rf_direction(spark, sf_dir):
    """Random forest on the chronological 80/20 split; test-set predictions (M8, M9)."""
    f = materialize(features_df(spark, sf_dir))
    train, test = classifier.split_chronological(f)
    model = classifier.train(quality.require_rows(train, classifier.MIN_ROWS))
    return classifier.predict(model, test)


@register("rf_split", """
SELECT date, price_direction AS actual,
       CASE WHEN row_number() OVER (ORDER BY date DESC)
                 <= ceil(CAST(count(*) OVER () AS DOUBLE) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part
FROM features""")
def q_rf_split(spark, sf_dir):
    """The chronological split that the forest is fitted and tested on."""
    train, test = classifier.split_chronological(materialize(features_df(spark, sf_dir)))
    parts = [d.select("date", F.col(classifier.TARGET).alias("actual"), F.lit(name).alias("part"))
             for d, name in ((train, "train"), (test, "test"))]
    return parts[0].unionByName(parts[1])


@register("rf_validity", """
SELECT date, actual, true AS valid_class, true AS valid_confidence
FROM (SELECT date, price_direction AS actual, row_number() OVER (ORDER BY date DESC) AS rk,
             count(*) OVER () AS n FROM features)
WHERE rk <= ceil(CAST(n AS DOUBLE) * 0.2::DOUBLE)""")
def q_rf_validity(spark, sf_dir):
    """One prediction for each test day, its class 0 or 1 and named accordingly, its
    probability that of the likelier class (M8, M9)."""
    p = q_rf_direction(spark, sf_dir)
    named = F.when(F.col("prediction_numeric") == 1, "Up").when(F.col("prediction_numeric") == 0, "Down")
    return p.select("date", "actual", F.coalesce(named == F.col("prediction"), F.lit(False)).alias("valid_class"),
                    F.col("confidence").between(0.5, 1.0).alias("valid_confidence"))


@register("landing_report")
def q_landing_report(spark, sf_dir):
    """Posts landed as CSV under a landing root; every expected source reported OK or
    MISSING with file count and bytes (K2, Q1)."""
    root = scratch_path(spark, "landing")
    posts = views.landed_posts(spark, sf_dir).drop("src_id")
    sinks.land_csv(posts.select(F.col("date").cast("string").alias("date"),
                                *[c for c in posts.columns if c != "date"],
                                F.lit(AS_OF).alias("ingest_date")), f"{root}/posts")
    return quality.landing_report(spark, root, ["prices", "posts", "news", "statements",
                                                "conflict_news", "tension_news"])


# =============================================================================
# Structured Streaming ingest of re-landed files
# =============================================================================

_POST_COLS = [
    "date", "subreddit", "subreddit_group", "title", "score", "sentiment_compound", "topic"]


@register("stream_landing", f"""
SELECT date, subreddit, subreddit_group, title, score,
       round(sentiment_compound, 10) AS sentiment_compound, topic
FROM landed_posts
QUALIFY row_number() OVER (PARTITION BY date, subreddit, title
                           ORDER BY sentiment_compound DESC, score DESC, topic DESC,
                                    subreddit_group DESC) = 1""")
def q_stream_landing(spark, sf_dir):
    """Posts landed twice (a full re-landing the next day), ingested by a file stream into a
    bronze table (availableNow trigger, exactly-once file sink) and deduplicated (D1, S9)."""
    landed = views.landed_posts(spark, sf_dir)
    rows = landed.select(F.col("date").cast("string").alias("date"), *_POST_COLS[1:])
    root = scratch_path(spark, "stream")
    for day in ("2024-01-30", "2024-01-31"):
        sinks.land_csv(rows.withColumn("ingest_date", F.lit(day)), f"{root}/landing")
    stream_landing.ingest(spark, f"{root}/landing", f"{root}/bronze", "posts",
                          checkpoint=f"{root}/checkpoint")
    order = ["landed_on", "sentiment_compound", "score", "topic", "subreddit_group"]
    out = stream_landing.clean_from_bronze(spark, f"{root}/bronze", "posts", order)
    return present(out.select(*_POST_COLS))


# =============================================================================
# More read-path and source queries
# =============================================================================
@register("date_span", """
SELECT source, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date
FROM news GROUP BY source""")
def q_date_span(spark, sf_dir):
    """Rows and first/last day per news source."""
    return daily.date_span(_narrow(spark, sf_dir, "news"), by=["source"])


@register("price_frame", """
SELECT date, open, high, low, close, volume FROM prices""")
def q_price_frame(spark, sf_dir):
    """A vendor-style frame (capitalised names, extra columns) normalised to OHLCV."""
    p = views.prices(spark, sf_dir)
    vendor = p.select(F.col("date").cast("timestamp").alias("Date"), F.col("open").alias("Open"),
                      F.col("high").alias("High"), F.col("low").alias("Low"),
                      F.col("close").alias("Close"), F.col("volume").alias("Volume"),
                      F.lit(0.0).alias("Stock Splits"))
    return files.normalise_price_frame(vendor)


@register("serving_tables", """
SELECT 'daily_summary' AS table_name, count(*) AS n_rows
  FROM (SELECT * FROM daily_sum ORDER BY date DESC LIMIT 30)
UNION ALL SELECT 'predictions', count(*) FROM predictions
UNION ALL SELECT 'statements', count(*) FROM statements
UNION ALL SELECT 'conflict_news', count(*) FROM conflict
UNION ALL SELECT 'exit_index', count(*) FROM pressure
UNION ALL SELECT 'tension', count(*) FROM tension""")
def q_serving_tables(spark, sf_dir):
    """Full refresh of the six serving tables (K5) and row counts read back by name.

    The features and the three article tables read one stored set of cleaned rows: texts are scored, tagged and moved once.
    """
    shared = materialize(views.cleaned_documents(spark, sf_dir))
    f = materialize(features_df(spark, sf_dir, shared))
    tables = {
        "daily_summary": feat.last_n(feat.daily_summary(f), 30),
        "predictions": views.predictions(spark, sf_dir),
        "statements": views.cleaned(spark, sf_dir, "statements", shared=shared),
        "conflict_news": views.cleaned(spark, sf_dir, "conflict_news", shared=shared),
        "exit_index": models.pressure_index(f),
        "tension": views.cleaned(spark, sf_dir, "tension_news", shared=shared),
    }
    root = scratch_path(spark, "serving")
    for name, df in tables.items():
        sinks.load_serving_table(df, f"{root}/{name}", f"serving_{name}")
    return daily.table_counts({name: files.read_table(spark, f"serving_{name}", T.StructType())
                               for name in tables})


_STRIKE_LINES = ",\n".join([
    line_sql(reports.FAVOR_LINE, pct_sql("favor_ratio"), cases_sql(("favor_ratio > 0.5", reports.FAVOR_HIGH), otherwise=reports.FAVOR_LOW)),
    line_sql(reports.WAR_LINE, "printf('%.3f', round(war_sentiment_avg, 3))",
             cases_sql(("war_sentiment_avg < -0.1", reports.WAR_HAWKISH), otherwise=reports.WAR_NEUTRAL)),
    line_sql(reports.TREND_LINE, "base_sentiment_trend",
             cases_sql(("base_sentiment_trend = 'declining'", reports.TREND_DECLINING),
                       ("base_sentiment_trend = 'improving'", reports.TREND_IMPROVING), otherwise=reports.TREND_STABLE))])


@register("strike_bullets", f"""
SELECT date, concat_ws(chr(10), {_STRIKE_LINES}) AS bullets
FROM pressure""")
def q_strike_bullets(spark, sf_dir):
    """Reasoning sentences of the strike outlook per day."""
    p = models.pressure_index(features_df(spark, sf_dir))
    return reports.strike_bullets(models.strike_outlook(p))


@register("rf_metrics")
def q_rf_metrics(spark, sf_dir):
    """Accuracy / precision / recall of the random forest on the chronological test set."""
    f = materialize(features_df(spark, sf_dir))
    train, test = classifier.split_chronological(f)
    model = classifier.train(quality.require_rows(train, classifier.MIN_ROWS))
    scored = classifier.predict(model, test)
    return ev.classifier_metrics(scored, label="actual", prediction="prediction_numeric")


@register("eval_log_csv", """
SELECT pred_date, predicted, actual, correct, round(confidence, 10) AS confidence, status
FROM evaluation""")
def q_eval_log_csv(spark, sf_dir):
    """Evaluation log written as CSV (K6) and read back with its schema; the evaluation
    timestamp parses error-tolerantly (F22)."""
    root = scratch_path(spark, "eval-log")
    log = evaluation_df(spark, sf_dir).withColumn("evaluated_at", F.lit(f"{AS_OF} 06:00:00"))
    sinks.write_csv(log, root)
    schema = ("pred_date date, predicted string, actual string, correct int, confidence double, "
              "status string, evaluated_at string")
    back = spark.read.schema(schema).option("header", True).option("escape", '"').csv(root)
    back = back.where(clean.to_timestamp_safe("evaluated_at").isNotNull())
    return present(back.drop("evaluated_at"))


# =============================================================================
# Feed ingest from landed RSS files
# =============================================================================
_STAMP_SQL = ("strftime(DATE '1995-01-01' + CAST(doc_id % 2400 AS INTEGER), '%a, %d %b %Y') "
              "|| ' 12:00:00 +0000'")


_FEED_SQL = f"""
WITH items AS (
  SELECT 0 AS feed_ord, doc_id, {_HEAD_SQL} || ' - ' || source AS raw_title, text AS summary,
         {_STAMP_SQL} AS published FROM documents WHERE lang = 'en'
  UNION ALL
  SELECT 1, doc_id, {_HEAD_SQL} || ' - ' || source, text, {_STAMP_SQL}
  FROM documents WHERE lang = 'de'
  UNION ALL
  SELECT 2, doc_id, {_HEAD_SQL}, text, {_STAMP_SQL} FROM documents
  WHERE coalesce(lang, '') NOT IN ('en', 'de')
    AND coalesce(regexp_matches({_HEAD_SQL} || ' ' || text, {rx(views.VIEW_CONFLICT_FILTER)}), false)),
entries AS (
  SELECT feed_ord, doc_id, summary, published,
         CASE WHEN feed_ord = 2 THEN 'world'
              WHEN contains(raw_title, ' - ') THEN trim(string_split(raw_title, ' - ')[-1])
              WHEN feed_ord = 0 THEN 'wire_a' ELSE 'wire_b' END AS source,
         CASE WHEN feed_ord = 2 THEN raw_title
              WHEN contains(raw_title, ' - ')
              THEN trim(regexp_replace(raw_title, '(?s)^(.*) - .*$', '\\1'))
              ELSE raw_title END AS title0
  FROM items),
valence AS (
  SELECT t.feed_ord, t.doc_id, sum(l.valence) AS vs
  FROM (SELECT feed_ord, doc_id,
               unnest(regexp_extract_all(lower(title0 || ' ' || summary), '[a-z]+')) AS token
        FROM entries) t
  JOIN lexicon l ON l.token = t.token
  GROUP BY t.feed_ord, t.doc_id),
scored AS (
  SELECT coalesce(TRY_CAST(try_strptime(regexp_extract(published,
                    '(\\d{{1,2}} [A-Za-z]{{3}} \\d{{4}})', 1), '%d %b %Y') AS DATE),
                  DATE '{AS_OF}') AS date,
         e.source, e.title0 AS title, e.published AS published_date, e.summary,
         round(coalesce(v.vs, 0.0) / sqrt(coalesce(v.vs, 0.0) * coalesce(v.vs, 0.0) + 15.0), 4)
           AS sentiment_compound, e.feed_ord, e.doc_id
  FROM entries e LEFT JOIN valence v ON v.feed_ord = e.feed_ord AND v.doc_id = e.doc_id)"""


def view_feeds(spark, sf_dir):
    """Three RSS feeds landed as XML and scanned: two headline feeds, one keyword-filtered world feed."""
    from sparksignal.plans import feeds as feeds_mod

    d, lang = views.table(spark, sf_dir, "documents"), F.col("lang")
    day = F.date_add(F.lit(views.EPOCH).cast("date"), (F.col("doc_id") % views.N_DAYS).cast("int"))
    stamp = F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 12:00:00 +0000"))

    def landed_feed(name: str, rows, with_source: bool) -> DataFrame:
        title = F.concat(_head(), F.lit(" - "), F.col("source")) if with_source else _head()
        items = (d.where(rows)
                 .select("doc_id", title.alias("title"), F.col("text").alias("description"),
                         stamp.alias("pubDate"))
                 # feed files in entry order: range-partitioned and sorted by position
                 .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
                 .drop("doc_id"))
        root = scratch_path(spark, f"feed-{name}")
        items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(root)
        return files.read_feed_xml(spark, root)

    feeds = [
        feeds_mod.Feed("wire_a", landed_feed("en", lang == "en", True)),
        feeds_mod.Feed("wire_b", landed_feed("de", lang == "de", True)),
        feeds_mod.Feed("world", landed_feed(
            "world", ~F.coalesce(lang, F.lit("")).isin("en", "de"), False), kind="filtered",
                       pattern=views.VIEW_CONFLICT_FILTER, source="world"),
    ]
    return feeds


@register("feed_ingest", f"""{_FEED_SQL}
SELECT date, source, title, published_date, summary,
       round(sentiment_compound, 10) AS sentiment_compound,
       CASE WHEN sentiment_compound > 0.05 THEN 'favor'
            WHEN sentiment_compound < -0.05 THEN 'against' ELSE 'neutral' END AS stance
FROM scored
QUALIFY row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY feed_ord, doc_id) = 1""")
def q_feed_ingest(spark, sf_dir):
    """Three RSS feeds, split, scored on whole texts and deduplicated first-seen across feeds
    (S6, F4-F6, F16, P7, V1, D2, F10)."""
    from sparksignal.plans import feeds as feeds_mod

    return present(feeds_mod.conflict_news(view_feeds(spark, sf_dir), F.lit(AS_OF).cast("date")))


@register("tension_by_source", """
SELECT source, n_articles, round(avg_sentiment, 10) AS avg_sentiment,
       round(escalation_ratio, 10) AS escalation_ratio, round(iran_pct, 10) AS iran_pct,
       round(greatest(0.05::DOUBLE, least(0.95::DOUBLE,
         0.20::DOUBLE + escalation_ratio * 0.30::DOUBLE - avg_sentiment * 0.15::DOUBLE
         + iran_pct * 0.10::DOUBLE + least(n_articles / 200.0::DOUBLE, 0.15::DOUBLE))), 10)
         AS war_probability
FROM (SELECT source, count(*) AS n_articles, avg(sentiment_compound) AS avg_sentiment,
             count_if(escalation = 'escalation') / count(*) AS escalation_ratio,
             avg(CASE WHEN lower(iran_spillover) = 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
               AS iran_pct
      FROM tension GROUP BY source)""")
def q_tension_by_source(spark, sf_dir):
    """The batch index with one batch per source feed."""
    return present(models.tension_batch(_narrow(spark, sf_dir, "tension_news"), by=["source"]))


from sparksignal import queries_landing  # noqa: E402, F401  (registers further queries)
