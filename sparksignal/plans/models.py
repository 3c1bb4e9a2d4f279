"""Index models as column expressions: exit pressure (M2, M3), strike outlook
(M4), ceasefire detector (M5), tension probability and report (A7-A9, M6, M7).

The reference scores only the newest row in pandas; here every day gets its
score in one projection over the day-grain frame, and "latest" is a
``max_by`` aggregate, so nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksignal.functions import classify
from sparksignal.functions.numeric import band_months, clamp, month_label, sigmoid
from sparksignal.operators import daily, series

# --- fixed values (weights, scales and bands of the reference) ---------------
PRESSURE_WEIGHTS = {"base_sentiment": 0.35, "favor_ratio": 0.30, "war_sentiment": 0.20,
                    "trend": 0.15}
SENTIMENT_NEUTRAL = 0.0
SIGMOID_SCALE = 6.0
STRIKE_MONTH_BANDS = [(0.65, 3), (0.45, 6), (0.25, 12)]
STRIKE_MONTHS_ELSE = 24
TENSION_MONTH_BANDS = [(0.75, 6), (0.55, 12), (0.35, 24)]
TENSION_MONTHS_ELSE = 36
CEASEFIRE_SENTIMENT = 0.15
CEASEFIRE_FAVOR = 0.70
CEASEFIRE_DAYS = 5
TENSION_BASE = 0.20
TENSION_ESCALATION_W = 0.30
TENSION_SENTIMENT_W = 0.15
TENSION_SPILLOVER_W = 0.10
TENSION_VOLUME_DIV = 200.0
TENSION_VOLUME_CAP = 0.15
TENSION_CLIP = (0.05, 0.95)
# -----------------------------------------------------------------------------
PRESSURE_MIN_ROWS = 2  # fixed value: days that the pressure index needs


def pressure_terms(b7: Column, prev: Column, favor: Column, war: Column) -> Column:
    """Pressure index in [0, 1], rounded to 4 (M2).

    A previous value of exactly 0.0 (or none) means "unknown": trend term 0.5 (T13).
    """
    base_p = clamp((F.lit(SENTIMENT_NEUTRAL) - b7 + F.lit(0.5)) / F.lit(1.0))
    favor_p = clamp(F.lit(1.0) - favor)
    war_p = clamp((F.lit(SENTIMENT_NEUTRAL) - war + F.lit(0.5)) / F.lit(1.0))
    trend = F.when(prev != 0.0, b7 - prev).otherwise(F.lit(0.0))
    trend_p = clamp((-trend + F.lit(0.1)) / F.lit(0.2))
    w = PRESSURE_WEIGHTS
    total = (F.lit(w["base_sentiment"]) * base_p + F.lit(w["favor_ratio"]) * favor_p
             + F.lit(w["war_sentiment"]) * war_p + F.lit(w["trend"]) * trend_p)
    return F.round(clamp(total), 4)


def pressure_index(features: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Exit pressure, exit probability and base trend for every day and series."""
    prev = series.shift(features, "base_sentiment_rolling_7d", "_prev", offset=1,
                        partition_by=partition_by)
    b7, p = F.col("base_sentiment_rolling_7d"), F.col("_prev")
    pressure = pressure_terms(b7, p, F.col("favor_ratio"), F.col("war_sentiment_avg"))
    out = prev.select(
        *partition_by, "date",
        pressure.alias("pressure_index"),
        b7.alias("_b7"), p.alias("_p"), "favor_ratio", "war_sentiment_avg",
    )
    return out.select(
        *partition_by, "date",
        F.round(sigmoid((F.col("pressure_index") - F.lit(0.5)) * F.lit(SIGMOID_SCALE)), 4)
        .alias("exit_probability"),
        "pressure_index",
        classify.base_trend("_b7", "_p").alias("base_sentiment_trend"),
        F.round("_b7", 4).alias("base_sentiment_current"),
        F.round("favor_ratio", 4).alias("favor_ratio"),
        F.round("war_sentiment_avg", 4).alias("war_sentiment_avg"),
    )


def strike_outlook(pressure: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Strike index = 1 - exit probability, estimated window and risk band.

    ``as_of`` defaults to each row's own date (the reference uses "today").
    """
    strike = F.lit(1.0) - F.col("exit_probability")
    months = band_months(strike, STRIKE_MONTH_BANDS, STRIKE_MONTHS_ELSE)
    day = F.col("date") if as_of is None else as_of
    return pressure.select(
        "date",
        strike.alias("strike_probability"),
        months.alias("months_ahead"),
        month_label(day, months).alias("estimated_window"),
        classify.risk_label(strike, classify.STRIKE_RISK_BANDS).alias("risk"),
        "pressure_index", "base_sentiment_trend", "favor_ratio", "war_sentiment_avg",
    )


def ceasefire(summary: DataFrame, days: int = CEASEFIRE_DAYS) -> DataFrame:
    """Per day: means of the last ``days`` rows and the ceasefire flag."""
    out, by = series.in_blocks(summary, before=days - 1), [series.BLOCK]
    out = series.rolling_mean(out, "avg_war_sentiment", days, "recent_war_sentiment", partition_by=by, digits=None)
    out = series.own_rows(series.rolling_mean(out, "favor_ratio", days, "recent_favor_ratio", partition_by=by, digits=None))
    flag = ((F.col("recent_war_sentiment") > CEASEFIRE_SENTIMENT)
            & (F.col("recent_favor_ratio") > CEASEFIRE_FAVOR))
    return out.select("date", "recent_war_sentiment", "recent_favor_ratio",
                      F.coalesce(flag, F.lit(False)).alias("ceasefire"))


def tension_probability(article_count: Column, esc: Column, sent: Column, iran: Column) -> Column:
    """Clipped heuristic probability."""
    vol = F.least(article_count / F.lit(TENSION_VOLUME_DIV), F.lit(TENSION_VOLUME_CAP))
    raw = (F.lit(TENSION_BASE) + esc * F.lit(TENSION_ESCALATION_W)
           - sent * F.lit(TENSION_SENTIMENT_W) + iran * F.lit(TENSION_SPILLOVER_W) + vol)
    return clamp(raw, *TENSION_CLIP)


def tension_days(tension: DataFrame) -> DataFrame:
    """Daily tension aggregates plus war probability."""
    d = daily.tension_daily(tension)
    return d.withColumn("war_probability", tension_probability(
        F.col("article_count"), F.col("escalation_pct"), F.col("avg_sentiment"),
        F.col("iran_pct")))


def tension_batch(tension: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Batch index: n, mean sentiment, escalation ratio, spillover share, probability.

    ``by`` chooses the scope (T14): nothing = the whole input as one batch,
    e.g. ``["ingest_date"]`` = one index per landing batch.
    """
    flag = F.when(F.lower(F.col("iran_spillover").cast("string")) == "true", 1.0).otherwise(0.0)
    grouped = tension.groupBy(*by) if by else tension.groupBy()
    agg = grouped.agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.avg("sentiment_compound").alias("avg_sentiment"),
        F.try_divide(F.count_if(F.col("escalation") == "escalation").cast("double"), F.count(F.lit(1)))
        .alias("escalation_ratio"),
        F.avg(flag).alias("iran_pct"),
    )
    return agg.withColumn("war_probability", tension_probability(
        F.col("n_articles").cast("double"), F.col("escalation_ratio"), F.col("avg_sentiment"),
        F.col("iran_pct")))


def tension_report(tension: DataFrame, as_of: Column | None = None, headlines: DataFrame | None = None) -> DataFrame:
    """One-row report: latest probability, window estimate, trend, totals, newest headlines.

    ``headlines`` is one row with an array (``reports.headline_lists``); it comes in as a scalar subquery, one title a line.

    Daily rows carry row-level sums so the totals come from the same one-row
    aggregate as the latest day (no second scan, no cross join).
    """
    flag = F.when(F.lower(F.col("iran_spillover").cast("string")) == "true", 1).otherwise(0)
    d = tension.groupBy("date").agg(
        F.count("title").alias("article_count"),
        F.avg("sentiment_compound").alias("avg_sentiment"),
        F.avg(F.when(F.col("escalation") == "escalation", 1.0).otherwise(0.0))
        .alias("escalation_pct"),
        F.avg(flag.cast("double")).alias("iran_pct"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("escalation") == "escalation").alias("_n_esc"),
        F.sum(flag).alias("_n_iran"),
        F.sum("sentiment_compound").alias("_sum_sent"),
        F.count("sentiment_compound").alias("_n_sent"),
    )
    d = d.withColumn("war_probability", tension_probability(
        F.col("article_count"), F.col("escalation_pct"), F.col("avg_sentiment"),
        F.col("iran_pct")))
    d = series.recent_vs_previous(d, "war_probability", "trend_delta", n=3)
    latest = F.max_by(F.struct("date", "war_probability", "trend_delta"), F.col("date"))
    rep = d.agg(
        latest.alias("_l"),
        F.sum("_n").alias("n_total"),
        F.sum("_n_esc").alias("n_escalation"),
        F.sum("_n_iran").alias("iran_n"),
        (F.sum("_sum_sent") / F.sum("_n_sent")).alias("avg_sentiment"),
    )
    prob = F.col("_l.war_probability")
    months = band_months(prob, TENSION_MONTH_BANDS, TENSION_MONTHS_ELSE)
    day = F.col("_l.date") if as_of is None else as_of
    return rep.select(
        F.col("_l.date").alias("latest_date"),
        prob.alias("latest_probability"),
        months.alias("months_ahead"),
        month_label(day, months, snap_quarter=True).alias("estimated_window"),
        classify.risk_label(prob, classify.TENSION_RISK_BANDS).alias("risk"),
        F.col("_l.trend_delta").alias("trend_delta"),
        classify.delta_trend(F.col("_l.trend_delta")).alias("trend"),
        "n_total", "n_escalation",
        F.when(F.col("n_total") > 0, F.col("n_escalation") / F.col("n_total"))
        .otherwise(F.lit(0.0)).alias("escalation_ratio"),
        F.col("iran_n").cast("long").alias("iran_n"),
        "avg_sentiment",
        *([F.array_join(headlines.scalar(), "\n").alias("headlines")] if headlines is not None else []),
    )
