"""Composite BUY/SELL/HOLD signals, backtest and reasons (W7, W12, M10, M11, O6,
A12, A13, M15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksignal.functions import classify
from sparksignal.functions.numeric import weighted_sum
from sparksignal.operators import series
from sparksignal.plans import reports

# --- fixed values (weights, thresholds and labels of the reference) ----------
# (signal column, source column, null fill, inverted, weight, label) in declared order
SIGNALS = [
    ("sig_momentum", "avg_price_delta", 0.0, False, 0.25, "Price Momentum"),
    ("sig_news", "avg_news_sentiment", 0.0, False, 0.20, "News Sentiment"),
    ("sig_reddit", "avg_reddit_sentiment", 0.0, False, 0.15, "Reddit Sentiment"),
    ("sig_trump", "avg_trump_sentiment", 0.0, False, 0.15, "Trump Sentiment"),
    ("sig_war", "avg_war_sentiment", 0.0, True, 0.15, "War Escalation"),
    ("sig_favor", "favor_ratio", 0.5, True, 0.10, "War Stance"),
]
BUY_THRESHOLD = 0.12
SELL_THRESHOLD = -0.12
MIN_TRADES = 3
RECENT_LINE = "Recent accuracy **%s** (last %s trades) — %s"
RECENT_GOOD = "model is performing well, signals are reliable"
RECENT_MIXED = "mixed results, use signals as one input among many"
RECENT_POOR = "⚠️ model is underperforming, signals may be contrarian indicators"
OVERALL_LINE = "Overall accuracy: **%s** across %s trades"
# -----------------------------------------------------------------------------

SIGNAL_COLUMNS = [s[0] for s in SIGNALS]


def minmax_signals(summary: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """The six normalised signals, per series if any; war and favor inverted."""
    tmp = summary
    cols = []
    for name, src, fill, _, _, _ in SIGNALS:
        tmp = tmp.withColumn(f"_in_{name}", F.coalesce(F.col(src), F.lit(fill)))
        cols.append((f"_in_{name}", name))
    out = series.minmax_scale(tmp, cols, negate=[s[0] for s in SIGNALS if s[3]],
                              partition_by=partition_by)
    return out.drop(*[c for c, _ in cols])


def trade_signals(summary: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Composite score, signal and strength per day, and series if any."""
    s = minmax_signals(summary, partition_by)
    comp = weighted_sum([(w, name) for name, _, _, _, w, _ in SIGNALS])
    s = s.withColumn("composite_score", comp)
    sig = (F.when(F.col("composite_score") > BUY_THRESHOLD, F.lit("BUY"))
           .when(F.col("composite_score") < SELL_THRESHOLD, F.lit("SELL"))
           .otherwise(F.lit("HOLD")))
    return (s.withColumn("signal", sig)
            .withColumn("signal_strength", F.least(F.abs("composite_score"), F.lit(1.0))))


def reasons(signals: DataFrame, top: int = 2) -> DataFrame:
    """``reason``: top contributors by |weight x signal|, ties in declared order."""
    items = [
        F.struct((-F.abs(F.lit(w) * F.col(name)) + F.lit(0.0)).alias("k"),
                 F.lit(i).alias("o"), F.lit(label).alias("l"),
                 (F.col(name) * F.lit(w)).alias("v"))
        for i, (name, _, _, _, w, label) in enumerate(SIGNALS)
    ]
    ranked = F.slice(F.array_sort(F.array(*items)), 1, top)
    parts = F.transform(ranked, lambda x: F.concat(x["l"], F.lit(" "), classify.arrow(x["v"])))
    return signals.withColumn("reason", F.array_join(parts, " + "))


def backtest(signals: DataFrame, horizon: int = 1,
             partition_by: Sequence[str] | None = None) -> DataFrame:
    """Next row's label, numeric signal and correctness of BUY/SELL days."""
    out = series.shift(signals, "price_direction", "next_day_direction", offset=-horizon,
                       partition_by=partition_by)
    num = classify.signal_numeric("signal")
    traded = F.col("signal").isin("BUY", "SELL") & F.col("next_day_direction").isNotNull()
    return (out.withColumn("signal_numeric", num)
            .withColumn("correct", F.when(traded, (F.col("signal_numeric")
                                                   == F.col("next_day_direction"))
                                          .cast("double"))))


def build_signals(summary: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Signal table: summary + signals + backtest + reason."""
    return reasons(backtest(trade_signals(summary, partition_by), partition_by=partition_by))


def signal_summary(signals: DataFrame) -> DataFrame:
    """Signal counts, trades, accuracy (0.0 without trades), latest signal."""
    latest = F.max_by(F.struct("signal", "composite_score", "reason"), F.col("date"))
    out = signals.agg(
        F.count_if(F.col("signal") == "BUY").alias("n_buy"),
        F.count_if(F.col("signal") == "SELL").alias("n_sell"),
        F.count_if(F.col("signal") == "HOLD").alias("n_hold"),
        F.count("correct").alias("n_trades"),
        F.coalesce(F.sum("correct"), F.lit(0.0)).cast("long").alias("n_correct"),
        F.coalesce(F.avg("correct"), F.lit(0.0)).alias("accuracy"),
        latest.alias("_l"),
    )
    return out.select("n_buy", "n_sell", "n_hold", "n_trades", "n_correct", "accuracy",
                      F.col("_l.signal").alias("latest_signal"),
                      F.col("_l.composite_score").alias("latest_score"),
                      F.col("_l.reason").alias("latest_reason"))


def backtest_detail(signals: DataFrame) -> DataFrame:
    """Decoded backtest rows, newest first."""
    nd = F.col("next_day_direction")
    ok = F.col("correct")
    return signals.select(
        "date", "signal", "avg_price", "composite_score", "signal_strength", "reason",
        F.when(nd == 1, F.lit("Up ↑")).when(nd == 0, F.lit("Down ↓")).alias("next_day"),
        F.when(ok == 1.0, F.lit("✓ Correct")).when(ok == 0.0, F.lit("✗ Wrong")).alias("result"),
    ).orderBy(F.desc("date"))


def self_assessment(signals: DataFrame, last: int = 5) -> DataFrame:
    """Recent (last ``last`` trades) and overall accuracy with the reference's bands.

    One row; empty when fewer than 3 trades exist.
    """
    traded = signals.where(F.col("correct").isNotNull())
    t = series.rolling_mean(traded, "correct", last, "_recent", digits=None)
    agg = t.agg(F.max_by("_recent", "date").alias("recent_accuracy"),
                F.avg("correct").alias("overall_accuracy"),
                F.count(F.lit(1)).alias("n_trades"))
    recent, overall = F.col("recent_accuracy"), F.col("overall_accuracy")
    verdict = (F.when(recent >= 0.7, RECENT_GOOD).when(recent >= 0.4, RECENT_MIXED)
               .otherwise(RECENT_POOR))
    sentences = F.concat_ws(
        "\n", reports.line(RECENT_LINE, reports.pct(recent), F.lit(str(last)), verdict),
        reports.line(OVERALL_LINE, reports.pct(overall), F.col("n_trades").cast("string")))
    return agg.where(F.col("n_trades") >= MIN_TRADES).withColumn("assessment", sentences)
