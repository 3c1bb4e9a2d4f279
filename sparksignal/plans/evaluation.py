"""Prediction evaluation.

Predictions and actuals are both day-grain; the joins are on DATE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksignal.functions import classify
from sparksignal.operators import series


def evaluate(predictions: DataFrame, actuals: DataFrame,
             evaluated_at: Column | None = None) -> DataFrame:
    """One row per prediction: predicted, actual, correct, confidence, status (J2, M12),
    and ``evaluated_at`` where the caller gives the stamp.

    A prediction whose date has no actual is "pending" (T4: the newest feature
    day carries label 0, so it is graded, as in the reference).
    """
    a = actuals.select(F.col("date").alias("_d"), F.col("price_direction").alias("_actual"))
    j = predictions.join(a, predictions["date"] == a["_d"], "left")
    pending = F.col("_actual").isNull()
    correct = F.when(~pending, (F.col("prediction_numeric") == F.col("_actual")).cast("int"))
    out = j.select(
        F.col("date").alias("pred_date"),
        F.when(F.col("prediction_numeric") == 1, F.lit("Up")).otherwise(F.lit("Down"))
        .alias("predicted"),
        classify.direction_label("_actual", missing="pending").alias("actual"),
        correct.alias("correct"),
        F.round("confidence", 4).alias("confidence"),
        F.when(pending, F.lit("pending")).when(correct == 1, F.lit("correct"))
        .otherwise(F.lit("incorrect")).alias("status"),
    )
    return out if evaluated_at is None else out.withColumn("evaluated_at", evaluated_at)


def running_accuracy(evaluation: DataFrame, last: int = 5) -> DataFrame:
    """Per evaluated prediction: cumulative accuracy and last-``last`` accuracy."""
    ev = evaluation.where(F.col("correct").isNotNull()).select("pred_date", "correct")
    ev = series.running_mean(ev, "correct", "cumulative_accuracy", order="pred_date", digits=None)
    ev = series.rolling_mean(ev, "correct", last, "recent_accuracy", order="pred_date",
                             digits=None)
    return ev


def accuracy_summary(evaluation: DataFrame, last: int = 5) -> DataFrame:
    """Totals: evaluated, correct, accuracy, last-``last`` accuracy, pending."""
    r = running_accuracy(evaluation, last)
    evaluated = r.agg(
        F.count(F.lit(1)).alias("total_evaluated"),
        F.sum("correct").cast("long").alias("correct_count"),
        F.avg("correct").alias("accuracy"),
        F.max_by("recent_accuracy", "pred_date").alias("recent_accuracy"),
    )
    pending = evaluation.where(F.col("correct").isNull()).agg(
        F.count(F.lit(1)).alias("pending"))
    return evaluated.select("*", pending.select("pending").scalar().alias("pending"))


def prediction_history(predictions: DataFrame, summary: DataFrame) -> DataFrame:
    """Prediction vs actual; a missing actual compares as not equal -> "✗" (J3, M13, T17)."""
    a = summary.select(F.col("date").alias("_d"), F.col("price_direction").alias("_an"))
    j = predictions.join(a, predictions["date"] == a["_d"], "left")
    eq = F.coalesce(F.col("prediction_numeric") == F.col("_an"), F.lit(False))
    return j.select(
        "date", "prediction", classify.direction_label("_an").alias("actual"), "confidence",
        F.when(eq, F.lit("✓")).otherwise(F.lit("✗")).alias("correct"),
    )


def classifier_metrics(scored: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall of a binary classifier, 0 on zero division, round 4."""
    y, p = F.col(label), F.col(prediction)
    c = scored.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")

    def ratio(num, den):
        return F.round(F.when(den > 0, num / den).otherwise(F.lit(0.0)), 4)

    return c.select(
        "tp", "fp", "fn", "tn",
        ratio(F.col("tp") + F.col("tn"), n).alias("accuracy"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )


def metric_cards(summary: DataFrame, predictions: DataFrame, pressure: DataFrame,
                 metrics: DataFrame | None = None) -> DataFrame:
    """One row: latest prediction, model accuracy, price, favor ratio, exit pressure,
    with N/A fallback (M14).

    Anchored on the summary's one-row aggregate; the other latest values are
    scalar subqueries (each a one-row aggregate), so no cross join.
    """
    pred = predictions.agg(F.max_by("prediction", "date")).scalar()
    exitp = pressure.agg(F.max_by("exit_probability", "date")).scalar()
    acc = (metrics.agg(F.first("accuracy")).scalar() if metrics is not None
           else F.lit(None).cast("double"))
    base = summary.agg(F.max_by("avg_price", "date").alias("latest_price"),
                       F.max_by("favor_ratio", "date").alias("latest_favor_ratio"))
    direction = F.coalesce(pred, F.lit("N/A"))
    return base.select(
        F.when(pred.isNull(), F.lit("N/A"))
        .otherwise(F.concat(F.when(direction == "Up", F.lit("↑")).otherwise(F.lit("↓")),
                            F.lit(" "), direction)).alias("prediction_card"),
        acc.alias("model_accuracy"),
        "latest_price", "latest_favor_ratio",
        exitp.alias("exit_pressure"),
    )
