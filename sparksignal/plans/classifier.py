"""Next-day direction classifier on ``pyspark.ml`` (M8, M9).

Chronological split: the newest ``ceil(0.2 * n)`` feature days are the test
set (T16).  The split point is one date found by ranking the day-grain
feature table (one row per day, bounded by the calendar).  Training runs the
distributed random forest of ``pyspark.ml``; prediction is a ``transform``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values (inputs and hyper-parameters of the reference model) -------
FEATURE_COLS = [
    "price_delta", "rolling_avg_7d", "sentiment_rolling_3d", "news_sentiment",
    "trump_sentiment_avg", "war_sentiment_avg", "favor_ratio",
]
TARGET = "price_direction"
TEST_FRACTION = 0.2
NUM_TREES = 100
MAX_DEPTH = 5
SEED = 42
MIN_ROWS = 20
PREDICTED = "date date, actual int, prediction_numeric int, prediction string, confidence double"
# -----------------------------------------------------------------------------


def split_chronological(features: DataFrame, test_fraction: float = TEST_FRACTION):
    """(train, test): newest ``ceil(fraction * n)`` days form the test set."""
    data = features.dropna(subset=FEATURE_COLS + [TARGET])
    ranked = data.withColumn("_rank_desc", F.row_number().over(Window.orderBy(F.desc("date"))))
    n = data.agg(F.count(F.lit(1))).scalar()
    n_test = F.ceil(n * F.lit(test_fraction))
    test = ranked.where(F.col("_rank_desc") <= n_test).drop("_rank_desc")
    train = ranked.where(F.col("_rank_desc") > n_test).drop("_rank_desc")
    return train, test


def train(train_df: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
          seed: int = SEED) -> PipelineModel:
    """Fit assembler + random forest (M8).

    A copy is returned, without the training summary: the summary holds the session, and with it the model's
    functions could not be sent to tasks once the session has observed a write.
    """
    assembler = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features_vec")
    rf = RandomForestClassifier(featuresCol="features_vec", labelCol="label",
                                numTrees=num_trees, maxDepth=max_depth, seed=seed)
    data = train_df.withColumn("label", F.col(TARGET).cast("double"))
    return Pipeline(stages=[assembler, rf]).fit(data).copy()


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Class, Up/Down and max class probability per row (M9)."""
    scored = model.transform(df.withColumn("label", F.col(TARGET).cast("double")))
    prob = F.array_max(vector_to_array("probability"))
    pred = F.col("prediction").cast("int")
    return scored.select(
        "date", F.col(TARGET).alias("actual"), pred.alias("prediction_numeric"),
        F.when(pred == 1, F.lit("Up")).otherwise(F.lit("Down")).alias("prediction"),
        F.round(prob, 4).alias("confidence"),
    )


def latest_prediction(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Prediction for the newest complete feature row with its feature values (M9): one row."""
    data = features.dropna(subset=FEATURE_COLS)
    newest = data.agg(F.max("date")).scalar()
    latest = data.where(F.col("date") == newest)
    values = F.struct(*[F.round(F.col(c).cast("double"), 4).alias(c) for c in FEATURE_COLS])
    return predict(model, latest).join(latest.select("date", values.alias("features")), "date")
