"""The daily batch end to end: landed files -> clean -> features -> summary ->
model/indices -> serving tables, as Spark jobs over one session.

Each stage refreshes a stored table under ``warehouse`` atomically (``sources.versioned``) and the
next stage reads it back, so lineage is cut at every durable table (a lost executor recomputes
at most one stage), a failed run leaves yesterday's tables readable, and nothing passes through the
driver but row counts, which the writes themselves observe.

``transform`` ends after the quality tables when too few rows were cleaned; ``predict_publish`` only starts on
tables that exist; ``run`` does both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.operators import clean, daily
from sparksignal.plans import classifier, evaluation, features, models, quality, signals
from sparksignal.sources import documents, files, sinks, versioned

SOURCES = ["prices", "posts", "news", "statements", "conflict_news", "tension_news"]


def landed(spark: SparkSession, landing: str, source: str) -> DataFrame:
    return files.read_landed_csv(spark, f"{landing.rstrip('/')}/{source}", source)


def clean_landed(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """Landed CSV of one source -> cleaned rows; the newest landing wins per key, ties by content."""
    order = ["landed_on", "file_name", *schemas.RAW[source].fieldNames()]
    out = clean.clean_source(landed(spark, landing, source), source, order, descending=True)
    return out.drop("landed_on", "file_name")


def bronze(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """Landed rows with a number of their own; stored before use, so the files are parsed once and numbers stay."""
    return landed(spark, landing, source).withColumn("row_id", F.monotonically_increasing_id())


def clean_bronze(rows: DataFrame, source: str) -> DataFrame:
    """Stored landed rows -> cleaned rows; the newest landing wins per key, ties by a digest of the content.

    Winners are found over digests and row numbers; whole rows are fetched for them alone.
    """
    order = ["landed_on", "file_name", clean.key_digest(*schemas.RAW[source].fieldNames()).alias("content")]
    out = clean.clean_source(rows, source, order, descending=True, row_id="row_id")
    return out.drop("landed_on", "file_name", "row_id")


def file_spans(landed_rows: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and first/last parseable day per landed file of every source."""
    out = None
    for s, rows in landed_rows.items():
        f = clean.normalise(rows.select("date", "file_name"))
        span = daily.date_span(f, by=["file_name"]).withColumn("source", F.lit(s))
        out = span if out is None else out.unionByName(span)
    return out


class _Tables:
    """Stored tables of a warehouse and the rows written to them in this run."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.root, self.written = spark, warehouse.rstrip("/"), {}

    def save(self, name: str, df: DataFrame) -> DataFrame:
        self.written[name] = sinks.write_parquet(df, f"{self.root}/{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return versioned.read(self.spark, f"{self.root}/{name}")


PROCESSED = ("features", "daily_summary", "clean/statements", "clean/conflict_news", "clean/tension_news")


def transform(spark: SparkSession, landing: str, warehouse: str) -> tuple[dict[str, int], bool]:
    """Clean, check and aggregate the landed files; rows written per table, and whether there were enough rows to go on."""
    t = _Tables(spark, warehouse)
    raw = {s: t.save(f"bronze/{s}", bronze(spark, landing, s)) for s in SOURCES}
    cleaned = {s: t.save(f"clean/{s}", clean_bronze(raw[s], s)) for s in SOURCES}
    counts = {s: t.written[f"clean/{s}"] for s in SOURCES}
    t.save("quality/volume_gate", quality.gate_of_counts(spark, counts))
    t.save("quality/landing", quality.landing_report(spark, landing, SOURCES))
    t.save("quality/file_spans", file_spans(raw))
    if sum(counts.values()) < quality.MIN_TOTAL_ROWS:
        return t.written, False
    feats = t.save("features", features.feature_table(
        cleaned["prices"], cleaned["posts"], cleaned["news"], cleaned["statements"],
        cleaned["conflict_news"]))
    t.save("daily_summary", features.daily_summary(feats))
    # the ingest-time index: one per landing day, before cleaning
    t.save("tension_batches", models.tension_batch(clean.normalise(raw["tension_news"]), by=["landed_on"]))
    return t.written, True


def predict_publish(spark: SparkSession, warehouse: str, evaluated_at: Column | None = None) -> dict[str, int]:
    """Indices, signals, model, evaluation and serving tables from the processed tables, which must exist."""
    t = _Tables(spark, warehouse)
    missing = quality.missing_tables(spark, warehouse, PROCESSED)
    if missing:
        raise FileNotFoundError(f"no processed data: {', '.join(missing)}")
    feats, summary = t.read("features"), t.read("daily_summary")
    pressure = t.save("exit_index", models.pressure_index(quality.require_rows(feats, models.PRESSURE_MIN_ROWS)))
    t.save("signals", signals.build_signals(summary))
    t.save("tension_daily", models.tension_days(t.read("clean/tension_news")))

    train, test = classifier.split_chronological(feats)
    docs = f"{t.root}/documents"
    if train.limit(classifier.MIN_ROWS).count() < classifier.MIN_ROWS:  # too few rows: nothing is trained
        t.save("model_test_predictions", spark.createDataFrame([], classifier.PREDICTED))
    else:
        classifier.train(train).write().overwrite().save(f"{t.root}/model")
        model = PipelineModel.load(f"{t.root}/model")
        tested = t.save("model_test_predictions", classifier.predict(model, test))
        t.save("model_metrics", evaluation.classifier_metrics(tested, label="actual", prediction="prediction_numeric"))
        latest = classifier.latest_prediction(model, feats)
        documents.append(
            latest.select(F.col("date").cast("string").alias("date"), "prediction",
                          "prediction_numeric", "confidence", "features"), docs, "prediction")
    documents.append(
        pressure.where(F.col("date") == feats.agg(F.max("date")).scalar())
        .withColumn("date", F.col("date").cast("string")), docs, "war_exit")
    preds = documents.read(spark, docs, schemas.PREDICTION).withColumn("date", F.to_date("date"))
    t.save("evaluation", evaluation.evaluate(
        preds, feats, F.current_timestamp() if evaluated_at is None else evaluated_at))
    documents.compact(spark, docs)

    for name, df in {"daily_summary_30d": features.last_n(summary, 30),
                     "predictions": preds, "statements": t.read("clean/statements"),
                     "conflict_news": t.read("clean/conflict_news"), "exit_index": pressure,
                     "tension": t.read("clean/tension_news")}.items():
        sinks.load_serving_table(df, f"{t.root}/serving/{name}", f"serving_{name}")
    return t.written


def run(spark: SparkSession, landing: str, warehouse: str,
        evaluated_at: Column | None = None) -> dict[str, int]:
    """Run the daily batch; returns rows written per output table.

    ``evaluated_at`` stamps the evaluation log (default: the time of the run).  With fewer than
    ``quality.MIN_TOTAL_ROWS`` cleaned rows the run ends after the quality tables.
    """
    written, enough = transform(spark, landing, warehouse)
    return {**written, **predict_publish(spark, warehouse, evaluated_at)} if enough else written
