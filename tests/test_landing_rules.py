"""Re-landed files and prediction documents: the newest landing wins, earlier documents stay."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.plans import daily_run
from sparksignal.plans.materialize import materialize
from sparksignal.session import scratch_path
from sparksignal.sources import documents, sinks


def test_newest_landing_wins(spark):
    for _ in range(20):
        root = scratch_path(spark, "landing")
        for day, close in (("2024-01-30", 1.0), ("2024-01-31", 2.0)):
            one = spark.createDataFrame([("2024-01-02", 1.0, 1.0, 1.0, close, 5, day)],
                                        "date string, open double, high double, low double, close double, volume long, ingest_date string")
            sinks.land_csv(one, f"{root}/prices")
        stored = materialize(daily_run.bronze(spark, root, "prices"))
        for out in (daily_run.clean_landed(spark, root, "prices"), daily_run.clean_bronze(stored, "prices")):
            assert [r.close for r in out.collect()] == [2.0]
            assert not {"ingest_date", "landed_on", "row_id"} & set(out.columns)


def test_documents_of_a_month_survive_the_next_run(spark):
    root = scratch_path(spark, "documents")
    schema = "date string, prediction string, prediction_numeric int, confidence double"
    for day, p in (("2024-01-02", "Up"), ("2024-01-03", "Up"), ("2024-01-04", "Up"), ("2024-01-03", "Down")):
        documents.append(spark.createDataFrame([(day, p, int(p == "Up"), 0.6)], schema), root, "prediction")
    got = documents.read(spark, root, schemas.PREDICTION).select(F.col("date").cast("string"), "prediction").collect()
    assert sorted(map(tuple, got)) == [("2024-01-02", "Up"), ("2024-01-03", "Down"), ("2024-01-04", "Up")]
