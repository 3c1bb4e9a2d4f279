"""Atomic refresh and the merge-on-read log of documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.session import scratch_path
from sparksignal.sources import documents, sinks, versioned

DOC = "date string, prediction string, prediction_numeric int, confidence double"


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark):
    root = scratch_path(spark, "table")
    assert versioned.publish(spark.range(10), root) == 10
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half way"):
        versioned.publish(broken, root)
    assert versioned.read(spark, root).count() == 10
    assert len([n for n in versioned.names(spark, root) if n.startswith("version-")]) == 1
    assert not [n for n in versioned.names(spark, root) if n.endswith(".tmp")]


def test_the_version_before_stays_until_the_next_refresh(spark):
    root = scratch_path(spark, "table")
    versioned.publish(spark.range(1), root)
    first = versioned.read(spark, root)
    versioned.publish(spark.range(2), root)
    assert first.count() == 1 and versioned.read(spark, root).count() == 2
    versioned.publish(spark.range(3), root)
    assert versioned.read(spark, root).count() == 3
    assert len([n for n in versioned.names(spark, root) if n.startswith("version-")]) == 2


def test_a_table_may_be_refreshed_from_itself(spark):
    root = scratch_path(spark, "table")
    versioned.publish(spark.range(5), root)
    assert versioned.publish(versioned.read(spark, root).unionByName(spark.range(5, 7)), root) == 7
    assert versioned.read(spark, root).count() == 7


def test_empty_and_absent_tables(spark):
    root = scratch_path(spark, "table")
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, root)
    assert versioned.read(spark, root, schemas.PREDICTION).count() == 0
    assert versioned.publish(spark.range(0), root, keep_if_empty=True) == 0  # the first version may be empty
    assert versioned.read(spark, root).columns == ["id"]
    versioned.publish(spark.range(4), root, keep_if_empty=True)
    assert versioned.publish(spark.range(0), root, keep_if_empty=True) == 0
    assert versioned.read(spark, root).count() == 4
    assert versioned.publish(spark.range(0), root) == 0 and versioned.read(spark, root).count() == 0


def test_serving_tables_run_their_plan_once(spark):
    root, seen = scratch_path(spark, "serving"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    sinks.load_serving_table(spark.range(6).mapInArrow(count, "id long"), root, "serving_once")
    assert seen.value == 6 and spark.table("serving_once").count() == 6


def _add(spark, root, *docs, kind="prediction"):
    return documents.append(spark.createDataFrame([(d, p, int(p == "Up"), 0.6) for d, p in docs], DOC), root, kind)


def _seen(spark, root, **how):
    return sorted((r["date"], r["prediction"]) for r in documents.read(spark, root, schemas.PREDICTION, **how).collect())


def test_three_runs_in_a_month_one_a_correction(spark):
    root = scratch_path(spark, "documents")
    assert _seen(spark, root) == []
    assert [_add(spark, root, ("2024-01-02", "Up"), ("2024-01-03", "Up")), _add(spark, root, ("2024-01-04", "Up")),
            _add(spark, root, ("2024-01-03", "Down"))] == [1, 2, 3]
    _add(spark, root, ("2024-01-03", "x"), kind="war_exit")
    want = [("2024-01-02", "Up"), ("2024-01-03", "Down"), ("2024-01-04", "Up")]
    assert _seen(spark, root) == want
    assert len(_seen(spark, root, exclude_kind=None)) == 4
    assert documents.compact(spark, root) == 4
    assert _seen(spark, root) == want and len(versioned.names(spark, f"{root}/runs")) == 4  # kept for late readers
    _add(spark, root, ("2024-02-01", "Up"), ("2024-01-02", "Down"))
    want = [("2024-01-02", "Down"), *want[1:], ("2024-02-01", "Up")]
    assert _seen(spark, root) == want
    assert documents.compact(spark, root) == 5 and _seen(spark, root) == want
    assert len(versioned.names(spark, f"{root}/runs")) == 1
    assert _add(spark, root, ("2024-02-02", "Up")) == 6


def test_a_run_that_failed_is_not_read(spark):
    root = scratch_path(spark, "documents")
    _add(spark, root, ("2024-01-02", "Up"))
    bad = spark.createDataFrame([("2024-01-05", "Up", 1, 0.6)], DOC).withColumn(
        "confidence", F.when(F.col("date") > "2024", F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        documents.append(bad, root, "prediction")
    assert _seen(spark, root) == [("2024-01-02", "Up")]
    assert _add(spark, root, ("2024-01-03", "Up")) == 3
    assert len(_seen(spark, root)) == 2
