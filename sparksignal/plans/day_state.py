"""Mergeable day state of the daily sides (S9 with A1-A5): sums instead of means.

A stored table holds, per day and side, the sums that the daily means come from.  An incremental pull reads
only its window (90 days when nothing is stored yet, else the last 2) and its sums take the place of
the stored ones of those days, which the pull covers whole; all other days stay as they are.  What is read
and aggregated so depends on the window, not on the history; the merged table equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.plans.features import side_sums, sides_from_sums
from sparksignal.sources import files, versioned

STATE = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("side", T.StringType()), T.StructField("vw", T.DoubleType()),
    T.StructField("w", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("favor", T.LongType()),
    T.StructField("against", T.LongType())])


def merge(stored: DataFrame, pulled: DataFrame, start: Column) -> DataFrame:
    """Stored days before ``start`` and the pulled days, which reach back to ``start``."""
    return stored.where(F.col("date") < start).unionByName(pulled)


def refresh(spark: SparkSession, root: str, articles: DataFrame, as_of: Column, backfill_days: int = 90,
            overlap_days: int = 2) -> int:
    """Pull the window before ``as_of`` from deduplicated ``articles`` and publish the merged state; returns its rows."""
    stored = versioned.read(spark, root, STATE)
    pulled = side_sums(files.incremental_window(articles, stored, as_of, backfill_days, overlap_days))
    start = F.date_sub(as_of, files.window_days(stored, backfill_days, overlap_days))
    return versioned.publish(merge(stored, pulled.select(STATE.names), start), root)


def sides(spark: SparkSession, root: str) -> DataFrame:
    """The daily sides (news, statements, conflict) from the stored state."""
    return sides_from_sums(versioned.read(spark, root, STATE))
