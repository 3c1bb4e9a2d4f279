"""Lineage cuts for small derived tables that several branches of a plan read.

A day-grain table (one row per day) that feeds both a scalar subquery and the
main plan would otherwise be recomputed from the raw tables by each branch.
``materialize`` writes it once as parquet to the shared folder named by
``spark.checkpoint.dir`` and returns a frame that reads it back: it survives lost executors, and
later plans prune its columns and know its size.  ``session.clear_scratch`` removes such tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparksignal.session import scratch_path


def materialize(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
