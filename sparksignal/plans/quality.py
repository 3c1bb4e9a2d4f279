"""Data-quality gates (Q1-Q4) as DataFrames, never exceptions or driver loops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparksignal.sources import versioned

MIN_TOTAL_ROWS = 10  # fixed value: proceed threshold of the volume gate


def volume_gate(counts: Mapping[str, DataFrame], threshold: int = MIN_TOTAL_ROWS) -> DataFrame:
    """Rows per cleaned source, the total and ``proceed``/``low_data`` (Q2).

    Each source contributes one global count row; the union is tiny.
    """
    out = None
    for name, df in counts.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"),
                                                                "n_rows")
        out = row if out is None else out.unionByName(row)
    # one row per source (a handful): a single-partition window over the union
    # adds the total without recomputing any per-source count
    total = F.sum("n_rows").over(Window.partitionBy())
    return out.select("source", "n_rows", total.alias("total_rows"),
                      F.when(total >= threshold, F.lit("proceed")).otherwise(F.lit("low_data"))
                      .alias("status"))


def gate_of_counts(spark: SparkSession, counts: Mapping[str, int], threshold: int = MIN_TOTAL_ROWS) -> DataFrame:
    """The volume gate from row counts that writes have observed already (Q2): nothing is read."""
    total = sum(counts.values())
    status = "proceed" if total >= threshold else "low_data"
    return spark.createDataFrame([(s, n, total, status) for s, n in counts.items()],
                                 "source string, n_rows long, total_rows long, status string")


def missing_tables(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """Stored tables under ``root`` that have no published version yet (Q3)."""
    return [n for n in names if versioned.current(spark, f"{root.rstrip('/')}/{n}") is None]


def landing_report(spark: SparkSession, root: str, sources: Sequence[str]) -> DataFrame:
    """Per expected source: OK with file count and bytes, or MISSING (Q1).

    Reads only file metadata (``binaryFile`` listing, content column pruned).
    """
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(root).select("path", "length"))
        prefix = "\\Q" + root.rstrip("/") + "\\E"  # literal root inside the regex
        per = (files.select(F.regexp_extract("path", prefix + "/([^/]+)/", 1)
                            .alias("source"), "length")
               .groupBy("source").agg(F.count(F.lit(1)).alias("n_files"),
                                      F.sum("length").alias("bytes")))
    except AnalysisException as e:  # an absent landing root means every source is missing
        if "PATH_NOT_FOUND" not in str(e):
            raise
        per = spark.createDataFrame([], "source string, n_files bigint, bytes bigint")
    j = expected.join(per, "source", "left")
    return j.select("source", F.coalesce("n_files", F.lit(0)).alias("n_files"),
                    F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.when(F.col("n_files") > 0, F.lit("OK")).otherwise(F.lit("MISSING"))
                    .alias("status"))


def require_rows(df: DataFrame, minimum: int) -> DataFrame:
    """``df`` when it has at least ``minimum`` rows, else an empty frame of the same schema (Q3, Q4).

    The count is a scalar subquery; no action runs on the driver.
    """
    n = df.limit(minimum).agg(F.count(F.lit(1))).scalar()  # reads at most ``minimum`` rows
    return df.where(n >= F.lit(minimum))
