"""Writers (K1-K6).  Row counts are observed by the writes themselves, not by
a second run of the producing plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparksignal.operators.clean import keep_first
from sparksignal.sources import versioned


def write_parquet(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Refresh a parquet table atomically and return the number of rows written (K1).

    Read it back with ``versioned.read``; the count is observed by the write itself.
    """
    return versioned.publish(df, root, partition_by)


def land_csv(df: DataFrame, root: str, day_col: str = "ingest_date", empty_day: str | None = None) -> int:
    """Day-stamped CSV landing, one folder per day (K2); returns the rows landed.

    Quotes are doubled (``escape='"'``) so HTML and newlines round-trip with
    ``read_landed_csv``; a day's folder is replaced on re-landing.  A pull without rows lands a file of the
    header alone for ``empty_day``, so that it can be told from a pull that never ran.
    """
    seen, spark = Observation(), df.sparkSession
    (df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).option("escape", '"').option("quoteAll", True)
     .partitionBy(day_col).csv(root))
    n = seen.get.get("n", 0)
    if n == 0 and empty_day is not None:
        none = spark.createDataFrame([], df.drop(day_col).schema).coalesce(1)
        none.write.mode("overwrite").option("header", True).csv(f"{root.rstrip('/')}/{day_col}={empty_day}")
    return n


def write_json_documents(df: DataFrame, root: str, kind: str) -> None:
    """Add documents as JSON lines, partitioned by kind and month, to a plain folder (K4).

    For a log with corrections see ``documents.append``.
    """
    new = (df.withColumn("kind", F.lit(kind))
           .withColumn("month", F.date_format(F.col("date").cast("date"), "yyyy-MM")))
    new.repartition("kind", "month").write.mode("append").partitionBy("kind", "month").json(root)


def load_serving_table(df: DataFrame, root: str, view: str) -> DataFrame:
    """Atomic refresh of a serving table; an empty input leaves the old table in place (K5)."""
    versioned.publish(df, root, keep_if_empty=True)
    served = versioned.read(df.sparkSession, root)
    served.createOrReplaceTempView(view)
    return served


def keyed_upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str],
                 version: str = "version") -> DataFrame:
    """Newest version per key from old + new rows.

    A keyed ``max_by`` aggregate: partial aggregation collapses repeated
    keys map-side, and a key with many versions never lands in one sort.
    """
    both = current.unionByName(updates, allowMissingColumns=True)
    return keep_first(both, list(keys), [version], descending=True)


def write_csv(df: DataFrame, path: str) -> None:
    """Plain CSV with header (K6)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
