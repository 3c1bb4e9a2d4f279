"""Incremental ingest of landed files with Structured Streaming.

The reference re-lands overlapping days (a 2-day overlap after the first
90-day backfill) and deduplicates in its daily clean job.  The streaming form:

* ``readStream`` over the landing folder with the fixed schema (new files only;
  the source's file log remembers what was read);
* stateless clean steps per micro-batch (date parse, trim, incomplete rows
  dropped);
* a parquet file sink ("bronze"), exactly-once through its own metadata log,
  with the checkpoint in the shared folder named by ``spark.checkpoint.dir``;
* the clean table is the keyed dedup (D1) over bronze, read as a batch frame,
  so re-landed duplicates collapse deterministically (newest file wins).

``trigger(availableNow=True)`` processes everything landed so far and stops,
so the same code serves a scheduled daily run and a continuous stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal import schemas
from sparksignal.operators import clean
from sparksignal.session import checkpoint_dir
from sparksignal.sources import files


def landed_stream(spark: SparkSession, landing: str, source: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of one source's landing folder (CSV, fixed schema)."""
    r = (spark.readStream.schema(schemas.RAW[source]).option("header", True)
         .option("multiLine", True).option("escape", '"'))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # landing day from the day folder (``land_csv`` layout), else the file name
    df = r.csv(landing).withColumn("landed_on", files.landed_on())
    trim_cols = [] if source == "prices" else ["title"]
    out = clean.normalise(df, "date", trim_cols)
    return clean.drop_incomplete(out, schemas.REQUIRED[source])


def ingest(spark: SparkSession, landing: str, bronze: str, source: str,
           query_name: str | None = None, checkpoint: str | None = None) -> None:
    """Append every newly landed file of ``source`` to the bronze parquet table and stop.

    Re-running resumes from the checkpoint: files already ingested are skipped.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name or source}"
    w = (landed_stream(spark, landing, source).writeStream.format("parquet")
         .option("path", bronze).option("checkpointLocation", ckpt)
         .trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    q.awaitTermination()


def clean_from_bronze(spark: SparkSession, bronze: str, source: str,
                      order: Sequence[str] = ("landed_on",)) -> DataFrame:
    """Clean table: one row per dedup key, the newest landing day winning.

    Add content columns to ``order`` to make ties inside one landing day deterministic.
    """
    b = spark.read.parquet(bronze)
    return clean.keep_first(b, schemas.DEDUP_KEYS[source], list(order), descending=True)
