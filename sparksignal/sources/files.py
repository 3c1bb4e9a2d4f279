"""Readers for landed files.

Landed data are scanned where they land; no HTTP client lives here.  Every
reader takes an explicit schema (no inference pass over the data) and returns
a typed empty frame when the location does not exist (optional sources, S3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal import schemas

OHLCV = ["date", "open", "high", "low", "close", "volume"]

FEED_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("pubDate", T.StringType()),
    T.StructField("link", T.StringType()),
])

LISTING = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("after", T.StringType()),
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()),
            T.StructField("data", T.StructType([
                T.StructField("subreddit", T.StringType()),
                T.StructField("title", T.StringType()),
                T.StructField("selftext", T.StringType()),
                T.StructField("score", T.IntegerType()),
                T.StructField("created_utc", T.DoubleType()),
            ])),
        ]))),
    ])),
])


def _optional(read, schema: T.StructType, spark: SparkSession) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def landed_on() -> Column:
    """Landing day of the scanned file: its ``ingest_date`` folder, else the file name."""
    day = F.regexp_extract(F.col("_metadata.file_path"), r"ingest_date=([^/]+)/", 1)
    return F.when(day != "", day).otherwise(F.col("_metadata.file_name"))


def read_landed_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Day-stamped CSV files of one source with the fixed schema.

    ``multiLine`` + ``escape='"'`` read quoted HTML and newlines in summaries
    correctly.  ``landed_on`` (the day folder of ``land_csv``, else the file name's
    stamp) and ``file_name`` are kept for newest-landing-wins dedup.
    """
    schema = schemas.RAW[source]

    def read():
        return (spark.read.schema(schema).option("header", True).option("multiLine", True)
                .option("escape", '"').option("mode", "PERMISSIVE")
                .csv(path).select(*schema.fieldNames(), landed_on().alias("landed_on"),
                                  F.col("_metadata.file_name").alias("file_name")))

    empty = T.StructType([*schema.fields, T.StructField("landed_on", T.StringType()),
                          T.StructField("file_name", T.StringType())])
    return _optional(read, empty, spark)


def read_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Catalog table by name, or an empty typed frame when it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType,
                        exclude_kind: str | None = "war_exit",
                        one_per_file: bool = False) -> DataFrame:
    """JSON result documents with nested objects dropped.

    Written by ``sinks.write_json_documents``: JSON lines partitioned by ``kind``;
    excluding a kind is a partition filter, so the excluded files are never opened.
    ``one_per_file`` reads a folder with one (indented) object per file instead; a kind is
    then excluded by the files' name prefix, ``<kind>_``.  A document that does not
    parse raises in both layouts.
    """
    full = T.StructType(schema.fields + [T.StructField("kind", T.StringType()),
                                         T.StructField("month", T.StringType())])

    def read():
        df = (spark.read.schema(full).option("multiLine", one_per_file)
              .option("mode", "FAILFAST").json(path))
        if not exclude_kind:
            return df
        if one_per_file:
            return df.where(~F.col("_metadata.file_name").startswith(f"{exclude_kind}_"))
        return df.where(F.col("kind") != exclude_kind)

    out = _optional(read, full, spark)
    return out.select(*[f.name for f in schema.fields
                        if not isinstance(f.dataType, (T.StructType, T.MapType))])


def read_feed_xml(spark: SparkSession, path: str) -> DataFrame:
    """RSS ``<item>`` entries -> (feed file, entry order, title, summary, published).

    Missing fields become ""; ``description`` stands in for a missing summary.
    """
    def read():
        return (spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)
                .withColumn("feed_file", F.col("_metadata.file_name"))
                .withColumn("entry_ord", F.monotonically_increasing_id()))

    empty = T.StructType(FEED_ITEM.fields + [T.StructField("feed_file", T.StringType()),
                                             T.StructField("entry_ord", T.LongType())])
    df = _optional(read, empty, spark)
    summary = F.coalesce("summary", "description", F.lit(""))
    return df.select("feed_file", "entry_ord",
                     F.coalesce("title", F.lit("")).alias("title"),
                     summary.alias("summary"),
                     F.coalesce("pubDate", F.lit("")).alias("published"))


def read_listings(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Post listings ``{"data": {"children": [{"data": {...}}]}}`` -> one row per post.

    One listing per line, or one (indented) listing per file with ``one_per_file``;
    a listing that does not parse raises.
    """
    def read():
        return (spark.read.schema(LISTING).option("multiLine", one_per_file)
                .option("mode", "FAILFAST").json(path))

    df = _optional(read, LISTING, spark)
    posts = df.select(F.explode("data.children").alias("c")).select("c.data.*")
    return posts


def normalise_price_frame(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Lower/underscore column names, derive ``date``, keep the OHLCV columns present."""
    out = df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])
    if "date" in out.columns:
        out = out.withColumn("date", F.try_to_date(F.col("date").cast("string")))
    elif "datetime" in out.columns:
        out = out.withColumn("date", F.try_to_date(F.col("datetime").cast("string")))
    else:
        out = out.withColumn("date", today if today is not None else F.current_date())
    return out.select(*[c for c in OHLCV if c in out.columns])


def window_days(target: DataFrame, backfill_days: int = 90, overlap_days: int = 2) -> Column:
    """Length of the pull window: the backfill while ``target`` is empty, else the overlap.

    The emptiness test is a scalar subquery that reads at most one row, not a driver-side action.
    """
    has_rows = target.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    return F.when(has_rows, F.lit(overlap_days)).otherwise(F.lit(backfill_days))


def incremental_window(source: DataFrame, target: DataFrame, as_of: Column,
                       backfill_days: int = 90, overlap_days: int = 2,
                       col: str = "date") -> DataFrame:
    """Rows of ``source`` in ``[as_of - N, as_of)``: N = 90 when ``target`` is empty, else 2."""
    days = window_days(target, backfill_days, overlap_days)
    return source.where((F.col(col) >= F.date_sub(as_of, days)) & (F.col(col) < as_of))


def with_columns_order(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Preferred columns first, the rest after in their order."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
