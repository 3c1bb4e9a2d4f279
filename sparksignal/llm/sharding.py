"""Shuffled shards by a two-pass external shuffle; DataFrame functions only.

Pass one gives each record a seeded random key, writes the table, and scatters the records uniformly into
memory-sized buckets by the key.  Pass two loads one bucket at a time, brings it to a fixed order,
Fisher-Yates-shuffles it (Spark's ``shuffle``), and writes its records to the shards' files.  The buckets end to end
are one uniform permutation of the table; place ``p`` of it goes to shard ``p mod n`` at slot ``p div n``, so the
shards' row counts are at most one apart (law ``rows``).

A bucket holds ``bucket_rows`` records and ``bucket_bytes`` bytes on average at most.  A record over a sixteenth of
``bucket_bytes`` is never loaded with others: only its number takes part in its bucket's shuffle, and the record
itself goes alone to the place that its number got.  So a bucket's bytes are a sum of small, uniformly dealt ones, with a
standard deviation of a quarter of ``bucket_bytes`` at most.

The key covers the record and, for repeated records, their row number in the first written table, so a
record that is a third of all rows spreads over all buckets.  Both passes are written to the shared
folder before anything reads them: a lost executor cannot change a shuffle that others have
seen.  The shards are Parquet files in folders ``shard=0``, ``shard=1``, ...

Cases: null ids and texts are hashed like any value; repeated rows are records of their own; an empty
table gives an empty result; the records come back as struct ``row``, so no column name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm.chunks import BUCKET_BYTES as PART_BYTES
from sparksignal.llm.chunks import partitions, write_table
from sparksignal.session import scratch_path

SHARDS, BUCKET_ROWS, SEED = 16, 20_000, 11
BUCKET_BYTES, LONG_SHARE = 16 << 20, 16
ONE_BUCKET_AT_A_TIME = "spark.sql.execution.useObjectHashAggregateExec"  # false: sorted groups, not a map of many buckets


def record_bytes(schema: T.StructType) -> Column:
    """Bytes of a record: those of strings and binaries, of nested values as JSON, and eight of any other."""
    size = F.lit(0).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            n = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            n = F.octet_length(F.to_json(F.struct(c.alias("c"))))
        else:
            n = F.lit(8)
        size = size + F.coalesce(n, F.lit(0))
    return size


def shuffled_shards(records: DataFrame, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS, seed: int = SEED,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The written shards: columns of ``records`` as struct ``row``, ``shard`` (int, from 0) and ``slot`` (long,
    gapless from 0)."""
    spark = records.sparkSession
    rows = records.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid"),
                          record_bytes(records.schema).alias("bytes"))
    rows = write_table(rows.withColumn("key", F.xxhash64(F.lit(seed), F.xxhash64("row"), "uid")), "records")
    too_long = F.col("bytes") > bucket_bytes // LONG_SHARE
    got = rows.agg(F.count("*").alias("n"), F.sum(F.when(~too_long, F.col("bytes"))).alias("bytes"),
                   F.count_if(too_long).alias("long")).first()
    n, total = got["n"], got["bytes"] or 0
    buckets = max(1, -(-n // bucket_rows), -(-total // bucket_bytes))
    parts = max(1, min(buckets, max(partitions(spark), total // PART_BYTES + 1)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(buckets)))
    before = _offsets(rows.groupBy("bucket").agg(F.count("*").alias("size")))
    # a bucket is a small group of records: its rows and bytes are bounded by the uniform hash
    item = F.struct("key", "uid", F.when(~too_long, F.col("row")).alias("row"), too_long.alias("long"))
    loaded = rows.select("bucket", item.alias("item")).repartition(parts, "bucket").groupBy("bucket").agg(
        F.array_sort(F.collect_list("item")).alias("all"))
    place = F.col("before") + F.col("place")
    mixed = loaded.join(before, "bucket").select("before", F.shuffle("all", seed).alias("all")).select(
        "before", F.posexplode("all").alias("place", "item")).select(
        "item.row", F.when(F.col("item.long"), F.col("item.uid")).alias("uid"), F.floor(place / shards).cast("long").alias("slot"),
        F.when(F.col("item.long"), "places").otherwise("shards").alias("kind"), (place % shards).cast("int").alias("shard"))
    path, own = scratch_path(spark, "shards"), spark.conf.get(ONE_BUCKET_AT_A_TIME)
    spark.conf.set(ONE_BUCKET_AT_A_TIME, "false")
    try:
        mixed.write.option("compression", "zstd").partitionBy("kind", "shard").parquet(path)
    finally:
        spark.conf.set(ONE_BUCKET_AT_A_TIME, own)
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("uid long, slot long, shard int").fields])
    if got["long"]:
        places = spark.read.schema(schema).parquet(f"{path}/kind=places").select("uid", "slot", "shard")
        alone = rows.where(too_long).select("row", "uid").join(places, "uid")
        alone.select("row", "uid", "slot", "shard").write.mode("append").option("compression", "zstd").partitionBy(
            "shard").parquet(f"{path}/kind=shards")
    if not n:
        return spark.createDataFrame([], schema).select("row", "shard", "slot")
    return spark.read.schema(schema).parquet(f"{path}/kind=shards").select("row", "shard", "slot")


def _offsets(sizes: DataFrame, group: int = 1000) -> DataFrame:
    """``bucket, before``: rows in all smaller buckets.  Sums run inside groups of buckets, then over
    the groups' totals: one row for ``bucket_rows * group`` records meets in one task."""
    groups = sizes.withColumn("group", F.floor(F.col("bucket") / group))
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = groups.groupBy("group").agg(F.sum("size").alias("total")).select(
        "group", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("base"))
    return groups.withColumn("here", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, "group").select(
        "bucket", (F.col("base") + F.col("here")).alias("before"))
