"""Result documents (JSON) as a merge-on-read log.

Each run appends its documents to a folder of its own, ``runs/run=N/kind=.../month=...``; nothing is ever
overwritten, so a correction is just a later document of the same kind and date.  Readers take the newest run per (kind,
date).  ``compact`` writes what readers see as a new base version, published atomically (``versioned``) with
the number of the last run in it; older runs stay until the next compaction.  A run without its success mark is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.operators.clean import keep_first
from sparksignal.sources import versioned


def _run(name: str) -> int:
    return int(name.split("=")[1])


def _finished(spark: SparkSession, root: str, after: int) -> list[str]:
    """Run folders with a success mark whose number is over ``after``."""
    runs = [n for n in versioned.names(spark, f"{root}/runs") if n.startswith("run=") and _run(n) > after]
    return [n for n in runs if versioned.exists(spark, f"{root}/runs/{n}/_SUCCESS")]


def append(df: DataFrame, root: str, kind: str) -> int:
    """Add the documents of one run (a row each, with ``date``); returns the run's number.

    Files are partitioned by kind and month, so their number grows with runs and months, not with days.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    base = versioned.read_json(spark, f"{root}/base/{versioned.POINTER}") or {"upto": 0}
    run = max([base["upto"], *[int(n) for n in versioned.names(spark, f"{root}/claims") if n.isdigit()]]) + 1
    while not versioned.claim(spark, f"{root}/claims/{run:08d}"):
        run += 1
    out = df.withColumn("kind", F.lit(kind)).withColumn("month", F.date_format(F.col("date").cast("date"), "yyyy-MM"))
    out.repartition("kind", "month").write.partitionBy("kind", "month").json(f"{root}/runs/run={run:08d}")
    return run


def _lines(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """All lines with ``kind, month, run`` (0 for the base), and the number of the last run."""
    base = versioned.read_json(spark, f"{root}/base/{versioned.POINTER}")
    upto = base["upto"] if base else 0
    cols = ["value", F.col("kind").cast("string").alias("kind"), F.col("month").cast("string").alias("month")]
    out = None
    if base:
        out = spark.read.format("text").load(f"{root}/base/{base['folder']}").select(*cols, F.lit(0).alias("run"))
    runs = _finished(spark, root, upto)
    if runs:
        new = spark.read.format("text").option("basePath", f"{root}/runs").load([f"{root}/runs/{n}" for n in runs])
        new = new.select(*cols, F.col("run").cast("int").alias("run"))
        out = new if out is None else out.unionByName(new)
    return out, max([upto, *map(_run, runs)])


def _newest(lines: DataFrame) -> DataFrame:
    """The line of the newest run per (kind, date); of several in that run the greatest."""
    dated = lines.withColumn("date", F.get_json_object("value", "$.date"))
    return keep_first(dated, ["kind", "date"], ["run", "value"], descending=True)


def read(spark: SparkSession, root: str, schema: T.StructType, exclude_kind: str | None = "war_exit") -> DataFrame:
    """Newest document per (kind, date), nested objects dropped; a line that does not parse raises.

    A kind is excluded by its partition, so its files are never opened.
    """
    lines, _ = _lines(spark, root.rstrip("/"))
    flat = [f.name for f in schema.fields if not isinstance(f.dataType, (T.StructType, T.MapType))]
    if lines is None:
        return spark.createDataFrame([], schema).select(*flat)
    if exclude_kind:
        lines = lines.where(F.col("kind") != exclude_kind)
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return _newest(lines).select(parsed.alias("d")).select(*[f"d.{c}" for c in flat])


def compact(spark: SparkSession, root: str) -> int:
    """Publish what readers see as the new base; returns its number of documents.  Safe beside readers and appends."""
    root = root.rstrip("/")
    before = versioned.read_json(spark, f"{root}/base/{versioned.POINTER}") or {"upto": 0}
    lines, upto = _lines(spark, root)
    if lines is None:
        return 0
    out = _newest(lines).select("kind", "month", "value").repartition("kind", "month")
    n = versioned.publish(out, f"{root}/base", partition_by=["kind", "month"], fmt="text", upto=upto)
    for name in versioned.names(spark, f"{root}/runs"):
        if name.startswith("run=") and _run(name) <= before["upto"]:
            versioned.delete(spark, f"{root}/runs/{name}")
    return n
