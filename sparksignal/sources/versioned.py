"""Stored tables that are refreshed atomically.

Every write goes to a new version folder under the table's root.  Only after the write has succeeded does
one small pointer file, replaced by a rename, name the new version; readers resolve the pointer and never see a
half-written or half-deleted table.  The version before stays until the next refresh, so a reader that resolved
the pointer just before it moved can finish.  Works on any file system that Spark's Hadoop layer opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _hadoop(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none when it is absent."""
    _, p, fs = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    _, p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it was there already (one of several writers wins)."""
    _, p, fs = _hadoop(spark, path)
    return fs.createNewFile(p)


def read_json(spark: SparkSession, path: str) -> dict | None:
    jvm, p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small file beside ``path`` and rename it onto ``path``."""
    jvm, p, fs = _hadoop(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(),
                                                                  spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(p), how)


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the published version, None before the first."""
    pointer = read_json(spark, f"{root.rstrip('/')}/{POINTER}")
    return None if pointer is None else f"{root.rstrip('/')}/{pointer['folder']}"


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), keep_if_empty: bool = False, fmt: str = "parquet",
            **extra: object) -> int:
    """Refresh the table at ``root`` with ``df``; returns the rows written, observed by the write itself.

    A failed write leaves the published version as it was.  With ``keep_if_empty`` an empty ``df`` does, too, once there is a
    version.  ``extra`` values are kept in the pointer.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    pointer = read_json(spark, f"{root}/{POINTER}") or {}
    folder = f"version-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(f"{root}/{folder}")
    except Exception:
        delete(spark, f"{root}/{folder}")
        raise
    n = seen.get.get("n", 0)
    if n == 0 and keep_if_empty and pointer:
        delete(spark, f"{root}/{folder}")
        return 0
    replace_json(spark, f"{root}/{POINTER}", {"folder": folder, "before": pointer.get("folder"), **extra})
    for name in names(spark, root):
        if name.startswith("version-") and name not in (folder, pointer.get("folder")):
            delete(spark, f"{root}/{name}")
    return n


def read(spark: SparkSession, root: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The published version; before the first an empty frame of ``schema``, or an error without one."""
    path = current(spark, root)
    if path is None:
        if schema is None:
            raise FileNotFoundError(f"{root} has no published version")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)
