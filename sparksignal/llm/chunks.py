"""Documents stored once as chunks, and questions that chunks put to shards.

Several operators need to know, for millions of hashed items of each document, how
often an item occurs in the corpus.  Joining items as rows would shuffle a row per
item and the texts again for every join.  Here the documents are written once, as a
Parquet table in the shared folder, bucketed by ``chunk`` (some megabytes of
documents).  Each round then is

1. ``ask``: every chunk sends each shard one packed message (the sorted distinct items
   of the chunk that belong to the shard, so a hot item costs one entry per chunk);
2. ``answer``: every shard sees all messages for its items and replies to each chunk;
3. the next round, or the result, cogroups the chunk table with the replies by chunk.
   The table is bucketed by that key, so texts are never shuffled.

Messages and replies are shuffle rows: lost executors recompute them from the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.session import scratch_path

MESSAGE = "shard long, chunk long, payload binary"
REPLY = "chunk long, round int, shard long, payload binary"
BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 100_000


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """UTF-8 bytes of all texts (one narrow aggregate)."""
    return docs.select(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_of(df: DataFrame, without: str) -> Column:
    """All columns but one as the struct ``row``; no name is added to theirs (a table of that one column alone gets a filler)."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != without]
    return F.struct(*(rest or [F.lit(0).alias("none")])).alias("row")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a cut of the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store(docs: DataFrame, text_col: str, total_bytes: int, chunk_bytes: int) -> DataFrame:
    """Write ``docs`` as the chunk table: ``chunk, pos, text, row``.

    ``row`` is a struct of all columns but the text, so no column name can clash.  A null
    text becomes an empty one.  A document longer than ``chunk_bytes`` is a chunk of its own.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), row_of(docs, text_col))
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("pos", T.LongType()),
                           *src.schema.fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, pos, size = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            lens = np.diff(np.frombuffer(b.column(0).cast(pa.large_string()).buffers()[1], np.int64)[
                b.column(0).offset:][:len(b) + 1]) if len(b) else np.zeros(0, np.int64)
            chunks, places = np.empty(len(b), np.int64), np.empty(len(b), np.int64)
            for i, n in enumerate(lens.tolist()):
                if pos and size + n > chunk_bytes:
                    chunk, pos, size = chunk + 1, 0, 0
                chunks[i], places[i] = chunk, pos
                pos, size = pos + 1, size + n
            yield pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(places), *b.columns],
                                             ["chunk", "pos", "text", "row"])

    buckets = int(min(MAX_BUCKETS, max(partitions(spark), total_bytes // BUCKET_BYTES + 1)))
    path = scratch_path(spark, "chunks")
    table = "chunks_" + path.rsplit("-", 1)[1]
    (src.mapInArrow(number, schema).write.bucketBy(buckets, "chunk").option("compression", "zstd")
        .option("path", path).format("parquet").saveAsTable(table))
    return spark.table(table)


class Block:
    """Some documents of a chunk, end to end: ``buf`` bytes, ``starts`` and ``lens`` of the documents."""

    def __init__(self, texts: list[bytes]):
        self.lens = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]]) if texts else np.zeros(0, np.int64)
        self.buf = np.frombuffer(b"".join(texts), np.uint8)


def blocks(table: pa.Table, most: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """Index of the first document and the texts (bytes) of consecutive documents, about ``most`` bytes each."""
    texts, size, first = [], 0, 0
    for i, v in enumerate(table.column("text").cast(pa.binary())):
        t = v.as_py()
        if texts and size + len(t) > most:
            yield first, texts
            texts, size, first = [], 0, i
        texts.append(t)
        size += len(t)
    if texts:
        yield first, texts


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def ask(chunks: DataFrame, replies: DataFrame | None, fn: Callable, schema: str = MESSAGE) -> DataFrame:
    """``fn(chunk id, documents, replies)`` for every chunk; yields a pyarrow table of ``schema``."""
    if replies is None:
        def one(key, docs):
            return fn(key[0].as_py(), in_order(docs), None)

        return chunks.groupBy("chunk").applyInArrow(one, schema)

    def both(key, docs, got):
        return fn(key[0].as_py(), in_order(docs), got)

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(both, schema)


def messages(chunk: int, shards: np.ndarray, items: np.ndarray) -> pa.Table:
    """One message per shard; ``items`` (a structured or plain array) is sorted by ``shards``."""
    cuts = np.flatnonzero(np.diff(shards)) + 1
    firsts = np.concatenate([[0], cuts]) if len(shards) else np.zeros(0, np.int64)
    return pa.table({
        "shard": pa.array(shards[firsts].astype(np.int64), pa.int64()),
        "chunk": pa.array(np.full(len(firsts), chunk, np.int64)),
        "payload": pa.array([x.tobytes() for x in np.split(items, cuts)] if len(firsts) else [], pa.binary())})
