"""Line dedup: lines that many documents share stay in one document only.

Distinct line keys are hashed to 128 bits and sharded.  For each shard a minimal perfect
hash over its keys (levels of bit arrays; an index is the rank of a key's bit) addresses
three flat arrays: fingerprint, number of documents, largest document id.  Documents probe
the arrays of a shard with one packed list of their chunk's distinct keys; lines and texts
are never joined (``llm.chunks``).  A hot line is one entry per chunk.  The arrays are a
table (``line_arrays``) and can be kept to probe later documents.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.  A key of at
least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines but
those in the largest id holding it.

Cases: a null or empty text is one empty line (text comes back empty); ids are integers, a null
id sorts below all others; each row is a document, and rows that share the largest id all keep
the line; a document may lose every line and stays with an empty text; an empty table gives an
empty result; the other columns come back untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksignal.llm import chunks as ch

MIN_CHARS, MIN_DOCS = 20, 3
CHUNK_BYTES = 8 << 20
SHARD_KEYS = 1 << 18
SPACE = " \t\n\x0b\x0c\r"
NO_ID = np.iinfo(np.int64).min
ITEM = np.dtype([("a", "<u8"), ("b", "<u8"), ("n", "<u4"), ("id", "<i8")])
ARRAYS = "shard long, levels array<long>, bits binary, fingerprint binary, n_docs binary, largest binary"
GAMMA = 2


def _hash(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    h = a + b * np.uint64(2 * level + 1) + np.uint64(level)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return (h % np.uint64(size)).astype(np.int64)


def build_mphf(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, end to end.  Keys alone on their bit settle; others go on."""
    sizes, bits, todo, level = [], [], np.arange(len(a)), 0
    while len(todo):
        size = max(64, GAMMA * len(todo))
        at = _hash(a[todo], b[todo], level, size)
        n = np.bincount(at, minlength=size)
        sizes.append(size)
        bits.append(n == 1)
        todo = todo[n[at] != 1]
        level += 1
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def mphf_index(sizes: list[int], bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of each key (0 .. keys - 1); a key outside the set gets any index or -1."""
    rank = np.cumsum(bits) - 1
    out, todo, base = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, size in enumerate(sizes):
        at = base + _hash(a[todo], b[todo], level, size)
        hit = bits[at]
        out[todo[hit]] = rank[at[hit]]
        todo, base = todo[~hit], base + size
    return out


def line_key(line: str, min_chars: int) -> bytes | None:
    if len(line) < min_chars:
        return None
    key = line.strip(SPACE)
    return key.encode().lower() if len(key) >= min_chars else None


def _lines(docs: pa.Table, id_col: str, min_chars: int):
    """For each document: id, lines, keys (16 bytes, or None)."""
    ids = docs["row"].combine_chunks().field(id_col)
    for text, i in zip(docs["text"], ids):
        lines, i = text.as_py().split("\n"), i.as_py()
        keys = [k and xxhash.xxh3_128_digest(k) for k in (line_key(x, min_chars) for x in lines)]
        yield NO_ID if i is None else i, lines, keys


def _distinct(docs: pa.Table, id_col: str, min_chars: int, shards: int):
    """The chunk's distinct keys by shard, with documents and largest id: (shards, items)."""
    n, largest = {}, {}
    for i, _, keys in _lines(docs, id_col, min_chars):
        for k in set(keys) - {None}:
            n[k] = n.get(k, 0) + 1
            largest[k] = max(i, largest.get(k, NO_ID))
    items = np.zeros(len(n), ITEM)
    ab = np.frombuffer(b"".join(n), "<u8").reshape(-1, 2)
    items["a"], items["b"] = ab[:, 0], ab[:, 1]
    items["n"], items["id"] = list(n.values()), list(largest.values())
    items = items[np.lexsort((items["b"], items["a"]))]
    return ((items["a"] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64), items


def line_arrays(sent: DataFrame) -> DataFrame:
    """One row per shard: the hash and its arrays, from the chunks' messages."""
    def build(key, got):
        x = np.concatenate([np.frombuffer(p, ITEM) for p in got["payload"].to_pylist()])
        x = x[np.lexsort((x["b"], x["a"]))]
        new = np.flatnonzero(np.concatenate([[True], (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])]))
        a, b = x["a"][new], x["b"][new]
        sizes, bits = build_mphf(a, b)
        at = mphf_index(sizes, bits, a, b)
        cols = [np.empty(len(a), t) for t in ("<u8", "<i8", "<i8")]
        for col, v in zip(cols, (b, np.add.reduceat(x["n"].astype(np.int64), new), np.maximum.reduceat(x["id"], new))):
            col[at] = v
        return pa.table({"shard": [key[0].as_py()], "levels": pa.array([sizes], pa.list_(pa.int64())),
                         "bits": [np.packbits(bits).tobytes()], "fingerprint": [cols[0].tobytes()],
                         "n_docs": [cols[1].tobytes()], "largest": [cols[2].tobytes()]})

    return sent.groupBy("shard").applyInArrow(build, ARRAYS)


def _probe(min_docs: int):
    """Each chunk's keys against the arrays of one shard: bits of lost keys, then the ids that keep them."""
    def fn(key, asked, arrays):
        if not asked.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "round": pa.array([], pa.int32()),
                             "shard": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        row = arrays.to_pylist()[0]
        sizes = row["levels"]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        fp, n, top = (np.frombuffer(row[c], t) for c, t in (("fingerprint", "<u8"), ("n_docs", "<i8"), ("largest", "<i8")))
        out = []
        for p in asked["payload"].to_pylist():
            x = np.frombuffer(p, ITEM)
            at = mphf_index(sizes, bits, x["a"], x["b"])
            lost = (at >= 0) & (fp[at] == x["b"]) & (n[at] >= min_docs)
            out.append(np.packbits(lost).tobytes() + top[at[lost]].tobytes())
        return pa.table({"chunk": asked["chunk"].cast(pa.int64()), "round": pa.array([0] * len(out), pa.int32()),
                         "shard": asked["shard"].cast(pa.int64()), "payload": pa.array(out, pa.binary())})

    return fn


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``row`` (struct of the other columns), ``text`` (kept lines joined by newlines), ``n_lines``, ``n_dropped``."""
    spark = docs.sparkSession
    total = ch.text_bytes(docs, text_col)
    table = ch.store(docs, text_col, total, chunk_bytes)
    shards = max(ch.partitions(spark), total // 64 // SHARD_KEYS)

    def ask(chunk, docs, _):
        return ch.messages(chunk, *_distinct(docs, id_col, min_chars, shards))

    sent = ch.write_table(ch.ask(table, None, ask), "line_keys")
    arrays = ch.write_table(line_arrays(sent), "line_arrays")
    replies = sent.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(_probe(min_docs), ch.REPLY)

    def drop(chunk, docs, got):
        at, items = _distinct(docs, id_col, min_chars, shards)
        keeper, by_shard = {}, dict(zip(got["shard"].to_pylist(), got["payload"].to_pylist()))
        for s in np.unique(at).tolist():
            mine = items[at == s]
            k = (len(mine) + 7) // 8
            lost = np.unpackbits(np.frombuffer(by_shard[s][:k], np.uint8), count=len(mine)).astype(bool)
            names = np.stack([mine["a"][lost], mine["b"][lost]], 1).astype("<u8")
            for name, i in zip(names, np.frombuffer(by_shard[s][k:], "<i8").tolist()):
                keeper[name.tobytes()] = i
        kept, n, dropped = [], [], []
        for i, lines, keys in _lines(docs, id_col, min_chars):
            stay = [x for x, k in zip(lines, keys) if keeper.get(k, i) == i]
            kept.append("\n".join(stay))
            n.append(len(lines))
            dropped.append(len(lines) - len(stay))
        return pa.table({"row": docs["row"], "text": pa.array(kept, pa.string()), "n_lines": pa.array(n, pa.int64()),
                         "n_dropped": pa.array(dropped, pa.int64())})

    row = table.schema["row"].dataType.simpleString()
    return ch.ask(table, replies, drop, f"row {row}, text string, n_lines long, n_dropped long")


def with_columns(out: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents' own columns, in their order, with the kept text."""
    return out.select(*[F.col(text_col if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns])
