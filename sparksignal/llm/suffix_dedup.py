"""Exact substring dedup: every byte covered by a ``width``-byte string that also starts elsewhere goes.

Blockwise suffix sorting with a difference cover, to depth ``width``.  ``D`` is a
difference cover modulo ``v``: for any two positions ``i, j`` there is a shift
``s < v`` at which ``i + s`` and ``j + s`` both lie in the cover.

* Cover samples (positions with offset mod ``v`` in ``D``; about 9 % of all) are sorted,
  one hash bucket at a time, by the ``width - v + 1`` bytes from them; equal neighbours
  give tied samples.  A suffix can tie with another for ``width`` bytes only if a tied
  sample lies in its first ``v`` positions, so all other suffixes are done here.
* Long ties are resolved at the samples: a tied sample whose ``width + v - 1`` bytes tie
  again settles the ``v`` suffixes from it at once.
* The suffixes left (around the ends of repeats) are sorted to full depth, one bucket at a
  time, together with one copy of each settled stretch (the first in the order of chunks and
  places), as a suffix left may tie with a settled one: first by short names, then those that tie by
  long ones.

Suffixes are compared by names, not by bytes: short ones where a tie only leaves more to do
(``SPARE_BITS`` more bits than it takes to number the corpus), 128 bits where a tie decides.  Memory per
task is one chunk or one bucket; the number of buckets grows with the input.

Cases: null text counts as empty; texts shorter than ``width`` are kept whole; repeated rows
are separate documents (and remove each other); an empty table gives an empty result; any other
columns come back untouched in ``row``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksignal.llm import chunks as ch

WIDTH = 200
COVER_ORDER = 11  # prime q: a cover of q + 1 places modulo q * q + q + 1 = 133
CHUNK_BYTES = 8 << 20
BUCKET_NAMES = 1 << 20
SPARE_BITS = 9
SAMPLES, LONG_TIES, REST, REST_EXACT, RESULT = range(5)  # rounds
SHORT = (SAMPLES, REST)
LANES = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB))


@lru_cache
def difference_cover(q: int) -> tuple[int, tuple[int, ...]]:
    """(v, D): the exponents of a cubic extension's generator that fall on one projective line (Singer)."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, line = (1, 0, 0), []
                for i in range(v):
                    if i and x[1:] == (0, 0):
                        break
                    if x[2] == 0:
                        line.append(i)
                    x = ((-c * x[2]) % q, (x[0] - b * x[2]) % q, (x[1] - a * x[2]) % q)
                else:
                    if len({(d - e) % v for d in line for e in line}) == v and len(line) == q + 1:
                        return v, tuple(line)
    raise ValueError(f"no difference cover of order {q}")


def names(buf: np.ndarray, at: np.ndarray, width: int, lanes: int) -> np.ndarray:
    """Names (n, lanes) of the ``width`` bytes (8 at least) from each place in ``at``."""
    out = np.empty((len(at), lanes), np.uint64)
    if not len(at):
        return out
    view = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))  # the eight bytes from every place
    steps = [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]
    for i in range(0, len(at), 1 << 14):
        rows = at[i:i + (1 << 14)]
        words = [view[rows + s] for s in steps]
        for k in range(lanes):
            m, n = (np.uint64(x) for x in LANES[k])
            h = np.full(len(rows), n, np.uint64)
            for w in words:
                h ^= w
                h *= m
                h ^= h >> np.uint64(29)
            h *= n
            h ^= h >> np.uint64(32)
            out[i:i + len(rows), k] = h
    return out


class Rounds:
    """The rounds of a chunk.  A round looks up its last round's names in the replies, keeps what is known
    now as flags of the chunk's bytes (sent along, one bit each, so that no earlier round is computed again)
    and asks for its own names."""

    def __init__(self, width: int, q: int, shards: int, total: int):
        self.width, self.shards = width, shards
        self.short = min(8, max(5, (total.bit_length() + SPARE_BITS + 7) // 8))  # bytes of a short name
        self.v, cover = difference_cover(q)
        self.depth = {SAMPLES: width - self.v + 1, LONG_TIES: width + self.v - 1, REST: width, REST_EXACT: width}
        if width < self.v + 8:
            raise ValueError(f"width must be {self.v + 8} at least")
        self.in_cover = np.zeros(self.v, bool)
        self.in_cover[list(cover)] = True

    def ordered(self, got: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct names (n, lanes) sorted by shard: names, shards, index of each input's name, occurs
        twice here, input where each name comes first."""
        if got.shape[1] == 1:
            uniq, first, back, n = np.unique(got[:, 0], True, True, True)
            twice, uniq, high = n > 1, uniq[:, None], uniq >> np.uint64(8 * self.short - 32)
        else:
            order = np.lexsort((got[:, 1], got[:, 0]))
            s = got[order]
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]).any(1)
            back = np.empty(len(s), np.int64)
            back[order] = np.cumsum(new) - 1
            uniq, first, high = s[new], order[new], s[new, 0] >> np.uint64(32)
            twice = np.bincount(back, minlength=len(uniq)) > 1
        return uniq, (high * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64), back, twice, first

    def pack(self, uniq: np.ndarray, twice: np.ndarray) -> bytes:
        """A message: the number of names, the names, a bit for each that occurs twice in its chunk."""
        if uniq.shape[1] == 1:
            body = uniq[:, 0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - self.short:].tobytes()
        else:
            body = uniq.astype("<u8").tobytes()
        return np.int64(len(uniq)).tobytes() + body + np.packbits(twice).tobytes()

    def unpack(self, payload: bytes, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        n = int(np.frombuffer(payload, np.int64, 1)[0])
        size = n * (self.short if lanes == 1 else 16)
        twice = np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 + size), count=n).astype(bool)
        if lanes == 2:
            return np.frombuffer(payload, "<u8", 2 * n, 8).reshape(-1, 2), twice
        wide = np.zeros((n, 8), np.uint8)
        wide[:, 8 - self.short:] = np.frombuffer(payload, np.uint8, size, 8).reshape(n, self.short)
        return wide.view(">u8").astype(np.uint64), twice

    def names(self, b: ch.Block, at: np.ndarray, width: int, level: int) -> np.ndarray:
        if level in SHORT:
            return names(b.buf, at, width, 1) >> np.uint64(64 - 8 * self.short)
        return names(b.buf, at, width, 2)

    def tied(self, got: np.ndarray, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each name, by the shards' replies: does it occur elsewhere, and is this the first place?"""
        uniq, shard, back, _, first = self.ordered(got)
        flags = np.zeros((2, len(uniq)), bool)
        for s, lo, hi in _runs(shard):
            bits = np.frombuffer(replies[s], np.uint8).reshape(2, -1)
            flags[:, lo:hi] = np.unpackbits(bits, axis=1, count=hi - lo)
        here = np.zeros(len(got), bool)
        here[first] = True
        return flags[0][back], flags[1][back] & here

    def ask(self, level: int):
        """The message function of a round."""
        def fn(chunk: int, docs: pa.Table, replies: pa.Table | None) -> pa.Table:
            parts, known = self.known(level, docs, replies)
            got = [self.names(b, self.asked(level, b, f), self.depth[level], level) for b, f in zip(parts, known)]
            got = np.concatenate(got) if got else np.zeros((0, 1 if level in SHORT else 2), np.uint64)
            uniq, shard, _, twice, _ = self.ordered(got)
            runs = _runs(shard)
            sent = [(s, self.pack(uniq[lo:hi], twice[lo:hi])) for s, lo, hi in runs]
            if level > SAMPLES:
                sent.append((-1 - chunk, _bits(known)))
            return pa.table({"shard": pa.array([s for s, _ in sent], pa.int64()),
                             "chunk": pa.array([chunk] * len(sent), pa.int64()),
                             "payload": pa.array([p for _, p in sent], pa.binary())})

        return fn

    def answer(self, level: int):
        """One bucket: sort its names, flag those met twice (in one chunk or in two) and the first place
        of each, reply to each chunk.  A chunk's own flags (a negative shard) go back as they are."""
        def fn(key, got):
            if key[0].as_py() < 0:
                return pa.table({"chunk": got["chunk"].cast(pa.int64()), "round": pa.array([level] * len(got), pa.int32()),
                                 "shard": got["shard"].cast(pa.int64()), "payload": got["payload"].cast(pa.binary())})
            got = got.sort_by("chunk")  # the first place of a name is that in the first chunk
            sent = [self.unpack(p, 1 if level in SHORT else 2) for p in got["payload"].to_pylist()]
            whole, m = (np.concatenate(x) for x in zip(*sent))
            order = np.argsort(whole[:, 0], kind="stable") if level in SHORT else np.lexsort((whole[:, 1], whole[:, 0]))
            same = (whole[order[1:]] == whole[order[:-1]]).all(1)
            m = m[order]
            m[1:] |= same
            m[:-1] |= same
            flags = np.zeros((2, len(m)), bool)
            flags[0, order] = m
            flags[1, order[np.concatenate([[True], ~same])]] = True
            cuts = np.cumsum([len(x) for x, _ in sent])[:-1]
            bits = [np.packbits(x, axis=1).tobytes() for x in np.split(flags, cuts, axis=1)]
            return pa.table({"chunk": got["chunk"].cast(pa.int64()), "round": pa.array([level] * len(bits), pa.int32()),
                             "shard": got["shard"].cast(pa.int64()), "payload": pa.array(bits, pa.binary())})

        return fn

    def samples(self, b: ch.Block) -> np.ndarray:
        off = np.arange(len(b.buf), dtype=np.int32) - np.repeat(b.starts, b.lens).astype(np.int32)
        at = np.flatnonzero(self.in_cover[off % self.v])
        return at[_left(b, at) >= self.depth[SAMPLES]]

    def asked(self, level: int, b: ch.Block, flags: tuple[np.ndarray, ...]) -> np.ndarray:
        """The places whose names a round asks for: cover samples, tied samples, suffixes left."""
        if level == SAMPLES:
            return self.samples(b)
        at = np.flatnonzero(flags[-1])
        return at[_left(b, at) >= self.depth[level]]

    def after(self, level: int, b: ch.Block, flags: tuple[np.ndarray, ...], at: np.ndarray, found: np.ndarray,
              first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Flags of a block's bytes after the replies to a round: (tied samples) after the first, (settled
        suffixes, suffixes left) after the others."""
        n = len(b.buf)
        if level == LONG_TIES:
            settled = _cover(n, at[found], self.v)
            sent_by_first = _cover(n, at[found & ~first], self.v)
            near = _cover(n + self.v, np.flatnonzero(flags[0]) + 1, self.v)[self.v:]  # a tied sample lies in [i, i + v)
            return settled, (near | settled) & ~sent_by_first
        marked = np.zeros(n, bool)
        marked[at[found]] = True
        return (*flags[:-1], marked)

    def known(self, level: int, docs: pa.Table, replies: pa.Table | None):
        """Blocks of the chunk, and each block's flags when round ``level`` starts.  Replies hold bits in the
        order of the whole chunk's distinct names, so the names of all blocks are gathered before they are looked up."""
        parts = [ch.Block(texts) for _, texts in ch.blocks(docs)]
        if level == SAMPLES:
            return parts, [()] * len(parts)
        bits = dict(zip(replies["shard"].to_pylist(), replies["payload"].to_pylist()))
        own = [p for s, p in bits.items() if s < 0]
        last = level - 1
        flags = _flags(own[0], parts, 1 if last == LONG_TIES else 2) if last else [()] * len(parts)
        at = [self.asked(last, b, f) for b, f in zip(parts, flags)]
        if not parts:
            return parts, []
        got = np.concatenate([self.names(b, a, self.depth[last], last) for b, a in zip(parts, at)])
        cuts = np.cumsum([len(a) for a in at])[:-1]
        found, first = (np.split(x, cuts) for x in self.tied(got, bits))
        return parts, [self.after(last, *x) for x in zip(parts, flags, at, found, first)]

    def result(self):
        def fn(chunk: int, docs: pa.Table, replies: pa.Table) -> pa.Table:
            n_removed, spans, kept = [], [], []
            for b, (settled, again) in zip(*self.known(RESULT, docs, replies)):
                gone = _cover(len(b.buf), np.flatnonzero(settled | again), self.width)
                for lo, n in zip(b.starts.tolist(), b.lens.tolist()):
                    g = gone[lo:lo + n]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
                    spans.append(edge.reshape(-1, 2).tolist())
                    n_removed.append(int(g.sum()))
                    kept.append(b.buf[lo:lo + n][~g].tobytes())
            span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            return pa.table({
                "row": docs["row"], "n_bytes": pa.array([len(t) for _, x in ch.blocks(docs) for t in x], pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array([[{"begin": a, "end": z} for a, z in s] for s in spans], pa.list_(span)),
                "kept": pa.array(kept, pa.binary())})

        return fn


def _runs(x: np.ndarray):
    cuts = np.flatnonzero(np.diff(x)) + 1
    edges = np.concatenate([[0], cuts, [len(x)]]) if len(x) else np.zeros(1, np.int64)
    return [(int(x[lo]), int(lo), int(hi)) for lo, hi in zip(edges[:-1], edges[1:])]


def _cover(n: int, at: np.ndarray, width: int) -> np.ndarray:
    """Places 0..n-1 within ``width`` from any place in ``at`` (ascending) on."""
    d = np.zeros(n + 1, np.int8)
    if len(at):
        gap = np.diff(at) > width
        d[at[np.concatenate([[True], gap])]] = 1
        d[np.minimum(at[np.concatenate([gap, [True]])] + width, n)] -= 1
    return np.cumsum(d[:n], dtype=np.int8).view(bool)


def _left(b: ch.Block, at: np.ndarray) -> np.ndarray:
    """Bytes from each place to the end of its document."""
    return (b.starts + b.lens)[np.searchsorted(b.starts, at, "right") - 1] - at


def _bits(flags: list[tuple[np.ndarray, ...]]) -> bytes:
    """The flags of a chunk's blocks as bits: all of the first kind, then all of the second."""
    return np.packbits(np.concatenate([x for kind in zip(*flags) for x in kind])).tobytes() if flags else b""


def _flags(payload: bytes, parts: list[ch.Block], kinds: int) -> list[tuple[np.ndarray, ...]]:
    sizes = [len(b.buf) for b in parts] * kinds
    flat = np.unpackbits(np.frombuffer(payload, np.uint8), count=sum(sizes)).view(bool)
    each = np.split(flat, np.cumsum(sizes)[:-1])
    return list(zip(*(each[k * len(parts):(k + 1) * len(parts)] for k in range(kinds))))


def dedup(docs: DataFrame, text_col: str = "text", width: int = WIDTH, cover_order: int = COVER_ORDER,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``row`` (struct of the other columns), ``n_bytes``, ``n_removed``, ``removed`` (maximal byte
    spans), ``kept`` (binary: the bytes left; a cut may fall inside a UTF-8 sequence)."""
    spark = docs.sparkSession
    total = ch.text_bytes(docs, text_col)
    table = ch.store(docs, text_col, total, chunk_bytes)
    v, cover = difference_cover(cover_order)
    shards = max(ch.partitions(spark), total * len(cover) // v // BUCKET_NAMES)
    rounds = Rounds(width, cover_order, shards, total)
    replies = None
    for level in range(RESULT):
        sent = ch.ask(table, replies, rounds.ask(level))
        replies = ch.write_table(sent.groupBy("shard").applyInArrow(rounds.answer(level), ch.REPLY), f"ties{level}")
    row = table.schema["row"].dataType.simpleString()
    out = ch.ask(table, replies, rounds.result(),
                 f"row {row}, n_bytes long, n_removed long, removed array<struct<begin:long,end:long>>, kept binary")
    return out.withColumn("n_spans", F.size("removed").cast("long"))
