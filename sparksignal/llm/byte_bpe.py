"""Byte-level BPE encoding and decoding: words of like length are rows of a padded numpy matrix and merge together.

The pattern cuts a text into words.  A word that is a token itself is that token.  The others start as one symbol a byte and
are gathered by length into matrices of symbol ids, padded on the right.  Each round finds the rank of every
neighbouring pair in a hash table of all pairs that a token can be merged from, merges the leftmost pair of least
rank of every row, closes the gaps, and looks up the two pairs that changed; rows without a known pair leave the
matrix.  A word over 128 bytes would cost a round of its own for nearly every byte; it is merged by a heap of its pairs in the
same order, in n log n steps.

Encoded words are kept in a bounded cache per worker, two generations of ``CACHE_WORDS`` at most; words over ``LONG_WORD``
characters are not kept.  The vocabulary is broadcast, its size checked.

Cases: null or empty texts have no ids and decode to no bytes; repeated rows are encoded each; a very long word needs memory
in proportion to it; unknown ids cannot be decoded (error); an empty table
gives an empty result; the other columns, of any name, come back in ``row``.
"""

from __future__ import annotations

import base64
import threading
from array import array
from bisect import bisect_left
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_WORDS, LONG_WORD, SLICE_ROWS = 300_000, 48, 256
MATRIX_CELLS = 1 << 20
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 96, 128)  # bytes; longer words are merged one by one
MAX_TOKENS = 1 << 20
PAD = NONE = np.uint32(0xFFFFFFFF)
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
SPREAD = np.uint64(0x9E3779B97F4A7C15)

# Letters and numbers of newer Unicode versions, which the pattern's own library does not know as such yet.
LATER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    r"\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    r"\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    r"\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    r"\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines ``base64 rank``; read by the driver."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"{path} has over {MAX_TOKENS} tokens")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks single bytes")
    return ranks


class Pairs:
    """Hash table (open addressing, linear probing) from a pair of ids to the id of their union."""

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int]) -> Pairs:
        """All pairs of tokens whose union is a token."""
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left, right, rank))
        return cls(found)

    def __init__(self, found: list[tuple[int, int, int]]):
        left, right, union = np.array(found, np.uint64).reshape(-1, 3).T
        bits = max(4, int(4 * len(found)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.unions = np.full(1 << bits, FREE), np.full(1 << bits, NONE)
        key = left << np.uint64(32) | right
        slot, todo = key * SPREAD >> self.shift, np.arange(len(key))
        while len(todo):
            first = np.unique(slot[todo], return_index=True)[1]
            first = todo[first[self.keys[slot[todo[first]]] == FREE]]
            self.keys[slot[first]], self.unions[slot[first]] = key[first], union[first]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = slot[todo] + np.uint64(1) & self.last

    def union(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the union of each pair, ``NONE`` without one."""
        key = left.astype(np.uint64) << np.uint64(32) | right
        slot = key * SPREAD >> self.shift
        held = self.keys[slot]
        out = np.where(held == key, self.unions[slot], NONE)
        todo = np.nonzero((held != key) & (held != FREE))
        slot, key = slot[todo], key[todo]
        while len(key):
            slot = slot + np.uint64(1) & self.last
            held = self.keys[slot]
            hit = held == key
            out[tuple(x[hit] for x in todo)] = self.unions[slot[hit]]
            left_over = ~hit & (held != FREE)
            todo, slot, key = tuple(x[left_over] for x in todo), slot[left_over], key[left_over]
        return out


def merge_leftmost(ids: np.ndarray, rank: np.ndarray, best: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """One merge in every row: the first pair of rank ``best``.  All rows lose one column."""
    n, width = ids.shape
    rows, at = np.arange(n), rank.argmin(1)
    ids[rows, at] = best
    keep = np.ones((n, width), bool)
    keep[rows, at + 1] = False
    ids = ids[keep].reshape(n, width - 1)
    keep = np.ones((n, width - 1), bool)
    keep[rows, at] = False
    rank = rank[keep].reshape(n, width - 2)
    r = np.flatnonzero(at > 0)
    a = at[r]
    rank[r, a - 1] = pairs.union(ids[r, a - 1], ids[r, a])
    r = np.flatnonzero(at < width - 2)
    a = at[r]
    rank[r, a] = pairs.union(ids[r, a], ids[r, a + 1])
    return ids, rank


def merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one very long word: a heap of pairs by rank and place, and linked symbols."""
    n = len(raw)
    end, start = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that starts, or ends, here
    heap = [(rank, a, a + 1, a + 2) for a in range(n - 1) if (rank := ranks.get(raw[a:a + 2])) is not None]
    heapify(heap)
    while heap:
        _, a, m, z = heappop(heap)
        if end[a] != m or end[m] != z:
            continue  # one of the two has been merged since
        end[a], end[m], start[z] = z, -1, a
        if a and (rank := ranks.get(raw[start[a]:z])) is not None:
            heappush(heap, (rank, start[a], a, z))
        if z < n and (rank := ranks.get(raw[a:end[z]])) is not None:
            heappush(heap, (rank, a, z, end[z]))
    out, a = [], 0
    while a < n:
        out.append(ranks[raw[a:end[a]]])
        a = end[a]
    return out


def merge_rows(ids: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each row, and all ids end to end, after all merges of a padded matrix."""
    at, parts = np.arange(len(ids)), []
    rank = pairs.union(ids[:, :-1], ids[:, 1:])
    while len(ids):
        best = rank.min(1, initial=NONE)
        live = best != NONE
        if not live.all():
            out = ids[~live]
            known = out != PAD
            parts.append((at[~live], known.sum(1), out[known]))
            ids, rank, at, best = ids[live], rank[live], at[live], best[live]
        if len(ids):
            ids, rank = merge_leftmost(ids, rank, best, pairs)
    rows, counts, values = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(rows)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[order]
    counts = counts[order]
    begins = np.cumsum(counts) - counts
    return counts, values[np.arange(counts.sum()) + np.repeat(starts - begins, counts)]


class Encoder:
    """Ids (little-endian, 32 bits) of words, and a cache of them; one instance per worker and vocabulary."""

    _own = threading.local()

    def __init__(self, ranks: dict[bytes, int], pairs: Pairs, pattern: str):
        self.ranks, self.pairs = ranks, pairs
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        whole = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{LATER}]]")
        for kind in (r"\p{L}", r"\p{N}"):
            whole = whole.replace(" ?" + kind + "+", f" ?[{kind}--[{LATER}]]+")
        self.plain, self.whole = regex.compile(pattern), regex.compile(whole, regex.V1)
        self.later = regex.compile(f"[{LATER}]")
        self.young, self.old = {}, {}

    @classmethod
    def of(cls, key, ranks, pairs, pattern) -> Encoder:
        """This worker's instance: workers live longer than tasks."""
        if getattr(cls._own, "key", None) != key:
            cls._own.key, cls._own.got = key, cls(ranks, pairs, pattern)
        return cls._own.got

    def words(self, text: str) -> list[str]:
        if text.isascii() or not self.later.search(text):
            return self.plain.findall(text)
        return self.whole.findall(text)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (none empty): tokens at once, the others in matrices of like length."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            known = self.ranks.get(w)
            if known is not None:
                out[i] = known.to_bytes(4, "little")
            else:
                width = bisect_left(WIDTHS, len(w))
                if width < len(WIDTHS):
                    by_width.setdefault(WIDTHS[width], []).append(i)
                else:
                    out[i] = array("I", merge_long(w, self.ranks)).tobytes()
        for width, some in by_width.items():
            step = max(1, MATRIX_CELLS // width)
            for lo in range(0, len(some), step):
                part = some[lo:lo + step]
                lens = np.array([len(raw[i]) for i in part])
                ids = np.full((len(part), int(lens.max())), PAD)
                ids[np.arange(ids.shape[1]) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)]
                counts, values = merge_rows(ids, self.pairs)
                packed, ends = values.astype("<u4").tobytes(), np.cumsum(4 * counts).tolist()
                for i, a, z in zip(part, [0, *ends], ends):
                    out[i] = packed[a:z]
        return out

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the words that the cache lacks are encoded together."""
        split = [self.words(t) for t in texts]
        missing = set().union(*split).difference(self.young)
        for w in missing.intersection(self.old):
            self.young[w] = self.old[w]
        missing = list(missing.difference(self.young))
        self.young.update(zip(missing, self.encode_words(missing)))
        out = [b"".join(map(self.young.__getitem__, words)) for words in split]
        for w in missing:
            if len(w) > LONG_WORD:
                del self.young[w]
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        return out


def _mapped(rows: DataFrame, col: str, kind: str, make, out: str) -> DataFrame:
    """``row`` (struct of the other columns) and the columns that ``make()`` (called once a task) derives from ``col``."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c != col] or [F.lit(0)]
    src = rows.select(F.struct(F.struct(*rest)).alias("row"), F.col(f"`{col}`").cast(kind).alias("t"))
    schema = T.StructType([src.schema["row"], *T.StructType.fromDDL(out).fields])

    def run(batches):
        one = make()
        for b in batches:
            for lo in range(0, len(b), SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), *one(part.column(1))], schema.names)

    inner = schema["row"].dataType.names[0]  # nested: no name of the input can clash
    return src.mapInArrow(run, schema).select(F.col("row").getField(inner).alias("row"), *schema.names[1:])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the other columns), ``ids`` (array of int), ``n_tokens``."""
    ranks = load_ranks(ranks_path)
    model = docs.sparkSession.sparkContext.broadcast((ranks, Pairs.of_ranks(ranks)))

    def make():
        coder = Encoder.of((ranks_path, pattern), *model.value, pattern)

        def one(texts):
            got = coder.many([t or "" for t in texts.to_pylist()])
            lens = np.array([len(x) // 4 for x in got], np.int64)
            values = np.frombuffer(b"".join(got), "<u4").astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(lens)

        return one

    return _mapped(docs, text_col, "string", make, "ids array<int>, n_tokens long")


def decode(rows: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``row`` (struct of the other columns) and ``data`` (the bytes) of encoded ids."""
    ranks = load_ranks(ranks_path)
    tokens: list = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    table = rows.sparkSession.sparkContext.broadcast(tokens)

    def make():
        tokens = pa.array(table.value, pa.large_binary())

        def one(ids):
            lens = ids.value_lengths().fill_null(0).to_numpy()
            got = tokens.take(ids.flatten())
            if got.null_count:
                raise ValueError("an id that is no token")
            ends = np.frombuffer(got.buffers()[1], np.int64)[:len(got) + 1] if len(got) else np.zeros(1, np.int64)
            offsets = ends[np.concatenate([[0], np.cumsum(lens)])]
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), got.buffers()[2]])
            return (data.cast(pa.binary()),)

        return one

    return _mapped(rows, ids_col, "array<int>", make, "data binary")
