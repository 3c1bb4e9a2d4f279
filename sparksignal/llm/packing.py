"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm.

A document is its token ids and an end id.  Only documents longer than a sequence are cut,
into full pieces; the last piece may be shorter.  Full pieces are sequences of their own.  The
others are dealt by hash into blocks of about ``block_pieces``; each block evolves on some islands:

* an individual is a grouping of the block's pieces into sequences;
* crossover injects whole well-filled sequences of one parent into the other, dissolves the
  sequences there that hold duplicates, and best-fits the displaced pieces;
* after each epoch the elite of an island migrates to the next island of the block (a shuffle of
  packed groupings, about two bytes a piece), and the best grouping of a block wins at the end.

Islands only depend on the pieces' lengths and a seed, so a lost task gives the same result again.  A
block's memory is bounded by ``block_pieces``; the blocks grow with the input.  A block leaves
one poorly filled sequence at most, 0.05 % of its sequences or so.

Token ids are found word by word: the tokenizer's rules never look across white space, nor from a letter
to a stop after it, so the ids of a text are those of its words and stops, and frequent words are kept in a
bounded cache per worker.

Cases: null or empty texts are the end id alone; repeated rows are documents of their own; ids of documents may be
of any type and null; an empty table gives an empty result; the other columns come back in ``row``.
"""

from __future__ import annotations

import json
import os
import random
import re
import threading
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm import byte_bpe
from sparksignal.llm import chunks as ch

CAPACITY, END_ID = 2048, 0
BLOCK_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 3, 6, 4
INJECTED = 0.15  # share of a parent's sequences that a crossover injects
CACHE_WORDS, LONG_WORD, SLICE_ROWS = 400_000, 64, 1024
STOPS = r"([A-Za-z])([,.])([ \n]|$)"  # a lone stop after a letter: a token run of its own
MAX_TOKENIZER_BYTES = 64 << 20


class LetterWords:
    """Ids of words of Latin letters alone, by padded matrices of all that a batch lacks (see ``byte_bpe``).

    Such a word is one run for the tokenizer: only its lower case matters.  Known for tokenizers that split as ``SPLIT`` does,
    mark a word's end by a suffix, and number their tokens in the order of the merges; for others ``known`` is false.
    """

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the tokenizer's own pattern
    LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]{2,32}")

    def __init__(self, spec: str):
        d = json.loads(spec)
        model, vocab, end = d["model"], d["model"]["vocab"], d["model"]["end_of_word_suffix"]
        cut = (d["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.known = (
            [x["type"] for x in (d["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in cut] == ["Split", "ByteLevel"] and cut[0]["pattern"] == {"Regex": self.SPLIT}
            and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"] and bool(end) and model["type"] == "BPE"
            and not model["ignore_merges"] and not model["dropout"])
        if not self.known:
            return
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        found = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        letters = {b: c for c, b in byte_bpe.byte_alphabet().items()}
        self.known = all(x[2] < y[2] for x, y in zip(found, found[1:])) and all(letters[b] + e in vocab for b in range(256) for e in ("", end))
        if self.known:
            self.pairs = byte_bpe.Pairs(found)
            self.inner, self.last = (np.array([vocab[letters[b] + e] for b in range(256)], np.uint32) for e in ("", end))

    def encode(self, words: list[str]) -> list[bytes]:
        raw = [w.lower().encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        lens = np.array([len(w) for w in raw])
        for lo, hi in ((2, 4), (5, 6), (7, 8), (9, 10), (11, 12), (13, 16), (17, 24), (25, 128)):
            some = np.flatnonzero((lens >= lo) & (lens <= hi))
            for k in range(0, len(some), 1 << 16):
                part = some[k:k + (1 << 16)]
                n, at = lens[part], part.tolist()
                data = np.frombuffer(b"".join([raw[i] for i in at]), np.uint8)
                symbols = self.inner[data]
                ends = np.cumsum(n)
                symbols[ends - 1] = self.last[data[ends - 1]]
                ids = np.full((len(part), int(n.max())), byte_bpe.PAD)
                ids[np.arange(ids.shape[1]) < n[:, None]] = symbols
                counts, values = byte_bpe.merge_rows(ids, self.pairs)
                packed, cuts = values.astype("<u4").tobytes(), np.cumsum(4 * counts).tolist()
                for i, a, z in zip(at, [0, *cuts], cuts):
                    out[i] = packed[a:z]
        return out


class WordIds:
    """Token ids (little-endian 32 bits) of a text, word by word; two generations of cached words."""

    _own = threading.local()

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.spec, self.tokenizer, self.letters = spec, Tokenizer.from_str(spec), LetterWords(spec)
        self.young, self.old = {"": b""}, {}

    @classmethod
    def of(cls, spec: str) -> WordIds:
        """This worker's instance: workers live longer than tasks."""
        got = getattr(cls._own, "got", None)
        if got is None or got.spec != spec:
            got = cls._own.got = cls(spec)
        return got

    def _encode(self, words: list[str]) -> list[bytes]:
        if self.letters.known:
            plain = list(map(LetterWords.LETTERS.fullmatch, words))
            quick = iter(self.letters.encode([w for w, m in zip(words, plain) if m]))
            slow = iter(self._tokenized([w for w, m in zip(words, plain) if not m]))
            return [next(quick if m else slow) for m in plain]
        return self._tokenized(words)

    def _tokenized(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; those that the cache lacks are encoded together."""
        young, old = self.young, self.old
        out = list(map(young.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        new = []
        for i in missing:
            got = old.get(words[i])
            if got is None:
                new.append(i)
            else:
                out[i] = young[words[i]] = got
        for i, ids in zip(new, self._encode([words[i] for i in new])):
            out[i] = ids
            if len(words[i]) <= LONG_WORD:
                young[words[i]] = ids
        if len(young) > CACHE_WORDS:
            self.young, self.old = {"": b""}, young
        return out

    def many(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text: its words as a dictionary-encoded column, whose distinct words are looked up once."""
        split = pc.split_pattern(pc.replace_substring(pc.replace_substring_regex(texts, STOPS, r"\1 \2\3"), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        ids = pa.array(self.words(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:][:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        cuts = ends[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])].tolist()
        data = ids.buffers()[2]
        data = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def read_tokenizer(path: str) -> str:
    """The tokenizer's definition, read by the driver; its size is checked, as it goes to every task."""
    if os.path.getsize(path) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is over {MAX_TOKENIZER_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """``row`` (struct of the other columns), ``piece``, ``start``, ``length``, ``ids`` (binary, 4 bytes an id)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    src = docs.select(ch.row_of(docs, text_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    schema = T.StructType([src.schema["row"], *T.StructType.fromDDL("piece int, start long, length int, ids binary").fields])
    end, step = np.uint32(end_id).tobytes(), 4 * capacity

    def run(batches):
        words = WordIds.of(spec.value)
        for b in batches:
            for lo in range(0, len(b), SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                at, piece, ids = [], [], []
                for i, x in enumerate(words.many(part.column(1).cast(pa.large_string()))):
                    x += end
                    cut = [x[k:k + step] for k in range(0, len(x), step)]
                    at += [i] * len(cut)
                    piece += range(len(cut))
                    ids += cut
                no = pa.array(piece, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), no, pa.array(np.array(piece, np.int64) * capacity),
                     pa.array([len(x) // 4 for x in ids], pa.int32()), pa.array(ids, pa.binary())],
                    ["row", "piece", "start", "length", "ids"])

    return src.mapInArrow(run, schema)


class Bins:
    """Open sequences by room left, for best fit: a bit set of the rooms that occur and a stack for each."""

    def __init__(self, capacity: int, room: dict[int, int]):
        self.capacity, self.stacks, self.mask = capacity, {}, 0
        for b, r in room.items():
            self.put(b, r)

    def put(self, b: int, room: int) -> None:
        if room:
            self.stacks.setdefault(room, []).append(b)
            self.mask |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """The open sequence with the least room of ``size`` at least."""
        m = self.mask >> size
        if not m:
            return None
        room = size + (m & -m).bit_length() - 1
        stack = self.stacks[room]
        b = stack.pop()
        if not stack:
            self.mask &= ~(1 << room)
        return b, room


def best_fit(lengths: list[int], order: list[int], group: np.ndarray, room: dict[int, int], free: int, capacity: int) -> int:
    """Put the pieces of ``order`` into open sequences, or new ones from number ``free`` on; returns the next free number."""
    bins = Bins(capacity, room)
    for i in order:
        got = bins.take(lengths[i])
        if got is None:
            got = free, capacity
            free += 1
        group[i] = got[0]
        bins.put(got[0], got[1] - lengths[i])
    return free


def fitness(group: np.ndarray, lengths: np.ndarray) -> tuple[int, float]:
    """Fewer sequences first, then uneven fill (mean square): smaller is better."""
    fill = np.bincount(group, lengths)
    fill = fill[fill > 0]
    return len(fill), -float((fill * fill).sum())


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, sizes: list[int], capacity: int, rng: random.Random) -> np.ndarray:
    """Inject well-filled sequences of ``a`` into ``b``."""
    fill = np.bincount(a, lengths)
    full = np.argsort(-fill, kind="stable")[:max(1, int((fill > 0).sum()) // 2)]
    start = rng.randrange(len(full))
    chosen = np.zeros(len(fill), bool)
    chosen[np.roll(full, -start)[:max(1, int(INJECTED * 2 * len(full)))]] = True
    injected = chosen[a]
    child = b.copy()
    broken = np.zeros(int(b.max()) + 1, bool)
    broken[b[injected]] = True
    displaced = np.flatnonzero(broken[b] & ~injected)
    base = int(b.max()) + 1
    child[injected] = base + a[injected]
    fill_b = np.bincount(b, lengths)
    open_bins = {int(k): capacity - int(fill_b[k]) for k in np.flatnonzero((fill_b > 0) & (fill_b < capacity) & ~broken)}
    fill_a = fill.astype(np.int64)
    open_bins.update({base + int(k): capacity - int(fill_a[k]) for k in np.flatnonzero(chosen & (fill_a < capacity))})
    order = displaced[np.argsort(-lengths[displaced], kind="stable")].tolist()
    best_fit(sizes, order, child, open_bins, base + len(fill), capacity)
    return np.unique(child, return_inverse=True)[1].astype(np.int64)


def first_groupings(lengths: np.ndarray, n: int, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit in falling order of length, the first exactly, the others with noise."""
    out, sizes = [], lengths.tolist()
    for k in range(n):
        order = np.argsort(-(lengths * (1 if k == 0 else rng.uniform(0.9, 1.1, len(lengths)))), kind="stable").tolist()
        group = np.zeros(len(lengths), np.int64)
        best_fit(sizes, order, group, {}, 0, capacity)
        out.append(group)
    return out


def evolve(groups: list[np.ndarray], lengths: np.ndarray, capacity: int, generations: int, seed: int) -> list[np.ndarray]:
    """Steady state: each child replaces the worst if it is better; ends early at the lower bound."""
    rng, sizes = random.Random(seed), lengths.tolist()
    least = -(-int(lengths.sum()) // capacity)
    pool = sorted(((fitness(g, lengths), g) for g in groups), key=lambda x: x[0])[:POPULATION]
    for _ in range(generations):
        if pool[0][0][0] <= least:
            break
        i, j = sorted(rng.sample(range(len(pool)), 2)) if len(pool) > 1 else (0, 0)
        for a, b in ((i, j), (j, i)):
            child = crossover(pool[a][1], pool[b][1], lengths, sizes, capacity, rng)
            score = fitness(child, lengths)
            if score < pool[-1][0] and all(score != s for s, _ in pool):
                pool = sorted([*pool[:-1], (score, child)], key=lambda x: x[0])
    return [g for _, g in pool]


STATE = "block long, island int, lengths binary, groups array<binary>"


def _state(block: int, islands: list[int], lengths: np.ndarray, groups: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({"block": pa.array([block] * len(islands), pa.int64()), "island": pa.array(islands, pa.int32()),
                     "lengths": pa.array([lengths.astype("<u4").tobytes()] * len(islands), pa.binary()),
                     "groups": pa.array([[g.astype("<u2").tobytes() for g in gs] for gs in groups], pa.list_(pa.binary()))})


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES,
         islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, seed: int = 7) -> DataFrame:
    """The rows of ``items`` as struct ``item``, with ``sequence_id`` and ``offset``.  Lengths are from 1 to ``capacity``."""
    if block_pieces > 60_000:
        raise ValueError("block_pieces is 60000 at most")
    src = items.select(F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("item"),
                       F.col(f"`{length_col}`").cast("int").alias("n"), F.monotonically_increasing_id().alias("uid"))
    src = ch.write_table(src, "pieces")
    counts = src.agg(F.count("*").alias("all"), F.count_if(F.col("n") < capacity).alias("part")).first()
    blocks = max(1, -(-counts["part"] // (block_pieces * 15 // 16)))  # the hash deals unevenly by a few hundredths
    whole = src.where(F.col("n") >= capacity).select("item", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    dealt = src.where(F.col("n") < capacity).withColumn("block", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(blocks)))

    def evolved(block, island, epoch, groups, lengths):
        return evolve(groups, lengths, capacity, generations, hash((seed, block, island, epoch)))

    def begin(key, got):
        block = key[0].as_py()
        lengths = got.sort_by("uid")["n"].to_numpy().astype(np.int64)
        homes = []
        for i in range(islands):
            rng = np.random.default_rng([seed, block, i])
            homes.append(evolved(block, i, 0, first_groupings(lengths, POPULATION, capacity, rng), lengths))
        return send(block, range(islands), lengths, homes)

    def send(block, at, lengths, homes):
        """Each island's population stays; its elite also goes to the next island."""
        return pa.concat_tables([_state(block, list(at), lengths, homes),
                                 _state(block, [(i + 1) % islands for i in at], lengths, [h[:1] for h in homes])])

    def later(epoch):
        def fn(key, got):
            block, island = (k.as_py() for k in key)
            lengths = np.frombuffer(got["lengths"][0].as_py(), "<u4").astype(np.int64)
            groups = sorted({x for r in got["groups"].to_pylist() for x in r})
            groups = [np.frombuffer(x, "<u2").astype(np.int64) for x in groups]
            return send(block, [island], lengths, [evolved(block, island, epoch, groups, lengths)])

        return fn

    state = dealt.select("block", "uid", "n").groupBy("block").applyInArrow(begin, STATE)
    for e in range(1, epochs):
        state = state.groupBy("block", "island").applyInArrow(later(e), STATE)

    def best(key, got):
        lengths = np.frombuffer(got["lengths"][0].as_py(), "<u4").astype(np.int64)
        groups = sorted({r[0] for r in got["groups"].to_pylist()})
        groups = [np.frombuffer(x, "<u2").astype(np.int64) for x in groups]
        win = min(groups, key=lambda g: fitness(g, lengths))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "best": pa.array([win.astype("<u2").tobytes()], pa.binary())})

    won = state.groupBy("block").applyInArrow(best, "block long, best binary")

    def place(key, got, win):
        got = got.sort_by("uid")
        group = np.frombuffer(win["best"][0].as_py(), "<u2").astype(np.int64)
        n = got["n"].to_numpy().astype(np.int64)
        order = np.lexsort((np.arange(len(n)), group))
        ends = np.cumsum(n[order])
        first = np.concatenate([[True], group[order][1:] != group[order][:-1]])
        begin_at = (ends - n[order])[first][np.cumsum(first) - 1]
        offset = np.empty(len(n), np.int64)
        offset[order] = ends - n[order] - begin_at
        return pa.table({"item": got["item"], "sequence_id": pa.array((key[0].as_py() << 16) + group), "offset": pa.array(offset)})

    item = src.schema["item"].dataType.simpleString()
    placed = dealt.groupBy("block").cogroup(won.groupBy("block")).applyInArrow(place, f"item {item}, sequence_id long, offset long")
    return placed.unionByName(whole)


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document: id, ``piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = pieces(docs.select(id_col, text_col), tokenizer_path, text_col)
    cut = cut.select(F.col(f"row.`{id_col}`").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"),
                     F.crc32("ids").alias("ids_crc32"))
    return pack(cut).select("item.*", "sequence_id", "offset")
